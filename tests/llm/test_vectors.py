import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyflow.llm import negatives, neighbours, queries
from keyflow.llm.common import table
from .conftest import rows

VECTORS = "vec_id long, embedding array<float>, label int"
CLASH = ("row", "id", "v", "vector", "asks", "block", "leaf", "place", "cluster", "score", "rank", "query", "ids", "anchor")
NAN, INF = float("nan"), float("inf")


def usable(vector):
    return vector is not None and all(x is not None and math.isfinite(x) for x in vector)


def inner(a, b):
    total = 0.0
    for x, y in zip(a, b):
        total += float(np.float32(x)) * float(np.float32(y))
    return total


def nearest(data, k, asks):
    data = [(key, v) for key, v, _ in data if usable(v) and any(v)]
    out = []
    for i, (key, v) in enumerate(data):
        if key is not None and asks(key):
            others = [(-inner(v, w), other is None, other or 0, other) for j, (other, w) in enumerate(data) if j != i]
            out += [(key, rank, o[3], -o[0]) for rank, o in enumerate(sorted(others, key=lambda o: o[:3])[:k], 1)]
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


def hardest(data, positives, count, share, anchor):
    data = [(key, [math.floor(256 * float(np.float32(x))) for x in v], label) for key, v, label in data if usable(v) and label is not None]
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    place = lambda o: (-o[0], o[1] is None, o[1] or 0)
    out = []
    for i, (key, v, label) in enumerate(data):
        if key is None or not anchor(key):
            continue
        others = sorted([(score(v, w), other, tag) for j, (other, w, tag) in enumerate(data) if j != i], key=place)
        for p, positive, _ in [o for o in others if o[2] == label][:positives]:
            fit = [o for o in others if o[2] != label and share[0] * p <= 100 * o[0] <= share[1] * p][:count]
            out += [(key, positive, rank, o[1], p, o[0]) for rank, o in enumerate(fit, 1)]
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


def small(n, width, seed, copies=0):
    """Whole numbers of a few values, so that scores tie, and copies of one vector."""
    draw = np.random.default_rng(seed)
    made = [(int(i), [float(x) for x in draw.integers(-2, 3, width)], int(draw.integers(0, 3))) for i in draw.permutation(n)]
    return made + [(n + i, [1.0] * width, i % 3) for i in range(copies)]


ODD = [
    (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (100, [1.0, 2.0], 0), (None, [1.0, 2.0], 0), (None, [3.0, 1.0], 1),
    (7, None, 1), (8, [], 1), (9, [0.0, -0.0], 1), (20, [NAN, 1.0], 1), (21, [1.0, None], 1), (22, [INF, 1.0], 0),
    (40, [2.0, 2.0, 5.0], 0), (60, [2.0], 1), (61, [4.0, -1.0], None), (200, [-1.0, -1.0], 1), (300, [1.0, 1.0], 0),
    (9223372036854775807, [1.0, 2.0], 1), (-100, [1.5, 2.5], 0),
]


@pytest.fixture
def table_of(spark):
    def make(data):
        return spark.createDataFrame(data, VECTORS)

    return make


@pytest.mark.parametrize("data, k", [(ODD, 4), (ODD, 50), (small(120, 5, 3, copies=40), 7), ([], 3), (ODD[5:8], 3)])
def test_small_tables_are_searched_whole(table_of, data, k):
    df = table_of(data).withColumns({n: F.lit("clash") for n in CLASH})
    got = neighbours.search(df, F.col("vec_id") % 20 == 0, k=k)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows(got) == nearest(data, k, lambda key: key % 20 == 0)


def test_blocks_of_any_size_find_the_same(table_of, monkeypatch):
    data = small(600, 6, 5, copies=30)
    df = table_of(data)
    ask = F.col("vec_id") % 5 == 0
    whole = rows(neighbours.search(df, ask, k=5, per_leaf=20, recall=0.9))
    monkeypatch.setattr(neighbours, "VECTORS_PER_BLOCK", 7)
    monkeypatch.setattr(neighbours, "QUERIES_PER_BLOCK", 50)
    monkeypatch.setattr(neighbours, "SCORES", 64)
    assert rows(neighbours.search(df, ask, k=5, per_leaf=20, recall=0.9)) == whole
    # With all leaves visited, the result is exact.
    assert rows(neighbours.search(df, ask, k=5, per_leaf=20, recall=1.0, asked=600)) == nearest(data, 5, lambda key: key % 5 == 0)


def test_leaves_come_by_distance_and_hold_every_vector():
    draw = np.random.default_rng(2)
    sample = draw.normal(size=(500, 8)) * draw.random((500, 1)) * 5
    forest = neighbours.fit(sample, 5, 500, trees=3, per_leaf=30)
    placed = forest.place(sample)
    assert all((np.bincount(placed[:, t], minlength=3 << forest.depth)[t << forest.depth :][: 1 << forest.depth] > 0).all() for t in range(3))
    # Written out: the leaves sorted by the sum of the squared margins missed on the way to them.
    for query, visited in zip(sample[:20], forest.visit(sample[:20])):
        aim, cost = forest.aimed(query[None])[0], {}
        for t in range(3):
            todo = [(0, 0.0)]
            for node, missed in todo:
                if node >= 2**forest.depth - 1:
                    cost[node - 2**forest.depth + 1 + (t << forest.depth)] = missed
                    continue
                margin = float(forest.normals[t, node] @ aim - forest.cuts[t, node])
                todo += [(2 * node + 1, missed + (margin**2 if margin > 0 else 0)), (2 * node + 2, missed + (0 if margin > 0 else margin**2))]
        costs = sorted(cost.values())
        assert [cost[leaf] for leaf in visited] == pytest.approx(costs[: forest.leaves]) and len(set(visited)) == forest.leaves


@pytest.mark.parametrize("seed, lengths", [(1, False), (2, True)])
def test_recall_of_hard_and_of_uneven_vectors(table_of, seed, lengths):
    draw = np.random.default_rng(seed)
    made = draw.normal(size=(3000, 24)) * (draw.lognormal(size=(3000, 1)) if lengths else 1)
    data = [(i, [float(x) for x in v], 0) for i, v in enumerate(made.astype(np.float32))]
    got = neighbours.search(table_of(data), F.col("vec_id") % 20 == 0, per_leaf=64).collect()
    scores = made.astype(np.float32).astype(float) @ made.astype(np.float32).astype(float).T
    np.fill_diagonal(scores, -np.inf)
    want = {(q, int(v)) for q in range(0, 3000, 20) for v in np.argsort(-scores[q])[:20]}
    assert len(got) == len(want) and len(want & {(r["query_id"], r["vec_id"]) for r in got}) >= 0.9 * len(want)


def test_recall_on_the_given_table(spark):
    embeddings = table(spark, "/root/testdata/sf0.1", "embeddings")
    data = [(r["vec_id"], r["embedding"], 0) for r in embeddings.collect()]
    matrix = np.array([v for _, v, _ in data], np.float64)
    scores = matrix @ matrix.T
    np.fill_diagonal(scores, -np.inf)
    want = {(data[q][0], data[v][0]) for q in range(len(data)) if data[q][0] % 20 == 0 for v in np.argsort(-scores[q])[:20]}
    got = queries.op12_neighbours(spark, "/root/testdata/sf0.1").collect()
    assert len(got) == len(want) and len(want & {(r["query_id"], r["vec_id"]) for r in got}) >= 0.9 * len(want)


@pytest.mark.parametrize("data", [ODD, small(150, 4, 1, copies=30), [], ODD[5:8]])
@pytest.mark.parametrize("anchor_bytes", [32_000_000, 100])
def test_negatives_match_brute_force(table_of, data, anchor_bytes):
    df = table_of(data).withColumns({n: F.lit("clash") for n in CLASH})
    got = negatives.mine(df, F.col("vec_id") % 20 == 0, positives=3, negatives=4, anchor_bytes=anchor_bytes)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert rows(got) == hardest(data, 3, 4, (30, 90), lambda key: key % 20 == 0)


def test_lists_are_walked_only_as_far_as_needed(table_of, monkeypatch):
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(12, 16)) * 3
    data = [(i, [float(x) for x in np.float32(centres[i % 12] + draw.normal(size=16) * 0.2)], i % 12 // 4) for i in range(2400)]
    monkeypatch.setattr(negatives, "STRIDE", 16)
    got = negatives.mine(table_of(data), F.col("vec_id") % 50 == 0)
    assert rows(got) == hardest(data, 5, 10, (30, 90), lambda key: key % 50 == 0)
    vector = np.floor(256 * np.array([v for _, v, _ in data])).astype(np.int64)
    label, key = np.array([t for _, _, t in data]), np.arange(len(data))
    picked = np.flatnonzero(key % 50 == 0)
    centroids = negatives._centroids(vector[picked].astype(float))
    nearest_ = np.argmax(vector[picked] @ centroids.T, axis=1)
    picked, nearest_ = picked[np.argsort(nearest_, kind="stable")], np.sort(nearest_)
    wide = np.full((len(picked), 1), negatives.LARGEST)
    search = negatives.Search(negatives.Anchors(picked, picked, label[picked], vector[picked], nearest_, centroids, -wide, wide, True, 5))
    search.block(key, key, label, vector)
    assert search.looked_at < 0.5 * len(picked) * len(data)


def test_scores_beyond_exact_floats(table_of):
    data = [(0, [2.0**23, 1.0], 0), (1, [2.0**23, 1.0], 0), (2, [2.0**22, 3.0], 1), (3, [2.0**22, 2.0], 1)]
    got = negatives.mine(table_of(data), F.col("vec_id") == 0)
    assert rows(got) == hardest(data, 5, 10, (30, 90), lambda key: key == 0) and got.count() == 2
