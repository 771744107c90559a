"""Approximate nearest neighbours by inner product: random-projection trees, one queue over all of them, exact reranking."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.llm.common import numbered, written
from keyflow.llm.vectors import best, finite, matrix
from keyflow.plans.saltjoin import skew_join
from keyflow.plans.spread import spread

# Vectors that one task holds to search in, and queries that it searches for at once.
VECTORS_PER_BLOCK = 16_384
QUERIES_PER_BLOCK = 16_384
# Scores worked out at once.
SCORES = 1_000_000


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth. Node 0 is a root, the children of node n are 2n + 1 and 2n + 2.

    Inner products are searched as distances: with a further component that brings all vectors to one length, the
    nearest vectors to a query without it are those of the largest inner product.
    """

    normals: np.ndarray  # trees by inner nodes by width + 1
    cuts: np.ndarray  # trees by inner nodes
    depth: int
    scale: float  # vectors are divided by this
    leaves: int  # how many a query visits

    @property
    def trees(self) -> int:
        return len(self.cuts)

    def lifted(self, vectors: np.ndarray) -> np.ndarray:
        scaled = vectors / self.scale
        rest = np.sqrt(np.maximum(0, 1 - (scaled**2).sum(axis=1)))
        return np.concatenate([scaled, rest[:, None]], axis=1)

    def aimed(self, queries: np.ndarray) -> np.ndarray:
        length = np.maximum(np.linalg.norm(queries / self.scale, axis=1, keepdims=True), 1e-300)
        return np.concatenate([queries / self.scale / length, np.zeros((len(queries), 1))], axis=1)

    def place(self, vectors: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree; leaves are numbered 0, 1, ... through all trees."""
        lifted = self.lifted(vectors)
        out = np.empty((len(vectors), self.trees), np.int32)
        for t in range(self.trees):
            node = np.zeros(len(vectors), np.int64)
            for _ in range(self.depth):
                side = (lifted * self.normals[t, node]).sum(axis=1) > self.cuts[t, node]
                node = 2 * node + 1 + side
            out[:, t] = node - (2**self.depth - 1) + t * 2**self.depth
        return out

    def visit(self, queries: np.ndarray, sizes: np.ndarray | None = None, least: int = 0) -> Iterator[list[int]]:
        """The leaves that each query visits: one queue holds the open nodes of all trees, the nearest comes first.

        How near a node is follows from the squares of the margins by which the query misses it on the way down. A
        query goes on beyond its number of leaves until those of some tree hold ``least`` vectors, by the ``sizes``.
        """
        inner = 2**self.depth - 1
        for query in self.aimed(queries):
            margins = (self.normals @ query - self.cuts).tolist()
            queue = [(0.0, t, 0) for t in range(self.trees)]
            met, out = [0] * self.trees, []
            while queue and (len(out) < self.leaves or max(met) < least):
                missed, t, node = heapq.heappop(queue)
                if node >= inner:
                    out.append(node - inner + (t << self.depth))
                    met[t] += 0 if sizes is None else int(sizes[out[-1]])
                    continue
                margin = margins[t][node]
                near, far = (2 * node + 2, 2 * node + 1) if margin > 0 else (2 * node + 1, 2 * node + 2)
                heapq.heappush(queue, (missed, t, near))
                heapq.heappush(queue, (missed + margin * margin, t, far))
            yield out


def _grow(lifted: np.ndarray, trees: int, depth: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Random directions, each cut at the median of the sample's vectors that come to its node."""
    draw = np.random.default_rng(seed)
    inner, width = 2**depth - 1, lifted.shape[1]
    normals = draw.normal(size=(trees, inner, width))
    normals /= np.linalg.norm(normals, axis=2, keepdims=True)
    cuts = np.zeros((trees, inner))
    for t in range(trees):
        members = {0: np.arange(len(lifted))}
        for node in range(inner):
            here = members.pop(node)
            along = lifted[here] @ normals[t, node]
            cuts[t, node] = np.median(along) if len(along) else 0.0
            right = along > cuts[t, node]
            members[2 * node + 1], members[2 * node + 2] = here[~right], here[right]
    return normals, cuts


def fit(
    sample: np.ndarray, k: int, total: int, trees: int = 4, per_leaf: int = 128, most_leaves: int = 1024,
    recall: float = 0.95, asked: int = 256, seed: int = 7,
) -> Forest:
    """A forest for ``total`` vectors from a sample of them, and the number of leaves to visit for a recall.

    That number is the smallest with which ``asked`` vectors of the sample find the share ``recall`` of their ``k``
    nearest in the sample, by comparison with all of it. Among more vectors the nearest are nearer, and found sooner.
    """
    largest = max(float(np.abs(sample).max(initial=0)), 1e-300)
    scale = largest * max(float(np.linalg.norm(sample / largest, axis=1).max(initial=0)), 1e-300)
    depth = max(0, round(math.log2(max(1, min(most_leaves, total / per_leaf, len(sample) / 4)))))
    none = np.zeros((trees, 0, sample.shape[1] + 1)), np.zeros((trees, 0))
    normals, cuts = _grow(Forest(*none, 0, scale, trees).lifted(sample), trees, depth, seed)
    all_leaves = Forest(normals, cuts, depth, scale, trees << depth)
    if len(sample) <= k or not depth:
        return all_leaves
    placed = all_leaves.place(sample)
    picked = np.random.default_rng(seed).permutation(len(sample))[:asked]
    needed = []
    for at, order in zip(picked, all_leaves.visit(sample[picked])):
        scores = sample @ sample[at]
        scores[at] = -np.inf
        nearest = np.argpartition(-scores, k - 1)[:k]
        turn = np.empty(trees << depth, np.int64)
        turn[order] = np.arange(1, len(order) + 1)
        needed.append(turn[placed[nearest]].min(axis=1))  # visits until each of them is met
    leaves = int(np.quantile(np.concatenate(needed), recall, method="higher"))
    return Forest(normals, cuts, depth, scale, leaves)


def _blocks(sizes: np.ndarray, per_tree: int) -> tuple[np.ndarray, np.ndarray]:
    """Per leaf the first block that holds it and how many do: small neighbours share one, a large leaf fills several."""
    first, several = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    block, filled = 0, 0
    for leaf, n in enumerate(sizes.tolist()):
        if filled and (filled + n > VECTORS_PER_BLOCK or leaf % per_tree == 0):  # a vector is in a block once
            block, filled = block + 1, 0
        first[leaf], several[leaf] = block, max(1, -(-n // VECTORS_PER_BLOCK))
        if several[leaf] > 1:
            block, filled = block + int(several[leaf]), 0
        else:
            filled += n
    return first, several


def search(
    df: DataFrame,
    asks: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    most_sampled: int = 32_768,
    **fitting: float,
) -> DataFrame:
    """For each row for which ``asks`` holds, ``k`` other rows of (nearly) the largest inner product with it.

    Returns ``query_id``, ``rank`` (1, 2, ... by falling score, ties to smaller keys, null keys last), ``vec_id`` and
    ``score``, the inner product in doubles, added up from the first component to the last.

    Rows whose vector is null or zero or holds null or non-finite components take no part. Shorter vectors count as
    continued by zeros. Repeated rows are rows of their own; only the query's own row is left out. With ``k`` or fewer
    other rows all are returned. No rows or no queries give no rows; other columns are not looked at.

    The forest is fitted on about ``most_sampled`` vectors at most (see :func:`fit`), and every vector is filed in it.
    Equal vectors are searched and found as one, standing for the ``k + 1`` rows of the smallest keys. Leaves are
    gathered in blocks, and a leaf with too many vectors for one is dealt over several; so are the queries of a block.
    """
    spark = df.sparkSession
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"), asks.alias("asks"))
    # Adding 0 makes no difference between 0 and -0.
    rows = rows.withColumn("vector", F.transform("vector", lambda x: x + F.lit(0.0)))
    rows = rows.where(finite(F.col("vector")) & F.exists("vector", lambda x: x != 0))
    rows = written(numbered(spread(rows), "row").withColumn("asks", F.coalesce("asks", F.lit(False))), "rows")
    vectors = _distinct(rows, k)
    count, width = vectors.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not count:
        return spark.createDataFrame([], RESULT)
    picked = F.pmod(F.xxhash64("v"), F.lit(1 << 20)) < F.lit((1 << 20) * min(1.0, most_sampled / count))
    sample = matrix(vectors.where(picked).select("vector").toArrow()["vector"], width)
    forest = fit(sample, k, count, **fitting)
    found = _found(vectors, forest, k + 1, width)
    return _answers(rows, vectors, found, k)


RESULT = "query_id long, rank int, vec_id long, score double"


def _distinct(rows: DataFrame, k: int) -> DataFrame:
    """The different vectors: a number ``v``, the first rows by key as ``ids``, and whether a query has it.

    Ranks are cut to the first rows in each task before any shuffle, so a vector that most rows share costs no more.
    """
    order = Window.partitionBy("vector", "asks").orderBy(F.col("id").asc_nulls_last(), "row")
    firsts = rows.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    entry = F.struct(F.col("id").isNull().alias("keyless"), "id", "row")
    grouped = firsts.groupBy("vector").agg(
        F.slice(F.array_sort(F.collect_list(entry)), 1, k + 1).alias("ids"), F.max("asks").alias("asked")
    )
    return written(numbered(grouped, "v"), "vectors")


def _found(vectors: DataFrame, forest: Forest, keep: int, width: int) -> DataFrame:
    """Per query vector (``query``), the first ``keep`` vectors that are met: their ``score`` and ``ids``."""
    spark = vectors.sparkSession
    sent = spark.sparkContext.broadcast(forest)  # bounded by the number and depth of the trees

    def file(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            placed = sent.value.place(matrix(batch.column("vector"), width))
            offsets = np.arange(len(placed) + 1, dtype=np.int32) * placed.shape[1]
            leaves = pa.ListArray.from_arrays(pa.array(offsets), pa.array(placed.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, leaves], [*batch.schema.names, "leaves"])

    filed = vectors.select("v", "vector", "ids")
    filed = filed.mapInArrow(file, T.StructType([*filed.schema, T.StructField("leaves", T.ArrayType(T.IntegerType()))]))
    filed = written(filed, "leaves")
    sizes = np.zeros(forest.trees << forest.depth, np.int64)
    for row in filed.select(F.explode("leaves").alias("leaf")).groupBy("leaf").count().collect():  # a row a leaf
        sizes[row["leaf"]] = row["count"]
    layout = spark.sparkContext.broadcast((*_blocks(sizes, 1 << forest.depth), sizes))
    asking = vectors.where("asked").select(F.col("v").alias("query"), F.col("vector").alias("aim"))
    chunks = max(1, -(-asking.count() // QUERIES_PER_BLOCK))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, several, sizes = layout.value
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                batch = whole.slice(at, 256)
                blocks, owner, visited = [], [], []
                for i, leaves in enumerate(sent.value.visit(matrix(batch.column("aim"), width), sizes, keep + 1)):
                    by: dict[int, list[int]] = {}
                    for leaf in leaves:
                        for block in range(first[leaf], first[leaf] + several[leaf]):
                            by.setdefault(block, []).append(leaf)
                    blocks += by.keys()
                    owner += [i] * len(by)
                    visited += by.values()
                given = batch.take(pa.array(owner, pa.int32()))
                columns = [pa.array(blocks, pa.int64()), pa.array(visited, pa.list_(pa.int32())), *given.columns]
                yield pa.RecordBatch.from_arrays(columns, ["block", "visited", "query", "aim"])

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, several, _ = layout.value
        for batch in batches:
            leaves = batch.column("leaves").flatten().to_numpy().reshape(batch.num_rows, -1)
            v = batch.column("v").to_numpy()
            for t in range(leaves.shape[1]):
                block = first[leaves[:, t]] + v % several[leaves[:, t]]
                columns = [pa.array(block), pa.array(leaves[:, t]), batch.column("vector"), batch.column("ids")]
                yield pa.RecordBatch.from_arrays(columns, ["block", "leaf", "vector", "ids"])

    asked = spread(asking).mapInArrow(ask, "block long, visited array<int>, query long, aim array<double>")
    asked = asked.withColumn("chunk", F.pmod(F.xxhash64("query"), F.lit(chunks)).cast("int"))
    kinds = T.StructType().add("block", T.LongType()).add("leaf", T.IntegerType())
    dealt = filed.mapInArrow(deal, T.StructType([*kinds, filed.schema["vector"], filed.schema["ids"]]))
    dealt = dealt.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))))

    def compare(of: pa.Table, to: pa.Table) -> pa.Table:
        query, at, score = _compare(of, to, width, keep)
        return pa.table({"query": query, "score": score, "ids": to["ids"].take(pa.array(at))})

    kinds = T.StructType().add("query", T.LongType()).add("score", T.DoubleType())
    pairs = asked.groupBy("block", "chunk").cogroup(dealt.groupBy("block", "chunk"))
    pairs = pairs.applyInArrow(compare, T.StructType([*kinds, filed.schema["ids"]])).withColumn("head", F.col("ids")[0])
    # A vector that is met in several trees has the same place each time.
    order = Window.partitionBy("query").orderBy(F.desc("score"), "head")
    return pairs.withColumn("place", F.dense_rank().over(order)).where(F.col("place") <= keep).dropDuplicates(["query", "place"])


def _compare(of: pa.Table, to: pa.Table, width: int, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Query, place of a vector, and score: of each query the first ``keep`` in the leaves of a block that it visits."""
    empty = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    if not of.num_rows or not to.num_rows:
        return empty
    queries, vectors = matrix(of["aim"], width), matrix(to["vector"], width)
    heads = [ids[0] for ids in to["ids"].to_pylist()]
    turn = np.empty(len(heads), np.int64)  # ties go by the smallest key that a vector stands for
    turn[sorted(range(len(heads)), key=lambda i: (heads[i]["keyless"], heads[i]["id"] or 0, heads[i]["row"]))] = range(len(heads))
    leaf = to["leaf"].to_numpy()
    order = np.argsort(leaf, kind="stable")
    leaf = leaf[order]
    visited = of["visited"].combine_chunks()
    asker = np.repeat(np.arange(of.num_rows), np.diff(visited.offsets.to_numpy()))
    wanted = visited.flatten().to_numpy()
    by = np.argsort(wanted, kind="stable")
    asker, wanted = asker[by], wanted[by]
    least = np.full(of.num_rows, -np.inf)  # the score of the last that is kept so far
    held, kept = empty, 0
    for here in np.unique(wanted):
        start, end = np.searchsorted(leaf, [here, here + 1])
        first, last = np.searchsorted(wanted, [here, here + 1])
        place = order[start:end]
        step = max(1, SCORES // max(1, len(place)))
        for at in range(first, last, step):
            asking = asker[at : min(last, at + step)]
            rough = queries[asking] @ vectors[place].T
            # Sums in another order may differ a little.
            i, j = np.nonzero(rough >= (least[asking] - 1e-9 * np.abs(np.nan_to_num(least[asking], neginf=0)))[:, None])
            who, what = asking[i], place[j]
            held = tuple(np.concatenate(x) for x in zip(held, (who, what, _inner(queries, who, vectors, what))))
            if len(held[0]) > 2 * kept + SCORES // 4:
                held = _cut(held, turn, least, keep)
                kept = len(held[0])
    who, what, score = _cut(held, turn, least, keep)
    return of["query"].to_numpy()[who], what, score


def _inner(left: np.ndarray, i: np.ndarray, right: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Inner products of pairs of rows, added up from the first component to the last."""
    score = np.zeros(len(i))
    for d in range(left.shape[1]):
        score += left[i, d] * right[j, d]
    return score


def _cut(held: tuple[np.ndarray, ...], turn: np.ndarray, least: np.ndarray, keep: int) -> tuple[np.ndarray, ...]:
    """The first ``keep`` entries of each query, which raise what a further one must reach."""
    who, what, score = held
    first = best(who, score, [turn[what]], keep)
    who, what, score = who[first], what[first], score[first]
    start = np.flatnonzero(np.diff(who, prepend=-1))
    full = np.diff(np.append(start, len(who))) == keep
    least[who[start[full]]] = score[start[full] + keep - 1]
    return who, what, score


def _answers(rows: DataFrame, vectors: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The rows that the vectors found stand for, without the query's own."""
    each = found.select("query", "score", F.explode("ids").alias("entry"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    each = each.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    answer = F.struct("place", F.col("entry.id").alias("id"), F.col("entry.row").alias("row"), "score")
    lists = each.groupBy("query").agg(F.array_sort(F.collect_list(answer)).alias("answers"))  # k + 1 at most
    lists = written(vectors.select(F.col("v").alias("query"), "vector").join(lists, "query").select("query", "vector", "answers"), "answers")
    asking = rows.where("asks").select("row", F.col("id").alias("query_id"), "vector")
    joined = skew_join(asking, lists, ["vector"], ["row"], ["query"])
    others = F.slice(F.filter("answers", lambda a: a["row"] != F.col("row")), 1, k)
    return joined.select("query_id", F.posexplode(others).alias("at", "other")).select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("other.id").alias("vec_id"), F.col("other.score").alias("score")
    )
