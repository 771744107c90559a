import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from keyflow.llm import queries, resampling
from .conftest import rows

SF_DIR = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, least, most):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [" ".join(words[i : i + n]) for n in range(least, most + 1) for i in range(len(words) - n + 1)]


def plain(documents, items, least, most, buckets, min_words, percent):
    def count(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t, least, most)[1])

    source, target = count(t for _, t in documents), count(items)
    s, t = sum(source.values()), sum(target.values())
    gain = [
        math.floor(1000 * math.log((target[b] + 1) * (s + buckets) / ((source[b] + 1) * (t + buckets)))) for b in range(buckets)
    ]
    out, able = [], []
    for at, (key, text) in enumerate(documents):
        words, found = features(text, least, most)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(found), weight, score, None])
        if len(words) >= min_words:
            able.append((-score, key is None, key or 0, len(found), weight, at))
    for rank, entry in enumerate(sorted(able)[: len(able) * percent // 100], 1):
        out[entry[-1]][4] = rank
    return sorted(map(tuple, out), key=lambda r: [(v is not None, v) for v in r])


TEXTS = [
    "The cat, the CAT and\tthe hat;  the-end é 日本 x1\x00y\x7fz",
    "alpha beta gamma " * 30,
    "ÀÉ straße İ naïve blank \x1cword",
    " ".join(f"w{i % 7}" for i in range(200)),
    "a" * 300 + " " + "b" * 300 + "-" + "c" * 300,
    "one\ntwo\r\nthree  four     five",
]


@pytest.mark.parametrize("least, most", [(1, 1), (1, 3), (2, 2)])
def test_draw_matches_a_plain_one(spark, docs, least, most):
    texts = [(i, f"{TEXTS[i % len(TEXTS)]} extra{i % 5}") for i in range(60)]
    items = ["the cat and the hat", "alpha beta delta", "", None]
    target = spark.createDataFrame([(i, t) for i, t in enumerate(items)], "item_id long, text string")
    got = resampling.resample(docs(*texts), target, least=least, most=most, buckets=97, min_words=5, percent=30)
    assert rows(got) == plain(texts, items, least, most, 97, 5, 30)


def test_words_have_their_places():
    words = resampling.Words()
    for text in TEXTS:
        lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        assert [(m[0], m.span()) for m in WORD.finditer(lowered)] == words(text)
        assert all(lowered[a:b].split() for _, (a, b) in resampling.windows(words(text), 2))


def test_odd_rows(spark, odd):
    target = spark.createDataFrame([(1, "x y z")], "item_id long, text string")
    texts = [(r["doc_id"], r["text"]) for r in odd.collect()]
    got = resampling.resample(odd, target, min_words=1, percent=100)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows(got) == plain(texts, ["x y z"], 1, 1, 10_000, 1, 100)
    assert resampling.resample(odd.limit(0), target).count() == 0
    untargeted = resampling.resample(odd, target.limit(0), min_words=0, percent=100)
    assert rows(untargeted) == plain(texts, [], 1, 1, 10_000, 0, 100)
    with pytest.raises(ValueError):
        resampling.resample(odd, target, least=2, most=1)


def test_packed_counts_of_any_size():
    import numpy as np

    for flat in ([], [1, 2, 3, 4], [7, 2**40]):
        at, counts = resampling._unpack(resampling._pack(np.array(flat, np.int64)))
        assert [*at, *counts] == flat


@pytest.mark.parametrize("name", ["op11_resampling", "op13_negatives"])
def test_query_matches_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "benchmark", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    want = duck.execute(queries.oracle_sql()[name])
    names = [d[0] for d in want.description]
    got = queries.queries()[name](spark, SF_DIR)
    assert set(got.columns) == set(names)
    expected = sorted(want.fetchall(), key=lambda r: [(v is not None, v) for v in r])
    assert rows(got.select(*[F.col(n) for n in names])) == expected and expected
