import struct
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from keyflow.llm import packing, sharding
from keyflow.llm.vocabularies import tokenizer
from .conftest import rows


def best(key, weights):
    """Rendezvous hashing over plain numbers: the seed is the hash of the key, as Spark chains hashes."""

    def bid(shard):
        h = 42 if key is None else xxhash.xxh64_intdigest(struct.pack("<q", key), 42)
        h = xxhash.xxh64_intdigest(struct.pack("<i", shard), h)
        return -np.log(((h >> 11) + 0.5) / 2.0**53) / weights[shard], shard

    return min(bid(s) for s in range(len(weights)))[1]


def test_shards_follow_the_rule(spark):
    weights = [1.0, 2.0, 0.5, 1.0]
    keys = [None, *range(-50, 2000)]
    df = spark.createDataFrame([(k,) for k in keys], "k bigint").withColumn("s", sharding.rendezvous(F.col("k"), weights))
    got = {r["k"]: r["s"] for r in df.collect()}
    assert got == {k: best(k, weights) for k in keys}
    counts = Counter(got.values())
    assert abs(counts[1] / len(keys) - 2 / 4.5) < 0.05


def test_growth_moves_keys_only_into_the_new_shard(spark, docs):
    out = sharding.assign(docs(*[f"t{i}" for i in range(3000)]), weights=(1.0,) * 9, rows_per_chunk=100)
    got = out.collect()
    moved = [r for r in got if r["shard"] != r["grown_shard"]]
    assert {r["grown_shard"] for r in moved} == {9}
    assert 150 < len(moved) < 480
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        assert r["size"] == len(f"t{r['doc_id']}") + 16
        assert r["text_crc32"] == zlib.crc32(f"t{r['doc_id']}".encode())
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_shards_of_odd_rows(spark, odd):
    got = rows(sharding.assign(odd), "doc_id", "size", "text_crc32", "shard", "slot")
    assert len(got) == odd.count()
    assert [g[1:3] for g in got if g[0] == 1] == [(16, 0)]
    assert len({g[3] for g in got if g[0] == 4}) == 1
    assert len({g[3:] for g in got}) == len(got)
    assert sharding.assign(odd.limit(0)).count() == 0
    with pytest.raises(ValueError):
        sharding.rendezvous(F.lit(1), [1.0, 0.0])


@given(
    st.lists(st.integers(1, 64), max_size=300),
    st.sampled_from(["norm", "dot"]),
    st.integers(1, 20),
)
@settings(max_examples=60, deadline=None)
def test_every_capacity_holds(lengths, score, most):
    limits = packing.Limits(tokens=64, pieces=most, attention=64 * 64, score=score)
    sequence, offset, n = packing.best_fit(np.array(lengths, np.int64), limits)
    bins = defaultdict(list)
    for length, s, o in zip(lengths, sequence, offset):
        bins[s].append((o, length))
    assert sorted(bins) == list(range(n))
    for found in bins.values():
        at = 0
        for o, length in sorted(found):
            assert o == at
            at += length
        assert at <= 64 and len(found) <= most and sum(x * x for _, x in found) <= 64 * 64
    # Two sequences that are both at most half full, with room for each other's pieces, are never left open.
    half = [f for f in bins.values() if sum(x for _, x in f) <= 32 and len(f) <= most // 2]
    assert len(half) <= 1


def test_empty_documents_fill_sequences():
    _, _, n = packing.best_fit(np.array([1000] * 3 + [1] * 5000, np.int64), packing.Limits())
    assert n == -(-8000 // 1024)


def test_packed_documents_round_trip(spark, docs):
    import public_tokenizers
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    reader.encode_special_tokens = True
    texts = [
        "Hello world, it's 2024!  \n\n tabs\tand  spaces ",
        "",
        "ünïcödé 日本語 😀   ​ x" * 40,
        "word " * 3000,
        "a<|endoftext|>b",
        *[f"short {i}" * (i % 17) for i in range(200)],
    ]
    got = packing.pack(docs(*texts), *tokenizer(), pieces_per_block=100).collect()
    ids = {i: [*reader.encode(t, add_special_tokens=False).ids, 2] for i, t in enumerate(texts)}
    pieces = defaultdict(dict)
    sequences = defaultdict(list)
    for r in got:
        pieces[r["doc_id"]][r["piece"]] = r
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        mine = ids[r["doc_id"]][r["start"] : r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(mine, "<u4").tobytes())
    for doc, own in ids.items():
        parts = [pieces[doc][k] for k in range(len(pieces[doc]))]
        assert [p["start"] for p in parts] == [sum(q["length"] for q in parts[:k]) for k in range(len(parts))]
        assert sum(p["length"] for p in parts) == len(own)
        assert len(parts) == -(-len(own) // 1024) and all(p["length"] == 1024 for p in parts[1:])
    for found in sequences.values():
        found.sort()
        assert [o for o, _ in found] == [sum(n for _, n in found[:k]) for k in range(len(found))]
        assert sum(n for _, n in found) <= 1024
    total = sum(map(len, ids.values()))
    assert len(sequences) <= total // 1024 + 4


def test_queries_encode_added_tokens_as_the_file_does(spark, docs, tmp_path):
    import corpus_pipeline
    import public_tokenizers
    from keyflow.llm import queries
    from tokenizers import Tokenizer

    reader = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # at its defaults
    texts = ["a <|endoftext|> b", "<|endoftext|><|endoftext|>  x", "x  \n<|endoftext|>\n\n y <|endoftext|", "<|ENDOFTEXT|>", "plain"]
    table = docs(*texts)
    table.write.parquet(f"{tmp_path}/documents.parquet")
    for out in (queries.op2_packing(spark, str(tmp_path)), corpus_pipeline.pack_sequences(spark, table, "")):
        got = {r["doc_id"]: (r["length"], r["ids_crc32"]) for r in out.collect()}
        for i, text in enumerate(texts):
            ids = [*reader.encode(text, add_special_tokens=False).ids, 2]
            assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))


def test_packing_odd_rows(spark, odd):
    got = rows(packing.pack(odd, *tokenizer()), "doc_id", "piece", "length")
    assert (1, 0, 1) in got and (2, 0, 1) in got
    assert len([g for g in got if g[0] == 4]) == 3
    assert packing.pack(odd.limit(0), *tokenizer()).count() == 0
