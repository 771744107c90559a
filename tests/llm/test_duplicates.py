import hashlib
import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from keyflow.llm import graph, neardup, suffixes
from keyflow.llm.shingles import distinct_shingles
from .conftest import rows


def ngrams(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def classes(texts, width, percent):
    sets = [ngrams(t, width) for t in texts]
    up = list(range(len(sets)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[max(top(i), top(j))] = min(top(i), top(j))
    return [(i, len(s), top(i)) for i, s in enumerate(sets)]


def family(pick, n, length, most):
    """Variants of one text that differ in up to ``most`` of its words."""
    words = [f"v{pick.randrange(10_000)}" for _ in range(length)]
    out = []
    for k in range(n):
        own = list(words)
        for _ in range(pick.randrange(most + 1)):
            own[pick.randrange(length)] = f"n{k}x{pick.randrange(6)}"
        out.append(" ".join(own))
    return out


def test_components_match_all_pairs(spark, docs):
    pick = random.Random(5)
    texts = [*family(pick, 60, 60, 6), *family(pick, 25, 200, 14), *family(pick, 20, 12, 1), *family(pick, 8, 3, 1)]
    texts += [" ".join(f"u{k}w{i}" for i in range(40)) for k in range(30)]
    texts += texts[:10] + [t.upper() for t in texts[10:15]] + [None, "", " \t", "a a a a a a", "a a a a", "one", "One", "one\ttwo"]
    # A chain in which only neighbours are similar.
    texts += [" ".join(f"c{i}" for i in range(4 * k, 4 * k + 60)) for k in range(12)]
    pick.shuffle(texts)
    for width, percent in ((4, 85), (5, 80)):
        got = rows(neardup.join(docs(*texts), width=width, percent=percent))
        assert got == sorted(classes(texts, width, percent))


def boilerplate(n):
    """Texts of 5 of 30 blocks of 40 words: each n-gram is in many of them, and hardly any two are similar."""
    pick = random.Random(11)
    blocks = [" ".join(f"b{k}w{i}" for i in range(40)) for k in range(30)]
    return [" ".join(pick.sample(blocks, 5)) for _ in range(n)]


def test_shared_blocks_make_few_candidates(spark, docs, monkeypatch):
    counts = []

    def counted(pairs, *rest, linked=neardup._linked):
        counts.append(pairs.count())
        return linked(pairs, *rest)

    monkeypatch.setattr(neardup, "_linked", counted)
    texts = boilerplate(600)
    assert rows(neardup.join(docs(*texts))) == sorted(classes(texts, 4, 85))
    assert sum(counts) < 600


def test_fragments_cut_the_order_into_like_parts(spark):
    grams = [[(level << neardup.HASH_BITS) + k * (1 << 50) for level in (4, 8, 9, 20) for k in range(n)] for n in (5, 9, 16)]
    sets = spark.createDataFrame([(i, len(g), sorted(g)) for i, g in enumerate(grams)], "rep long, n long, grams array<long>")
    cuts = neardup._cuts(sets)
    assert len(cuts) == neardup.FRAGMENTS - 1
    segments = neardup._cut(sets, cuts).collect()
    assert sorted(g for r in segments for g in r["g"]) == sorted(sum(grams, []))
    sizes = [sum(len(r["g"]) for r in segments if r["f"] == f) for f in range(neardup.FRAGMENTS)]
    assert max(sizes) <= 2 * min(sizes)
    highest = [max(g for r in segments if r["f"] == f for g in r["g"]) for f in range(neardup.FRAGMENTS)]
    assert all(min(r["g"]) > highest[r["f"] - 1] for r in segments if r["f"])
    assert neardup._cuts(sets.limit(0)) == [] and neardup._cut(sets.limit(0), []).count() == 0


def test_one_document_of_each_group_stays(spark, docs):
    pick = random.Random(7)
    texts = [*family(pick, 30, 80, 3), "lone words that nobody else has at all", None, "", "twice twice", "twice twice"]
    df = docs(*texts)
    out = neardup.one_of_each(df)
    assert out.columns == df.columns
    kept = [r["doc_id"] for r in out.collect()]
    found = classes(texts, 5, 80)
    assert len(kept) == len(set(kept)) == len({c for _, _, c in found})
    assert {found[i][2] for i in kept} == {c for _, _, c in found}


def test_near_duplicates_in_odd_rows(spark, odd):
    got = rows(neardup.join(odd))
    assert got == [
        (None, 0, None), (None, 1, None), (1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (4, 1, 4), (4, 1, 4), (5, 29_997, 5)
    ]
    kept = neardup.one_of_each(odd)
    assert kept.columns == odd.columns and kept.count() == odd.count() - 1
    assert neardup.join(odd.limit(0)).count() == 0 and neardup.one_of_each(odd.limit(0)).count() == 0


@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \n\x1c\u00a0", max_size=30)), max_size=12), st.integers(1, 5))
@settings(max_examples=150, deadline=None)
def test_shingles_of_many_texts_match_those_of_one(texts, width):
    hashes, bounds = distinct_shingles(texts, width)
    seen = {}
    for text, s, e in zip(texts, bounds, bounds[1:]):
        want = ngrams(text, width)
        assert e - s == len(want)
        assert seen.setdefault(want, hashes[s:e].tolist()) == hashes[s:e].tolist()
    different = {h for hs in seen.values() for h in hs}
    assert len(different) == len({g for want in seen for g in want})


def test_components_of_links(spark):
    pick = random.Random(1)
    links = [(i, i + 1) for i in range(0, 40)] + [(100 + i, 100) for i in range(1, 30)] + [(200, 200), (301, 300)]
    pick.shuffle(links)
    got = {r["node"]: r["label"] for r in graph.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 200, 300: 300, 301: 300}
    assert got == want
    assert graph.components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def removed(table, length=50):
    """All strings of the length, judged one by one."""
    first = {}
    for key, text in table:
        body = (text or "").encode()
        for i in range(len(body) - length + 1):
            part = body[i : i + length]
            first[part] = min(first.get(part, suffixes.LAST), suffixes.LAST if key is None else key)
    out = []
    for key, text in table:
        body = (text or "").encode()
        gone = bytearray(len(body))
        for i in range(len(body) - length + 1):
            if first[body[i : i + length]] < (suffixes.LAST if key is None else key):
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(body, gone) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        out.append((key, len(body), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("seed", range(3))
def test_removed_bytes_match_all_strings(spark, docs, seed):
    pick = random.Random(seed)
    passages = ["".join(pick.choice("abcd é") for _ in range(pick.randrange(30, 140))) for _ in range(6)]
    passages += ["ab" * 60, "x" * 130]
    table = []
    for k in range(60):
        parts = []
        for _ in range(pick.randrange(4)):
            source = pick.choice(passages)
            s = pick.randrange(len(source))
            parts.append(pick.choice([source, source[s:], source[:s]]))
            parts.append("".join(pick.choice("abcd ") for _ in range(pick.randrange(40))))
        table.append((pick.choice([k, 1000 - k, k // 2]), "".join(parts)))
    table += [(None, passages[0]), (None, passages[0]), (7, None), (8, ""), (9, passages[1]), (9, passages[1]), (10, "y" * 49)]
    pick.shuffle(table)
    assert rows(suffixes.deduplicate(docs(*table))) == removed(table)


def test_suffixes_of_odd_rows(spark, odd):
    got = rows(suffixes.deduplicate(odd), "doc_id", "n_bytes", "n_removed")
    assert len(got) == odd.count() and all(g[2] == 0 for g in got)
    assert suffixes.deduplicate(odd.limit(0)).count() == 0


def test_equal_strings_have_equal_anchors():
    pick = random.Random(2)
    shared = bytes(pick.randrange(97, 101) for _ in range(120))
    bodies = [bytes(pick.randrange(97, 101) for _ in range(n)) + shared + b"zz" for n in (0, 3, 40)]
    c = suffixes.Chunk.of(bodies, np.arange(3))
    inside = []
    for k, body in enumerate(bodies):
        start = c.starts[k] + body.index(shared)
        mine = c.anchors[c.owner == k] - start
        inside.append(set(mine[(mine >= 24) & (mine <= 70)].tolist()))
    assert inside[0] == inside[1] == inside[2] and inside[0]
