"""Jaccard self-join on word n-grams by vertical partitioning, for components of near-copies."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.blocks import Blocks, answered, asked, blocks, in_order, understood
from keyflow.llm.common import ROW, numbered, sent, written
from keyflow.llm.graph import components
from keyflow.llm.shingles import distinct_shingles, mix

FRAGMENTS = 4  # into which the order of the n-grams is cut
SETS_PER_BLOCK = 1000
HASH_BITS = 56  # of an n-gram's place in the order; the bits above are the level of its count
MOST_LEVEL = 127
PLACE_BITS = 48  # left out when n-grams are counted for the cuts, which leaves 32,768 places
PARITIES = [f"p{i}" for i in range(4)]  # a set's n-grams by parity, 64 places each

SIGNED = "uid long, id long, n long, k1 long, k2 long, grams binary"
ORDERED = "rep long, n long, shared long, grams array<long>, " + ", ".join(f"{p} long" for p in PARITIES)


def _sets(rows: Blocks, width: int, percent: int) -> DataFrame:
    """Per row the size and signature of its set; of rows that could have a link also the n-grams found elsewhere."""
    # A text has an n-gram for about every six bytes.
    parts = rows.parts(6)

    def hashes_of(group: pa.Table) -> np.ndarray:
        return distinct_shingles(group["text"].to_pylist(), width)[0]

    def sign(key, group, answers):
        group = in_order(group)
        hashes, bounds = distinct_shingles(group["text"].to_pylist(), width)
        shared = understood(hashes, parts, answers) > 0 if len(hashes) else np.zeros(0, bool)
        with np.errstate(over="ignore"):
            keys = [mix(hashes + np.uint64(c)) for c in (1, 2)]
        sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(k)]) for k in keys]
        n = np.diff(bounds)
        grams = []
        for s, e in zip(bounds, bounds[1:]):
            mine = hashes[s:e][shared[s:e]]
            grams.append(mine.tobytes() if len(mine) and 100 * len(mine) >= percent * (e - s) else None)
        signature = [(x[bounds[1:]] - x[bounds[:-1]]).view(np.int64) for x in sums]
        arrays = [group["uid"], group["id"], pa.array(n, pa.int64()), *map(pa.array, signature), pa.array(grams, pa.binary())]
        return pa.table(arrays, ["uid", "id", "n", "k1", "k2", "grams"])

    by_block = rows.rows.groupBy("block")
    answers = answered(asked(by_block, hashes_of, parts))
    return by_block.cogroup(answers.groupBy("block")).applyInArrow(sign, SIGNED)


def _ordered(sets: DataFrame, percent: int) -> DataFrame:
    """Sets with their n-grams in one order for all, rare ones first; n-grams of a single set are left out.

    An n-gram is its place in the order: the level of its count, then its hash. The parities say for
    each of 256 places whether an odd number of the set's n-grams falls there.
    Takes one set of each class of equal ones, so copies no longer count. Sets that have too few shared
    n-grams for any link are dropped.
    """
    n = max(1, sets.count() // SETS_PER_BLOCK)
    parts = max(1, n // 8)
    dealt = sets.withColumn("block", F.pmod(F.xxhash64("uid"), F.lit(n)))
    dealt = dealt.repartition(max(dealt.sparkSession.sparkContext.defaultParallelism, min(n, 100_000)), "block")

    def unpack(group: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = [np.frombuffer(g.as_py(), np.uint64) for g in group["grams"]]
        bounds = np.concatenate([[0], np.cumsum([len(x) for x in lists])])
        return np.concatenate(lists), bounds

    def hashes_of(group: pa.Table) -> np.ndarray:
        return unpack(group)[0]

    def order(key, group, answers):
        group = in_order(group)
        hashes, bounds = unpack(group)
        levels = understood(hashes, parts, answers)
        sizes, lists, shared, parities = group["n"].to_numpy(), [], [], []
        for s, e, size in zip(bounds, bounds[1:], sizes):
            mine, rank = hashes[s:e], levels[s:e]
            mine, rank = mine[rank > 0], rank[rank > 0]
            shared.append(len(mine))
            enough = len(mine) and 100 * len(mine) >= percent * size
            level = np.minimum(rank, MOST_LEVEL).astype(np.uint64) << np.uint64(HASH_BITS)
            lists.append(np.sort(level | mine >> np.uint64(64 - HASH_BITS)).view(np.int64) if enough else None)
            odd = np.bincount((mine & np.uint64(255)).astype(np.int64), minlength=256) & 1
            parities.append(np.packbits(odd.astype(np.uint8)).view(np.int64))
        kept = [i for i, x in enumerate(lists) if x is not None]
        out = {
            "rep": group["uid"].take(pa.array(kept, pa.int64())),
            "n": group["n"].take(pa.array(kept, pa.int64())),
            "shared": pa.array([shared[i] for i in kept], pa.int64()),
            "grams": pa.array([lists[i] for i in kept], pa.list_(pa.int64())),
        }
        out |= {p: pa.array([parities[i][k] for i in kept], pa.int64()) for k, p in enumerate(PARITIES)}
        return pa.table(out)

    by_block = dealt.groupBy("block")
    return by_block.cogroup(answered(asked(by_block, hashes_of, parts)).groupBy("block")).applyInArrow(order, ORDERED)


def _possible(a: str, b: str, percent: int) -> Column:
    """Whether a pair can still have the similarity, by sizes, n-grams shared with anything, what follows a common one,
    and the parities.

    An n-gram that one set alone holds changes one parity at most, so no fewer n-grams differ than parities do.
    """
    col = lambda side, name: F.col(f"{side}.{name}")
    need = (100 + percent) * F.least(
        col(a, "shared"), col(b, "shared"), col(a, "n") - col(a, "at"), col(b, "n") - col(b, "at")
    ) >= percent * (col(a, "n") + col(b, "n"))
    different = col(a, "n") - col(a, "shared") + col(b, "n") - col(b, "shared")
    for p in PARITIES:
        different += F.bit_count(col(a, p).bitwiseXOR(col(b, p)))
    near = (100 + percent) * different <= (100 - percent) * (col(a, "n") + col(b, "n"))
    return need & near & (100 * F.least(col(a, "n"), col(b, "n")) >= percent * F.greatest(col(a, "n"), col(b, "n")))


def _cuts(sets: DataFrame) -> list[int]:
    """Places that cut the order of the n-grams into fragments with about equally many n-grams of sets."""
    place = F.shiftright("gram", PLACE_BITS).alias("place")
    found = sets.select(F.explode("grams").alias("gram")).groupBy(place).count()
    found = sorted(found.collect())  # a bounded number of places, whatever the table
    total, before, cuts = sum(n for _, n in found), 0, []
    for place, n in found:
        if before * FRAGMENTS >= (len(cuts) + 1) * total:
            cuts.append(place << PLACE_BITS)
        before += n
    return cuts


def _cut(sets: DataFrame, cuts: list[int]) -> DataFrame:
    """The segments of the sets: for each fragment of the order the n-grams that fall into it, if any."""
    ends = [None, *cuts, None]
    inside = lambda low, high: lambda g: (F.lit(True) if low is None else g >= low) & (F.lit(True) if high is None else g < high)
    segments = [
        F.struct(F.lit(f).alias("f"), F.filter("grams", inside(low, high)).alias("g"))
        for f, (low, high) in enumerate(zip(ends, ends[1:]))
    ]
    return written(sets.select("rep", "n", F.inline(F.array(*segments))).where(F.size("g") > 0), "segments")


def _linked(pairs: DataFrame, segments: DataFrame, percent: int) -> DataFrame:
    """The pairs (``a``, ``b``) with the similarity. Overlaps are counted per fragment and summed per pair."""
    left = segments.select(F.col("rep").alias("a"), "f", F.col("n").alias("na"), F.col("g").alias("ga"))
    right = segments.select(F.col("rep").alias("b"), "f", F.col("n").alias("nb"), F.col("g").alias("gb"))
    both = pairs.join(right, "b").join(left, ["a", "f"])
    counted = both.groupBy("a", "b", "na", "nb").agg(F.sum(F.size(F.array_intersect("ga", "gb"))).alias("common"))
    return counted.where((100 + percent) * F.col("common") >= percent * (F.col("na") + F.col("nb"))).select("a", "b")


def _links(sets: DataFrame, percent: int) -> DataFrame:
    """Links that connect exactly the sets which links of the whole join connect.

    Two similar sets have an n-gram in common among their first ones. In each list of sets with such
    an n-gram, all are compared with a hub first: the set that has most of its n-grams in common with
    others. What hangs together by then needs no further links; the pairs that are left are compared
    one by one.
    """
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - (F.col("n") - F.col("shared"))
    exploded = sets.select(
        "rep", "n", "shared", *PARITIES, F.posexplode(F.slice("grams", 1, F.greatest(first.cast("int"), F.lit(1)))).alias("i", "gram")
    )
    lists = written(exploded.withColumn("at", F.col("n") - F.col("shared") + F.col("i")).drop("i"), "lists")
    member = F.struct("rep", "n", "shared", "at", *PARITIES)
    best = F.struct(F.col("shared") / F.col("n"), "n", -F.col("rep"))
    hubs = lists.groupBy("gram").agg(F.max_by(member, best).alias("h"), F.count("*").alias("size"))
    hubs = hubs.where("size > 1").select("gram", "h.*")
    stars = hubs.alias("x").join(lists.alias("y"), "gram").where(F.col("x.rep") != F.col("y.rep"))
    pairs = stars.where(_possible("x", "y", percent)).select(F.col("x.rep").alias("a"), F.col("y.rep").alias("b")).distinct()
    segments = _cut(sets, _cuts(sets))
    found = written(_linked(pairs, segments, percent), "links")

    known = components(found)
    labelled = lists.join(known, lists["rep"] == known["node"], "left")
    labelled = written(labelled.select(*lists.columns, F.coalesce("label", "rep").alias("label")), "lists")
    major = labelled.groupBy("gram").agg(
        F.max_by("label", best).alias("major"), F.min("label").alias("low"), F.max("label").alias("high")
    )
    major = major.where("low < high").select("gram", "major")
    split = labelled.join(major, "gram")
    minor = split.where(F.col("label") != F.col("major"))
    other = (F.col("x.label") != F.col("y.label")) & ((F.col("y.label") == F.col("y.major")) | (F.col("x.rep") < F.col("y.rep")))
    rest = minor.alias("x").join(split.alias("y"), "gram").where(other & _possible("x", "y", percent))
    low, high = F.least("x.rep", "y.rep"), F.greatest("x.rep", "y.rep")
    more = rest.select(low.alias("a"), high.alias("b")).distinct()
    return found.union(written(_linked(more, segments, percent), "links"))


def join(
    df: DataFrame, key: str = "doc_id", text: str = "text", width: int = 4, percent: int = 85
) -> DataFrame:
    """Per row: key, ``n_shingles`` (size of its set) and ``component_id`` (smallest key reachable by links).

    A row's set holds the distinct runs of ``width`` words of its lower-cased text (A-Z); with fewer words all
    of them as one; a null text, or one without words, has an empty set and no link. Two rows are
    linked when 100 times the intersection is at least ``percent`` times the union. Repeated rows are
    linked like other copies. A null key is passed over as smallest key; where a component has no
    other, its id is null. An empty table gives no rows; other columns are not looked at.

    Rows with equal sets are one class and are compared once. N-grams are compared as 64-bit hashes.
    """
    signed = written(_sets(blocks(df, F.col(key), F.col(text)), width, percent), "sets")
    classes = signed.where("n > 0").groupBy("k1", "k2").agg(F.min("uid").alias("rep"), F.min("id").alias("first"))
    classes = written(classes, "classes")
    able = signed.where(F.col("grams").isNotNull()).select("uid", "n", "grams")
    able = written(able.join(classes.select("rep"), F.col("uid") == F.col("rep")).select("uid", "n", "grams"), "able")
    sets = written(_ordered(able, percent), "ordered")
    groups = components(_links(sets, percent))
    named = classes.join(groups, classes["rep"] == groups["node"], "left")
    named = named.select("k1", "k2", "first", F.coalesce("label", "rep").alias("label"))
    lowest = named.groupBy("label").agg(F.min("first").alias("component_id"))
    labels = named.join(lowest, "label").select(F.col("k1").alias("_1"), F.col("k2").alias("_2"), "component_id")
    same = (signed["k1"] == F.col("_1")) & (signed["k2"] == F.col("_2")) & (signed["n"] > 0)
    return signed.join(labels, same, "left").select(
        F.col("id").alias(key),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
    )


def one_of_each(df: DataFrame, text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row of each component as it is, and all rows that have no words. All columns are kept.

    Which of a component's rows stays depends on how the table is read; of repeated rows one stays. Null keys
    don't matter, as rows are numbered. An empty table gives no rows.
    """
    plain = [f"_c{i}" for i in range(len(df.columns))]  # whatever the columns are called, nothing clashes
    rows = written(numbered(df.toDF(*plain)), "neardup")
    found = join(rows, ROW, plain[df.columns.index(text)], width, percent)
    gone = sent(found.where(F.col(ROW) != F.col("component_id")).select(F.col(ROW).alias("_gone")), "gone")
    return rows.join(gone, rows[ROW] == gone["_gone"], "left_anti").select(*plain).toDF(*df.columns)

