"""Benchmark decontamination: SimHash of item-sized windows, a multi-index of Hamming blocks, exact verification."""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import ascii_lower, sent, written
from keyflow.llm.licenses import WORD

WIDTH = 5  # words of a shingle
NARROW = 16_383  # hashes that counters of 16 bits can count
SLACK = 1e-6  # against rounding, where numbers of shingles are compared with the similarity
STEPS = 64  # windows of an item's size start this share of it apart, or at each shingle of a shorter item


def shingles(text: Column, width: int = WIDTH) -> Column:
    """Hashes of all runs of ``width`` words in order; of a text with fewer words, none."""
    return F.transform(F.array(_words(text)), lambda w: _runs(w, width))[0]  # the words are worked out once


def _words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def _runs(w: Column, width: int) -> Column:
    starts = F.sequence(F.lit(0), F.size(w) - width)
    runs = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))
    return F.when(F.size(w) >= width, runs).otherwise(F.array().cast("array<bigint>"))


def _shifted(value: Column, bits: Column) -> Column:
    return F.call_function("shiftrightunsigned", value, bits)


def fingerprint(hashes: Column) -> Column:
    """The 64-bit SimHash of an array of hashes, repetitions counted; of none, 0."""
    narrow, wide = _majority(hashes, 16), _majority(hashes, 32)
    return F.when(F.size(hashes) <= NARROW, narrow).otherwise(wide)  # the same, in counters that hold as many


def _majority(hashes: Column, bits: int) -> Column:
    """Counts the hashes that have each of 64 bits set, in counters of ``bits`` bits, several to a long."""
    ones = F.lit(sum(1 << at for at in range(0, 64, bits)))
    names = [f"l{k}" for k in range(bits)]
    zero = F.struct(*[F.lit(0).cast("long").alias(n) for n in names])

    def add(sums: Column, h: Column) -> Column:
        return F.struct(
            *[(sums[n] + F.shiftrightunsigned(h, k).bitwiseAND(ones)).alias(n) for k, n in enumerate(names)]
        )

    def majority(sums: Column) -> Column:
        # A counter over half the number of hashes carries into its last bit but one once this is added; none goes further.
        lift = (F.lit((1 << bits - 2) - 1) - F.shiftright(F.size(hashes), 1)).cast("long") * ones
        set_ = [F.shiftleft(F.shiftrightunsigned(sums[n] + lift, bits - 2).bitwiseAND(ones), k) for k, n in enumerate(names)]
        return reduce(lambda a, b: a.bitwiseOR(b), set_)

    return F.aggregate(hashes, zero, add, majority)


def variants(bits: int, radius: int) -> list[int]:
    """All numbers of ``bits`` bits that differ from 0 in at most ``radius`` bits."""
    return [sum(1 << b for b in c) for n in range(radius + 1) for c in combinations(range(bits), n)]


def text_key(text: Column) -> Column:
    """128 bits that tell texts apart."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def items(benchmark: DataFrame, key: str = "item_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """``item``, ``width`` of its shingles, ``m`` (their number) and ``h`` (the shingles in order).

    An item with fewer words than ``width`` is one shingle of all its words. Items without words can't be found.
    """
    rows = benchmark.select(F.col(key).alias("item"), _words(F.col(text)).alias("_w"))
    rows = rows.withColumn("width", F.least(F.size("_w"), F.lit(width))).where(F.col("width") > 0)
    runs = reduce(lambda other, k: F.when(F.col("width") == k, _runs(F.col("_w"), k)).otherwise(other), range(1, width), _runs(F.col("_w"), width))
    return rows.select("item", "width", runs.alias("h")).select("item", "width", F.size("h").alias("m"), "h").distinct()


def _starts(at: Column, m: Column, n: Column, similarity: float) -> Column:
    """Starts of windows of ``m`` of a text's ``n`` shingles in which enough of the places ``at`` (sorted) lie.

    Of a full window, 2 s / (1 + s) of its shingles must be among the item's. At the end of the text, where
    windows are shorter, s of the item's size is asked for, which none of the similarity has less of. Of a run of
    neighbouring starts the first, the last and every (m / ``STEPS``)-th are taken: others differ little from these.
    """
    none = F.array().cast("array<int>")
    full = F.ceil(2 * similarity / (1 + similarity) * m - SLACK).cast("int")
    least = F.ceil(similarity * m - SLACK).cast("int")
    size = F.size(at)

    def ending(i: Column) -> Column:
        """Starts of full windows whose first place is the i-th, and that hold enough from there on."""
        first = F.greatest(F.get(at, i + full - 1) - m + 1, F.coalesce(F.get(at, i - 1) + 1, F.lit(0)), F.lit(0))
        last = F.least(F.get(at, i), n - m)
        return F.when(first <= last, F.sequence(first, last)).otherwise(none)

    whole = F.when(size >= full, F.flatten(F.transform(F.sequence(F.lit(0), size - full), ending))).otherwise(none)
    first, last = F.greatest(n - m + 1, F.lit(0)), F.get(at, size - least)
    cut = F.when((size >= least) & (first <= last), F.sequence(first, last)).otherwise(none)

    def thinned(starts: Column) -> Column:
        def taken(x: Column, i: Column) -> Column:
            alone = F.coalesce(F.get(starts, i - 1) != x - 1, F.lit(True)) | F.coalesce(F.get(starts, i + 1) != x + 1, F.lit(True))
            return alone | (x % F.greatest(F.lit(1), (m / STEPS).cast("int")) == 0)

        return F.filter(starts, taken)

    return F.transform(F.array(F.concat(whole, cut)), thinned)[0]


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item_key: str = "item_id",
    item_text: str = "text",
    similarity: float = 0.8,
    width: int = WIDTH,
    radius: int = 23,
    blocks: int = 8,
) -> DataFrame:
    """Texts of documents and the benchmark items that stand in them.

    Returns ``_text`` (the text's key), ``item``, ``first_word`` (start of the best window, in shingles; of equally
    good ones the first), ``similarity`` (weighted Jaccard, repetitions counted) and ``distance`` (of the nearest
    fingerprint), one row per distinct text and item with a window of the item's size that reaches ``similarity`` and
    whose fingerprint, or a close neighbour's, lies within ``radius`` bits of the item's. At similarity 0.8 some 10 of
    64 bits differ, and the radius leaves room for more than four standard deviations.

    An item of fewer than ``width`` words is found wherever these stand one after the other. Null and empty texts
    match nothing, items without words are not found. Copies of a text share one search. Two empty tables give no
    rows; other columns are not looked at. Items are judged whole, however long.

    The documents are cut into shingles once, whatever the size of the benchmark: shingles of any item tell texts that
    hold enough for an item of some size, and only those texts are read again, for the items whose own shingles they
    hold. Windows of these are fingerprinted and looked up by item in an index of ``blocks`` equal blocks, in
    which up to ``radius // blocks`` bits are flipped: of two prints within the radius at least one block differs by no
    more, so none is missed. The similarity of all windows of a text then follows from one pass over the places.
    """
    if 64 % blocks:
        raise ValueError("the blocks must divide 64 bits evenly")
    known = written(items(benchmark, item_key, item_text, width), "benchmark")
    widths = sorted(r["width"] for r in known.select("width").distinct().collect())  # at most ``width`` of them
    rows = docs.select(F.col(text).alias("_t"), text_key(F.col(text)).alias("_text"))
    found = [_leaks(rows, known.where(F.col("width") == k), k, similarity, radius, blocks) for k in widths or [width]]
    return reduce(DataFrame.unionByName, found)


def _leaks(rows: DataFrame, known: DataFrame, width: int, similarity: float, radius: int, blocks: int) -> DataFrame:
    """``leaks`` of the items whose shingles have ``width`` words."""
    enough = F.ceil(similarity * F.col("m") - SLACK)
    # Texts in which enough shingles of the items of a size stand.
    postings = sent(known.select("m", F.explode("h").alias("h")).distinct(), "postings")
    seen = rows.select("_text", F.posexplode(shingles(F.col("_t"), width)).alias("pos", "h"))
    places = seen.join(postings, "h").select("_text", "m", "pos").distinct()
    sizes = places.groupBy("_text", "m").count().where(F.col("count") >= enough).select("_text", "m")
    sizes = written(sizes, "sizes")
    texts = sent(sizes.select("_text").distinct(), "texts")
    chosen = rows.join(texts, "_text", "left_semi").groupBy("_text").agg(F.first("_t").alias("_t"))
    cut = written(chosen.select("_text", shingles(F.col("_t"), width).alias("_h")), "shingles")

    # In these, the places of each item's own shingles. An item's repetitions count as often as it has them.
    own = known.select("item", "m", F.explode("h").alias("h")).groupBy("item", "m", "h").agg(F.count("*").alias("times"))
    seen = cut.select("_text", F.size("_h").alias("n"), F.posexplode("_h").alias("pos", "h")).join(sizes, "_text")
    places = seen.join(own, ["m", "h"]).groupBy("_text", "n", "item", "m", "h", "times")
    places = places.agg(F.array_sort(F.collect_list("pos")).alias("at"))
    reach = Window.partitionBy("_text", "item")
    places = places.withColumn("_all", F.sum(F.size("at")).over(reach)).where(F.col("_all") >= enough).drop("_all")
    places = written(places, "places")

    # Windows in which enough of them lie, by fingerprint.
    at = places.groupBy("_text", "n", "item", "m").agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("at"))
    starts = at.select("_text", "item", "m", F.explode(_starts(F.col("at"), F.col("m"), F.col("n"), similarity)).alias("start"))
    windows = starts.join(cut, "_text").select("_text", "item", F.slice("_h", F.col("start") + 1, F.col("m")).alias("h"))
    windows = windows.select("_text", "item", fingerprint(F.col("h")).alias("print")).distinct()
    bits = 64 // blocks
    block = _shifted(F.col("print"), F.col("block") * bits).bitwiseAND((1 << bits) - 1)
    numbers = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    flips = F.array(*[F.lit(v).cast("long") for v in variants(bits, radius // blocks)])
    index = known.select("item", fingerprint(F.col("h")).alias("print")).select("item", F.col("print").alias("iprint"), "print", numbers)
    index = index.select("item", "iprint", "block", F.explode(F.transform(flips, lambda v: block.bitwiseXOR(v))).alias("value"))
    probes = windows.select("*", numbers).withColumn("value", block)
    distance = F.bit_count(F.col("print").bitwiseXOR(F.col("iprint")))
    near = probes.join(index, ["item", "block", "value"]).where(distance <= radius)
    near = near.groupBy("_text", "item").agg(F.min(distance).alias("distance"))

    best = _best(places.join(near, ["_text", "item"]))
    return best.where(F.col("similarity") >= similarity)


def _best(places: DataFrame) -> DataFrame:
    """The best window of each text and item, from the places of the item's shingles in the text.

    What a window shares with the item is the number of places in it, of a shingle no more than the item has. A place
    therefore counts for the starts from which it is among the first so many of its shingle in the window. These are
    intervals of starts; a running sum over their ends gives what every window shares, without forming any.
    """
    group = ["_text", "item", "n", "m", "distance"]

    def counts(p: Column, i: Column) -> Column:
        first = F.greatest(p - F.col("m") + 1, F.coalesce(F.get("at", i - F.col("times").cast("int")) + 1, F.lit(0)), F.lit(0))
        return F.array(F.struct(first.alias("start"), F.lit(1).alias("by")), F.struct((p + 1).alias("start"), F.lit(-1).alias("by")))

    steps = places.select(*group, F.inline(F.flatten(F.transform("at", counts))))
    steps = steps.groupBy(*group, "start").agg(F.sum("by").alias("by"))
    along = Window.partitionBy("_text", "item").orderBy("start")
    steps = steps.select(
        *group,
        "start",
        F.sum("by").over(along.rowsBetween(Window.unboundedPreceding, 0)).alias("both"),
        F.least(F.lead("start").over(along) - 1, F.col("n") - 1).alias("last"),  # the same up to here
    )
    # Full windows are all of one size, so the first start is as good as the next; those at the end get smaller.
    full = F.when(F.col("start") + F.col("m") <= F.col("n"), _window(F.col("start"), F.col("m")))
    short = F.when(F.col("last") + F.col("m") > F.col("n"), _window(F.col("last"), F.col("n") - F.col("last")))
    return (
        steps.select(*group, F.greatest(full, short).alias("best"))
        .groupBy("_text", "item", "distance")
        .agg(F.max("best").alias("best"))
        .select(
            "_text",
            "item",
            (-F.col("best.back")).cast("long").alias("first_word"),
            "best.similarity",
            F.col("distance").cast("int").alias("distance"),
        )
    )


def _window(start: Column, size: Column) -> Column:
    return F.struct((F.col("both") / (size + F.col("m") - F.col("both"))).alias("similarity"), (-start).alias("back"))


def contaminated(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``leaks`` of each document: one row per row of ``docs`` and item that stands in it, by the document's key.

    Repeated rows and null keys get rows of their own; null texts and empty tables give none.
    """
    found = sent(leaks(docs, benchmark, key, text, **settings), "leaks")
    rows = docs.select(F.col(key).alias("_id"), text_key(F.col(text)).alias("_key"))
    joined = rows.join(found, rows["_key"] == found["_text"])
    return joined.select(F.col("_id").alias(key), F.col("item").alias("item_id"), "first_word", "similarity", "distance")


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` whose text holds no benchmark item, as they are.

    Null and empty texts and repeated rows stay; without documents there are no rows, and without items all stay.
    """
    plain = [f"_c{i}" for i in range(len(docs.columns))]  # whatever the columns are called, nothing clashes
    name, body = plain[docs.columns.index(key)], plain[docs.columns.index(text)]
    rows = docs.toDF(*plain)
    found = leaks(rows, benchmark, name, body, **settings)
    bad = sent(found.select(F.col("_text").alias("_bad")).distinct(), "leaks")
    keyed = rows.withColumn("_text", text_key(F.col(body)))
    return keyed.join(bad, keyed["_text"] == bad["_bad"], "left_anti").select(*plain).toDF(*docs.columns)
