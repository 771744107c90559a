"""Running and final aggregates per key.

A running operator gives one output row per input row, carrying the aggregate of the key so far.
``order`` fixes what "so far" means and must be unique inside a key.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.plans import hotsplit
from keyflow.plans.hotsplit import CHUNK, KeyedOrder, as_right, match, running


def level_or_zero(column: str = "vc") -> Column:
    """The level, a missing one counting as 0."""
    return F.coalesce(column, F.lit(0))


def word_count(words: DataFrame) -> DataFrame:
    return words.groupBy("word").agg(F.count("*").alias("cnt"))


def word_count_running(
    words: DataFrame, order: Sequence[str], measured: DataFrame | None = None, share: float = 1.0
) -> DataFrame:
    """How often each word has occurred so far. Sizes are taken from ``measured``, a share of the words, if given."""
    return running(words, ["word"], order, measured, share, cnt=hotsplit.count())


def running_reduce(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    agg: Column,
    combine: Callable[[Column], Column],
    merge: Callable[[Column, Column], Column],
    name: str = "reduced",
) -> DataFrame:
    """A reduce that the caller gives as Columns: an aggregate, the same over aggregates, and over two of them."""
    return running(df, keys, order, **{name: hotsplit.Running(agg, combine, merge)})


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Running sum; the other fields keep the key's first record."""
    return _with_first(df, keys, order, value, hotsplit.total(value))


def running_max(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Running maximum; the other fields keep the key's first record."""
    return _with_first(df, keys, order, value, hotsplit.highest(value))


def running_min(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """Running minimum; the other fields keep the key's first record."""
    return _with_first(df, keys, order, value, hotsplit.lowest(value))


def _with_first(df, keys, order, value, scan) -> DataFrame:
    others = [name for name in df.columns if name not in (*keys, *order, value)]
    kept = {f"first_{name}": hotsplit.first(name, order) for name in others}
    kept[f"first_{order[0]}"] = hotsplit.first(order[0], order)
    out = running(df, keys, order, **kept, **{f"running_{value}": scan})
    return out.drop(*others, value)


def _best(df: DataFrame, order: Sequence[str], value: str, smallest: bool) -> Column:
    """Sorts by value and, on ties, by who came first: the earlier record stays."""
    rank = F.struct(*[(F.col(name) if smallest else _descending(df, name)).alias(f"_{name}") for name in order])
    others = [name for name in df.columns if name != value]
    return F.struct(F.col(value), rank.alias("_rank"), *others)


def _descending(df: DataFrame, name: str) -> Column:
    """A value that falls where the column rises."""
    kind = df.schema[name].dataType.typeName()
    if kind.startswith("timestamp"):
        return -F.unix_micros(F.col(name).cast("timestamp"))
    if kind == "date":
        return -F.unix_date(name)
    if kind == "boolean":
        return ~F.col(name)
    if kind in ("string", "binary"):
        # The bytes turned round, and an end mark above them, since a text comes before its continuations.
        return F.concat(F.translate(F.hex(name), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("G"))
    return -F.col(name)


def running_max_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The whole record of the maximum so far, as the struct ``best``; ties keep the earlier record."""
    return running(df, keys, order, best=hotsplit.highest(_best(df, order, value, smallest=False)))


def running_min_by(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """The whole record of the minimum so far, as the struct ``best``; ties keep the earlier record."""
    return running(df, keys, order, best=hotsplit.lowest(_best(df, order, value, smallest=True)))


def max_by_final(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.max(_best(df, order, value, smallest=False)).alias("best"))


def previous_value(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column | str) -> DataFrame:
    """Adds ``last``, the value of the key's previous record (null at the first)."""
    return running(df, keys, order, last=hotsplit.latest(value, order).before())


def jump_alarm(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "vc", jump: int = 10) -> DataFrame:
    """Records whose level differs from the previous one by more than ``jump``; the first compares to 0."""
    level = level_or_zero(value)
    seen = previous_value(df, keys, order, level)
    seen = seen.withColumn("curr", level).withColumn("last", F.coalesce("last", F.lit(0)))
    return seen.filter(F.abs(F.col("curr") - F.col("last")) > jump)


def running_mean(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "vc") -> DataFrame:
    level = level_or_zero(value)
    sums = running(df, keys, order, _sum=hotsplit.total(level), _n=hotsplit.count())
    return sums.withColumn("mean", F.col("_sum") / F.col("_n")).drop("_sum", "_n")


def level_counts(df: DataFrame, keys: Sequence[str], value: str = "vc") -> DataFrame:
    return df.groupBy(*keys, level_or_zero(value).alias(value)).agg(F.count("*").alias("cnt"))


def level_counts_running(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "vc") -> DataFrame:
    """How often the record's own level has occurred in its key so far."""
    return running(df.withColumn(value, level_or_zero(value)), [*keys, value], order, cnt=hotsplit.count())


def bucket_counter(df: DataFrame, n: int, bucket: Column, order: Sequence[str]) -> DataFrame:
    """Running record count per bucket, as ``n`` counting tasks would keep it."""
    return running(df.withColumn("bucket", F.pmod(bucket, F.lit(n))), ["bucket"], order, cnt=hotsplit.count())


def top_final(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "vc", n: int = 3) -> DataFrame:
    """The ``n`` largest levels per key, duplicates kept, as rows with their rank."""
    ranked = Window.partitionBy(*keys).orderBy(F.col(value).desc(), *order)
    rows = df.withColumn(value, level_or_zero(value))
    return rows.withColumn("rank", F.row_number().over(ranked)).filter(F.col("rank") <= n)


def largest(n: int, *lists: Column) -> Column:
    """The ``n`` largest values of several arrays, any of which may be null."""
    both = F.concat(*[F.coalesce(values, F.array().cast("array<int>")) for values in lists])
    return F.slice(F.sort_array(both, asc=False), 1, n)


def top_running(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str = "vc", n: int = 3, start: DataFrame | None = None
) -> DataFrame:
    """After each record, the ``n`` largest levels of its key so far, as the array ``top``.

    ``start`` holds the arrays of an earlier table that this one continues.
    """
    ordered = KeyedOrder(df, keys, order)
    levels = ordered.rows.withColumn("_level", level_or_zero(value))
    local = _top_chain(levels, ordered.window(exclusive=True), n)
    if ordered.cut:
        early = as_right(_earlier_top(ordered, levels, n), ordered.partition)
        local = local.join(F.broadcast(early), match(local, early, ordered.partition), "left")
        local = local.withColumn("top", largest(n, F.col("top"), F.col("_early")))
    if start is not None:
        before = ordered.spread_start(ordered.rows, start.withColumnRenamed("top", "_start"))
        local = local.join(before, match(local, before, ordered.partition), "left")
        local = local.withColumn("top", largest(n, F.col("top"), F.col("_start")))
    return local.select(*df.columns, "top")


def _top_chain(df: DataFrame, before, n: int) -> DataFrame:
    """Running top n without lists: what a new value pushes off one rank competes for the next.

    Rank 1 is the running maximum. At each row the smaller of the value and the maximum before it
    drops out, and rank 2 is the running maximum of these dropped values, and so on.
    """
    offered = "_level"
    for rank in range(1, n + 1):
        df = df.withColumn(f"_held{rank}", F.max(offered).over(before))
        df = df.withColumn(f"_top{rank}", F.greatest(f"_held{rank}", offered))
        dropped = F.when(F.col(f"_held{rank}").isNotNull() & F.col(offered).isNotNull(), F.least(f"_held{rank}", offered))
        offered = f"_drop{rank}"
        df = df.withColumn(offered, dropped)
    top = F.array_compact(F.array(*[F.col(f"_top{rank}") for rank in range(1, n + 1)]))
    return df.withColumn("top", top)


def _earlier_top(ordered: KeyedOrder, levels: DataFrame, n: int) -> DataFrame:
    """Per chunk of a hot key, the top n of its earlier chunks."""
    hot = ordered.hot(levels)
    in_chunk = Window.partitionBy(*ordered.partition).orderBy(F.col("_level").desc(), *ordered.order)
    best = hot.withColumn("_rank", F.row_number().over(in_chunk)).filter(F.col("_rank") <= n)
    best = best.select(*ordered.partition, "_rank", "_level")
    across = Window.partitionBy(*ordered.keys).orderBy(CHUNK, "_rank")
    chained = _top_chain(best, across.rowsBetween(Window.unboundedPreceding, -1), n)
    at_end = chained.groupBy(*ordered.partition).agg(F.max_by("top", "_rank").alias("_upto"))
    return at_end.select(
        *ordered.partition,
        F.lag("_upto").over(Window.partitionBy(*ordered.keys).orderBy(CHUNK)).alias("_early"),
    )
