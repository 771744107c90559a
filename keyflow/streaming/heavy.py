"""Stream joins whose heavy keys are spread over tasks, as heavy as they turn out to be.

Key sizes of a stream are not known beforehand and Spark's join state can't be moved later. So each micro-batch of
both inputs passes through here first. Its keys are counted and merged into a summary of the heaviest keys so far
(a Misra-Gries summary: bounded, mergeable, no key with more than its share of the rows is missed). A key that
has become heavy is cut into slices of both sides from a time on which no row has had yet. A row's slices thus depend
on its key and its time alone, whenever it comes, and all rows of a key and time agree on them. Rows are handed
on with their numbers of slices; the join lays them out on a grid, so that each pair meets once. Only heavy keys are copied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from keyflow.plans.hotsplit import as_right, match, rows_per_task, small_copy
from keyflow.session import drop, scratch_dir
from keyflow.sinks.writers import BatchWriter

# A task's fair share of the rows is cut into this many slices, so that their chance places even out.
SLICES_PER_TASK = 4
SIDES = ("left", "right")
SLICES = ["_left_slices", "_right_slices"]
GRID = ["_a", "_b"]
FIRST = -(1 << 63)  # microseconds: before all times


def summarise(counted: DataFrame, keys: Sequence[str], capacity: int) -> DataFrame:
    """The ``capacity`` heaviest keys of ``(*keys, n)``, each less by what the next heaviest has.

    Summaries of parts of a stream may be added up and summarised again: a key's count is then never too high, and
    too low by at most a ``capacity``-th of all rows.
    """
    summed = counted.groupBy(*keys).agg(F.sum("n").alias("n"))
    top = small_copy(summed.orderBy(F.desc("n"), *keys).limit(capacity + 1))
    sizes = sorted((row.n for row in top.select("n").collect()), reverse=True)
    rest = sizes[capacity] if len(sizes) > capacity else 0
    return top.select(*keys, (F.col("n") - F.lit(rest)).alias("n")).where("n > 0")


def _slices(counts: dict[str, DataFrame], keys: Sequence[str], limit: int) -> DataFrame:
    """Into how many slices of ``limit`` rows the sides of each key go."""
    sides = [counts[side].select(*keys, *[(F.col("n") if one == side else F.lit(0)).alias(one) for one in SIDES]) for side in SIDES]
    both = sides[0].unionByName(sides[1]).groupBy(*keys).agg(*[F.sum(side).alias(side) for side in SIDES])
    cut = [F.greatest(F.lit(1), F.ceil(F.col(side) / F.lit(limit))).cast("int").alias(name) for side, name in zip(SIDES, SLICES)]
    return both.select(*keys, *cut)


def _grown(now: DataFrame, known: DataFrame, keys: Sequence[str], since: Column) -> DataFrame:
    """New slices of the keys that need over twice what they have. So a key has few versions."""
    have = known.groupBy(*keys).agg(*[F.max(name).alias(f"_had{name}") for name in SLICES])
    joined = now.join(have, list(keys), "left")
    had = {name: F.coalesce(f"_had{name}", F.lit(1)) for name in SLICES}
    more = [F.col(name) > 2 * had[name] for name in SLICES]
    new = [F.greatest(F.col(name), had[name]).alias(name) for name in SLICES]
    return joined.where(more[0] | more[1]).select(*keys, since.alias("since"), *new)


def _before(spark: SparkSession, folder: str, batch_id: int) -> DataFrame | None:
    """What was known before this micro-batch."""
    try:
        kept = spark.read.parquet(f"{folder}/heavy")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    earlier = kept.where(F.col("batch") < batch_id)
    newest = earlier.agg(F.max("batch").alias("batch")).first()["batch"]
    return None if newest is None else earlier.where(F.col("batch") == newest).drop("batch")


def place(folder: str, keys: Sequence[str], at: Column, capacity: int = 1000) -> BatchWriter:
    """Hands the rows of both sides on, into ``folder/placed``, with the numbers of slices of their keys.

    A micro-batch holds both inputs, told apart by ``side`` ('left' or 'right'). ``at`` is a time that rows which are to
    meet have in common, such as the start of their window. A side of a key is cut once it has more rows than
    ``keyflow.rowsPerTask`` and than a quarter of a task's share of all rows. Rows with a null key or ``at`` are handed on
    uncut (``F.window`` leaves rows without a time out; they have no partner). Batches must come with ascending numbers; one that is repeated writes the same rows anew, so start the join over
    ``placed`` when this stream has worked off what there is.
    """
    keys = list(keys)

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        once = scratch_dir(spark, "heavy")
        batch.withColumn("_at", F.unix_micros(at.cast("timestamp"))).write.parquet(once)
        kept = spark.read.parquet(once)
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        most = max(capacity, 2 * SLICES_PER_TASK * tasks)
        before = _before(spark, folder, batch_id)
        found = kept.groupBy("side").agg(F.count("*").alias("n"), F.max("_at").alias("since"))
        all_seen = found.select("n", "since")
        if before is not None:
            all_seen = all_seen.unionByName(before.where("what = 'seen'").select("n", "since"))
        seen = all_seen.agg(F.sum("n").alias("n"), F.max("since").alias("since"))
        total = seen.first()["n"] or 0

        per_key = kept.dropna(subset=keys).groupBy(*keys, "side").agg(F.count("*").alias("n"))
        counts = {}
        for side in SIDES:
            counted = per_key.where(F.col("side") == side).select(*keys, "n")
            if before is not None:
                counted = counted.unionByName(before.where(F.col("what") == side).select(*keys, "n"))
            counts[side] = summarise(counted, keys, most)

        limit = max(rows_per_task(spark), -(-total // (SLICES_PER_TASK * tasks)))
        now = _slices(counts, keys, limit)
        empty = now.limit(0).select(*keys, F.lit(0).cast("bigint").alias("since"), *SLICES)
        known = empty if before is None else before.where("what = 'slices'").select(*keys, "since", *SLICES)
        # Rows up to the latest time of earlier batches may be in the join's state already.
        past = None if before is None else before.where("what = 'seen'").first()["since"]
        since = F.lit(FIRST if past is None else past + 1).cast("bigint")
        versions = small_copy(known.unionByName(_grown(now, known, keys, since)))

        parts = [seen.withColumn("what", F.lit("seen")), versions.withColumn("what", F.lit("slices"))]
        parts += [counts[side].withColumn("what", F.lit(side)) for side in SIDES]
        state = parts[0]
        for part in parts[1:]:
            state = state.unionByName(part, allowMissingColumns=True)
        state.coalesce(1).write.mode("overwrite").parquet(f"{folder}/heavy/batch={batch_id}")

        _with_slices(kept, versions, keys).drop("_at").write.mode("overwrite").parquet(f"{folder}/placed/batch={batch_id}")
        drop(spark, f"{folder}/heavy/batch={batch_id - 2}")
        drop(spark, once)

    return write


def _with_slices(rows: DataFrame, versions: DataFrame, keys: list[str]) -> DataFrame:
    """Each row with the slices that are in force for its key at its time."""
    until = F.lead("since").over(Window.partitionBy(*keys).orderBy("since"))
    spans = as_right(versions.withColumn("_until", until), [*keys, *SLICES])
    there = (rows["_at"] >= spans["since"]) & (spans["_until"].isNull() | (rows["_at"] < spans["_until"]))
    joined = rows.join(F.broadcast(spans), match(rows, spans, keys) & there, "left")
    return joined.select(*rows.columns, *[F.coalesce(f"_r_{name}", F.lit(1)).alias(name) for name in SLICES])


def on_grid(left: DataFrame, right: DataFrame, left_id: Sequence[str], right_id: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Both sides with columns ``_a`` and ``_b`` to join on as well: a row is in its own slice and meets all of the other side."""

    def laid(df: DataFrame, row_id: Sequence[str], own: tuple[str, str], other: tuple[str, str]) -> DataFrame:
        mine = df.withColumn(own[1], F.pmod(F.xxhash64(*row_id), F.col(own[0])).cast("int"))
        copies = mine.withColumn(other[1], F.explode(F.sequence(F.lit(0), F.col(other[0]) - 1)))
        return copies.drop(*SLICES)

    a, b = (SLICES[0], GRID[0]), (SLICES[1], GRID[1])
    return laid(left, left_id, a, b), laid(right, right_id, b, a)


def placed_stream(spark: SparkSession, folder: str) -> DataFrame:
    """The rows that ``place`` has handed on, as a stream."""
    schema = spark.read.parquet(f"{folder}/placed").drop("batch").schema
    return spark.readStream.schema(schema).parquet(f"{folder}/placed")
