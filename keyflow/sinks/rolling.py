"""Text files that roll by bytes or by age, and become visible batch by batch.

Which file a line belongs to is worked out before anything is written: lines have an order within their bucket,
a running sum of their bytes tells where each one starts, and a file takes the lines that start in its share
of the bytes. That sum is a scan that cuts crowded buckets into chunks, so that one full bucket is as many tasks.

A batch is written into a folder of its own and counts from the moment its files are listed in the manifest, a
single file that appears at once and holds a row for each of them. A batch that was lost half way is written anew, over what it left.
One that is in the manifest already is not written again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.plans import hotsplit
from keyflow.session import listing
from keyflow.sinks.writers import BatchWriter

MANIFEST = "batch bigint, bucket string, span bigint, part bigint, path string, bytes bigint"
LISTED = "path string, modificationTime timestamp, length bigint, content binary, bucket string, span bigint, part bigint"
LINES = "value string, batch bigint, bucket string, span bigint, part bigint"


def with_parts(
    df: DataFrame, order: Sequence[str], most_bytes: int, time: str | None = None, most_seconds: int | None = None
) -> DataFrame:
    """Adds ``span`` and ``part``, which together with ``bucket`` name the file of each line ``value``.

    No file holds more than ``most_bytes`` and one line, line ends counted, and with ``time`` and
    ``most_seconds`` none holds lines from more than one span of that many seconds (counted from
    the epoch; 0 without). Lines with no time share a span, that with no number. ``order`` must be unique within a bucket.
    """
    span = F.lit(0).cast("bigint")
    if most_seconds is not None:
        span = F.floor(F.unix_micros(F.col(time).cast("timestamp")) / F.lit(most_seconds * 1_000_000)).cast("bigint")
    sized = df.withColumn("span", span).withColumn("_bytes", F.octet_length(F.coalesce("value", F.lit(""))) + F.lit(1).cast("bigint"))
    ends = hotsplit.running(sized, ["bucket", "span"], order, _end=hotsplit.total("_bytes"))
    start = F.col("_end") - F.col("_bytes")
    return ends.withColumn("part", F.floor(start / F.lit(most_bytes)).cast("bigint")).drop("_bytes", "_end")


def rolled_text(
    path: str,
    bucket: Column,
    line: Column,
    order: Sequence[str],
    most_bytes: int = 128 << 20,
    time: str | None = None,
    most_seconds: int | None = None,
) -> BatchWriter:
    """Writes micro-batches, or a table as a single one, to text files of limited size, in the order given.

    Batches must come with ascending numbers, as those of a stream do. Null lines are empty ones,
    a null bucket is a bucket and an empty one is null, lines must not hold line ends. A batch without rows writes nothing. At most one
    task writes to a file, and a task may write several files one after the other.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= last_batch(spark, path) or batch.isEmpty():
            return
        # The bucket and the line must not be confused with columns of the batch that have their names.
        inner = [F.col(name).alias(f"_o{at}") for at, name in enumerate(order)]
        at = [] if most_seconds is None else [F.col(time).alias("_time")]
        rows = batch.select(F.nullif(bucket.cast("string"), F.lit("")).alias("bucket"), line.cast("string").alias("value"), *inner, *at)
        names = [f"_o{at}" for at in range(len(order))]
        placed = with_parts(rows, names, most_bytes, "_time", most_seconds)
        file = ["bucket", "span", "part"]
        # As many tasks as there may be: what a file costs doesn't follow from its bytes, so few bytes don't mean few tasks.
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
        lined = placed.repartition(tasks, *file).sortWithinPartitions(*file, *names)
        folder = f"{path}/files/batch={batch_id}"
        lines = lined.select(*file, F.coalesce("value", F.lit("")).alias("value")).write.partitionBy(*file).mode("overwrite")
        # Each task moves its own files into place, not the driver those of all; none counts before the manifest lists it.
        lines.option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(folder)
        # A row for each file: sizes and names come from a listing, contents are not read.
        with listing(spark):
            listed = spark.read.schema(LISTED).format("binaryFile").load(folder)
        entry = listed.select(F.lit(batch_id).cast("bigint").alias("batch"), *file, "path", F.col("length").alias("bytes"))
        entry.repartition(1).write.mode("append").parquet(f"{path}/manifest")

    return write


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """The files of all batches that are complete, with their sizes in bytes."""
    try:
        return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], MANIFEST)


def last_batch(spark: SparkSession, path: str) -> int:
    """The newest complete batch, -1 before the first. All earlier ones are complete too."""
    newest = manifest(spark, path).agg(F.max("batch").alias("batch")).first()["batch"]
    return -1 if newest is None else newest


def read_rolled(spark: SparkSession, path: str) -> DataFrame:
    """The lines of all complete batches with the file they are in; a batch being written is not seen."""
    newest = last_batch(spark, path)
    if newest < 0:
        return spark.createDataFrame([], LINES)
    with listing(spark):
        return spark.read.schema(LINES).text(f"{path}/files").where(F.col("batch") <= newest)
