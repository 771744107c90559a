"""What the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.session import scratch_dir

# The letters lower-cased by ``ascii_lower`` (A-Z only, whatever the locale).
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"

ROW = "_row"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def written(df: DataFrame, label: str) -> DataFrame:
    """Writes a table into the shared scratch folder and reads it back.

    Later jobs read the files, so that a lost executor costs them nothing that was worked out before.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# Rows of a few numbers each that may be broadcast.
BROADCAST_ROWS = 500_000


def sent(df: DataFrame, label: str) -> DataFrame:
    """A narrow table for the right side of a join: written, counted, and broadcast if it is small enough."""
    kept = written(df, label)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def numbered(df: DataFrame, name: str = ROW) -> DataFrame:
    """Adds a number that tells rows apart, repeated rows too. Write the result before it is read twice."""
    return df.withColumn(name, F.monotonically_increasing_id())
