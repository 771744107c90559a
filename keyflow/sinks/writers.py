"""Sinks: console, bucketed text files, databases, Kafka, and several outputs of one stream."""

from __future__ import annotations

import os
import time
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from keyflow.session import drop, scratch_dir

BatchWriter = Callable[[DataFrame, int], None]


def console(df: DataFrame, label: str | None = None) -> DataStreamWriter:
    """Prints a stream, each row behind its label."""
    shown = df if label is None else df.select(F.lit(label).alias("label"), "*")
    return shown.writeStream.format("console").option("truncate", "false")


def _with_bucket(df: DataFrame, time_column: str, line: Column, pattern: str) -> DataFrame:
    """Rows with their folder. A full folder is spread over tasks, small ones share one."""
    bucketed = df.select(F.date_format(time_column, pattern).alias("bucket"), line.alias("value"))
    return bucketed.hint("rebalance", "bucket")


def bucketed_text_stream(
    df: DataFrame,
    path: str,
    time_column: str,
    line: Column,
    rows_per_file: int = 1_000_000,
    pattern: str = "yyyy-MM-dd HH",
) -> DataStreamWriter:
    """Text files in one folder per hour, exactly once. Files roll by row count and per trigger."""
    bucketed = _with_bucket(df, time_column, line, pattern)
    return (
        bucketed.writeStream.format("text")
        .partitionBy("bucket")
        .option("path", path)
        .option("maxRecordsPerFile", rows_per_file)
    )


def write_bucketed_text(
    df: DataFrame,
    path: str,
    time_column: str,
    line: Column,
    rows_per_file: int = 1_000_000,
    pattern: str = "yyyy-MM-dd HH",
) -> None:
    """The same folders from a bounded table."""
    bucketed = _with_bucket(df, time_column, line, pattern)
    bucketed.write.partitionBy("bucket").option("maxRecordsPerFile", rows_per_file).text(path)


def batch_folders(path: str) -> BatchWriter:
    """Writes each micro-batch to a folder of its own. A repeated batch replaces itself."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


def fan_out(outputs: Mapping[str, Callable[[DataFrame], DataFrame]]) -> BatchWriter:
    """Several outputs of one stream: ``{folder: part of the batch}``.

    The batch is written once and read back for each of them, so that none of it need be held in memory.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        once = scratch_dir(spark, "batch")
        try:
            batch.write.parquet(once)
            kept = spark.read.schema(batch.schema).parquet(once)
            for path, part in outputs.items():
                batch_folders(path)(part(kept), batch_id)
        finally:
            drop(spark, once)

    return write


def jdbc_options(url: str, table: str, batch_rows: int = 100, driver: str | None = None) -> dict[str, str]:
    """Options of a database table. User and password come from the environment, never from code."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_rows)}
    if driver:
        options["driver"] = driver
    for option, variable in (("user", "KEYFLOW_JDBC_USER"), ("password", "KEYFLOW_JDBC_PASSWORD")):
        if variable in os.environ:
            options[option] = os.environ[variable]
    return options


def jdbc_writer(options: Mapping[str, str], retries: int = 3, pause_seconds: float = 1.0) -> BatchWriter:
    """Appends each micro-batch to a database table, trying again when the database fails."""

    def append(batch: DataFrame, batch_id: int) -> None:
        batch.write.format("jdbc").options(**options).mode("append").save()

    return with_retries(append, retries, pause_seconds)


def with_retries(write: BatchWriter, retries: int = 3, pause_seconds: float = 1.0) -> BatchWriter:
    def attempt(batch: DataFrame, batch_id: int) -> None:
        for left in range(retries, -1, -1):
            try:
                return write(batch, batch_id)
            except Exception:
                if left == 0:
                    raise
                time.sleep(pause_seconds)

    return attempt


def kafka_stream(df: DataFrame, value: Column, servers: str, topic: str) -> DataStreamWriter:
    """Sends text to a Kafka topic. Needs Spark's Kafka package on the class path."""
    return kafka_rows(df, value).writeStream.format("kafka").options(**kafka_options(servers, topic))


def kafka_rows(df: DataFrame, value: Column) -> DataFrame:
    return df.select(value.cast("string").alias("value"))


def kafka_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}
