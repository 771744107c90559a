"""Running streams so that they can be stopped, lost and started again.

Every query has a checkpoint folder. Started again with the same folder it goes on where it
stopped. Results are written per micro-batch, and a repeated micro-batch replaces its own output.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from keyflow.sinks.writers import BatchWriter, batch_folders


def start(writer: DataStreamWriter, checkpoint: str, every: str | None = None, name: str | None = None):
    """Starts a stream: over what is there now, or again and again at an interval."""
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def run_query(
    df: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    mode: str = "append",
    name: str | None = None,
) -> None:
    """Works off everything there is now, then stops."""
    start(df.writeStream.outputMode(mode).foreachBatch(write), checkpoint, name=name).awaitTermination()


def run_to_folder(df: DataFrame, folder: str, mode: str = "append", name: str | None = None) -> DataFrame:
    """Runs a stream into ``folder`` and reads back what it has written, ``batch`` telling the batches apart."""
    run_query(df, batch_folders(f"{folder}/out"), f"{folder}/checkpoint", mode, name)
    return read_batches(df.sparkSession, f"{folder}/out", df.schema)


def read_batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.LongType())])).parquet(path)


def latest_update(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The newest row per key of a result written in update mode."""
    values = [name for name in batches.columns if name not in (*keys, "batch")]
    newest = batches.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_row"))
    return newest.select(*keys, "_row.*")


def read_state(spark: SparkSession, checkpoint: str, operator_id: int = 0) -> DataFrame:
    """The stored state of a stopped query, for inspection."""
    return spark.read.format("statestore").option("operatorId", operator_id).load(checkpoint)
