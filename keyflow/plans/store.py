"""Keeping an intermediate table that several results are made from."""

from __future__ import annotations

from pyspark.sql import DataFrame

from keyflow.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """Writes a table into the shared scratch folder and reads it back, so that it is worked out once."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
