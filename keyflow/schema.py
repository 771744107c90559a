"""Record types and the views the registered queries read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.plans.spread import spread

READING = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("ts", T.LongType()),
        T.StructField("vc", T.IntegerType()),
    ]
)

LINE = T.StructType([T.StructField("value", T.StringType())])

EVENT = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

DOCUMENT = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

# The order in which readings count as having arrived when nothing disturbs them. ``seq`` is
# unique, so the order is total.
ARRIVAL_ORDER = ["ts", "seq"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def level(value: Column | str) -> Column:
    """Whole-number level of a measured value."""
    return F.floor(value).cast("int")


def as_readings(events: DataFrame) -> DataFrame:
    """Events as sensor readings. Works on a table and on a stream."""
    return events.select(
        F.col("event_id").alias("seq"),
        F.col("user_id").alias("id"),
        "ts",
        level("value").alias("vc"),
        "event_type",
    )


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_readings(table(spark, sf_dir, "events"))


def with_arrival(df: DataFrame) -> DataFrame:
    """Adds an arrival time up to 4.8 hours after the event time, so that rows arrive disordered."""
    delay = F.make_dt_interval(mins=((F.col("seq") * 7919) % 97 * 3).cast("int"))
    return df.withColumn("arrival", F.col("ts") + delay)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as lines, ready to be taken apart."""
    return spread(text_lines(table(spark, sf_dir, "documents")))


def text_lines(documents: DataFrame) -> DataFrame:
    """Documents as one line of text each."""
    return documents.select("doc_id", F.replace("text", F.lit("\n"), F.lit(" ")).alias("value"))
