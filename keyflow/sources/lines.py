"""Sources of lines and rows, bounded and unbounded, and the line-to-record parser."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.functions.text import whole_number
from keyflow.schema import LINE, READING


def rows(spark: SparkSession, values: Iterable, schema: T.StructType | str) -> DataFrame:
    """Literal rows. Plain values become a one-column table."""
    return spark.createDataFrame(list(values), schema)


def text_file(spark: SparkSession, path: str) -> DataFrame:
    """A bounded text file, one row per line."""
    return spark.read.schema(LINE).text(path)


def text_stream(
    spark: SparkSession, path: str, files_per_trigger: int | None = None, bytes_per_trigger: int | None = None
) -> DataFrame:
    """A folder of text files as a stream of lines; new files are picked up as they appear."""
    return _file_stream(spark, LINE, files_per_trigger, bytes_per_trigger).text(path)


def parquet_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    files_per_trigger: int | None = None,
    bytes_per_trigger: int | None = None,
) -> DataFrame:
    """A folder of parquet files (or a glob over files) as a stream."""
    return _file_stream(spark, schema, files_per_trigger, bytes_per_trigger).parquet(path)


def _file_stream(spark: SparkSession, schema: T.StructType, files: int | None, size: int | None):
    """Micro-batches are bounded by a number of files or by their size, not both."""
    reader = spark.readStream.schema(schema)
    if files:
        reader = reader.option("maxFilesPerTrigger", files)
    elif size:
        reader = reader.option("maxBytesPerTrigger", size)
    return reader


def socket_lines(spark: SparkSession, host: str, port: int) -> DataFrame:
    """Lines sent to a socket by someone else, for trying things out (no replay after a failure)."""
    return spark.readStream.format("socket").option("host", host).option("port", port).load()


def generate(spark: SparkSession, n: int, value: Column | None = None) -> DataFrame:
    """``n`` generated rows, each made from its index (0, 1, ...)."""
    made = F.concat(F.lit("number:"), F.col("id")) if value is None else value
    return spark.range(n).select(F.col("id").alias("index"), made.alias("value"))


def generate_stream(spark: SparkSession, rows_per_second: int, value: Column | None = None) -> DataFrame:
    """Endless generated rows at a fixed rate."""
    rate = spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
    made = F.concat(F.lit("number:"), F.col("value")) if value is None else value
    return rate.select("timestamp", F.col("value").alias("index"), made.alias("value"))


def _fields(lines: DataFrame, schema: T.StructType, separator: str) -> DataFrame:
    parts = F.split("value", rf"\Q{separator}\E")
    parsed = []
    for position, field in enumerate(schema):
        text = F.get(parts, F.lit(position))
        is_text = isinstance(field.dataType, T.StringType)
        parsed.append((text if is_text else whole_number(text, field.dataType.simpleString())).alias(field.name))
    return lines.select("*", F.struct(*parsed).alias("_record"))


def _complete(schema: T.StructType) -> Column:
    complete = F.lit(True)
    for field in schema:
        complete = complete & F.col(f"_record.{field.name}").isNotNull()
    return complete


def parse(lines: DataFrame, schema: T.StructType = READING, separator: str = ",") -> DataFrame:
    """Lines as records. Extra fields are ignored; a missing field or bad number fails the job.

    The check is a condition on the row, so that it is made whatever columns are read afterwards.
    """
    fail = F.raise_error(F.concat(F.lit("not a record: "), F.coalesce("value", F.lit("null"))))
    sound = F.when(_complete(schema), F.lit(True)).otherwise(fail.cast("boolean"))
    parsed = _fields(lines, schema, separator).filter(sound)
    keep = [name for name in lines.columns if name != "value"]
    return parsed.select(*keep, "_record.*")


def parse_or_reject(
    lines: DataFrame, schema: T.StructType = READING, separator: str = ","
) -> tuple[DataFrame, DataFrame]:
    """Lines that are records, parsed, and the lines that are not."""
    parsed = _fields(lines, schema, separator)
    keep = [name for name in lines.columns if name != "value"]
    good = parsed.filter(_complete(schema)).select(*keep, "_record.*")
    return good, parsed.filter(~_complete(schema)).select(*lines.columns)


def kafka_options(servers: str, topic: str, group: str | None = None, start: str = "latest") -> Mapping[str, str]:
    """Options of a Kafka subscription."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
    }
    if group:
        options["kafka.group.id"] = group
    return options


def kafka_lines(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    """A Kafka topic as lines of text. Needs Spark's Kafka package on the class path."""
    stream = spark.readStream.format("kafka").options(**options).load()
    return stream.select(F.col("value").cast("string").alias("value"))
