"""Text files that roll by size, as they are found on disk."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.catalog import query
from keyflow.catalog.sql import READINGS
from keyflow.schema import ARRIVAL_ORDER, readings
from keyflow.session import scratch_dir
from keyflow.sinks.rolling import manifest, read_rolled, rolled_text
from keyflow.sinks.writers import BatchWriter
from keyflow.streaming.run import run_query
from keyflow.streaming.slices import run_in_slices

FILE = ["bucket", "span", "part"]
MOST_BYTES = 4096
WEEK = 7 * 86400

LINES = f"""{READINGS},
    l AS (SELECT event_type AS bucket, seq, ts, seq || ',' || id || ',' || vc AS value FROM r)"""


def _writer(path: str) -> BatchWriter:
    line = F.concat_ws(",", "seq", "id", "vc")
    return rolled_text(path, F.col("event_type"), line, ARRIVAL_ORDER, MOST_BYTES, "ts", WEEK)


@query(
    f"""WITH {LINES},
    s AS (SELECT bucket, seq, ts, CAST(epoch_us(ts) // {WEEK}000000 AS BIGINT) AS span, strlen(value) + 1 AS b FROM l),
    p AS (SELECT *, (sum(b) OVER (PARTITION BY bucket, span ORDER BY ts, seq) - b) // {MOST_BYTES} AS part FROM s)
    SELECT bucket, span, CAST(part AS BIGINT) AS part, count(*) AS lines, CAST(sum(b) AS BIGINT) AS bytes
    FROM p GROUP BY ALL"""
)
def file_sink_rolls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files by type and week, cut at 4096 bytes: the lines read back from each, and its size on disk."""
    path = f"{scratch_dir(spark, 'rolls')}/out"
    _writer(path)(readings(spark, sf_dir), 0)
    found = read_rolled(spark, path).groupBy(*FILE).agg(F.count("*").alias("lines"))
    return found.join(manifest(spark, path).select(*FILE, "bytes"), FILE)


@query(f"WITH {LINES} SELECT bucket, value FROM l")
def stream_file_rolls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from a stream, batch by batch: all lines, each in one file."""
    folder = scratch_dir(spark, "rolls")
    write = _writer(f"{folder}/out")
    run_in_slices(
        readings(spark, sf_dir), ARRIVAL_ORDER, folder, lambda stream: run_query(stream, write, f"{folder}/checkpoint")
    )
    return read_rolled(spark, f"{folder}/out").select("bucket", "value")
