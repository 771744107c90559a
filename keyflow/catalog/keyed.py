"""Running and final aggregates per key, keyed state, timers."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.catalog import query
from keyflow.catalog.sql import READINGS, WORDS
from keyflow.functions.accumulator import LevelCounts, Reduce
from keyflow.operators import running, scan, timers, transforms
from keyflow.plans.hotsplit import hash_sample
from keyflow.schema import ARRIVAL_ORDER, lines, readings

KEY = ["id"]
SO_FAR = "PARTITION BY id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW"


def _sensor(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readings(spark, sf_dir).select("seq", "id", "ts", "vc")


@query(
    f"""WITH {WORDS}
    SELECT doc_id, pos, word, count(*) OVER (PARTITION BY word ORDER BY doc_id, pos
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM w"""
)
def word_count_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Word sizes are estimated on one document in 16, so that texts are not taken apart once more for them."""
    text = lines(spark, sf_dir)
    some = transforms.numbered_words(hash_sample(text, 16, ["doc_id"]))
    return running.word_count_running(transforms.numbered_words(text), ["doc_id", "pos"], some, 1 / 16)


def _running_sql(expression: str, name: str, cast: str) -> str:
    return f"""WITH {READINGS}
    SELECT seq, id, ts, first_value(ts) OVER ({SO_FAR}) AS first_ts,
           CAST({expression} OVER ({SO_FAR}) AS {cast}) AS {name} FROM r"""


@query(_running_sql("sum(vc)", "running_vc", "BIGINT"))
def running_sum(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.running_sum(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER, "vc")


@query(_running_sql("max(vc)", "running_vc", "INTEGER"))
def running_max(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.running_max(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER, "vc")


@query(_running_sql("min(vc)", "running_vc", "INTEGER"))
def running_min(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.running_min(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER, "vc")


def _running_best_sql(best: str) -> str:
    return f"""WITH {READINGS},
    m AS (SELECT seq, id, {best}(vc) OVER ({SO_FAR}) AS best_vc FROM r),
    f AS (SELECT id, vc, min(ts) AS best_ts FROM r GROUP BY id, vc)
    SELECT m.seq, m.id, best_vc, best_ts FROM m JOIN f ON m.id = f.id AND m.best_vc = f.vc"""


def _best(rows: DataFrame, *keep: str) -> DataFrame:
    return rows.select(*keep, F.col("best.vc").alias("best_vc"), F.col("best.ts").alias("best_ts"))


@query(_running_best_sql("max"))
def running_max_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(running.running_max_by(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER, "vc"), "seq", "id")


@query(_running_best_sql("min"))
def running_min_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(running.running_min_by(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER, "vc"), "seq", "id")


@query(
    f"""WITH {READINGS},
    n AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY vc DESC, ts, seq) AS k FROM r)
    SELECT id, vc AS best_vc, ts AS best_ts FROM n WHERE k = 1"""
)
def max_by_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _best(running.max_by_final(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER, "vc"), "id")


@query(f"WITH {READINGS} SELECT seq, id, ts, vc, bit_xor(vc) OVER ({SO_FAR}) AS reduced FROM r")
def running_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reduce supplied as Columns: the parity of the levels so far, bit by bit."""

    def both(early: Column, late: Column) -> Column:
        return F.coalesce(early.bitwiseXOR(late), early, late)

    return running.running_reduce(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER, F.bit_xor("vc"), F.bit_xor, both)


@query(f"WITH {READINGS} SELECT seq, id, ts, vc, CAST(sum(vc) OVER ({SO_FAR}) AS BIGINT) AS reduced FROM r")
def custom_reduce(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A reduce function supplied in Python."""
    add = Reduce(lambda a, b: a + b)
    return scan.keyed_scan(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER, add, ["vc"], "reduced", T.LongType())


@query(
    f"""WITH {READINGS}
    SELECT seq, id, vc AS curr, last FROM (
        SELECT *, lag(vc, 1, 0) OVER (PARTITION BY id ORDER BY ts, seq) AS last FROM r)
    WHERE abs(vc - last) > 10"""
)
def jump_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.jump_alarm(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER).select("seq", "id", "curr", "last")


TOP3_SQL = f"""WITH {READINGS}
    SELECT seq, id, array_to_string(list_slice(list_reverse_sort(list(vc) OVER ({SO_FAR})), 1, 3), ',') AS top
    FROM r"""


@query(TOP3_SQL)
def top3_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = running.top_running(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER)
    return top.select("seq", "id", F.array_join(F.col("top").cast("array<string>"), ",").alias("top"))


@query(
    f"""WITH {READINGS},
    n AS (SELECT id, vc, row_number() OVER (PARTITION BY id ORDER BY vc DESC, ts, seq) AS rank FROM r)
    SELECT id, vc, CAST(rank AS INTEGER) AS rank FROM n WHERE rank <= 3"""
)
def top3_final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.top_final(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER).select("id", "vc", "rank")


@query(f"WITH {READINGS} SELECT id, vc, count(*) AS cnt FROM r GROUP BY id, vc")
def level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.level_counts(_sensor(spark, sf_dir), KEY)


LEVEL_COUNTS_SQL = f"""WITH {READINGS}
    SELECT seq, id, vc, count(*) OVER (PARTITION BY id, vc ORDER BY ts, seq
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cnt FROM r"""


@query(LEVEL_COUNTS_SQL)
def level_counts_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.level_counts_running(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER).drop("ts")


@query(
    f"""WITH {READINGS},
    c AS (
        SELECT x.seq, x.id, y.vc, count(*) AS n FROM r x JOIN r y ON x.id = y.id AND y.ts <= x.ts
        GROUP BY x.seq, x.id, y.vc
    )
    SELECT seq, id, string_agg(vc || '=' || n, ',' ORDER BY vc) AS levels FROM c GROUP BY seq, id"""
)
def level_map_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After each record, the counts of all levels of its sensor."""
    out = scan.keyed_scan(
        _sensor(spark, sf_dir), KEY, ARRIVAL_ORDER, LevelCounts(), ["vc"], "levels", T.StringType()
    )
    return out.select("seq", "id", "levels")


@query(f"WITH {READINGS} SELECT seq, id, CAST(sum(vc) OVER ({SO_FAR}) AS BIGINT) AS sum_vc FROM r")
def running_sum_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reducing state, a missing level counting as 0."""
    level = _sensor(spark, sf_dir).withColumn("vc", running.level_or_zero())
    out = running.running_sum(level, KEY, ARRIVAL_ORDER, "vc")
    return out.select("seq", "id", F.col("running_vc").alias("sum_vc"))


@query(f"WITH {READINGS} SELECT seq, id, avg(vc) OVER ({SO_FAR}) AS mean FROM r")
def running_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return running.running_mean(_sensor(spark, sf_dir), KEY, ARRIVAL_ORDER).select("seq", "id", "mean")


BUCKETS = 4


@query(
    f"""WITH {READINGS}
    SELECT seq, seq % {BUCKETS} AS bucket, row_number() OVER (PARTITION BY seq % {BUCKETS} ORDER BY ts, seq) AS cnt
    FROM r"""
)
def bucket_counter(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = running.bucket_counter(_sensor(spark, sf_dir), BUCKETS, F.col("seq"), ARRIVAL_ORDER)
    return counted.select("seq", "bucket", "cnt")


@query(
    f"""WITH {READINGS}
    SELECT DISTINCT id, ts + INTERVAL 1 HOUR AS fires_at FROM r
    WHERE ts + INTERVAL 1 HOUR <= (SELECT max(ts) FROM r) - INTERVAL 1 HOUR"""
)
def event_timers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timers.event_timers(_sensor(spark, sf_dir), KEY, "ts", "1 HOUR", "1 HOUR")


@query(
    f"""WITH {READINGS},
    n AS (SELECT id, ts, lead(ts) OVER (PARTITION BY id ORDER BY ts, seq) AS next FROM r)
    SELECT id, ts AS last_ts, ts + INTERVAL 12 HOUR AS fires_at FROM n
    WHERE next > ts + INTERVAL 12 HOUR
       OR (next IS NULL AND ts + INTERVAL 12 HOUR <= (SELECT max(ts) FROM r) - INTERVAL 1 HOUR)"""
)
def inactivity_alarm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return timers.inactivity_alarm(_sensor(spark, sf_dir), KEY, "ts", ARRIVAL_ORDER, "12 HOUR", "1 HOUR")
