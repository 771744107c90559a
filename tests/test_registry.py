"""Every registered query against its SQL, run by an independent engine on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from keyflow import catalog

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Queries whose plan depends on key sizes, and the size above which a key is cut up.
SIZED = {
    name: 20
    for name in (
        "running_sum running_max running_min running_max_by running_min_by custom_reduce jump_alarm top3_running "
        "level_counts_running level_map_running running_avg bucket_counter inactivity_alarm keyed_connect_join "
        "window_join interval_join interval_join_bucketed interval_join_on_time session_fixed session_dynamic "
        "count_window_tumbling count_window_sliding count_window_sliding_step count_window_long stream_running_sum file_sink_rolls"
    ).split()
} | {"window_process": 1, "late_panes": 1, "word_count_running": 500}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return connection


def _rows(frame, columns):
    frame = frame[columns].copy()
    for name in columns:
        if "datetime" in str(frame[name].dtype):
            frame[name] = frame[name].astype("datetime64[us]")
    return frame.sort_values(columns).reset_index(drop=True)


def _compare(spark, duck, name, sf_dir=SF_DIR):
    got = entry.queries()[name](spark, sf_dir).toArrow().to_pandas()
    want = duck.execute(entry.oracle_sql()[name]).fetchdf()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    got, want = _rows(got, columns), _rows(want, columns)
    assert len(got) == len(want)
    for column in columns:
        same = (got[column] == want[column]) | (got[column].isna() & want[column].isna())
        assert same.all(), (column, got[~same].head(), want[~same].head())
        assert str(got[column].dtype) == str(want[column].dtype), column


@pytest.mark.parametrize("name", [name for name in catalog.load() if not name.startswith("stream_")])
def test_matches_sql(spark, duck, name):  # those over streams: test_slices.py
    _compare(spark, duck, name)


@pytest.mark.parametrize("name", SIZED)
def test_matches_sql_with_keys_cut_up(spark, duck, name):
    spark.conf.set("keyflow.rowsPerTask", str(SIZED[name]))
    try:
        _compare(spark, duck, name)
    finally:
        spark.conf.unset("keyflow.rowsPerTask")


def test_every_query_has_sql():
    assert all(query.sql for query in catalog.load().values())


def test_entry(spark):
    assert set(entry.entry(spark).columns) == {"word", "cnt"}


def test_queries_leave_the_session_as_it_was(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        rows = entry.queries()["lines_of_text"](spark, SF_DIR)
        assert spark.conf.get("spark.sql.session.timeZone") == "Asia/Tokyo"
        text = {(r.id, r.at) for r in rows.select("id", "at").collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert text == {(r.id, r.at) for r in entry.queries()["lines_of_text"](spark, SF_DIR).select("id", "at").collect()}
