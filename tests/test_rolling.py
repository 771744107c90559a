"""Files that roll by bytes or age, and appear batch by batch."""

import os

import pytest
from pyspark.sql import functions as F

from keyflow.session import LISTING, listing, scratch_dir
from keyflow.sinks.rolling import last_batch, manifest, read_rolled, rolled_text

DDL = "seq bigint, bucket string, value string, s bigint"


def table(spark, rows):
    return spark.createDataFrame(rows, DDL).withColumn("at", F.timestamp_seconds("s"))


def writer(path, **more):
    return rolled_text(path, F.col("bucket"), F.col("value"), ["seq"], 50, **more)


def expected(rows, seconds=None):
    """Each line's file, by adding up the bytes line by line."""
    used, files = {}, {}
    for seq, bucket, value, s in sorted(rows):
        key = (bucket or None, 0 if seconds is None else None if s is None else s // seconds)
        size = len((value or "").encode()) + 1
        files.setdefault((*key, used.get(key, 0) // 50), []).append(value or "")
        used[key] = used.get(key, 0) + size
    return files


def read(spark, path, batch=0):
    found = {}
    for row in read_rolled(spark, path).where(F.col("batch") == batch).collect():
        found.setdefault((row.bucket, row.span, row.part), []).append(row.value)
    return found


@pytest.mark.parametrize("seconds", [None, 30])
def test_every_line_is_in_the_file_its_place_gives(spark, layout, seconds):
    rows = [(i, "a b:+%/é", "é" * (i * 7 % 23), i) for i in range(150)]
    rows += [(200, None, "x", 1), (201, "", None, 1), (202, "long", "y" * 500, 1), (203, "long", "z", 1), (204, "z", "", None)]
    path = scratch_dir(spark, "rolls")
    writer(path, **({} if seconds is None else {"time": "at", "most_seconds": seconds}))(table(spark, rows), 0)
    want = expected(rows, seconds)
    assert {key: sorted(lines) for key, lines in read(spark, path).items()} == {key: sorted(lines) for key, lines in want.items()}
    for row in manifest(spark, path).where("bucket IS NOT NULL").collect():
        lines = want[row.bucket, row.span, row.part]
        # The limit, and at most the line that crosses it; lines stand in their order.
        assert row.bytes == sum(len(line.encode()) + 1 for line in lines)
        assert row.bytes <= 50 + len(lines[-1].encode())
        folder = "span=" + ("__HIVE_DEFAULT_PARTITION__" if row.span is None else str(row.span))
        assert f"/{folder}/part={row.part}/" in row.path
        with open(row.path.removeprefix("file:"), encoding="utf-8") as file:
            assert file.read() == "".join(f"{line}\n" for line in lines)


def test_a_repeated_batch_leaves_no_second_copy(spark):
    rows = table(spark, [(i, "a", "line", 0) for i in range(40)])
    path = scratch_dir(spark, "rolls")
    write = writer(path)
    write(rows, 0)
    files = sorted(row.path for row in manifest(spark, path).collect())
    write(rows, 0)
    assert sorted(row.path for row in manifest(spark, path).collect()) == files
    on_disk = [name for folder, _, names in os.walk(f"{path}/files") for name in names if name.endswith(".txt")]
    assert len(on_disk) == len(files)
    write(rows, 1)
    assert read_rolled(spark, path).count() == 80


def test_a_batch_lost_half_way_is_not_seen_and_written_anew(spark, monkeypatch):
    rows = table(spark, [(i, "a", "line", 0) for i in range(40)])
    path = scratch_dir(spark, "rolls")
    writer(path)(rows, 0)
    # The files of batch 1 are there, those of another attempt, but the manifest doesn't list them.
    left = rows.selectExpr("'a' AS bucket", "0 AS span", "9 AS part", "value")
    left.write.partitionBy("bucket", "span", "part").text(f"{path}/files/batch=1")
    assert last_batch(spark, path) == 0
    assert read_rolled(spark, path).count() == 40
    writer(path)(rows.limit(3), 1)
    assert read_rolled(spark, path).count() == 43
    assert read_rolled(spark, path).where("part = 9").count() == 0


def test_nothing_written(spark):
    path = scratch_dir(spark, "rolls")
    assert read_rolled(spark, path).count() == 0
    assert manifest(spark, path).count() == 0
    writer(path)(table(spark, []), 0)
    assert last_batch(spark, path) == -1
    writer(path)(table(spark, [(1, "a", "b", 0)]), 1)
    assert read(spark, path, 1) == {("a", 0, 0): ["b"]}


def test_few_bytes_in_many_files_are_many_tasks_with_few_listing_them(spark, monkeypatch):
    rows = table(spark, [(i, f"b{i}", "line", 0) for i in range(60)])
    path = scratch_dir(spark, "rolls")
    listed = spark.conf.get(LISTING, None)
    seen = []
    monkeypatch.setattr("keyflow.sinks.rolling.listing", lambda session: seen.append(session) or listing(session), raising=False)
    writer(path)(rows, 0)
    # The name of a file begins with the number of its task.
    tasks = {row.path.rsplit("/", 1)[1][:10] for row in manifest(spark, path).collect()}
    assert len(tasks) > 4
    assert read_rolled(spark, path).count() == 60
    assert len(seen) == 2 and spark.conf.get(LISTING, None) == listed
    with listing(spark):
        assert spark.conf.get(LISTING) == "32"
