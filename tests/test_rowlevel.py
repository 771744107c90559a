import pytest
from pyspark.sql import functions as F

from keyflow.session import scratch_dir
from keyflow.functions.text import format_millis, message, split_words
from keyflow.operators import distribute, joins, split, transforms
from keyflow.operators.running import word_count, word_count_running
from keyflow.schema import READING, text_lines
from keyflow.sources import lines


def column(df, name):
    return [row[name] for row in df.collect()]


@pytest.mark.parametrize(
    "line, expected",
    [
        ("a b  ", ["a", "b"]),
        ("", [""]),
        ("  ", []),
        (" a", ["", "a"]),
        ("a  b", ["a", "", "b"]),
        (None, []),
    ],
)
def test_split_drops_only_trailing_blanks(spark, line, expected):
    table = lines.rows(spark, [(line,)], "value string")
    assert column(transforms.words(table), "word") == expected


def test_split_on_another_separator(spark):
    table = lines.rows(spark, [("a,b,,",), (".|$",)], "value string")
    assert column(transforms.words(table, separator=","), "word") == ["a", "b", ".|$"]
    assert column(transforms.words(table, separator="|"), "word") == ["a,b,,", ".", "$"]


LINES = [(0, "hello world"), (1, "hello spark"), (2, "hello java")]


def test_word_count(spark):
    words = transforms.words(lines.rows(spark, LINES, "n int, value string"))
    assert {row.word: row.cnt for row in word_count(words).collect()} == {"hello": 3, "world": 1, "spark": 1, "java": 1}


def test_word_count_running(spark, layout):
    words = transforms.numbered_words(lines.rows(spark, LINES, "n int, value string"))
    rows = word_count_running(words, ["n", "pos"]).orderBy("n", "pos").collect()
    assert [(row.word, row.cnt) for row in rows] == [
        ("hello", 1), ("world", 1), ("hello", 2), ("spark", 1), ("hello", 3), ("java", 1)
    ]


def test_text_file_and_parse(spark, tmp_path):
    (tmp_path / "in.txt").write_text("s1,1,1\ns2,2,-5,ignored\n")
    parsed = lines.parse(lines.text_file(spark, str(tmp_path)))
    assert sorted(map(tuple, parsed.collect())) == [("s1", 1, 1), ("s2", 2, -5)]
    assert parsed.schema == READING


@pytest.mark.parametrize("bad", ["s1,1", "s1,x,1", "s1, 1,1", "s1,1,1.5", "s1,1,99999999999"])
def test_bad_line_fails_or_is_rejected(spark, bad):
    table = lines.rows(spark, [("s1,1,1",), (bad,)], "value string")
    with pytest.raises(Exception, match="not a record"):
        lines.parse(table).collect()
    good, rejected = lines.parse_or_reject(table)
    assert column(good, "vc") == [1]
    assert column(rejected, "value") == [bad]


def test_generate(spark):
    assert column(lines.generate(spark, 10).orderBy("index"), "value") == [f"number:{i}" for i in range(10)]


def test_generate_stream(spark):
    stream = lines.generate_stream(spark, 5)
    assert stream.isStreaming and stream.columns == ["timestamp", "index", "value"]


def test_increment_and_lifecycle(spark):
    numbers = lines.rows(spark, [1, 2, 3, 4], "int")
    assert column(transforms.increment(numbers, "value"), "value") == [2, 3, 4, 5]
    mapped = transforms.map_with_setup(
        numbers, "value int, task int", lambda batch, task: batch.assign(value=batch["value"] + 1, task=task), setup=int
    )
    assert column(mapped, "value") == [2, 3, 4, 5]


def test_filter_and_project(spark):
    table = lines.rows(spark, [("s1", 1, 1), ("s2", 1, 1), ("s3", 1, 1)], READING)
    assert [tuple(row) for row in transforms.filter_equal(table, "id", "s1").collect()] == [("s1", 1, 1)]
    assert column(transforms.project(table, "id"), "id") == ["s1", "s2", "s3"]
    assert table.filter(transforms.above("vc", 1)).count() == 0


def test_remainder_keeps_sign(spark):
    table = lines.rows(spark, [-3, 4, 5], "int")
    assert column(table.select(transforms.remainder_key("value", 2).alias("r")), "r") == [-1, 0, 1]


def test_union(spark):
    text = lines.rows(spark, ["22", "999", "222", "999"], "string").select(F.col("value").cast("int").alias("value"))
    all_rows = joins.union_all(
        lines.rows(spark, [1, 2, 3, 4], "int"), lines.rows(spark, [12, 2222, 1113, 433], "int"), text
    )
    values = column(all_rows, "value")
    assert len(values) == 12 and values.count(999) == 2


def test_connect_maps_each_side(spark):
    numbers, text = lines.rows(spark, [1, 2], "int"), lines.rows(spark, ["3"], "string")
    out = joins.connect(
        numbers, text, [F.concat(F.lit("n"), "value").alias("x")], [F.concat(F.lit("t"), "value").alias("x")]
    )
    assert sorted(column(out, "x")) == ["n1", "n2", "t3"]


def test_routes_are_exclusive(spark):
    table = lines.rows(spark, [("s1", 1, 1), ("s2", 1, 20), ("s3", 1, 30)], READING)
    routed = split.route(table, {"first": F.col("id") == "s1", "second": F.col("id").isin("s1", "s2")})
    parts = split.outputs(routed, ["first", "second"])
    assert {name: column(part, "id") for name, part in parts.items()} == {
        "first": ["s1"], "second": ["s2"], "main": ["s3"]
    }
    main, alerts = split.alert_side_output(table, "vc", 20)
    assert main.count() == 3 and column(alerts, "vc") == [30]


def test_messages(spark):
    table = spark.sql("SELECT 15 AS vc, TIMESTAMP_NTZ '1970-01-01 00:00:01.5' AS ts")
    row = table.select(message("level %s above %s", "vc", F.lit(10)).alias("m"), format_millis("ts").alias("t")).first()
    assert tuple(row) == ("level 15 above 10", "1970-01-01 00:00:01.500")


def test_placement(spark):
    table = spark.range(100).withColumn("k", F.col("id") % 7)

    def tasks(df):
        return df.withColumn("task", F.spark_partition_id())

    keyed = tasks(distribute.key_by(table, 4, "k"))
    assert keyed.groupBy("k").agg(F.count_distinct("task").alias("n")).filter("n > 1").count() == 0
    assert distribute.shuffle(table, 4, ["id"]).rdd.getNumPartitions() == 4
    assert distribute.rescale(distribute.rebalance(table, 8), 4).rdd.getNumPartitions() == 4
    copies = tasks(distribute.replicate(table, 3))
    assert copies.groupBy("task").count().count() == 3
    assert copies.filter("task != spark_partition_id()").count() == 0
    placed = tasks(distribute.partition_by(table, 3, F.col("id") % 3))
    assert placed.filter(F.col("task") != F.col("id") % 3).count() == 0


def test_global_sequence(spark, layout):
    table = spark.range(50).select((49 - F.col("id")).alias("n"))
    rows = distribute.global_sequence(table, ["n"]).collect()
    assert len(rows) == 50 and all(row.position == row.n + 1 for row in rows)


def test_a_bad_line_fails_whatever_is_read(spark):
    table = spark.createDataFrame([("s1,1,1",), ("s1,x,2",)], "value string").withColumn("seq", F.lit(1))
    for read in (lambda df: df.select("seq").collect(), lambda df: df.count(), lambda df: df.select("vc").collect()):
        with pytest.raises(Exception, match="not a record"):
            read(lines.parse(table))
    assert lines.parse(table.filter("value = 's1,1,1'")).select("seq").count() == 1


def test_scratch_folder_must_be_shared():
    class Conf:
        def get(self, name, default):
            return default

    class Context:
        master = "spark://somewhere:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")
    Context.master = "local-cluster[2,1,1024]"
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_dir(Session(), "x")


@pytest.mark.parametrize("separator", list(" ,|.$^*+?()[]{}\\-&#\tx9é"))
def test_separators_stand_for_themselves(spark, separator):
    texts = ["", separator, separator * 3, f"{separator}a{separator}{separator}b{separator}", "no", f"q{separator}", "\\E|.y "]
    line = spark.createDataFrame([(n, text) for n, text in enumerate(texts)], "n int, value string")
    got = {row.n: row.words for row in line.select("n", split_words("value", separator).alias("words")).collect()}
    want = {n: [] if text and not text.strip(separator) else text.rstrip(separator).split(separator) for n, text in enumerate(texts)}
    assert got == want
    # No quoting, which would have each text split by a pattern compiled for it.
    assert r"\Q" not in str(split_words("value", separator))


def test_lines_of_texts(spark):
    table = spark.createDataFrame([(1, "a\n\nb\\n\n"), (2, None), (3, "")], "doc_id bigint, text string")
    lines = text_lines(table)
    assert [tuple(row) for row in lines.orderBy("doc_id").collect()] == [(1, "a  b\\n "), (2, None), (3, "")]
    assert "translate" not in lines._jdf.queryExecution().optimizedPlan().toString()
