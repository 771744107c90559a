import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from keyflow.llm import queries
from keyflow.llm.common import table

SF_DIR = "/root/testdata/sf0.001"


def test_stages_one_after_the_other(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    columns, before = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF_DIR)
        out.write.parquet(str(tmp_path / str(k)))
        docs, was = spark.read.parquet(str(tmp_path / str(k))), docs
        if name != "packing":
            assert docs.columns == columns
            assert docs.count() <= before
            if name == "near_duplicates":
                assert docs.count() < was.count()
            before = docs.count()
    assert docs.select("doc_id").distinct().count() == before
    assert corpus_pipeline.run(spark, SF_DIR).count() == docs.count()


# How many of the odd rows each stage keeps. Language: those with letters. Near duplicates: all but a repeated row.
KEPT = {"language": 5, "near_duplicates": 8, "decontamination": 9, "secrets": 9}


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows_and_on_none(spark, odd, name, stage):
    """Null and empty texts, null keys, repeated rows, a very long text, clashing columns; then no rows at all."""
    out = stage(spark, odd, SF_DIR)
    if name == "packing":
        pieces = out.select("doc_id", "piece").collect()
        assert sum(row.piece == 0 for row in pieces) == odd.count()  # each row of the table has its first piece
        assert sum(row.doc_id is None for row in pieces) == 2
    else:
        assert out.columns == odd.columns
        got, given = [tuple(row) for row in out.collect()], [tuple(row) for row in odd.collect()]
        assert len(got) == KEPT[name]
        assert set(got) <= set(given)  # as they were
        texts = odd.columns.index("text")
        if name == "language":
            assert all(row[texts] and row[texts].strip() for row in got)
        else:
            assert set(got) == set(given)
    none = stage(spark, odd.limit(0), SF_DIR)
    assert none.columns == out.columns and none.count() == 0


def test_every_query_is_registered():
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} <= {name.split("_")[0] for name in names}
    assert "pipeline" in names and set(queries.oracle_sql()) <= names


OF_VECTORS = ("op12_neighbours", "op13_negatives")  # rows for each query or anchor: see test_vectors.py


@pytest.mark.parametrize("name", [n for n in queries.queries() if n != "pipeline" and n not in OF_VECTORS])
def test_queries_return_a_row_for_each_row_of_their_table(spark, name):
    out = queries.queries()[name](spark, SF_DIR).toPandas()
    key = "page_id" if name == "op8_urls" else "doc_id"
    source = "pages" if name == "op8_urls" else "documents"
    ids = {r[0] for r in duckdb.sql(f"SELECT {key} FROM '{SF_DIR}/{source}.parquet'").fetchall()}
    if name == "op7_decontamination":
        assert set(out[key]) < ids
    else:
        assert set(out[key]) == ids
        assert name == "op2_packing" or len(out) == len(ids)
