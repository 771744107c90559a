import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"

# Columns whose names are also used inside the operators.
CLASHING = ("_row", "_k", "_t", "hits", "shard", "block", "uid", "id", "text_", "piece", "_hits", "label", "h", "n")


@pytest.fixture
def docs(spark):
    """Texts as a table of documents with ids from 0; a pair gives the id too, a triple also the source."""

    def make(*texts):
        rows = []
        for i, t in enumerate(texts):
            key, body, source = (*t, "s")[:3] if isinstance(t, tuple) else (i, t, "s")
            rows.append((key, body, "en", source, None if body is None else len(body)))
        return spark.createDataFrame(rows, DOCS)

    return make


@pytest.fixture
def odd(docs):
    """Null and empty texts, null keys, repeated rows, a very long text, and columns with clashing names."""
    from pyspark.sql import functions as F

    long = " ".join(f"w{i}" for i in range(30_000))
    table = docs(
        (1, None), (2, ""), (3, " \n\t"), (None, "a b"), (None, None), (4, "x y z"), (4, "x y z"), (4, "other words"), (5, long)
    )
    return table.withColumns({n: F.lit("clash") for n in CLASHING})


def rows(df, *columns):
    """All rows as tuples, sorted with nulls first."""
    out = [tuple(r[c] for c in (columns or df.columns)) for r in df.collect()]
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])
