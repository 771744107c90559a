"""From raw documents to packed training sequences.

Each stage takes any table with the columns of ``documents``; further columns are kept up to packing, whatever their
names. Keys may be null or repeated: rows are judged by their texts, and what holds for a row holds for its copies.
An empty table gives an empty one.
"""

from __future__ import annotations

from keyflow.llm import decontamination, language, neardup, packing, secrets
from keyflow.llm.common import table, written
from keyflow.llm.vocabularies import added, pieces, tokenizer
from pyspark.sql import DataFrame, SparkSession


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; those without text (null or empty) or letters, or with an unsure language, go."""
    return language.recognised(docs, language.train(docs, pieces()))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that hangs together by a similarity of 0.8 or more on runs of five words.

    Null texts and those without words are no copies of anything and stay. Of repeated rows one stays.
    """
    return neardup.one_of_each(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Null and empty texts and repeated rows stay."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, owner-specific secrets replaced in their texts; a null text stays null, a null source is one owner."""
    return secrets.redact(docs, size="n_chars")


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences of at most 1024 tokens. A null text is an empty one."""
    return packing.pack(docs, *tokenizer(), added=added())


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# The language model, the tokens and the packing are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over ``documents``, each one's result written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
