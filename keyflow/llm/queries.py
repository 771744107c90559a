"""The registered queries of the operators, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow.llm import (
    decontamination,
    language,
    licenses,
    neardup,
    negatives,
    neighbours,
    packing,
    quality,
    resampling,
    secrets,
    sharding,
    sql,
    suffixes,
    urls,
)
from keyflow.llm.common import table
from keyflow.llm.vocabularies import added, pieces, tokenizer

Run = Callable[[SparkSession, str], DataFrame]


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign(table(spark, sf_dir, "documents"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), *tokenizer(), added=added())


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"))


def op6_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.deduplicate(table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, urls.train(urls.labelled_by_rules(pages)))


def op9_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.join(table(spark, sf_dir, "documents"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return language.identify(documents, language.train(documents, pieces()))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op13_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id, label = F.col("vec_id"), F.col("label")
    moved = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.mine(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, label=moved)


RUNS: tuple[Run, ...] = (
    op1_sharding,
    op2_packing,
    op3_secrets,
    op4_licenses,
    op5_quality,
    op6_suffixes,
    op7_decontamination,
    op8_urls,
    op9_neardup,
    op10_language,
    op11_resampling,
    op12_neighbours,
    op13_negatives,
)


def queries() -> dict[str, Run]:
    return {run.__name__: run for run in RUNS} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    """The others cannot be expressed in DuckDB's SQL: see tests/llm for what they are compared with."""
    own = {"op11_resampling": sql.RESAMPLING, "op13_negatives": sql.NEGATIVES}
    return own | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
