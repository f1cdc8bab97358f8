"""A corpus from documents: language, near duplicates, benchmark leaks, secrets, mixture.

Each stage works on what its predecessor kept. All but the last return the columns of
documents; the last one emits every document as often as the mixture takes it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratamart.llm.common import apart, stored, table
from stratamart.llm.decontaminate import without_leaks
from stratamart.llm.jaccard import representatives
from stratamart.llm.language import UNKNOWN, fit, identify
from stratamart.llm.mixing import emitted, mix
from stratamart.llm.secret_scan import redacted

#: Calibrated probability below which a language counts as not recognised.
LEAST_SCORE = 0.4


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those without letters or with an unclear language go."""
    model = fit(docs)

    def recognised(rows: DataFrame) -> DataFrame:
        known = identify(rows, model).where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= LEAST_SCORE))
        return known.drop("lang_pred", "score")

    return apart(docs, ("text",), recognised).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of linked ones."""
    return representatives(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark."""
    return redacted(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target asks for, with its number among its copies."""
    needed = ("doc_id", "source", "text")
    return apart(docs, needed, lambda rows: emitted(mix(rows)).drop("source_size", "target", "copies", "taken"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
]

#: Two stages cannot be stated in SQL; tests/llm/test_pipeline.py tests the stages and their chain on a small corpus.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
