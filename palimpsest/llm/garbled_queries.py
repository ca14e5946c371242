"""Queries of problem 10."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm.garbled import garbled_words, restored
from palimpsest.session import cut, table


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return garbled_words(table(spark, sf_dir, "documents", "doc_id", "text"), cut=cut).select("doc_id").distinct()


def p10_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return restored(table(spark, sf_dir, "documents", "doc_id", "text"), cut=cut)


QUERIES = {"p10_found": p10_found, "p10_restored": p10_restored}
ORACLES: dict[str, str] = {}
