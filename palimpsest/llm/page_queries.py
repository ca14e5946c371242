"""Queries of problem 1."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm.boilerplate import around_lines, main_lines
from palimpsest.session import table


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return around_lines(table(spark, sf_dir, "doc_chunks", "chunk_id", "text"))


def p1_main(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_lines(table(spark, sf_dir, "doc_chunks", "chunk_id", "text"))


QUERIES = {"p1_found": p1_found, "p1_main": p1_main}
ORACLES: dict[str, str] = {}
