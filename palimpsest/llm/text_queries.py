"""Queries of problems 2, 4 and 7."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.llm.lookalikes import affected, one_form
from palimpsest.llm.repeated_lines import deleted_blocks, lines_to_delete, without_lines
from palimpsest.llm.residue import marked, residue_windows
from palimpsest.session import cut, table


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return affected(table(spark, sf_dir, "doc_chunks"), cut=cut).select("chunk_id").distinct()


def p2_one_form(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_form(table(spark, sf_dir, "doc_chunks"), cut=cut)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return residue_windows(table(spark, sf_dir, "doc_chunks")).select("chunk_id").distinct()


def p4_marked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marked(table(spark, sf_dir, "doc_chunks"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_to_delete(table(spark, sf_dir, "doc_chunks"), cut=cut)


def p7_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the repeated blocks stand that no other covers, and how many lines they have."""
    return deleted_blocks(table(spark, sf_dir, "doc_chunks"), cut=cut).drop("row")


def p7_without(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = table(spark, sf_dir, "doc_chunks")
    return without_lines(chunks, lines_to_delete(chunks, cut=cut))


QUERIES = {"p2_found": p2_found, "p2_one_form": p2_one_form, "p4_found": p4_found, "p4_marked": p4_marked, "p7_found": p7_found, "p7_blocks": p7_blocks, "p7_without": p7_without}

P7 = r"""
WITH raw AS (SELECT chunk_id, company, policy, string_split(text, chr(10)) AS ls FROM doc_chunks WHERE text IS NOT NULL AND company IS NOT NULL AND policy IS NOT NULL),
lines AS (SELECT chunk_id, company, policy, unnest(ls) AS l, unnest(range(len(ls))) AS line_no FROM raw),
keyed AS (SELECT chunk_id, company, policy, line_no::INT AS line_no,
  regexp_replace(trim(regexp_replace(lower(upper(l)), '[\s\x1c-\x1f\x{85}\p{Z}\x{b}]+', ' ', 'g')), '[0-9]+', '0', 'g') AS k FROM lines),
totals AS (SELECT company, count(DISTINCT policy) AS n FROM doc_chunks WHERE policy IS NOT NULL GROUP BY 1),
hot AS (SELECT company, k FROM keyed WHERE k <> '' GROUP BY 1, 2 HAVING count(DISTINCT policy) >= 4
  AND count(DISTINCT policy) >= ceil(round((SELECT n FROM totals t WHERE t.company = keyed.company) * 0.3, 6)))
"""

ORACLES = {
    "p7_found": P7 + "SELECT chunk_id, line_no FROM keyed JOIN hot USING (company, k)",
    "p7_without": P7 + """, gone AS (SELECT chunk_id, list(DISTINCT line_no) AS nos FROM keyed JOIN hot USING (company, k) GROUP BY 1)
SELECT chunk_id, CASE WHEN nos IS NULL THEN text ELSE array_to_string(list_transform(list_filter(range(len(ls)), lambda i: NOT list_contains(nos, i)), lambda i: ls[i + 1]), chr(10)) END AS text
FROM (SELECT chunk_id, text, string_split(text, chr(10)) AS ls, nos FROM doc_chunks LEFT JOIN gone USING (chunk_id))""",
}
