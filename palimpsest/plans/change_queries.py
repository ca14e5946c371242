"""Queries over whole deliveries: snapshot changes (p5) and schema drift (p6)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from palimpsest.operators.schema_drift import schema_changes, schema_scripts, unified_records
from palimpsest.operators.snapshots import snapshot_changes
from palimpsest.session import cut, table


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshot_changes(table(spark, sf_dir, "doc_chunks"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema_changes(table(spark, sf_dir, "summary_records"), table(spark, sf_dir, "summary_files"), cut)


def p6_scripts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cheapest edit script of every file, with moves and renamed objects."""
    return schema_scripts(table(spark, sf_dir, "summary_records"), table(spark, sf_dir, "summary_files"), cut)


def p6_unified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unified_records(table(spark, sf_dir, "summary_records"), table(spark, sf_dir, "summary_files"), cut)


QUERIES = {"p5_found": p5_found, "p6_found": p6_found, "p6_scripts": p6_scripts, "p6_unified": p6_unified}

ORACLES = {
    "p5_found": """
WITH latest AS (
  SELECT company, policy, version_ts, chunk_idx, text FROM doc_chunks
  WHERE company IS NOT NULL AND policy IS NOT NULL AND version_ts IS NOT NULL AND chunk_idx IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY company, policy, version_ts, chunk_idx ORDER BY loaded_at DESC NULLS LAST, chunk_id DESC) = 1),
versions AS (
  SELECT company, policy, version_ts, lag(version_ts) OVER w AS prev_ts, lead(version_ts) OVER w AS next_ts
  FROM (SELECT DISTINCT company, policy, version_ts FROM latest) WINDOW w AS (PARTITION BY company, policy ORDER BY version_ts)),
now_rows AS (SELECT l.*, 1 AS hit FROM latest l JOIN versions v USING (company, policy, version_ts) WHERE v.prev_ts IS NOT NULL),
before_rows AS (SELECT l.company, l.policy, v.next_ts AS version_ts, l.chunk_idx, l.text, 1 AS hit
  FROM latest l JOIN versions v USING (company, policy, version_ts) WHERE v.next_ts IS NOT NULL)
SELECT company, policy, version_ts, chunk_idx,
  CASE WHEN b.hit IS NULL THEN 'added' WHEN n.hit IS NULL THEN 'removed' ELSE 'changed' END AS change_kind
FROM now_rows n FULL JOIN before_rows b USING (company, policy, version_ts, chunk_idx)
WHERE b.hit IS NULL OR n.hit IS NULL OR n.text IS DISTINCT FROM b.text
""",
}
