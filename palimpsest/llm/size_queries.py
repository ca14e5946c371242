"""Queries of problems 3, 8 and 9."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.llm.mixing import mix, shares
from palimpsest.llm.packing import containers
from palimpsest.llm.tokens import counts, decode, encode
from palimpsest.session import cut, table


def p3_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    sections = table(spark, sf_dir, "diff_sections", "section_id", "company", "before", "after")
    chars = F.coalesce(F.length("before"), F.lit(0)) + F.coalesce(F.length("after"), F.lit(0))
    limits = [tuple(r) for r in table(spark, sf_dir, "prompt_limits", "limit_name", "capacity_chars").collect()]  # a fixed table of three rows
    return containers(sections.select("section_id", "company", chars.alias("chars")), limits, "company", "section_id", "chars")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return p3_containers(spark, sf_dir).where("part_no > 0").select("limit_name", "section_id").distinct()


def p3_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each section under each limit the number of its parts and all their characters: nothing is lost, split needlessly or packed twice."""
    got = p3_containers(spark, sf_dir).groupBy("limit_name", "section_id").agg(F.count("*").alias("parts"), F.sum("part_chars").alias("chars"), F.max("part_no").alias("last_part"))
    return got


def p3_overfull(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Containers that hold more than their limit, by limit: none may."""
    limits = F.broadcast(table(spark, sf_dir, "prompt_limits", "limit_name", "capacity_chars"))  # a fixed table of three rows
    each = p3_containers(spark, sf_dir).groupBy("limit_name", "company", "container").agg(F.sum("part_chars").alias("chars")).join(limits, "limit_name")
    return each.groupBy("limit_name").agg(F.count_if(F.col("chars") > F.col("capacity_chars")).alias("overfull"), F.sum("chars").alias("chars"))


def p3_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How full the containers of each limit are, and the share of the parts that the least-squares plans placed."""
    limits = F.broadcast(table(spark, sf_dir, "prompt_limits", "limit_name", "capacity_chars"))
    each = p3_containers(spark, sf_dir).groupBy("limit_name", "company", "container").agg(F.sum("part_chars").alias("chars"), F.count("*").alias("parts"), F.count_if("planned").alias("planned"))
    return each.join(limits, "limit_name").groupBy("limit_name").agg(
        F.count("*").alias("containers"), F.max("chars").alias("fullest"), F.max("capacity_chars").alias("capacity_chars"), (F.sum("chars") / F.sum("capacity_chars")).alias("fill"), (F.sum("planned") / F.sum("parts")).alias("planned_share")
    )


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents", "doc_id", "text"))


def p8_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents", "doc_id", "text"), offsets=True)


def p8_decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the texts put together again from their ids."""
    ids = encode(table(spark, sf_dir, "documents", "doc_id", "text"))
    return decode(ids).select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("n_chars"))


def _sized(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut(counts(table(spark, sf_dir, "documents", "doc_id", "text", "source"), "doc_id", "text", keep=("source",)))


def _mixes(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return table(spark, sf_dir, "mix_targets"), table(spark, sf_dir, "mix_totals")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_sized(spark, sf_dir), *_mixes(spark, sf_dir))


def p9_within_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each mix and source whether no document is repeated beyond its cap and none is of another source."""
    targets, totals = _mixes(spark, sf_dir)
    sized = _sized(spark, sf_dir)
    most = mix(sized, targets, totals).join(table(spark, sf_dir, "documents", "doc_id", "source").withColumnRenamed("source", "own"), "doc_id").groupBy("mix_name", "source").agg(F.max("repeats").alias("most"), F.bool_and(F.col("own") == F.col("source")).alias("own"))
    rows = targets.join(F.broadcast(most), ["mix_name", "source"], "left")  # one row a mix and source
    return rows.select("mix_name", "source", (F.coalesce("most", F.lit(0)) <= F.col("max_repeats")).alias("within"), F.coalesce("own", F.lit(True)).alias("own"))


def p9_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = _sized(spark, sf_dir)
    return shares(mix(sized, *_mixes(spark, sf_dir)), sized, *_mixes(spark, sf_dir))


QUERIES = {"p3_found": p3_found, "p3_containers": p3_containers, "p3_fill": p3_fill, "p3_parts": p3_parts, "p3_overfull": p3_overfull, "p8_ids": p8_ids, "p8_offsets": p8_offsets, "p8_decoded": p8_decoded, "p9_mix": p9_mix, "p9_within_caps": p9_within_caps, "p9_shares": p9_shares}

ORACLES = {
    "p3_found": """
SELECT limit_name, section_id FROM (SELECT DISTINCT section_id, coalesce(length(before), 0) + coalesce(length("after"), 0) AS n FROM diff_sections)
JOIN prompt_limits ON n > capacity_chars""",
    "p3_parts": """
SELECT limit_name, section_id, count(*) * greatest(1, ceil(any_value(n)::DOUBLE / any_value(capacity_chars)))::BIGINT AS parts, sum(n)::BIGINT AS chars, (greatest(1, ceil(max(n)::DOUBLE / any_value(capacity_chars))) - 1)::INT AS last_part
FROM (SELECT section_id, coalesce(length(before), 0) + coalesce(length("after"), 0) AS n FROM diff_sections), prompt_limits GROUP BY 1, 2""",
    "p3_overfull": """SELECT limit_name, 0 AS overfull, sum(coalesce(length(before), 0) + coalesce(length("after"), 0))::BIGINT AS chars FROM diff_sections, prompt_limits GROUP BY 1""",
    "p8_decoded": "SELECT doc_id, md5(coalesce(text, '')) AS digest, length(coalesce(text, ''))::INT AS n_chars FROM documents",
    "p9_within_caps": "SELECT mix_name, source, TRUE AS within, TRUE AS own FROM mix_targets",
}
