"""Audits of what a pipeline holds: missing outputs, counts of tasks, listings, and touching of blobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.functions.columns import blob_path


def missing_outputs(expected: DataFrame, present: DataFrame, *by: str) -> DataFrame:
    """Per stage: expected outputs, those missing, and 'missing n/total'. Both hold stage and the key columns."""
    have = present.select("stage", *by).distinct().withColumn("have", F.lit(1))
    got = expected.select("stage", *by).distinct().join(have, ["stage", *by], "left")
    return got.groupBy("stage").agg(F.count_if(F.col("have").isNull()).alias("n_missing"), F.count("*").alias("n_total")).withColumn("report", F.format_string("missing %d/%d", "n_missing", "n_total"))


def expected_outputs(captures: DataFrame, stages: list[str]) -> DataFrame:
    """Every stage's expected output of every capture; a document without captures is expected once in the first stage only."""
    return captures.select("company", "policy", "version_ts").distinct().select(F.explode(F.array(*[F.lit(s) for s in stages])).alias("stage"), "company", "policy", "version_ts")


def task_counters(tasks: DataFrame, *dims: str) -> DataFrame:
    """Number of tasks by each dimension in one pass over the input: (dimension, value, n)."""
    return tasks.select(F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dims])).alias("x")).groupBy("x.dimension", "x.value").agg(F.count("*").alias("n"))


def nested_listing(names: DataFrame, name: str = "name") -> DataFrame:
    """Of each stage and company the policies and the number of blobs; names of other forms are left out."""
    p = names.select(blob_path(name).alias("p")).where("p is not null").select("p.*")
    return p.groupBy("stage", "company").agg(F.array_sort(F.collect_set("policy")).alias("policies"), F.count("*").alias("n_blobs"))


def touched(blobs: DataFrame, stamp, stage: str | None = None, company: str | None = None, policy: str | None = None, timestamp: str | None = None, run_id: str | None = None) -> DataFrame:
    """The blobs chosen (timestamp by its beginning, all else by equality) with `touched` put into their metadata."""
    hit = F.lit(True)
    for col, value in (("stage", stage), ("company", company), ("policy", policy), ("run_id", run_id)):
        if value is not None:
            hit &= F.col(col) == value
    if timestamp is not None:
        hit &= F.col("timestamp").startswith(timestamp)
    entry = F.map_from_arrays(F.array(F.lit("touched")), F.array(F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss")))
    rest = F.map_filter(F.coalesce("metadata", F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))), lambda k, v: k != "touched")
    return blobs.where(hit).withColumn("metadata", F.map_concat(rest, entry))


def not_yet(rows: DataFrame, done: DataFrame, *key: str) -> DataFrame:
    """Rows whose output does not exist yet."""
    return rows.join(done.select(*key).distinct(), list(key), "left_anti")


def only_existing(rows: DataFrame, held: DataFrame, *key: str) -> DataFrame:
    return rows.join(held.select(*key).distinct(), list(key), "left_semi")


def first_per(rows: DataFrame, n: int, key: list[str], *order) -> DataFrame:
    """The first n rows of each key in an order."""
    return rows.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where(F.col("_n") <= n).drop("_n")
