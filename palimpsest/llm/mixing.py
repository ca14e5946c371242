"""Mixing sources to target weights (problem 9).

Every document of a source gets the same number of expected copies, the smaller of the source's cap and what brings it to
its target. Prefix sums of expected copies run through each source in a fixed order, shifted by one random offset a mix and
source, and a document is emitted once for each whole number they cross (systematic sampling). The order goes by size, so
that the chosen sizes follow the source's. Ranks come from counts of small buckets, so no source meets in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 64


def ranked(sized: DataFrame) -> DataFrame:
    """(doc_id, source, n_tokens, rank from 0 within the source). Order: size class, hash slice, size, id."""
    rows = sized.select(
        "doc_id", "source", "n_tokens", F.monotonically_increasing_id().alias("tie"),
        (F.floor(F.log2(F.col("n_tokens").cast("double")) * 4) * SLICES + F.pmod(F.xxhash64("doc_id"), F.lit(SLICES))).cast("long").alias("bucket"),
    )
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    heads = rows.groupBy("source", "bucket").agg(F.count("*").alias("n")).select("source", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("head"))
    within = Window.partitionBy("source", "bucket").orderBy("n_tokens", "doc_id", "tie")
    return rows.join(heads, ["source", "bucket"]).select("doc_id", "source", "n_tokens", (F.col("head") + F.row_number().over(within) - 1).alias("rank"))


def plans(sized: DataFrame, targets: DataFrame, totals: DataFrame, seed: int) -> DataFrame:
    """Expected copies and offset of each mix and source; a source without documents has no tokens and no copies.

    The size of a mix is corpus_ratio of the tokens of all documents, whatever their source. Targets with a null mix, source,
    share or cap are left out; shares and caps below zero count as zero.
    """
    stats = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count_if(F.col("n_tokens") > 0).alias("docs"))
    corpus = sized.agg(F.sum("n_tokens")).first()[0] or 0
    wanted = targets.dropna(subset=["mix_name", "source", "target_share", "max_repeats"]).join(F.broadcast(totals.dropna()), "mix_name")
    goal = F.greatest(F.lit(0.0).cast("double"), F.col("target_share")) * F.col("corpus_ratio") * F.lit(corpus)
    return (
        wanted.join(stats, "source", "left")
        .select(
            "mix_name", "source", "target_share", goal.alias("goal_tokens"), F.coalesce("tokens", F.lit(0)).alias("source_tokens"),
            F.when(F.coalesce("tokens", F.lit(0)) > 0, F.least(F.greatest(F.col("max_repeats"), F.lit(0)).cast("double"), goal / F.col("tokens"))).otherwise(F.lit(0.0)).cast("double").alias("copies"),
            (F.pmod(F.xxhash64("mix_name", "source", F.lit(seed)), F.lit(1_000_003)) / F.lit(1_000_003)).cast("double").alias("shift"),
        )
    )


def mix(sized: DataFrame, targets: DataFrame, totals: DataFrame, seed: int = 17) -> DataFrame:
    """(mix_name, source, doc_id, n_tokens, repeats) of the chosen documents, each at most max_repeats times.

    sized: doc_id, source, n_tokens. Documents of null source or of none of the targets, and texts without tokens (null and
    empty), are in no mix. Repeated rows are documents of their own.
    """
    plan = plans(sized, targets, totals, seed).where("copies > 0")
    # the target table is fixed and small (one row a mix and source)
    hit = ranked(sized.where("source is not null and n_tokens > 0").join(F.broadcast(targets.select("source").distinct()), "source", "left_semi")).join(F.broadcast(plan), "source")
    upto = lambda r: F.floor(r * F.col("copies") + F.col("shift"))
    return hit.withColumn("repeats", (upto(F.col("rank") + 1) - upto(F.col("rank"))).cast("int")).where("repeats > 0").select("mix_name", "source", "doc_id", "n_tokens", "repeats")


def shares(mixed: DataFrame, sized: DataFrame, targets: DataFrame, totals: DataFrame, seed: int = 17) -> DataFrame:
    """Of each mix and source the share of the mix's tokens beside the target, with tokens wanted and given."""
    got = mixed.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count("*").alias("documents"), F.max("repeats").alias("most_repeats"))
    rows = plans(sized, targets, totals, seed).select("mix_name", "source", "target_share", "goal_tokens").join(got, ["mix_name", "source"], "left").fillna(0, ["tokens", "documents", "most_repeats"])
    whole = F.sum("tokens").over(Window.partitionBy("mix_name"))
    return rows.select("mix_name", "source", "target_share", F.when(whole > 0, F.col("tokens") / whole).otherwise(F.lit(0.0)).cast("double").alias("actual_share"), "goal_tokens", "tokens", "documents", "most_repeats")
