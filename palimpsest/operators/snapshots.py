"""Changes between consecutive full snapshots of a keyed table.

Every key is windowed by *snapshot index*, not by row neighbour alone: lag() of the content hash shows
changes, and gaps in the index show removals and later re-additions. Only hashes travel, never the texts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_delivery(rows: DataFrame, group: list[str], version: str, key: str, value: str, loaded: str, tiebreak: str) -> DataFrame:
    """One row per (group, version, key): the latest delivered; ties on `loaded` go to the greatest `tiebreak`.

    Null `loaded` counts as the earliest. Rows with null group, version or key identify no cell and are left out.
    The result holds a 128-bit fingerprint of `value`, in which null is a value of its own.
    """
    cells = rows.select(
        *[F.col(c).alias(c) for c in group],
        F.col(version).alias("version_ts"),
        F.col(key).alias("key"),
        F.struct(F.col(loaded).alias("l"), F.col(tiebreak).alias("t")).alias("rank"),
        F.struct(F.col(value).isNull().alias("n"), F.xxhash64(value).alias("h"), F.hash(value).alias("g"), F.length(value).alias("c")).alias("print"),
    ).dropna(subset=[*group, "version_ts", "key"])
    return cells.groupBy(*group, "version_ts", "key").agg(F.max_by("print", "rank").alias("print"))


def version_index(cells: DataFrame, group: list[str]) -> DataFrame:
    """Versions of each group with their index, the next version and the number of versions.

    Distinct versions are pre-aggregated first, so the window sees one row per version, however many rows a version has.
    """
    by = Window.partitionBy(*group).orderBy("version_ts")
    return (
        cells.groupBy(*group, "version_ts").agg(F.count("*").alias("n_rows"))
        .withColumn("idx", F.row_number().over(by))
        .withColumn("next_ts", F.lead("version_ts").over(by))
    )


def snapshot_changes(
    rows: DataFrame,
    group: list[str] = ["company", "policy"],  # noqa: B006
    version: str = "version_ts",
    key: str = "chunk_idx",
    value: str = "text",
    loaded: str = "loaded_at",
    tiebreak: str = "chunk_id",
) -> DataFrame:
    """added / removed / changed cells between each version of a group and the one before.

    Columns: group columns, version_ts (the later version), `key`, change_kind. The first version of a group yields nothing.
    An empty table gives no rows; columns beyond those named are ignored, so clashing names do no harm.
    """
    cells = latest_delivery(rows, group, version, key, value, loaded, tiebreak)
    versions = version_index(cells, group)
    placed = cells.join(versions.select(*group, "version_ts", "idx", "next_ts"), [*group, "version_ts"])
    by = Window.partitionBy(*group, "key").orderBy("idx")
    seen = placed.select(
        *group, "version_ts", "key", "idx", "next_ts", "print",
        F.lag("idx").over(by).alias("was_idx"), F.lag("print").over(by).alias("was"), F.lead("idx").over(by).alias("will_idx"),
    )
    kept = F.col("was_idx") == F.col("idx") - 1
    events = F.array(
        F.when(kept & (F.col("was") != F.col("print")), F.struct(F.col("version_ts").alias("at"), F.lit("changed").alias("kind"))),
        F.when((F.col("idx") > 1) & (F.col("was_idx").isNull() | ~kept), F.struct(F.col("version_ts").alias("at"), F.lit("added").alias("kind"))),
        F.when(
            F.col("next_ts").isNotNull() & (F.col("will_idx").isNull() | (F.col("will_idx") != F.col("idx") + 1)),
            F.struct(F.col("next_ts").alias("at"), F.lit("removed").alias("kind")),
        ),
    )
    return (
        seen.withColumn("e", F.explode(F.array_compact(events)))
        .select(*group, F.col("e.at").alias("version_ts"), F.col("key").alias(key), F.col("e.kind").alias("change_kind"))
    )
