"""Session, table access and lineage cutting shared by every operator."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "palimpsest", cpus: int | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A local session for tests and the bench; a cluster hands in its own."""
    n = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    spark = (
        SparkSession.builder.master(f"local[{n}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")  # Python stages over small tables keep their parallelism
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("PALIMPSEST_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One parquet table, pruned to `columns` when they are named (all otherwise)."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use spark.checkpoint.dir of the session. Where none is set, a session in one process takes a local folder (tests) and a cluster is refused."""
    if spark.sparkContext.getCheckpointDir() is None:
        where = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
        if not where and not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        spark.sparkContext.setCheckpointDir(where or tempfile.mkdtemp(prefix="palimpsest-ckpt-"))


def cut(df: DataFrame, eager: bool = True) -> DataFrame:
    """Cut lineage through a reliable checkpoint in the shared folder (survives lost executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Rows by keys over all shuffle partitions: few bytes that cost much Python each must not be coalesced into one task."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors' Python workers this package through Spark's own file server, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        here = Path(__file__).resolve().parent
        target = Path(tempfile.mkdtemp(prefix="palimpsest-pkg-")) / f"{here.name}.zip"
        with zipfile.ZipFile(target, "w") as z:
            for f in sorted(here.rglob("*.py")):
                z.write(f, f.relative_to(here.parent))
        spark.sparkContext.addPyFile(str(target))
        _SHIPPED.add(app)
    return spark
