"""Blobs as DataFrames: names, contents and metadata; written and rewritten by partition."""

from __future__ import annotations

from pathlib import PurePosixPath

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from palimpsest.functions.columns import blob_path, strip_container

META = "map<string,string>"


def scan(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(name, content, length, modified) of all files below a root; content is read only if it is used."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    base = PurePosixPath(root).as_posix().rstrip("/")
    return rows.select(F.regexp_replace("path", f"^.*?{base}/", "").alias("name"), "content", "length", F.col("modificationTime").alias("modified"))


def names(blobs: DataFrame) -> DataFrame:
    """Distinct names without the container's."""
    return blobs.select(strip_container("name").alias("name")).distinct()


def load(blobs: DataFrame, name: str) -> bytes:
    """Contents of one blob; a missing one raises."""
    row = blobs.where(strip_container("name") == strip_container(F.lit(name))).select("content").first()
    if row is None:
        raise ValueError(f"no blob {name}")
    return bytes(row["content"])


def text(blobs: DataFrame) -> DataFrame:
    return blobs.select("name", F.decode("content", "UTF-8").alias("text"))


def json_rows(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    reader = spark.read.option("multiLine", "true").option("recursiveFileLookup", "true")
    return (reader.schema(schema) if schema else reader).json(path)


def text_files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("wholetext", "true").option("recursiveFileLookup", "true").text(path)


def catalog(blobs: DataFrame) -> DataFrame:
    """Parts of each name beside its metadata; names of other forms are left out."""
    p = blobs.withColumn("p", blob_path("name")).where("p is not null")
    return p.select("name", "p.stage", "p.company", "p.policy", "p.timestamp", "p.run_id", *(["metadata"] if "metadata" in blobs.columns else []))


def write(rows: DataFrame, root: str, *partition: str) -> None:
    """Writes rows as parquet by partition; partitions that occur are replaced, others stay (an overwrite by key)."""
    w = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*partition) if partition else w).parquet(root)


def upsert(old: DataFrame, new: DataFrame, *key: str) -> DataFrame:
    """Old rows whose key has no new row, and the new rows; of several new rows of a key the last by all columns."""
    last = new.withColumn("_n", F.row_number().over(Window.partitionBy(*key).orderBy(*[F.col(c).desc() for c in new.columns if c not in key and not dict(new.dtypes)[c].startswith("map")] or [F.lit(1)]))).where("_n = 1").drop("_n")
    return old.join(last.select(*key), list(key), "left_anti").unionByName(last)


def replace_metadata(blobs: DataFrame, changes: DataFrame) -> DataFrame:
    """Blobs with their metadata replaced where changes has a row; changes of blobs that don't exist do nothing."""
    new = changes.select("name", F.col("metadata").alias("new_metadata"))
    return blobs.join(new, "name", "left").withColumn("metadata", F.coalesce("new_metadata", "metadata")).drop("new_metadata")


def remove(blobs: DataFrame, gone: DataFrame) -> DataFrame:
    """Blobs without those named; names that don't exist do nothing."""
    return blobs.join(gone.select("name").distinct(), "name", "left_anti")


class MemoryBlobs:
    """A store in memory with the same operations, for tests and for small tools on the driver."""

    def __init__(self, container: str = "documents"):
        self.container, self.blobs, self.metadata, self.made = container, {}, {}, False

    def _key(self, name: str) -> str:
        return name.removeprefix(f"{self.container}/")

    def create(self) -> None:
        self.made = True

    def exists(self, name: str) -> bool:
        return self._key(name) in self.blobs

    def list(self) -> list[str]:
        if not self.made:
            raise ValueError("container is missing")
        return sorted(self.blobs)

    def upload(self, name: str, data: bytes, metadata: dict[str, str] | None = None) -> None:
        self.blobs[self._key(name)] = data
        self.metadata[self._key(name)] = dict(metadata or {})

    def load(self, name: str) -> bytes:
        if not self.exists(name):
            raise ValueError(f"no blob {name}")
        return self.blobs[self._key(name)]

    def load_metadata(self, name: str) -> dict[str, str]:
        self.load(name)
        return self.metadata[self._key(name)]

    def upload_metadata(self, name: str, metadata: dict[str, str]) -> None:
        if self.exists(name):
            self.metadata[self._key(name)] = dict(metadata)

    def remove(self, name: str) -> None:
        self.blobs.pop(self._key(name), None)
        self.metadata.pop(self._key(name), None)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(k, bytearray(v), self.metadata[k]) for k, v in sorted(self.blobs.items())]
        return spark.createDataFrame(rows, f"name string, content binary, metadata {META}")
