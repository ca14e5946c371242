"""Pipeline stages as streams: files that arrive, versions that come late, breaker and limiter as keyed state."""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator
from datetime import datetime

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from palimpsest.operators.control import STRIKES, Limiter
from palimpsest.session import ensure_checkpoint_dir

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below the checkpoint folder that all executors share."""
    ensure_checkpoint_dir(spark)
    return os.path.join(spark.sparkContext.getCheckpointDir(), f"stream-{uuid.uuid4().hex}")


def arrivals(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None, pattern: str = "*.parquet") -> DataFrame:
    """Rows of parquet files as they arrive. A pattern without wildcards names a table in `path`: one file, or a folder of files of any name."""
    r = spark.readStream.schema(schema)
    r = r.option("maxFilesPerTrigger", files_per_trigger) if files_per_trigger else r
    if any(c in pattern for c in "*?[{\\"):
        return r.option("pathGlobFilter", pattern).parquet(path)
    return r.parquet(f"{path}/[{pattern[0]}]{pattern[1:]}")  # a plain path must be a folder and a filter sees only names of files; a pattern of paths takes both


def run_available(stream: DataFrame, out: str, mode: str = "append") -> DataFrame:
    """Runs a stream over all that has arrived and ends; its rows are read back from `out`."""
    q = stream.writeStream.format("parquet").outputMode(mode).option("compression", "zstd").option("checkpointLocation", f"{out}-state").option("path", out).trigger(availableNow=True).start()
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema).parquet(out)


def chain(spark: SparkSession, source: str, schema, steps: dict[str, Callable[[DataFrame], DataFrame]], out: str, pattern: str = "*.parquet") -> dict[str, str]:
    """Runs stages one after the other, each a stream that is set off by the files the stage before wrote; gives the folder of each.

    Each stage keeps its own state, so that a later call takes up only what has arrived since.
    """
    where, folders = source, {}
    for name, step in steps.items():
        stream = step(arrivals(spark, where, schema, pattern=pattern))
        folders[name] = f"{out}/{name}"
        done = run_available(stream, folders[name])
        where, schema, pattern = folders[name], done.schema, "*.parquet"
    return folders


def recompute_keys(stream: DataFrame, history: Callable[[SparkSession], DataFrame], recompute: Callable[[DataFrame], DataFrame], key: list[str], out: str, state: str):
    """For each batch recomputes the documents it touches from their whole history and overwrites their partitions.

    A version that comes late between two others changes the difference of the one after it, which no watermark can tell;
    so the keys of a batch decide what is computed again.
    """

    def handle(batch: DataFrame, _: int) -> None:
        keys = batch.select(*key).distinct()
        rows = recompute(history(batch.sparkSession).join(keys, key, "left_semi"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*key).parquet(out)

    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", state).trigger(availableNow=True).start()


def _in_order(rows: Iterator[pd.DataFrame]) -> pd.DataFrame:
    """The rows of a key in one batch by time: their times and numbers only, which is all a fold needs to see at once."""
    return pd.concat(list(rows), ignore_index=True).sort_values(["ts", "seq"], kind="stable", ignore_index=True)


def _in_parts(rows: pd.DataFrame, more: Callable[[pd.DataFrame], pd.DataFrame], size: int = 10_000) -> Iterator[pd.DataFrame]:
    """Rows with what `more` says of them, in parts of bounded size."""
    for k in range(0, len(rows), size):
        part = rows.iloc[k : k + size].reset_index(drop=True)
        yield pd.concat([part, more(part)], axis=1)


class Breaker(StatefulProcessor):
    """Strikes of a workflow's breaker; one row out for each operation."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("breaker", "strikes int")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        strikes = self.state.get()[0] if self.state.exists() else STRIKES

        def fold(part: pd.DataFrame) -> pd.DataFrame:
            nonlocal strikes
            out = []
            for op in part["op"]:
                strikes = max(0, strikes - 1) if op == "TRIP" else STRIKES if op == "RESET" else strikes
                out.append((strikes, strikes == 0))
            return pd.DataFrame(out, columns=["strikes", "is_open"]).astype({"strikes": "int32"})

        yield from _in_parts(_in_order(rows)[["workflow", "ts", "seq", "op"]], fold)
        self.state.update((strikes,))

    def close(self) -> None:
        pass


class RateLimiter(StatefulProcessor):
    """Counts of a workflow's limiter; one row out for each call."""

    rpm, period = 10, 60

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("limiter", "used_previous int, used_current int, remaining int, last_success timestamp")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        lim = Limiter(self.rpm, self.period)
        if self.state.exists():
            lim.used_previous, lim.used_current, lim.remaining, last = self.state.get()
            lim.last_success = datetime.fromtimestamp(last.timestamp()) if last is not None else None

        def fold(part: pd.DataFrame) -> pd.DataFrame:
            out = [(lim.acquire(now), *lim.counts()) for now in (t.to_pydatetime() for t in part["ts"])]
            return pd.DataFrame(out, columns=["allowed", "used_previous", "used_current", "remaining"]).astype({"used_previous": "int32", "used_current": "int32", "remaining": "int32"})

        yield from _in_parts(_in_order(rows)[["workflow", "ts", "seq"]], fold)
        self.state.update((*lim.counts(), lim.last_success))

    def close(self) -> None:
        pass


def keyed_state(stream: DataFrame, processor: StatefulProcessor, schema: str) -> DataFrame:
    stream.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return stream.groupBy("workflow").transformWithStateInPandas(statefulProcessor=processor, outputStructType=schema, outputMode="Append", timeMode="None")


def breaker_stream(ops: DataFrame) -> DataFrame:
    return keyed_state(ops.select("workflow", "ts", "seq", "op"), Breaker(), "workflow string, ts timestamp, seq long, op string, strikes int, is_open boolean")


def limiter_stream(calls: DataFrame) -> DataFrame:
    return keyed_state(calls.select("workflow", "ts", "seq"), RateLimiter(), "workflow string, ts timestamp, seq long, allowed boolean, used_previous int, used_current int, remaining int")


def operations(events: DataFrame) -> DataFrame:
    """Operations on breakers made of an event log: errors trip, sign-ups reset, all else asks."""
    op = F.when(F.col("event_type") == "error", "TRIP").when(F.col("event_type") == "signup", "RESET").otherwise("GET_STATUS")
    return events.select(F.concat(F.lit("w"), (F.col("user_id") % 4).cast("string")).alias("workflow"), "ts", F.col("event_id").alias("seq"), op.alias("op"), F.col("props").alias("error"))
