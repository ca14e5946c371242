"""Running work: what is in flight, what to stop, resets that are confirmed, and pages due again."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from time import sleep

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from palimpsest.operators.control import STRIKES


def in_flight(spark: SparkSession, page_size: int = 100) -> Iterator[list[dict]]:
    """Active streams by pages of at most page_size."""
    rows = [{"id": str(q.id), "name": q.name, "status": q.status["message"], "active": q.isActive} for q in spark.streams.active]
    for k in range(0, len(rows), page_size):
        yield rows[k : k + page_size]


def stop(spark: SparkSession, chosen: Callable[[str | None, str], bool]) -> list[str]:
    """Stops the streams whose name and status message are chosen; gives their names."""
    gone = []
    for q in spark.streams.active:
        if chosen(q.name, q.status["message"]):
            q.stop()
            gone.append(q.name)
    return gone


def in_flight_page(tasks: DataFrame, token: str | None = None, page_size: int = 100) -> DataFrame:
    """The next page of running tasks by id after a token; the last id of a page is the token of the next.

    tasks: task_id, status. A page is a limit by its nature: only its rows are sorted to the end and leave the executors.
    """
    rows = tasks.where(F.col("status") == "Running")
    return (rows.where(F.col("task_id") > token) if token is not None else rows).orderBy("task_id").limit(page_size)


def all_in_flight(tasks: DataFrame, page_size: int = 100) -> Iterator[list]:
    """Pages of running tasks until none is left."""
    token = None
    while page := in_flight_page(tasks, token, page_size).collect():
        yield page
        token = page[-1]["task_id"]


def breaker_states(spark: SparkSession, state: str) -> DataFrame:
    """(workflow, strikes, is_open) of every breaker as the stream's state store holds it. state: the stream's checkpoint folder."""
    rows = spark.read.format("statestore").option("stateVarName", "breaker").load(state)
    return rows.select(F.col("key.workflow").alias("workflow"), F.col("value.strikes").alias("strikes"), (F.col("value.strikes") <= 0).alias("is_open"))


class Circuit:
    """Breakers of a running stream: operations are sent as files to the folder it reads, and its state store is asked."""

    def __init__(self, spark: SparkSession, inbox: str, state: str, advance: Callable[[], None] = lambda: None):
        """advance: lets a stream that does not run by itself take in what has arrived."""
        self.spark, self.inbox, self.state, self.advance = spark, inbox, state, advance

    def check(self, workflow: str) -> dict:
        """Strikes left and whether the circuit is open; a breaker that was never used is closed."""
        row = breaker_states(self.spark, self.state).where(F.col("workflow") == workflow).first()
        return {"workflow": workflow, "strikes": row.strikes if row else STRIKES, "is_open": bool(row and row.is_open)}

    def send(self, workflow: str, op: str, ts, seq: int) -> None:
        row = self.spark.createDataFrame([(workflow, ts, seq, op)], "workflow string, ts timestamp, seq long, op string")
        row.coalesce(1).write.mode("append").parquet(self.inbox)
        self.advance()

    def reset(self, workflow: str, ts, seq: int, wake: Callable[[], None] = lambda: None, **how) -> bool:
        """A reset that is confirmed by the state, after which what waits is woken."""
        return confirmed_reset(lambda: self.send(workflow, "RESET", ts, seq), lambda: not self.check(workflow)["is_open"], wake, **how)


def confirmed_reset(send: Callable[[], None], is_closed: Callable[[], bool], wake: Callable[[], None], steps: int = 10, first: float = 0.1, pause: Callable[[float], None] = sleep) -> bool:
    """Sends a reset, asks until the breaker is closed (each pause twice the one before), then wakes what waits for it."""
    send()
    for k in range(steps):
        if is_closed():
            wake()
            return True
        pause(first * 2**k)
    return False


def due_again(captures: DataFrame, now, days: int = 7) -> DataFrame:
    """Pages whose latest readable capture is at least `days` old; a page without one is due."""
    from palimpsest.functions.columns import capture_time

    last = captures.groupBy("company", "policy").agg(F.max(capture_time(F.col("capture_ts"))).alias("last_capture"))
    return last.where(F.col("last_capture").isNull() | (F.col("last_capture") <= now - F.expr(f"INTERVAL {int(days)} DAYS")))
