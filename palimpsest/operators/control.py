"""The control plane over event logs: circuit breaker, rate limiter and the orchestration of tasks."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from heapq import heappop, heappush

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from palimpsest.session import spread

STRIKES = 3
# Calls a period, its seconds, delay when throttled, attempts and delay between them, by workflow.
WORKFLOWS = {"summarizer": (50, 60, 20, 3, 60), "scraper": (10, 60, 20, 3, 120), "webscraper": (120, 60, 20, 3, 60), "meta": (5, 60, 20, 3, 180)}


def breaker_replay(ops: DataFrame, strikes: int = STRIKES, slice_seconds: int = 3600) -> DataFrame:
    """State of each workflow's breaker after every operation: trips since the last reset decide.

    ops: workflow, ts, seq, op (TRIP, RESET, GET_STATUS), error. Operations of other names change nothing. A workflow is not one
    task: operations are counted within slices of time, and each slice starts from what the slices before it leave,
    which is summed over one row a slice.
    """
    trip = F.col("op") == "TRIP"
    rows = ops.select("workflow", "ts", "seq", "op", "error").withColumn("slice", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (slice_seconds * 1_000_000)))
    inside = Window.partitionBy("workflow", "slice").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("epoch", F.sum(F.when(F.col("op") == "RESET", 1).otherwise(0)).over(inside))
    last_of = lambda c: F.max_by(F.when(trip, F.col(c)), F.when(trip, F.struct("ts", "seq")))
    ends = (
        rows.groupBy("workflow", "slice", "epoch").agg(F.count_if(trip).alias("trips"), last_of("error").alias("error"), last_of("ts").alias("at"))
        .groupBy("workflow", "slice").agg(F.max("epoch").alias("resets"), F.max_by(F.struct("trips", "error", "at"), "epoch").alias("end"))
    )
    by = Window.partitionBy("workflow").orderBy("slice")
    run = Window.partitionBy("workflow", "since").orderBy("slice").rowsBetween(Window.unboundedPreceding, 0)
    left = ends.withColumn("since", F.sum(F.when(F.col("resets") > 0, 1).otherwise(0)).over(by)).select(
        "workflow", "slice", F.sum("end.trips").over(run).alias("trips"), F.last("end.error", ignorenulls=True).over(run).alias("error"), F.last("end.at", ignorenulls=True).over(run).alias("at")
    )
    start = left.select("workflow", "slice", *[F.lag(c).over(by).alias(f"{c}_before") for c in ("trips", "error", "at")])
    within = Window.partitionBy("workflow", "slice", "epoch").orderBy("ts", "seq").rowsBetween(Window.unboundedPreceding, 0)
    so_far = lambda c: F.last(F.when(trip, F.col(c)), ignorenulls=True).over(within)
    counted = rows.withColumns({"own": F.sum(F.when(trip, 1).otherwise(0)).over(within), "own_error": so_far("error"), "own_at": so_far("ts")}).join(start, ["workflow", "slice"])
    carried = lambda own, before: F.when(F.col("epoch") == 0, F.coalesce(own, F.col(before))).otherwise(own)
    trips = F.col("own") + F.when(F.col("epoch") == 0, F.coalesce("trips_before", F.lit(0))).otherwise(F.lit(0))
    is_open = trips >= strikes
    return counted.select(
        "workflow", "ts", "seq", "op", F.greatest(F.lit(0), strikes - trips).cast("int").alias("strikes"), is_open.alias("is_open"),
        F.when(is_open, carried(F.col("own_error"), "error_before")).alias("error_message"), F.when(is_open, carried(F.col("own_at"), "at_before")).alias("opened_at"), (~is_open).alias("allowed"),
    )


@dataclass
class Limiter:
    """Calls counted by windows of `period` seconds: those of the window of the last call that went, and of the window before it."""

    rpm: int
    period: int = 60
    used_previous: int = 0
    used_current: int = 0
    remaining: int | None = None
    last_success: datetime | None = None

    def acquire(self, now: datetime) -> bool:
        """Whether a call may go now: the calls of its window and, weighted by what is left of the minute, of the window before
        stay below `rpm`. Counts are carried over by how many windows ago the last call went, whether or not this one may go."""
        here = now.timestamp() // self.period
        self.last_success = self.last_success or now
        ago = here - self.last_success.timestamp() // self.period
        self.used_previous, self.used_current = {0: (self.used_previous, self.used_current), 1: (self.used_current, 0)}.get(ago, (0, 0))
        allowed = self._admits(now.second)
        if allowed:
            self.used_current, self.last_success = self.used_current + 1, now
            self.remaining = self.rpm - self.used_current - self.used_previous
        return allowed

    def _admits(self, second: int) -> bool:
        weighted = self.used_current + self.used_previous * (self.period - second) / self.period
        return math.ceil(weighted) < self.rpm

    def shut_for(self, now: datetime) -> int:
        """For how many seconds, from the start of that of `now`, every call is turned away and changes nothing, as one just was: until
        less is left of the minute, or the window of the last call that went ends. None (0) in later windows, as the next call may go there."""
        here = now.timestamp() // self.period
        if here != self.last_success.timestamp() // self.period:
            return 0
        left = math.floor((here + 1) * self.period - now.replace(microsecond=0).timestamp())
        return max(0, min([left, *(s - now.second for s in range(now.second + 1, 60) if self._admits(s))]))

    def counts(self) -> tuple[int, int, int]:
        return self.used_previous, self.used_current, self.rpm if self.remaining is None else self.remaining


LIMITER_SCHEMA = "workflow string, ts timestamp, seq long, allowed boolean, used_previous int, used_current int, remaining int"


def limiter_replay(calls: DataFrame, rpm: int, period: int = 60) -> DataFrame:
    """Every call of each workflow in order with whether it was allowed and the counts after it.

    An ordered fold: what one call may do hangs on the calls of its window and the one before. After a whole window without
    a call nothing is left to carry over (the next call goes in any case), so a workflow is split there and busy
    stretches are folded apart. Only time and number of a call travel. calls: workflow, ts, seq.
    """
    rows = calls.select("workflow", "ts", "seq").where("workflow is not null and ts is not null").withColumn("win", F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / (period * 1_000_000)))
    by = Window.partitionBy("workflow").orderBy("win")
    gap = F.when(F.col("win") - F.lag("win").over(by) > 1, 1).otherwise(0)
    stretches = rows.select("workflow", "win").distinct().withColumn("gap", gap).select("workflow", "win", F.sum("gap").over(by).alias("stretch"))

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["ts", "seq"], kind="stable")
        lim = Limiter(rpm, period)
        out = [(lim.acquire(now), *lim.counts()) for now in (t.to_pydatetime() for t in pdf["ts"])]
        return pd.concat([pdf[["workflow", "ts", "seq"]].reset_index(drop=True), pd.DataFrame(out, columns=["allowed", "used_previous", "used_current", "remaining"])], axis=1)

    return rows.join(stretches, ["workflow", "win"]).groupBy("workflow", "stretch").applyInPandas(fold, LIMITER_SCHEMA)


@dataclass(slots=True)
class Task:
    task_id: str | int
    workflow: str
    attempts: int = 0
    status: str = "pending"
    ready: datetime = field(default_factory=lambda: datetime(2024, 1, 1))
    error: str | None = None


class Throttled:
    """Tasks whose turns come round every so many whole seconds, by the second of the round. None of them is due before `since`; as that
    is a whole second, the turns in between are passed over without touching the tasks."""

    def __init__(self, every: int):
        self.every, self.since, self.rounds = every, 0, defaultdict(list)

    def add(self, second: int, micro: int, at: int) -> None:
        heappush(self.rounds[second % self.every], micro << 40 | at)  # one number is smaller than a pair

    def first(self) -> tuple[int, int, int] | None:
        """(second, microsecond, task) of the next turn."""
        if not self.rounds:
            return None
        wait = min((second - self.since) % self.every for second in self.rounds)
        key = self.rounds[(self.since + wait) % self.every][0]
        return self.since + wait, key >> 40, key & (1 << 40) - 1

    def remove_first(self) -> None:
        key = self.first()[0] % self.every
        heappop(self.rounds[key])
        if not self.rounds[key]:
            del self.rounds[key]


class Orchestrator:
    """Runs tasks against a clock of its own: breaker, limiter, breaker again, then the activity; retries, and trips when
    the last attempt fails. Tasks that meet an open breaker wait for a reset and then start from scratch. A heap of (time, order)
    says whose turn it is. While a limiter is shut, those it turns away are put by (where the delay is of whole seconds) and only the
    one of them whose turn comes first stands in the heap, so a task costs a few turns however long it waits."""

    def __init__(self, activity: Callable[[Task], dict | str | None], workflows: dict[str, tuple] = WORKFLOWS, start: datetime = datetime(2024, 1, 1)):
        self.activity, self.config, self.now = activity, workflows, start
        self.limiter = {w: Limiter(c[0], c[1]) for w, c in workflows.items()}
        self.strikes = dict.fromkeys(workflows, STRIKES)
        self.tasks: list[Task] = []
        self.turns: list[tuple[datetime, int]] = []
        self.waiting: dict[str, list[int]] = defaultdict(list)
        self.origin = start.replace(microsecond=0)
        self.throttled = {w: Throttled(int(c[2])) for w, c in workflows.items() if c[2] >= 1 and c[2] == int(c[2])}
        self.called: dict[str, tuple[datetime, int]] = {}

    def submit(self, tasks: Iterable[Task]) -> None:
        """Takes tasks for now, or for their own time where that is later."""
        for t in tasks:
            self._queue(len(self.tasks), max(self.now, t.ready), t)
            self.tasks.append(t)

    def _queue(self, at: int, ready: datetime, task: Task) -> None:
        task.ready = ready
        heappush(self.turns, (ready, at))

    def _turned_away(self, workflow: str) -> bool:
        by, since = self.throttled.get(workflow), self.now - self.origin
        second = since.days * 86_400 + since.seconds
        if by and second < by.since:
            return True
        if self.limiter[workflow].acquire(self.now):
            return False
        if by and (shut := self.limiter[workflow].shut_for(self.now)):
            by.since = second + shut
        return True

    def _put_by(self, at: int, task: Task, delay: float) -> None:
        by, since = self.throttled.get(task.workflow), self.now - self.origin
        second = since.days * 86_400 + since.seconds
        if by and second < by.since:
            by.add(second, since.microseconds, at)
        else:
            self._queue(at, self.now + timedelta(seconds=delay), task)

    def _call_up(self, workflow: str) -> None:
        """The first of those put by has its turn in the heap, unless one called before comes earlier."""
        by = self.throttled.get(workflow)
        if by and (first := by.first()):
            second, micro, at = first
            ready = self.origin + timedelta(seconds=second, microseconds=micro)
            if workflow not in self.called or (ready, at) < self.called[workflow]:
                by.remove_first()
                self.called[workflow] = (ready, at)
                self._queue(at, ready, self.tasks[at])

    def reset(self, workflow: str) -> None:
        self.strikes[workflow] = STRIKES
        for at in self.waiting.pop(workflow, []):
            self.tasks[at].status, self.tasks[at].attempts = "pending", 0
            self._queue(at, self.now, self.tasks[at])

    def run(self) -> None:
        """Until every task is done, failed or waiting for its circuit."""
        while self.turns:
            ready, at = heappop(self.turns)
            t = self.tasks[at]
            self.now = max(self.now, ready)
            if self.called.get(t.workflow) == (ready, at):
                del self.called[t.workflow]
            _, _, throttle, most, delay = self.config[t.workflow]
            if self.strikes[t.workflow] <= 0:
                t.status = "Waiting for circuit"
                self.waiting[t.workflow].append(at)
            elif self._turned_away(t.workflow):
                t.status = "throttled"
                self._put_by(at, t, throttle)
            else:
                t.attempts += 1
                result = self.activity(t)
                if not (isinstance(result, dict) and "error_type" in result):
                    t.status = "done"
                elif t.attempts < most:
                    t.status = "retrying"
                    self._queue(at, self.now + timedelta(seconds=delay), t)
                else:
                    t.status, t.error = "failed", str(result.get("message"))
                    self.strikes[t.workflow] = max(0, self.strikes[t.workflow] - 1)
            self._call_up(t.workflow)


def orchestrated(tasks: DataFrame, config: tuple = (10, 60, 20, 3, 60)) -> DataFrame:
    """Outcome of every task (workflow, task_id, status, attempts, ready): each workflow is run by an orchestrator of its own.

    tasks: workflow, task_id, ts (when it comes), failures (how many of its attempts fail). A workflow is one sequence by nature, as
    its breaker and its limiter serve one call at a time; only these four values of a task travel. config: calls a
    period, its seconds, delay when throttled, attempts and delay between them. A null workflow is left out.
    """

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("ts", "ascending"), ("task_id", "ascending")])
        name, fails = rows["workflow"][0].as_py(), rows["failures"].to_numpy()
        times = rows["ts"].cast(pa.timestamp("us", "UTC")).cast(pa.timestamp("us")).to_pylist()
        o = Orchestrator(lambda t: {"error_type": "failure", "message": "failed"} if t.attempts <= fails[t.task_id] else None, {name: config}, times[0])
        o.submit(Task(k, name, ready=ts) for k, ts in enumerate(times))  # rows by number: their ids stay in Arrow
        del times
        o.run()
        ready = pa.array([t.ready for t in o.tasks], pa.timestamp("us")).cast(pa.timestamp("us", "UTC"))
        return pa.table({"workflow": rows["workflow"], "task_id": rows["task_id"], "status": pa.array([t.status for t in o.tasks]), "attempts": pa.array([t.attempts for t in o.tasks], pa.int32()), "ready": ready})

    rows = tasks.select("workflow", "task_id", "ts", F.coalesce("failures", F.lit(0)).cast("int").alias("failures")).dropna(subset=["workflow", "task_id", "ts"]).dropDuplicates(["workflow", "task_id"])
    return spread(rows, "workflow").groupBy("workflow").applyInArrow(run, "workflow string, task_id string, status string, attempts int, ready timestamp")


def tasks_with(tasks: DataFrame, status: str | None = None, workflow: str | None = None) -> DataFrame:
    """Tasks of a status and workflow; `input` is JSON text, possibly encoded twice."""
    shape = "struct<task_id:string,workflow_type:string,company:string,policy:string,timestamp:string>"
    data = F.coalesce(F.from_json(F.when(F.col("input").startswith('"'), F.get_json_object(F.concat(F.lit('{"v":'), F.col("input"), F.lit("}")), "$.v")).otherwise(F.col("input")), shape))
    rows = tasks.withColumn("data", data)
    rows = rows.where(F.col("status") == status) if status else rows
    return rows.where(F.col("data.workflow_type") == workflow) if workflow else rows


def to_kill(tasks: DataFrame, workflow: str, every: bool = False) -> DataFrame:
    """Running tasks of a workflow to end: those that wait for their circuit, or all."""
    hit = (F.col("workflow") == workflow) & (F.col("status") == "Running")
    return tasks.where(hit if every else hit & (F.col("custom_status") == "Waiting for circuit"))


def as_error(ok, app: str, kind, message):
    """A failure as a value: null where ok."""
    return F.when(~ok, F.struct(F.lit(app).alias("app"), kind.alias("error_type"), message.alias("message")))
