import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from palimpsest.operators import audit, control
from palimpsest.operators.control import Limiter, Orchestrator, Task
from palimpsest.streaming import stages


def test_limiter_windows():
    lim, t = Limiter(10, 60), datetime(2024, 1, 1, 0, 0, 30)
    assert [lim.acquire(t) for _ in range(11)] == [True] * 10 + [False]
    # a minute later half of the ten still count
    later = t + timedelta(seconds=60)
    assert [lim.acquire(later) for _ in range(6)] == [True] * 5 + [False]
    # two windows later all is free
    assert Limiter.acquire(lim, later + timedelta(seconds=180)) and lim.used_previous == 0 and lim.used_current == 1


def test_second_denied_try_in_the_next_window_shifts_again():
    lim, t = Limiter(1, 60), datetime(2024, 1, 1, 0, 0, 59)
    assert lim.acquire(t)
    nxt = datetime(2024, 1, 1, 0, 1, 0)
    assert not lim.acquire(nxt) and lim.used_previous == 1
    assert lim.acquire(nxt)


def test_breaker_windows_equal_the_fold(spark):
    rnd = random.Random(2)
    rows = [(rnd.choice("ab"), i // 3, i, rnd.choice(["TRIP", "TRIP", "RESET", "GET_STATUS"]), f"e{i}") for i in range(300)]
    got = {r.seq: r for r in control.breaker_replay(spark.createDataFrame(rows, "workflow string, ts long, seq long, op string, error string")).collect()}
    state = {}
    for w, ts, seq, op, err in rows:
        s = state.setdefault(w, [3, None, None])
        if op == "TRIP":
            s[0] = max(0, s[0] - 1)
            s[1:] = [err, ts] if s[0] == 0 else [None, None]
        elif op == "RESET":
            s[:] = [3, None, None]
        r = got[seq]
        assert (r.strikes, r.is_open, r.error_message, r.opened_at) == (s[0], s[0] == 0, s[1], s[2])


def test_replay_equals_the_limiter(spark):
    rnd = random.Random(4)
    rows = [("w" + str(i % 2), datetime(2024, 1, 1) + timedelta(seconds=rnd.randint(0, 400)), i) for i in range(200)]
    got = control.limiter_replay(spark.createDataFrame(rows, "workflow string, ts timestamp, seq long"), rpm=5).collect()
    lim = {}
    for r in sorted(got, key=lambda r: (r.ts, r.seq)):
        assert r.allowed == lim.setdefault(r.workflow, Limiter(5)).acquire(r.ts)
    assert len(got) == 200


def test_orchestrator_stops_at_three_failures_and_resumes():
    bad = {"t2", "t3", "t4"}
    o = Orchestrator(lambda t: {"error_type": "failure", "message": "no"} if t.task_id in bad else "ok", {"w": (100, 60, 1, 1, 1), "v": (100, 60, 1, 1, 1)})
    o.submit(Task(f"t{i}", "w") for i in range(10))
    o.submit([Task("other", "v")])
    o.run()
    count = lambda s: sum(t.status == s and t.workflow == "w" for t in o.tasks)
    assert (count("done"), count("failed"), count("Waiting for circuit")) == (2, 3, 5) and o.tasks[-1].status == "done"
    bad.clear()
    o.reset("w")
    o.run()
    assert (count("done"), count("failed")) == (7, 3)


def test_orchestrator_retries_and_throttles():
    tries = []
    o = Orchestrator(lambda t: tries.append(o.now) or ({"error_type": "x", "message": "m"} if len(tries) < 3 else "ok"), {"w": (1, 60, 20, 3, 5)})
    o.submit([Task("t", "w")])
    o.run()
    assert o.tasks[0].status == "done" and o.tasks[0].attempts == 3 and tries[1] - tries[0] >= timedelta(seconds=20)


def test_streams_equal_batches(spark, sf):
    events = spark.read.parquet(f"{sf}/events.parquet")
    live = lambda: stages.operations(stages.arrivals(spark, sf, events.schema, pattern="events.parquet"))
    got = stages.run_available(stages.breaker_stream(live()), stages.shared_folder(spark))
    want = control.breaker_replay(stages.operations(events)).select("workflow", "ts", "seq", "op", "strikes", "is_open")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))
    got = stages.run_available(stages.limiter_stream(live()), stages.shared_folder(spark))
    want = control.limiter_replay(stages.operations(events), rpm=10)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.select(got.columns).collect()))


def test_streams_take_tables_of_many_files(spark, sf, tmp_path):
    from __spark_entry__ import queries

    for name in ("diff_sections", "events"):
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))
    for name in ("A19_stage_chain", "S2_breaker_stream"):
        got, want = (sorted(map(tuple, queries()[name](spark, d).collect())) for d in (str(tmp_path), sf))
        assert got == want and got


def test_late_versions_recompute_their_documents(spark, tmp_path):
    from palimpsest.operators.versions import neighbours

    src, out, state = (str(tmp_path / x) for x in ("in", "out", "state"))
    schema = "company string, policy string, version_ts string"
    put = lambda *v: spark.createDataFrame([("c", "p", x) for x in v] + [("c", "q", "1")], schema).coalesce(1).write.mode("append").parquet(src)
    go = lambda: stages.recompute_keys(stages.arrivals(spark, src, spark.read.parquet(src).schema), lambda s: s.read.parquet(src).distinct(), neighbours, ["company", "policy"], out, state).awaitTermination()
    put("1", "3")
    go()
    put("2")
    go()
    got = {r.version_ts: r.before_ts for r in spark.read.parquet(out).where("policy = 'p'").collect()}
    assert got == {"1": None, "2": "1", "3": "2"}


def test_tasks_and_kill(spark):
    rows = spark.createDataFrame([("Running", '{"task_id":"a","workflow_type":"w"}'), ("Done", '{"task_id":"b","workflow_type":"w"}'), ("Running", '"{\\"task_id\\":\\"c\\",\\"workflow_type\\":\\"w\\"}"'), ("Running", "broken"), (None, None)], "status string, input string")
    assert sorted(r.data.task_id for r in control.tasks_with(rows, "Running", "w").collect()) == ["a", "c"]
    t = spark.createDataFrame([("w", "Running", "Waiting for circuit"), ("w", "Running", ""), ("v", "Running", "Waiting for circuit")], "workflow string, status string, custom_status string")
    assert control.to_kill(t, "w").count() == 1 and control.to_kill(t, "w", every=True).count() == 2


def test_audit(spark):
    e = spark.createDataFrame([("s", "c", "1"), ("s", "c", "2"), ("t", "c", "1")], "stage string, company string, version_ts string")
    got = {r.stage: r.report for r in audit.missing_outputs(e, e.where("version_ts = '1' and stage = 's'"), "company", "version_ts").collect()}
    assert got == {"s": "missing 1/2", "t": "missing 1/1"}
    b = spark.createDataFrame([("04", "c", "p", "20190101", None, {"a": "b"}), ("04", "c", "p", "20200101", None, None)], "stage string, company string, policy string, timestamp string, run_id string, metadata map<string,string>")
    hit = audit.touched(b, F.lit("2024-01-01 00:00:00").cast("timestamp"), company="c", timestamp="2019").collect()
    assert len(hit) == 1 and hit[0].metadata == {"a": "b", "touched": "2024-01-01T00:00:00"}
    assert audit.touched(b, F.lit("2024-01-01 00:00:00").cast("timestamp")).count() == 2


def test_hot_workflow_over_many_slices(spark):
    """One workflow over days, with stretches without resets or trips: the same as counting call by call."""
    import random

    rnd = random.Random(3)
    rows, at = [], datetime(2024, 1, 1)
    for k in range(3000):
        at += timedelta(seconds=rnd.choice([0, 1, 30, 4000]))
        rows.append(("w", at, k, rnd.choice(["TRIP", "GET_STATUS", "GET_STATUS", "GET_STATUS"]) if rnd.random() > 0.02 else "RESET", f"e{k}"))
    got = {r.seq: r for r in control.breaker_replay(spark.createDataFrame(rows, "workflow string, ts timestamp, seq long, op string, error string")).collect()}
    strikes, error, opened = 3, None, None
    for _, ts, k, op, e in rows:
        if op == "TRIP":
            strikes, error, opened = max(0, strikes - 1), e, ts
        elif op == "RESET":
            strikes = 3
        assert (got[k].strikes, got[k].is_open) == (strikes, strikes == 0)
        if strikes == 0:
            assert (got[k].error_message, got[k].opened_at) == (error, opened)
    lim = Limiter(3)
    want = {k: (lim.acquire(ts), *lim.counts()) for _, ts, k, *_ in rows}
    calls = control.limiter_replay(spark.createDataFrame([r[:3] for r in rows], "workflow string, ts timestamp, seq long"), rpm=3)
    assert {r.seq: (r.allowed, r.used_previous, r.used_current, r.remaining) for r in calls.collect()} == want


def test_orchestrated_frames(spark):
    rows = [("w", f"t{k}", datetime(2024, 1, 1, 0, 0, k), 9 if k < 2 else 0) for k in range(6)] + [("v", "x", datetime(2024, 1, 1), 1), (None, "y", datetime(2024, 1, 1), 0)]
    df = spark.createDataFrame(rows, "workflow string, task_id string, ts timestamp, failures int").withColumn("status", F.lit("clash"))
    got = {(r.workflow, r.task_id): (r.status, r.attempts) for r in control.orchestrated(df, (100, 60, 20, 2, 5)).collect()}
    assert got["v", "x"] == ("done", 2) and got["w", "t0"] == got["w", "t1"] == ("failed", 2) and got["w", "t5"] == ("done", 1) and len(got) == 7
    assert control.orchestrated(df.limit(0)).count() == 0


def plain_replay(tasks, config, fails):
    """The orchestrator's turns one by one, every throttled task asked again each time its delay is over."""
    rpm, period, throttle, most, delay = config
    lim, strikes, n, out = Limiter(rpm, period), 3, {}, {}
    turns = sorted((ready, k) for k, (_, ready) in enumerate(tasks))
    while turns:
        now, k = turns.pop(0)
        if strikes <= 0:
            out[k] = ("Waiting for circuit", n.get(k, 0), now)
            continue
        if not lim.acquire(now):
            turns.append((now + timedelta(seconds=throttle), k))
        else:
            n[k] = n.get(k, 0) + 1
            if n[k] > fails.get(k, 0):
                out[k] = ("done", n[k], now)
            elif n[k] < most:
                turns.append((now + timedelta(seconds=delay), k))
            else:
                out[k], strikes = ("failed", n[k], now), strikes - 1
        turns.sort()
    return [out[k] for k in range(len(tasks))]


def test_throttled_tasks_keep_their_turns():
    rnd = random.Random(5)
    for k in range(40):
        config = (rnd.choice([1, 3, 10]), rnd.choice([60, 60, 90]), rnd.choice([20, 7, 0.5]), rnd.choice([1, 3]), 61.25)
        start = datetime(2024, 1, 1, 0, 0, rnd.randint(0, 59), 5000)
        tasks = [(f"t{i}", start + timedelta(seconds=rnd.randint(0, 90), microseconds=rnd.choice([0, rnd.randint(0, 999_999)]))) for i in range(30)]
        fails = {i: rnd.choice([1, 9]) for i in range(30) if rnd.random() < k % 4 / 20}
        o = Orchestrator(lambda t: {"error_type": "x", "message": "m"} if t.attempts <= fails.get(int(t.task_id[1:]), 0) else None, {"w": config}, start)
        o.submit(Task(i, "w", ready=ready) for i, ready in tasks)
        o.run()
        assert [(t.status, t.attempts, t.ready) for t in o.tasks] == plain_replay(tasks, config, fails)


def test_waiting_for_the_limiter_costs_a_few_calls_a_task(monkeypatch):
    calls, acquire = [], Limiter.acquire
    monkeypatch.setattr(Limiter, "acquire", lambda self, now: calls.append(1) or acquire(self, now))
    o = Orchestrator(lambda t: None, {"w": (50, 60, 20, 1, 60)})
    o.submit(Task(str(k), "w") for k in range(2000))
    o.run()
    assert all(t.status == "done" for t in o.tasks) and o.now == datetime(2024, 1, 1, 0, 39, 20) and len(calls) < 3 * 2000
