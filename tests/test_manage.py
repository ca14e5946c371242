from pyspark.sql import functions as F

from palimpsest.streaming.manage import confirmed_reset, due_again, in_flight, stop


def test_streams_in_flight_and_stopped(spark):
    q = spark.readStream.format("rate").load().writeStream.format("noop").queryName("ticks").start()
    try:
        assert [r["name"] for page in in_flight(spark) for r in page] == ["ticks"]
        assert stop(spark, lambda name, _: name == "other") == [] and stop(spark, lambda name, _: name == "ticks") == ["ticks"]
        assert list(in_flight(spark)) == []
    finally:
        q.stop()


def test_reset_is_confirmed():
    asked, woken, waits = [], [], []
    ok = confirmed_reset(lambda: None, lambda: asked.append(1) or len(asked) > 3, lambda: woken.append(1), pause=waits.append)
    assert ok and woken == [1] and waits == [0.1, 0.2, 0.4]
    assert not confirmed_reset(lambda: None, lambda: False, lambda: woken.append(1), pause=lambda s: None) and woken == [1]


def test_due_again(spark):
    rows = spark.createDataFrame([("c", "old", "20240101000000"), ("c", "new", "20240101000000"), ("c", "new", "20240109000000"), ("c", "bad", "2024"), ("c", "none", None)], "company string, policy string, capture_ts string")
    assert {r.policy for r in due_again(rows, F.lit("2024-01-10 00:00:00").cast("timestamp")).collect()} == {"old", "bad", "none"}


def test_circuit_over_the_state_store(spark, tmp_path):
    """Three trips open a breaker; a reset sent to the running stream closes it, and what waits is woken."""
    from datetime import datetime

    from palimpsest.streaming import stages
    from palimpsest.streaming.manage import Circuit

    inbox, out = str(tmp_path / "ops"), str(tmp_path / "out")
    at = datetime(2024, 1, 1)
    schema = "workflow string, ts timestamp, seq long, op string"
    spark.createDataFrame([("w", at, k, "TRIP") for k in range(3)] + [("v", at, 9, "TRIP")], schema).write.parquet(inbox)
    advance = lambda: stages.run_available(stages.breaker_stream(stages.arrivals(spark, inbox, schema)), out)
    advance()
    c, woken = Circuit(spark, inbox, f"{out}-state", advance), []
    assert c.check("w") == {"workflow": "w", "strikes": 0, "is_open": True} and c.check("v")["strikes"] == 2 and not c.check("new")["is_open"]
    assert c.reset("w", at, 100, lambda: woken.append("w"), pause=lambda s: None) and woken == ["w"] and c.check("w")["strikes"] == 3


def test_pages_of_tasks(spark):
    from palimpsest.streaming.manage import all_in_flight

    tasks = spark.createDataFrame([(f"t{k:03d}", "Running" if k % 2 else "Done") for k in range(50)], "task_id string, status string")
    pages = list(all_in_flight(tasks, 10))
    assert [len(p) for p in pages] == [10, 10, 5] and pages[0][0].task_id == "t001"
