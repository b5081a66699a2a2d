"""Streams: windows by the clock with state as large as their paths, sessions, and a join of two streams."""

import json
import random
import time
from datetime import datetime, timedelta

import pytest

from colscope.streaming import events


def put(folder, name, rows):
    folder.mkdir(exist_ok=True)
    (folder / f"{name}.json").write_text("\n".join(map(json.dumps, rows)))


def wait(done, seconds=90):
    until = time.time() + seconds
    while not done() and time.time() < until:
        time.sleep(0.3)


def stream(spark, folder, schema):
    folder.mkdir(exist_ok=True)
    return spark.readStream.schema(schema).json(str(folder))


def clock(spark, tmp_path, seconds, name):
    """A query of windows by the clock, and its folder. With timers of the clock a query always has another batch to run, so nothing
    waits for the last one."""
    rows = stream(spark, tmp_path / name, "listener long, action string, path string")
    found = events.debounced_triggers(rows, "listener", seconds=seconds)
    query = found.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"c-{name}")).trigger(processingTime="500 milliseconds").start()
    return query, tmp_path / name


def given_out(spark, name):
    return {(r.listener, tuple(r.paths), r.n_events) for r in spark.table(name).collect()}


@pytest.fixture
def rocks(spark):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    yield
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_open_windows_hold_different_paths_only(spark, tmp_path, rocks):
    query, src = clock(spark, tmp_path, 900, "open_windows")
    put(src, "one", [{"listener": 1, "action": "created", "path": f"p{i % 3}"} for i in range(600)] + [{"listener": 2, "action": "created", "path": "q"}])
    wait(lambda: sum(p["numInputRows"] for p in query.recentProgress) >= 601)
    state = next(p for p in query.recentProgress if p["numInputRows"])["stateOperators"][0]
    # Two open windows: their starts, four different paths, two timers (by key, and by time): not six hundred events.
    assert 0 < state["numRowsTotal"] <= 12
    put(src, "two", [{"listener": 2, "action": "stop", "path": None}, {"listener": 2, "action": "created", "path": "r"}])
    wait(lambda: given_out(spark, "open_windows"))
    assert given_out(spark, "open_windows") == {(2, ("q", "r"), 2)}
    query.stop()


def test_the_clock_ends_a_window(spark, tmp_path, rocks):
    query, src = clock(spark, tmp_path, 1, "ended_windows")
    put(src, "one", [{"listener": 1, "action": "created", "path": f"p{i % 3}"} for i in range(60)])
    wait(lambda: given_out(spark, "ended_windows"))
    assert given_out(spark, "ended_windows") == {(1, ("p0", "p1", "p2"), 60)}
    query.stop()


def at(minute, second=0):
    return f"2024-01-01T{10 + minute // 60:02d}:{minute % 60:02d}:{second:02d}"


def run(found, tmp_path, name):
    query = found.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"c-{name}")).outputMode("append").start()
    return query


def test_sessions_of_a_stream(spark, tmp_path):
    src = tmp_path / "in"
    rows = stream(spark, src, "path string, ts timestamp")
    query = run(events.sessions(rows, ["path"], gap=300, late="2 minutes"), tmp_path, "sessions")
    put(src, "1", [{"path": "a", "ts": at(0)}, {"path": "a", "ts": at(4)}, {"path": "b", "ts": at(1)}])
    query.processAllAvailable()
    put(src, "2", [{"path": "a", "ts": at(8)}, {"path": "b", "ts": at(20)}])  # joins the first session of a
    query.processAllAvailable()
    put(src, "3", [{"path": "a", "ts": at(2)}, {"path": "z", "ts": at(60)}])  # too late for a
    query.processAllAvailable()
    query.processAllAvailable()
    query.stop()
    got = {(r.path, r.session_start.strftime("%H:%M"), r.session_end.strftime("%H:%M"), r.n_events) for r in spark.table("sessions").collect()}
    assert got == {("a", "10:00", "10:13", 3), ("b", "10:01", "10:06", 1), ("b", "10:20", "10:25", 1)}


def test_events_with_outputs_of_another_stream(spark, tmp_path):
    one, two = tmp_path / "events", tmp_path / "outputs"
    changes, outputs = stream(spark, one, "path string, ts timestamp"), stream(spark, two, "path string, done_at timestamp")
    query = run(events.finished(changes, outputs, seconds=600, late="1 minute"), tmp_path, "joined")
    put(one, "1", [{"path": "a", "ts": at(0)}, {"path": "b", "ts": at(0)}])
    put(two, "1", [{"path": "a", "done_at": at(5)}, {"path": "b", "done_at": at(11)}])
    query.processAllAvailable()
    for k, minute in enumerate((30, 60), 2):
        put(one, str(k), [{"path": "z", "ts": at(minute)}])
        put(two, str(k), [{"path": "y", "done_at": at(minute)}])
        query.processAllAvailable()
    put(one, "9", [{"path": "a", "ts": at(1)}])  # too late: left out
    query.processAllAvailable()
    query.stop()
    got = {(r.path, r.ts.strftime("%H:%M"), r.done_at and r.done_at.strftime("%H:%M")) for r in spark.table("joined").collect()}
    assert {("a", "10:00", "10:05"), ("b", "10:00", None)} <= got and not any(x[:2] == ("a", "10:01") for x in got)


def test_outputs_are_counted_without_pairs(spark):
    """all at one time and of one path, ends included; a path or time that is null has no output."""
    ts = "timestamp '2024-01-01 00:09:00'"
    hot = spark.range(20_000).selectExpr("'hot' AS path", f"{ts} AS ts")
    late = spark.range(20_000).selectExpr("'hot' AS output", f"{ts} + make_dt_interval(0, 0, 0, CAST(id % 2 AS INT) * 601) AS done_at").toDF("path", "done_at")
    found = events.outputs_within(hot, late, 600)
    assert "Join" not in found._jdf.queryExecution().executedPlan().toString()
    assert [(r.path, r.n_events, r.n_outputs) for r in found.collect()] == [("hot", 20_000, 10_000)]

    r = random.Random(3)
    minute = lambda m: None if m is None else datetime(2024, 1, 1, 10) + timedelta(minutes=m)
    pick = lambda: [(r.choice(["a", "b", None]), minute(r.choice([None, *range(-3, 45)]))) for _ in range(150)]
    one, two = pick(), pick()
    left, right = spark.createDataFrame(one, "path string, ts timestamp_ntz"), spark.createDataFrame(two, "path string, done_at timestamp_ntz")
    pairs = [(p, t, d) for p, t in one for q, d in two if p and p == q and t and d and t <= d <= t + timedelta(minutes=10)]
    alone = [(p, t, None) for p, t in one if not any(x[:2] == (p, t) for x in pairs)]
    assert sorted(map(repr, (tuple(x) for x in events.finished(left, right, 600).collect()))) == sorted(map(repr, pairs + alone))
    counts = {(x.path, x.ts): x.n_events * x.n_outputs for x in events.outputs_within(left, right, 600).collect()}
    assert counts == {k: sum(x[:2] == k for x in pairs) for k in set(one)}
