"""File events as streams: decoding, filtering, batches by a quiet period, counts."""

from __future__ import annotations

import itertools
from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from ..operators.discovery import extension

_FILE = "struct<file_path:string, extension:string>"
EVENT = f"event string, file_path string, extension string, files struct<created:array<{_FILE}>, modified:array<{_FILE}>, deleted:array<{_FILE}>>"
DOCUMENTS = (".xlsx", ".knfo", ".meta")


def decode(raw: DataFrame) -> DataFrame:
    """(action, path, extension, *others) from JSON events in ``value``: batched ones give a row for each file, others than file
    events none."""
    e = raw.withColumn("e", F.from_json("value", EVENT))
    listed = lambda k: F.transform(F.coalesce(F.col(f"e.files.{k}"), F.array().cast(f"array<{_FILE}>")), lambda f: F.struct(F.lit(k).alias("action"), f["file_path"].alias("path")))
    single = F.array(F.struct(F.regexp_replace("e.event", "^file_", "").alias("action"), F.col("e.file_path").alias("path")))
    files = F.when(F.col("e.event") == "files_changed", F.concat(listed("created"), listed("modified"), listed("deleted"))).when(F.col("e.event").isin("file_created", "file_modified", "file_deleted"), single)
    return e.withColumn("f", F.explode(files)).select("f.action", "f.path", extension(F.col("f.path")).alias("extension"), *[c for c in raw.columns if c != "value"])


def relevant(events: DataFrame) -> DataFrame:
    """Spreadsheets that appear or change, and documents of any kind that go."""
    sheet = F.col("extension") == ".xlsx"
    return events.where(F.when(F.col("action") == "deleted", F.col("extension").isin(*DOCUMENTS)).otherwise(sheet))


def batched(events: DataFrame, time: str = "ts", seconds: int = 5, slide: int | None = None, late: str = "1 minute") -> DataFrame:
    """(batch_start, path, n_events): the different paths of each period of some seconds; periods begin every ``slide`` seconds.
    On a stream, events count until they are later than ``late``."""
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(F.window(time, f"{seconds} seconds", f"{slide or seconds} seconds").alias("w"), "path").agg(F.count("*").alias("n_events")).select(F.col("w.start").alias("batch_start"), "path", "n_events")


def _windows(keys: list[str], time: str, seconds: float):
    """Rows sorted by key and time: the first of a key opens a window, and the first after its end the next."""

    def run(batches):
        now, end = None, None
        for batch in batches:
            stamps = batch[time].to_numpy()
            opened = []
            for key, at in zip(zip(*(batch[k].tolist() for k in keys), strict=True) if keys else itertools.repeat(()), stamps, strict=False):
                if key != now or at >= end:
                    now, begin = key, at
                    end = at + np.timedelta64(int(seconds * 1_000_000), "us")
                opened.append(begin)
            yield batch.assign(batch_start=np.array(opened, stamps.dtype) if opened else stamps)

    return run


def debounced(events: DataFrame, keys: list[str], time: str = "ts", seconds: float = 5) -> DataFrame:
    """(*keys, batch_start, path, n_events): an event opens a window of some seconds, later ones join it until it ends, and the
    next event opens another. Paths count once for each window. ``keys`` name the listeners that have windows of their own.

    Rows are sorted by Spark and read one after another, so no listener's events are gathered in memory. Events without a time
    are left out.
    """
    rows = events.where(F.col(time).isNotNull()).select(*keys, F.col(time).cast("timestamp_ntz").alias(time), "path")
    rows = (rows.repartition(*keys) if keys else rows.coalesce(1)).sortWithinPartitions(*keys, time)
    schema = T.StructType([*rows.schema.fields, T.StructField("batch_start", T.TimestampNTZType())])
    return rows.mapInPandas(_windows(keys, time, seconds), schema).groupBy(*keys, "batch_start", "path").agg(F.count("*").alias("n_events"))


def debounced_stream(events: DataFrame, key: str, time: str = "ts", seconds: float = 5, late: str = "1 minute") -> DataFrame:
    """(key, batch_start, paths) of a stream by the events' own times: a window is given out when the watermark has passed its end.
    State holds the events of open windows, as earlier ones may still come; ``debounced_triggers`` goes by the clock and holds paths
    only. Events later than ``late`` are left out."""
    import pandas as pd
    from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

    step = pd.Timedelta(seconds=seconds)

    def run(found: tuple, frames, state: GroupState):
        waiting = list(zip(*state.get, strict=True)) if state.exists else []
        if not state.hasTimedOut:
            for frame in frames:
                waiting += zip(frame[time].tolist(), frame["path"].tolist(), strict=True)
        # Events are kept until their window is over, as earlier ones may still come before the watermark.
        waiting.sort()
        border, out = pd.Timestamp(state.getCurrentWatermarkMs(), unit="ms"), []
        while waiting and waiting[0][0] + step <= border:
            inside = [x for x in waiting if x[0] < waiting[0][0] + step]
            out.append((found[0], waiting[0][0], sorted({p for _, p in inside})))
            waiting = waiting[len(inside) :]
        if waiting:
            state.update(tuple(map(list, zip(*waiting, strict=True))))
            state.setTimeoutTimestamp(max(int((waiting[0][0] + step).timestamp() * 1000), state.getCurrentWatermarkMs() + 1))
        elif state.exists:
            state.remove()
        yield pd.DataFrame(out, columns=[key, "batch_start", "paths"])

    kind = events.schema[key].dataType.simpleString()
    rows = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(key)
    return rows.applyInPandasWithState(run, f"`{key}` {kind}, batch_start timestamp, paths array<string>", "times array<timestamp>, paths array<string>", "append", GroupStateTimeout.EventTimeTimeout)


class _Debouncer:
    """For each listener: the window's start, and how often each different path came since. State is as large as those paths."""

    def __init__(self, milliseconds: int):
        self.milliseconds = milliseconds

    def init(self, handle) -> None:
        self.handle = handle
        self.opened = handle.getValueState("opened", "at timestamp")
        self.paths = handle.getMapState("paths", "path string", "n long")

    def _given_out(self, key: tuple):
        import pandas as pd

        if not self.opened.exists():
            return
        found = sorted((p[0], n[0]) for p, n in self.paths.iterator())
        yield pd.DataFrame({"listener": [key[0]], "batch_start": [self.opened.get()[0]], "paths": [[p for p, _ in found]], "n_events": [sum(n for _, n in found)]})
        self.opened.clear()
        self.paths.clear()
        for at in list(self.handle.listTimers()):
            self.handle.deleteTimer(at)

    def handleInputRows(self, key, rows, timerValues):  # Spark calls these by the names of their arguments
        import pandas as pd

        stop = False
        for frame in rows:
            stop |= bool((frame["action"] == "stop").any())
            for path, n in frame.loc[frame["action"] != "stop", "path"].dropna().value_counts().items():
                before = self.paths.getValue((path,))[0] if self.paths.containsKey((path,)) else 0
                self.paths.updateValue((path,), (int(before + n),))
                if not self.opened.exists():
                    now = timerValues.getCurrentProcessingTimeInMs()
                    self.opened.update((pd.Timestamp(now, unit="ms").to_pydatetime(),))
                    self.handle.registerTimer(now + self.milliseconds)
        if stop:
            yield from self._given_out(key)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        yield from self._given_out(key)

    def handleInitialState(self, key, initialState, timerValues) -> None:
        pass

    def close(self) -> None:
        pass


def debounced_triggers(events: DataFrame, key: str, seconds: float = 5) -> DataFrame:
    """(listener, batch_start, paths, n_events) of a stream with ``key``, action and path: a listener's first event opens a window of
    some seconds of the clock, and its end gives out the different paths that came; an event with the action ``stop`` gives
    out what waits at once. Needs the session's state store to be RocksDB's (spark.sql.streaming.stateStore.providerClass)."""
    from pyspark.sql.streaming.stateful_processor import StatefulProcessor

    processor = type("Debouncer", (_Debouncer, StatefulProcessor), {})(round(seconds * 1000))
    kind = events.schema[key].dataType.simpleString()
    return events.select(key, "action", "path").groupBy(key).transformWithStateInPandas(processor, f"listener {kind}, batch_start timestamp, paths array<string>, n_events long", "append", "processingTime")


def sessions(events: DataFrame, keys: list[str], time: str = "ts", gap: int = 300, late: str = "1 minute") -> DataFrame:
    """(*keys, session_start, session_end, n_events): runs of events less than ``gap`` seconds apart; a session ends ``gap`` seconds
    after its last event. On a stream a session is given out when the watermark has passed its end."""
    rows = events.withWatermark(time, late) if events.isStreaming else events.where(F.col(time).isNotNull())
    found = rows.groupBy(F.session_window(time, f"{gap} seconds").alias("w"), *keys).agg(F.count("*").alias("n_events"))
    return found.select(*keys, F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "n_events")


def _period(time: str, seconds: int):
    """The start of the period of so many seconds in which a time lies; rows without a time go."""
    return F.window(time, f"{seconds} seconds")["start"]


def finished(events: DataFrame, outputs: DataFrame, seconds: int = 600, late: str = "1 minute") -> DataFrame:
    """(path, ts, done_at): each event (path, ts) with the outputs (path, done_at) that came within so many seconds after it, or a
    null. Two streams are joined between their watermarks: an event without an output is given out when none can come any more.

    Tables are joined by path and period as well: an output is dealt to its own period and the one before, so no path is one task's.
    There are as many rows as pairs; ``outputs_within`` counts without pairing.
    """
    left, right = events.select("path", "ts"), outputs.select(F.col("path").alias("output"), "done_at")
    span = F.expr(f"interval {int(seconds)} seconds")
    within = (F.col("path") == F.col("output")) & (F.col("done_at") >= F.col("ts")) & (F.col("done_at") <= F.col("ts") + span)
    if events.isStreaming:
        return left.withWatermark("ts", late).join(right.withWatermark("done_at", late), within, "left").select("path", "ts", "done_at")
    width = max(int(seconds), 1)
    dealt = right.withColumn("p", _period("done_at", width)).withColumn("period", F.explode(F.array("p", F.col("p") - F.expr(f"interval {width} seconds"))))
    found = left.withColumn("own", _period("ts", width)).join(dealt, within & (F.col("own") == F.col("period")), "left").select("path", "ts", "done_at")
    return found.unionByName(left.where("ts is null").withColumn("done_at", F.lit(None).cast(right.schema["done_at"].dataType)))


def outputs_within(events: DataFrame, outputs: DataFrame, seconds: int = 600) -> DataFrame:
    """(path, ts, n_events, n_outputs): for each different (path, ts) of the events how often it is there, and how many outputs (path,
    done_at) came within so many seconds (1 at least) after it.

    Nothing is paired. The outputs that count are those of the event's period from its time on and those of the next period up to
    the time ``seconds`` later: differences of running sums over the sorted times of one path and period.
    """
    span = F.expr(f"interval {int(seconds)} seconds")
    own = events.groupBy("path", "ts").agg(F.count("*").alias("n_events"))
    came = outputs.where("path is not null").groupBy("path", "done_at").agg(F.count("*").alias("n"))
    came = came.withColumn("period", _period("done_at", seconds)).select("path", "period", F.col("done_at").alias("at"), F.lit(1).alias("turn"), "n", F.lit(None).cast(own.schema["ts"].dataType).alias("ts"), F.lit(0).alias("sign"))
    # A look at the sum before its time (turn 0), or after it (turn 2).
    look = lambda period, at, turn, sign: F.struct(period.alias("period"), at.alias("at"), F.lit(turn).alias("turn"), F.lit(0).cast("long").alias("n"), F.col("ts"), F.lit(sign).alias("sign"))
    period, ts = F.col("period"), F.col("ts")
    looks = F.array(look(period, ts, 0, -1), look(period, period + span, 2, 1), look(period + span, ts + span, 2, 1))
    asked = own.where("path is not null").withColumn("period", _period("ts", seconds)).select("path", F.explode(looks).alias("x")).select("path", "x.*")
    so_far = F.sum("n").over(Window.partitionBy("path", "period").orderBy("at", "turn").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    seen = came.unionByName(asked).withColumn("n", so_far).where("sign <> 0").select("path", "ts", F.lit(0).cast("long").alias("n_events"), (F.col("sign") * F.col("n")).alias("n_outputs"))
    both = own.withColumn("n_outputs", F.lit(0).cast("long")).unionByName(seen)
    return both.groupBy("path", "ts").agg(F.sum("n_events").alias("n_events"), F.sum("n_outputs").alias("n_outputs"))


class Statistics(StreamingQueryListener):
    """What a listener has done: batches with rows, rows, failures, and when the last batch was."""

    def __init__(self):
        self.batches, self.rows, self.errors, self.last = 0, 0, 0, None

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        if event.progress.numInputRows:
            self.batches, self.rows, self.last = self.batches + 1, self.rows + event.progress.numInputRows, event.progress.timestamp

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self.errors += event.exception is not None


def flush(query: StreamingQuery) -> None:
    """Act on all that has come so far, then stop."""
    query.processAllAvailable()
    query.stop()


def counts_by_extension(events: DataFrame) -> DataFrame:
    return events.groupBy("extension").agg(F.count("*").alias("n_events"))


def trigger(events: DataFrame, act: Callable[[list[str]], None], checkpoint: str, seconds: float = 5) -> StreamingQuery:
    """Call ``act`` with the different paths of each micro-batch, which takes ``seconds`` to fill. Paths of a batch are those of a
    few seconds of file events, and only their names reach the driver."""

    def each(batch: DataFrame, _: int) -> None:
        if paths := sorted(r["path"] for r in batch.select("path").distinct().collect()):
            act(paths)

    return events.writeStream.trigger(processingTime=f"{seconds} seconds").option("checkpointLocation", checkpoint).foreachBatch(each).start()
