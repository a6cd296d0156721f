"""Structured Streaming jobs: windowed popularity with watermark, last-n monitor state."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orchard.streaming.monitor import ScoreWindow, stream_monitor
from orchard.streaming.popularity import (load_popularity, run_popularity_table, run_stream_popularity, store_batch,
                                          windowed_item_weights)

EV_SCHEMA = "event_id long, timestamp timestamp_ntz, visitorid long, itemid long, event string, transactionid long"


def _events(spark, start_hour, n):
    base = dt.datetime(2024, 1, 1)
    rows = [(start_hour * 100 + i, base + dt.timedelta(hours=start_hour, minutes=7 * i), i % 3, i % 2,
             ["view", "addtocart", "transaction", "other"][i % 4], None) for i in range(n)]
    return spark.createDataFrame(rows, EV_SCHEMA)


def test_windowed_popularity_stream_matches_batch(spark, tmp_path):
    src = str(tmp_path / "src")
    _events(spark, 0, 20).write.parquet(src + "/p0")
    _events(spark, 5, 20).write.parquet(src + "/p1")
    stream = spark.readStream.schema(EV_SCHEMA).parquet(src + "/*")
    q = run_stream_popularity(spark, stream, str(tmp_path / "out"), str(tmp_path / "ckpt"), "1 hour", "1 hour")
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    batch = windowed_item_weights(spark.read.parquet(src + "/*"), "1 hour")
    # every emitted (finalised) window equals the batch result for that window
    cols = ["window_start", "window_end", "itemid", "weight", "n_events"]
    expected = batch.join(got.select("window_start", "itemid"), ["window_start", "itemid"], "left_semi").select(*cols)
    diff = got.select(*cols).exceptAll(expected)
    assert got.count() > 0 and diff.count() == 0


def test_stream_monitor_keeps_last_n_and_freezes_baseline(spark, tmp_path):
    schema = "model string, ts timestamp, seq long, score double"
    base = dt.datetime(2024, 1, 1)
    src = tmp_path / "scores"

    def write(part, start, n, level):
        rows = [("m", base + dt.timedelta(seconds=start + i), start + i, level + 0.01 * (i % 5)) for i in range(n)]
        spark.createDataFrame(rows, schema).write.parquet(str(src / part))

    write("a", 0, 30, 0.5)
    stream = spark.readStream.schema(schema).parquet(str(src / "*"))
    out = stream_monitor(stream, window=20, threshold=2.0)
    sink = str(tmp_path / "sink")

    def run():
        q = (out.writeStream.outputMode("update")
             .foreachBatch(lambda b, epoch: b.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(sink))
             .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start())
        q.awaitTermination(120)
        return spark.read.parquet(sink).orderBy(F.col("epoch").desc()).first()

    r1 = run()
    assert r1.n == 20 and r1.baseline_mean == pytest.approx(r1.mean) and not r1.has_drift
    write("b", 100, 20, 0.9)  # a higher level replaces the whole window
    r2 = run()
    assert r2.n == 20 and r2.baseline_mean == pytest.approx(r1.baseline_mean)
    assert r2.mean == pytest.approx(0.9 + 0.02) and r2.has_drift


def test_static_monitor_window(spark):
    rows = [("m", dt.datetime(2024, 1, 1, 0, 0, i), i, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "model string, ts timestamp, seq long, score double")
    r = stream_monitor(df, window=4).first()
    assert r.n == 4 and r.mean == pytest.approx(7.5)


def test_monitor_restart_and_late_rows(spark, tmp_path):
    schema = "model string, ts timestamp, seq long, score double"
    base = dt.datetime(2024, 1, 1)
    src, ck, sink = tmp_path / "s", str(tmp_path / "c"), str(tmp_path / "o")

    def run(part, rows, idle_ms=None):
        """Each run is a query of its own that goes on from the checkpoint."""
        df = spark.createDataFrame([(m, base + dt.timedelta(seconds=t), t, x) for m, t, x in rows], schema)
        df.write.parquet(str(src / part))
        stream = spark.readStream.schema(schema).parquet(str(src / "*"))
        q = (stream_monitor(stream, window=4, threshold=1.0, idle_ms=idle_ms).writeStream.outputMode("update")
             .foreachBatch(lambda b, n: b.withColumn("epoch", F.lit(n)).write.mode("append").parquet(sink))
             .option("checkpointLocation", ck).trigger(availableNow=True).start())
        q.awaitTermination(120)
        seen = spark.read.parquet(sink)
        last = seen.agg(F.max("epoch")).first()[0]
        return {r.model: r for r in seen.where(F.col("epoch") == last).collect()}

    first = run("a", [("m", t, float(t)) for t in range(10, 14)] + [("k", 1, 0.5)])
    assert first["m"].baseline_mean == pytest.approx(11.5) and first["k"].n == 1 and first["k"].baseline_mean is None
    late = run("b", [("m", 5, 99.0)])["m"]  # older than the window: no change
    assert late.n == 4 and late.mean == pytest.approx(11.5) and not late.has_drift
    between = run("c", [("m", 20, 30.0), ("m", 12, 12.0)])["m"]  # one newer, one at its place
    assert between.n == 4 and between.mean == pytest.approx((12 + 12 + 13 + 30) / 4)
    assert between.baseline_mean == pytest.approx(11.5) and between.has_drift


class _State:
    """Stand-in for a list or value state."""

    def __init__(self):
        self.held = None

    def get(self):
        return self.held if self.held is not None else getattr(self, "empty", None)

    def put(self, rows):
        self.held = rows

    update = put

    def clear(self):
        self.held = None


class _Handle:
    def __init__(self):
        self.timers = set()

    def getListState(self, name, schema):
        state = _State()
        state.empty = []
        return state

    def getValueState(self, name, schema):
        return _State()

    def listTimers(self):
        return iter(self.timers)

    def deleteTimer(self, at):
        self.timers.discard(at)

    def registerTimer(self, at):
        self.timers.add(at)


class _Clock:
    def __init__(self, now):
        self.now = now

    def getCurrentProcessingTimeInMs(self):
        return self.now


def test_idle_keys_are_cleared():
    handle, job = _Handle(), ScoreWindow(window=3, threshold=1.0, idle_ms=100)
    job.init(handle)
    rows = [{"_t": float(t), "seq": t, "score": float(t)} for t in range(20)]
    first, = job.handleInputRows(("m",), iter(rows), _Clock(1000))
    assert first.n == 3 and first.baseline_mean == pytest.approx(18.0) and handle.timers == {1100}
    list(job.handleInputRows(("m",), iter(rows[-1:]), _Clock(1050)))
    assert handle.timers == {1150}  # one timer per key, moved on by every trigger with rows
    assert list(job.handleExpiredTimer(("m",), _Clock(1200), None)) == []
    again, = job.handleInputRows(("m",), iter(rows[:1]), _Clock(1300))
    assert again.n == 1 and again.baseline_mean is None


COLS = ["window_start", "window_end", "itemid", "weight", "n_events"]


def _rows(df):
    return sorted(map(tuple, df.select(*[F.col(c).cast("string") for c in COLS]).collect()))


def test_popularity_table_drops_replays_and_late_rows(spark, tmp_path):
    src, table = str(tmp_path / "src"), str(tmp_path / "table")

    def run():
        stream = spark.readStream.schema(EV_SCHEMA).parquet(src + "/*")
        run_popularity_table(stream, table, str(tmp_path / "ckpt"), watermark="1 hour").awaitTermination(120)
        return _rows(load_popularity(spark, table))

    first, later = _events(spark, 10, 20), _events(spark, 13, 20)
    nameless = first.limit(3).withColumn("event_id", F.lit(None).cast("long"))
    first.union(nameless).write.parquet(src + "/a")
    assert run() == _rows(windowed_item_weights(first.union(nameless), "1 hour"))
    assert run() == _rows(windowed_item_weights(first.union(nameless), "1 hour"))  # nothing new
    first.union(nameless).write.parquet(src + "/replayed")
    _events(spark, 2, 20).write.parquet(src + "/late")  # hours before the watermark
    later.write.parquet(src + "/b")
    assert run() == _rows(windowed_item_weights(first.union(nameless).union(later), "1 hour"))


def test_popularity_table_versions_and_bases(spark, tmp_path):
    table = str(tmp_path)
    parts = [_events(spark, h, 5) for h in (0, 0, 3, 3, 6)]
    for k, part in enumerate(parts):
        store_batch(part, k, table, compact_every=2)
    store_batch(parts[3], 3, table, compact_every=2)  # runs again after a failure
    seen = parts[0]
    for k, part in enumerate(parts):
        seen = seen.union(part) if k else seen
        assert _rows(load_popularity(spark, table, k)) == _rows(windowed_item_weights(seen, "1 hour"))
    with pytest.raises(ValueError):
        load_popularity(spark, str(tmp_path / "none"))
