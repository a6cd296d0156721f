"""Continuous score monitoring: last-n window per model key with a frozen baseline and a
z-score drift flag, kept as streaming state.

Each key's state holds at most ``window`` scores (plus the baseline pair), so memory per key
is bounded no matter how many rows a micro-batch brings: incoming Arrow batches are merged
into the ring one at a time. The baseline freezes the first time a key's window is full.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor

OUTPUT_SCHEMA = ("model string, n long, mean double, std double, baseline_mean double, baseline_std double, "
                 "z double, has_drift boolean")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class ScoreWindow(StatefulProcessor):
    """State of one key: a list of its latest scores and, once the window was full, the baseline.

    A late row takes its place by (ts, seq), or none where it is older than the window. With ``idle_ms`` a
    timer clears a key that has had no rows for so long, baseline included.
    """

    def __init__(self, window: int, threshold: float, idle_ms: int | None = None):
        self.window, self.threshold, self.idle_ms = window, threshold, idle_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.latest = handle.getListState("latest", "ts double, seq long, score double")
        self.baseline = handle.getValueState("baseline", "mean double, std double")

    def handleInputRows(self, key, rows, timerValues):
        held = [tuple(r) for r in self.latest.get()]
        for row in rows:
            held.append((row["_t"], row["seq"], row["score"]))
            if len(held) >= 2 * self.window:  # a long batch is merged piece by piece
                held = sorted(held)[-self.window:]
        held = sorted(held)[-self.window:]
        self.latest.put(held)
        scores = [x for _, _, x in held if x is not None]
        mean = math.fsum(scores) / len(scores) if scores else None
        std = math.sqrt(math.fsum((x - mean) ** 2 for x in scores) / len(scores)) if scores else None
        base = self.baseline.get()
        if base is None and len(held) >= self.window and scores:
            base = (mean, std)
            self.baseline.update(base)
        base_mean, base_std = base or (None, None)
        z = abs(mean - base_mean) / base_std if base_std and mean is not None else None
        if self.idle_ms is not None:
            for at in list(self.handle.listTimers()):
                self.handle.deleteTimer(at)
            self.handle.registerTimer(timerValues.getCurrentProcessingTimeInMs() + self.idle_ms)
        yield Row(model=key[0], n=len(held), mean=mean, std=std, baseline_mean=base_mean, baseline_std=base_std, z=z,
                  has_drift=z is not None and z > self.threshold)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        self.latest.clear()
        self.baseline.clear()
        return iter(())

    def close(self) -> None:
        pass


def stream_monitor(scores: DataFrame, window: int = 1000, threshold: float = 2.0, model_col: str = "model",
                   idle_ms: int | None = None) -> DataFrame:
    """scores: (model, ts, seq, score), streaming or static. Returns one row per key and trigger.

    The stream keeps its state with ``transformWithState`` in RocksDB (set for the session here, which the
    operator requires); a query restarted from its checkpoint goes on with it. ``idle_ms`` clears keys that fall silent; use it
    with a trigger that goes on, since an available-now query waits for its timers.
    """
    df = scores.select(F.col(model_col).cast("string").alias("model"),
                       F.col("ts").cast("timestamp").cast("double").alias("_t"), "seq", "score")
    if not df.isStreaming:
        return _static_monitor(df, window, threshold)
    df.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return _latest_of_partition(df, window).groupBy("model").transformWithState(
        ScoreWindow(window, threshold, idle_ms), OUTPUT_SCHEMA, "Update", "None" if idle_ms is None else "ProcessingTime")


def _latest_of_partition(df: DataFrame, window: int) -> DataFrame:
    """The latest ``window`` rows of each key in each partition: what a trigger shuffles, and what
    the task of a hot key gets, is bounded by partitions x ``window`` rows. Earlier rows could
    not be in the key's window after the trigger."""
    def latest(batches):
        held: dict[str, pd.DataFrame] = {}
        for pdf in batches:
            for key, rows in pdf.groupby("model", dropna=False, sort=False):
                rows = pd.concat([held[key], rows]) if key in held else rows
                held[key] = rows.sort_values(["_t", "seq"]).tail(window)
        yield from held.values()

    return df.mapInPandas(latest, df.schema)


def _static_monitor(df: DataFrame, window: int, threshold: float) -> DataFrame:
    """A static table as one long run of small triggers: the baseline is each key's first full
    window, checked against its latest ``window`` rows. Both are row_number limits, applied
    per partition before the shuffle."""
    from pyspark.sql import Window

    def stats(newest: bool) -> DataFrame:
        order = [F.col(c).desc() if newest else F.col(c).asc() for c in ("_t", "seq")]
        rank = F.row_number().over(Window.partitionBy("model").orderBy(*order))
        return df.withColumn("_rn", rank).where(F.col("_rn") <= window).groupBy("model").agg(
            F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean"), F.stddev_pop("score").alias("std"))

    full = F.col("n") >= window
    base = stats(False).select("model", F.when(full, F.col("mean")).alias("baseline_mean"),
                               F.when(full, F.col("std")).alias("baseline_std"))
    z = F.when(F.col("baseline_std") > 0, F.abs(F.col("mean") - F.col("baseline_mean")) / F.col("baseline_std"))
    return stats(True).join(base, "model").select(
        "model", "n", "mean", "std", "baseline_mean", "baseline_std", z.alias("z"),
        F.coalesce(z > threshold, F.lit(False)).alias("has_drift"))
