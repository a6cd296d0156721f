"""Event-time windowed item popularity, for streams and for batch backfills.

The same transformation runs on a static DataFrame (backfill, oracle check) and on a
``readStream`` DataFrame. On a stream the watermark bounds the state: windows older than
the watermark are finalised and emitted once (append mode); later rows are dropped.

``run_popularity_table`` keeps a table that is up to date after every micro-batch: replayed
events are dropped by id, each batch is stored as a delta under its id, and deltas are
folded into a base now and then.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.operators.dictionary import versions
from orchard.operators.interactions import weighted_interactions


def windowed_item_weights(events: DataFrame, window: str = "1 hour", watermark: str | None = "2 hours",
                          ts_col: str = "timestamp", item_col: str = "itemid") -> DataFrame:
    """Sum of event weights and event count per (item, event-time window).

    On a stream ``ts_col`` is cast to TIMESTAMP (watermarks need it). A static input keeps its
    type, so TIMESTAMP_NTZ event times give wall-clock windows whatever the session time zone.
    """
    ev = weighted_interactions(events)
    if ev.isStreaming:
        ev = ev.withColumn("_ts", F.col(ts_col).cast(T.TimestampType()))
        if watermark:
            ev = ev.withWatermark("_ts", watermark)
    else:
        ev = ev.withColumn("_ts", F.col(ts_col))
    agg = ev.groupBy(F.window("_ts", window).alias("w"), F.col(item_col)).agg(
        F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n_events"))
    return agg.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), item_col,
                      "weight", "n_events")


def run_stream_popularity(spark: SparkSession, source: DataFrame, sink_path: str, checkpoint: str,
                          window: str = "1 hour", watermark: str = "2 hours", trigger_once: bool = True):
    """Start the streaming job: append finalised windows as Parquet (exactly-once with the
    checkpoint). Returns the StreamingQuery."""
    out = windowed_item_weights(source, window, watermark)
    w = (out.writeStream.outputMode("append").format("parquet").option("path", sink_path)
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()


def store_batch(batch: DataFrame, batch_id: int, path: str, window: str = "1 hour", compact_every: int = 16) -> None:
    """Stores the item weights of one micro-batch as version ``batch_id`` of the table under ``path``.

    A batch that runs again after a failure overwrites its own version, so nothing counts twice.
    Every ``compact_every``-th version also writes a base, the sum of all versions up to it.
    """
    spark = batch.sparkSession
    windowed_item_weights(batch, window, None).write.mode("overwrite").parquet(f"{path}/delta/version={batch_id}")
    if (batch_id + 1) % compact_every == 0:
        load_popularity(spark, path, batch_id, before=batch_id).write.mode("overwrite").parquet(f"{path}/base/version={batch_id}")


def load_popularity(spark: SparkSession, path: str, version: int | None = None, before: int | None = None) -> DataFrame:
    """window_start, window_end, itemid, weight, n_events of a version, the latest by default.

    Reads the newest base and the deltas after it; ``before`` leaves out bases from that version on.
    """
    top = float("inf") if version is None else version
    bases = [v for v in versions(spark, f"{path}/base") if v <= top and (before is None or v < before)]
    base = bases[-1] if bases else -1
    deltas = [v for v in versions(spark, f"{path}/delta") if base < v <= top]
    if not bases and not deltas:
        raise ValueError(f"no popularity version under {path}")
    files = [f"{path}/base/version={base}"] * bool(bases) + [f"{path}/delta/version={v}" for v in deltas]
    return spark.read.parquet(*files).groupBy("window_start", "window_end", "itemid").agg(
        F.sum("weight").alias("weight"), F.sum("n_events").alias("n_events"))


def run_popularity_table(source: DataFrame, path: str, checkpoint: str, window: str = "1 hour",
                         watermark: str = "2 hours", id_col: str = "event_id", compact_every: int = 16,
                         trigger_once: bool = True):
    """Start the stream that keeps the table under ``path``; returns the StreamingQuery.

    Events of an id seen within the watermark are dropped, so replayed files change nothing; so are events older than
    the watermark, the latest event time of earlier batches less ``watermark``. Events without an id are told apart
    by their values.
    """
    values = F.concat(F.lit("values "), F.sha2(F.to_json(F.struct(*source.columns)), 256))
    events = (source.withColumn("timestamp", F.col("timestamp").cast(T.TimestampType()))
              .withColumn("_key", F.coalesce(F.concat(F.lit("id "), F.col(id_col).cast("string")), values))
              .withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["_key"]).drop("_key"))

    def store(batch: DataFrame, batch_id: int) -> None:
        store_batch(batch, batch_id, path, window, compact_every)

    w = events.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if trigger_once else w.trigger(processingTime="30 seconds")
    return w.start()
