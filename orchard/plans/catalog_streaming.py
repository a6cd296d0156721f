"""Queries for the streaming jobs, run here on the static tables (the same transformations
drive the ``readStream`` versions; see tests/test_streaming.py)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.plans.catalog_io import _folder
from orchard.plans.common import round_doubles
from orchard.plans.registry import register
from orchard.sources import fixtures as fx
from orchard.streaming.monitor import stream_monitor
from orchard.streaming.popularity import load_popularity, run_popularity_table, windowed_item_weights

_POPULARITY = fx.with_views("""
SELECT time_bucket(INTERVAL 1 hour, timestamp) AS window_start,
  time_bucket(INTERVAL 1 hour, timestamp) + INTERVAL 1 hour AS window_end, itemid,
  sum(CASE event WHEN 'view' THEN 1e0 WHEN 'addtocart' THEN 2e0 WHEN 'transaction' THEN 3e0 ELSE 0e0 END) AS weight,
  count(*) AS n_events
FROM interactions_raw GROUP BY 1, 2, itemid""", "interactions_raw")


@register("windowed_popularity", _POPULARITY)
def q_windowed_popularity(spark, sf_dir):
    return windowed_item_weights(fx.interactions_raw(spark, sf_dir), "1 hour")


@register("stream_popularity", _POPULARITY)
def q_stream_popularity(spark, sf_dir):
    """The popularity table kept by a stream: the earlier half of the log first, then the later half and the earlier one again."""
    folder = _folder(spark, "popularity")
    events = fx.interactions_raw(spark, sf_dir)
    middle = events.select(F.percentile_approx(F.unix_micros(F.col("timestamp").cast("timestamp")), 0.5)).scalar()
    early = F.unix_micros(F.col("timestamp").cast("timestamp")) < middle
    files = spark.readStream.schema(events.schema)
    for part in ((early, "a"),), ((~early, "b"), (early, "again")):
        for rows, name in part:
            events.where(rows).write.parquet(f"{folder}/events/{name}")
        run_popularity_table(files.parquet(f"{folder}/events/*"), f"{folder}/table", f"{folder}/checkpoint").awaitTermination()
    return load_popularity(spark, f"{folder}/table").select(
        *[F.col(c).cast("timestamp_ntz").alias(c) for c in ("window_start", "window_end")], "itemid", "weight", "n_events")


@register("stream_monitor", fx.with_views("""
WITH p AS (SELECT 'm' || CAST(user_id % 2 AS VARCHAR) AS model, ts, seq, score FROM prediction_log),
r AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY ts DESC, seq DESC) AS late,
  row_number() OVER (PARTITION BY model ORDER BY ts, seq) AS early FROM p),
w AS (SELECT model, count(*) AS n, avg(score) AS mean, stddev_pop(score) AS std FROM r WHERE late <= 500 GROUP BY model),
b AS (SELECT model, CASE WHEN count(*) >= 500 THEN avg(score) END AS bm, CASE WHEN count(*) >= 500 THEN stddev_pop(score) END AS bs
  FROM r WHERE early <= 500 GROUP BY model),
z AS (SELECT *, CASE WHEN bs > 0 THEN abs(mean - bm) / bs END AS zz FROM w JOIN b USING (model))
SELECT model, n, round(mean, 6) AS mean, round(std, 6) AS std, round(bm, 6) AS baseline_mean, round(bs, 6) AS baseline_std,
  round(zz, 6) AS z, coalesce(zz > 0.05, false) AS has_drift FROM z""", "prediction_log"))
def q_stream_monitor(spark, sf_dir):
    """The latest 500 scores of each model key against its first 500, flagged beyond 0.05 deviations."""
    log = fx.prediction_log(spark, sf_dir).withColumn(
        "model", F.concat(F.lit("m"), (F.col("user_id") % 2).cast("string")))
    return round_doubles(stream_monitor(log, 500, 0.05))
