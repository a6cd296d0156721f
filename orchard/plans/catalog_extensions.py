"""Queries: funnel, list coverage / novelty / diversity, user activity, latency percentiles,
input quality, group fairness."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.operators import extensions as XT
from orchard.operators import sketches as SK
from orchard.operators.clean import predict_class
from orchard.operators.profile import event_summary, event_summary_approx
from orchard.plans.catalog_io import _folder
from orchard.plans.catalog_recommend import _TOPK, top_k
from orchard.plans.common import round_doubles
from orchard.plans.registry import register
from orchard.session import cut_lineage
from orchard.sources import fixtures as fx


@register("funnel_rates", fx.with_views("""
SELECT count_if(event_type = 'view') AS n_view, count_if(event_type = 'click') AS n_cart,
  count_if(event_type = 'purchase') AS n_purchase,
  CASE WHEN count_if(event_type = 'view') > 0 THEN count_if(event_type = 'click') / count_if(event_type = 'view') END
    AS cart_rate,
  CASE WHEN count_if(event_type = 'view') > 0 THEN count_if(event_type = 'purchase') / count_if(event_type = 'view') END
    AS conversion_rate,
  CASE WHEN count_if(event_type = 'click') > 0 THEN count_if(event_type = 'purchase') / count_if(event_type = 'click') END
    AS cart_to_purchase_rate,
  round(avg(CASE WHEN event_type = 'purchase' THEN value END), 6) AS mean_order_value FROM events"""))
def q_funnel(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return round_doubles(XT.funnel_rates(ev, "event_type", "value", view="view", cart="click", buy="purchase"))


_FIX = ("user_factors", "item_factors", "truth")


@register("catalog_coverage", fx.with_views(f"""WITH {_TOPK}
SELECT count(DISTINCT item_idx) AS n_recommended, (SELECT count(DISTINCT item_idx) FROM item_factors) AS n_catalog,
  count(DISTINCT item_idx) / (SELECT count(DISTINCT item_idx) FROM item_factors) AS coverage FROM tk""", *_FIX))
def q_coverage(spark, sf_dir):
    recs = top_k(spark, sf_dir).withColumnRenamed("item_idx", "item_id")
    cat = fx.item_factors(spark, sf_dir).withColumnRenamed("item_idx", "item_id")
    return XT.catalog_coverage(recs, cat)


@register("novelty", fx.with_views(f"""WITH {_TOPK},
p AS (SELECT itemid, count(*) / (SELECT count(*) FROM interactions_raw) AS p FROM interactions_raw GROUP BY itemid)
SELECT round(avg(-log2(p.p)), 6) AS novelty FROM tk JOIN p ON p.itemid = tk.item_idx""", *_FIX, "interactions_raw"))
def q_novelty(spark, sf_dir):
    recs = top_k(spark, sf_dir).withColumnRenamed("item_idx", "item_id")
    return round_doubles(XT.novelty(recs, fx.interactions_raw(spark, sf_dir)))


@register("intra_list_diversity", fx.with_views(f"""WITH {_TOPK},
uv AS (SELECT tk.user_idx, generate_subscripts(f.factors, 1) AS j,
  unnest(f.factors) / sqrt(list_sum(list_transform(f.factors, lambda x: x * x))) AS v
  FROM tk JOIN item_factors f USING (item_idx)),
sv AS (SELECT user_idx, j, sum(v) AS s FROM uv GROUP BY user_idx, j),
sq AS (SELECT user_idx, sum(s * s) AS sq FROM sv GROUP BY user_idx),
nn AS (SELECT user_idx, count(*) AS n FROM tk GROUP BY user_idx)
SELECT round(avg(CASE WHEN n > 1 THEN 1 - ((sq - n) / 2) / (n * (n - 1) / 2) END), 6) AS diversity
FROM sq JOIN nn USING (user_idx)""", *_FIX))
def q_diversity(spark, sf_dir):
    recs = top_k(spark, sf_dir).select(F.col("user_idx").alias("user_id"), F.col("item_idx").alias("item_id"))
    return round_doubles(XT.intra_list_diversity(recs, fx.item_factors(spark, sf_dir)))


@register("user_activity", fx.with_views("""
WITH ev AS (SELECT visitorid AS u, CAST(timestamp AS TIMESTAMP) AS ts FROM interactions_raw),
days AS (SELECT DISTINCT u, CAST(ts AS DATE) AS day FROM ev),
first AS (SELECT u, min(day) AS first_day FROM days GROUP BY u),
d AS (SELECT days.u, days.day, first.first_day, p.u IS NOT NULL AS prev FROM days JOIN first USING (u)
  LEFT JOIN days p ON p.u = days.u AND p.day + INTERVAL 1 DAY = days.day),
per_day AS (SELECT day, count(*) AS active_users, count_if(day = first_day) AS new_users,
  count_if(prev) AS retained_users FROM d GROUP BY day),
o AS (SELECT u, ts, lag(ts) OVER (PARTITION BY u ORDER BY ts) AS prev_ts FROM ev),
s1 AS (SELECT *, sum(CASE WHEN prev_ts IS NULL OR ts - prev_ts > INTERVAL 30 MINUTE THEN 1 ELSE 0 END)
  OVER (PARTITION BY u ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM o),
sess AS (SELECT u, sid, min(ts) AS t0, max(ts) AS t1 FROM s1 GROUP BY u, sid),
slen AS (SELECT CAST(t0 AS DATE) AS day, count(*) AS sessions,
  round(avg(floor(epoch(t1)) - floor(epoch(t0))), 6) AS mean_session_seconds FROM sess GROUP BY 1)
SELECT per_day.*, slen.sessions, slen.mean_session_seconds FROM per_day LEFT JOIN slen USING (day)""",
                                         "interactions_raw"))
def q_user_activity(spark, sf_dir):
    return round_doubles(XT.user_activity(fx.interactions_raw(spark, sf_dir)))


@register("latency_percentiles", """
SELECT event_type, round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.95), 6) AS p95,
  round(quantile_cont(value, 0.99), 6) AS p99,
  CASE WHEN quantile_cont(value, 0.95) > 1000 THEN 'critical' WHEN quantile_cont(value, 0.95) > 500 THEN 'warning'
       ELSE 'ok' END AS status
FROM events WHERE value IS NOT NULL GROUP BY event_type""")
def q_latency(spark, sf_dir):
    """Exact latency percentiles per event type (the event value stands in for a latency)."""
    ev = fx.table(spark, sf_dir, "events")
    return round_doubles(XT.latency_percentiles(ev, "value", ["event_type"]))


@register("input_quality", """
WITH b AS (SELECT CAST(ts AS DATE) AS day, props, value FROM events),
st AS (SELECT day, count(*) AS n_rows, count_if(props IS NULL) / count(*) AS missing_rate_props,
  count_if(value IS NULL) / count(*) AS missing_rate_value, avg(value) AS mean_value, stddev_pop(value) AS std_value
  FROM b GROUP BY day),
o AS (SELECT b.day, count_if(st.std_value > 0 AND abs(b.value - st.mean_value) > 3.0 * st.std_value) AS n_outliers
  FROM b JOIN st USING (day) GROUP BY b.day)
SELECT st.day, n_rows, round(missing_rate_props, 6) AS missing_rate_props, round(missing_rate_value, 6) AS missing_rate_value,
  round(mean_value, 6) AS mean_value, round(std_value, 6) AS std_value, n_outliers FROM st JOIN o USING (day)""")
def q_input_quality(spark, sf_dir):
    ev = fx.table(spark, sf_dir, "events")
    return round_doubles(XT.input_quality(ev, F.to_date("ts"), "value", ["props", "value"]))


@register("group_fairness", fx.with_views("""
WITH sp AS (SELECT s.*, CAST(s.y_proba > 0.5 AS INT) AS y_pred, l.quality FROM scored s JOIN labels l ON l.doc_id = s.id),
cm AS (SELECT model, quality, count_if(y_true = 0 AND y_pred = 0) AS tn, count_if(y_true = 0 AND y_pred = 1) AS fp,
  count_if(y_true = 1 AND y_pred = 0) AS fn, count_if(y_true = 1 AND y_pred = 1) AS tp, count(*) AS support
  FROM sp GROUP BY model, quality)
SELECT model, quality, round(CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) / (tp + tn + fp + fn) ELSE 0e0 END, 6) AS accuracy,
  round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END, 6) AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END, 6) AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0e0 END, 6) AS f1, support FROM cm""",
                                          "scored"))
def q_fairness(spark, sf_dir):
    """Classification metrics per model and sensitive group (document quality flag)."""
    lab = fx.table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), "quality")
    sp = predict_class(fx.scored(spark, sf_dir), 0.5).join(lab, "id")
    return round_doubles(XT.group_fairness(sp, ["model", "quality"]))


_QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


@register("sketch_summary", """
SELECT event_type, count(*) AS n_rows, CAST(0 AS BIGINT) AS n_outside FROM events GROUP BY event_type""")
def q_sketch_summary(spark, sf_dir):
    """Distinct users and value percentiles per event type from stored day sketches, checked against every event.

    The earlier days are stored first, then the later ones, with the last early day once more."""
    ev = fx.table(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    path = f"{_folder(spark, 'sketches')}/store"
    middle = ev.select(F.percentile_approx(F.unix_date("day"), 0.5)).scalar()
    for days in F.unix_date("day") <= middle, F.unix_date("day") >= middle:
        SK.update_sketches(ev.where(days), path, "day", ["event_type"], "user_id", "value")
    summary = SK.merged_summary(SK.load_sketches(spark, path), ["event_type"], _QUANTILES)
    return SK.outside_bounds(ev, cut_lineage(summary), ["event_type"], "user_id", "value", _QUANTILES)


@register("event_summary_approx_bound", fx.with_views("""
SELECT count(*) AS n_events, CAST(0 AS BIGINT) AS n_outside FROM interactions_raw""", "interactions_raw"))
def q_event_summary_approx_bound(spark, sf_dir):
    """Whether the approximate user count is within five standard errors of the exact one."""
    events = fx.interactions_raw(spark, sf_dir)
    exact = event_summary(events).select("n_users").scalar()
    near = F.abs(F.col("n_users_approx") - exact) <= exact * 0.05
    return event_summary_approx(events, rsd=0.01).select("n_events", (~near).cast("long").alias("n_outside"))
