"""Operational analytics named in the monitoring plan: funnel, recommendation-list
coverage / novelty / diversity, user activity, latency percentiles, input quality, group
fairness. All are grouped aggregates; no pair tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orchard.operators import classification as M
from orchard.operators.prefix import quantile_columns


def funnel_rates(events: DataFrame, type_col: str = "event", value_col: str | None = "value",
                 view="view", cart="addtocart", buy="transaction") -> DataFrame:
    """Views, carts, purchases, click (cart) rate, conversion rate, mean order value (one row)."""
    t = F.col(type_col)
    nv, nc, nb = F.count_if(t == view), F.count_if(t == cart), F.count_if(t == buy)
    aggs = [nv.alias("n_view"), nc.alias("n_cart"), nb.alias("n_purchase"),
            F.when(nv > 0, nc / nv).alias("cart_rate"), F.when(nv > 0, nb / nv).alias("conversion_rate"),
            F.when(nc > 0, nb / nc).alias("cart_to_purchase_rate")]
    if value_col:
        aggs.append(F.avg(F.when(t == buy, F.col(value_col))).alias("mean_order_value"))
    return events.agg(*aggs)


def catalog_coverage(recs: DataFrame, catalog: DataFrame, item_col: str = "item_id") -> DataFrame:
    """Distinct recommended items / catalog size (one row)."""
    n_cat = catalog.select(F.count_distinct(item_col)).scalar()
    return recs.agg(F.count_distinct(item_col).alias("n_recommended"), n_cat.alias("n_catalog"),
                    (F.count_distinct(item_col) / n_cat).alias("coverage"))


def novelty(recs: DataFrame, interactions: DataFrame, item_col: str = "item_id",
            inter_item_col: str = "itemid") -> DataFrame:
    """Mean self-information -log2(p(item)) of recommended items, p = share of interactions
    (items never interacted with are skipped)."""
    total = interactions.select(F.count(F.lit(1))).scalar()
    p = interactions.groupBy(F.col(inter_item_col).alias(item_col)).agg((F.count(F.lit(1)) / total).alias("_p"))
    return recs.join(p, item_col).agg(F.avg(-F.log2("_p")).alias("novelty"))


def intra_list_diversity(recs: DataFrame, item_factors: DataFrame, user_col: str = "user_id",
                         item_col: str = "item_id", factor_item_col: str = "item_idx") -> DataFrame:
    """Mean pairwise cosine distance inside each user's list, averaged over users with 2+ items.

    sum_{i<j} cos(a_i, a_j) = (|sum_i u_i|^2 - n) / 2 with u_i = a_i / |a_i|, so each list is
    reduced to the sum of its unit vectors - no item pairs are formed. Lists are top-k, so a
    user's group holds at most k vectors.
    """
    f = item_factors.select(F.col(factor_item_col).alias(item_col), "factors")
    norm = F.sqrt(F.aggregate("factors", F.lit(0.0), lambda a, x: a + x * x))
    j = recs.join(f, item_col).select(user_col, F.transform("factors", lambda x: x / norm).alias("_u"))
    agg = j.groupBy(user_col).agg(F.count(F.lit(1)).alias("_n"), _array_sum("_u").alias("_s"))
    sq = F.aggregate("_s", F.lit(0.0), lambda a, x: a + x * x)
    n = F.col("_n")
    div = F.when(n > 1, 1 - ((sq - n) / 2) / (n * (n - 1) / 2))
    return agg.agg(F.avg(div).alias("diversity"))


def _array_sum(col: str) -> Column:
    """Element-wise sum of equally long double arrays inside a (bounded) group."""
    return F.aggregate(F.collect_list(col), F.lit(None).cast("array<double>"),
                       lambda acc, x: F.when(acc.isNull(), x).otherwise(F.zip_with(acc, x, lambda a, b: a + b)))


def sessionize(events: DataFrame, user_col: str, ts_col: str, gap_seconds: float = 1800.0,
               n_buckets: int | None = None) -> DataFrame:
    """Sessions per user: a new session starts when the gap to the user's previous event is
    greater than ``gap_seconds`` (Spark's session_window rule). Returns (user, session_id,
    start, end, n_events).

    A user's events are split into time ranges (approximate quantiles of the timestamps), so a
    user holding a large share of all events is processed by many tasks: each (user, range) is
    ordered locally, a per-(user, range) summary - at most ``n_buckets`` rows per user - decides
    whether the first event of a range continues the previous range's last session, and running
    counts of session starts number the sessions.
    """
    from pyspark.sql import Window

    from orchard.operators.prefix import BUCKET, with_range_bucket

    e = events.select(F.col(user_col).alias("_u"), F.col(ts_col).cast("timestamp").alias("_ts"))
    e = with_range_bucket(e.withColumn("_t", F.col("_ts").cast("double")), "_t", n_buckets)
    w = Window.partitionBy("_u", BUCKET).orderBy("_t")
    prev = F.lag("_t").over(w)
    e = e.withColumn("_start_in", (prev.isNotNull() & (F.col("_t") - prev > gap_seconds)).cast("int"))
    summ = e.groupBy("_u", BUCKET).agg(F.min("_t").alias("_first"), F.max("_t").alias("_last"),
                                       F.sum("_start_in").alias("_n_in"))
    ws = Window.partitionBy("_u").orderBy(BUCKET)
    prev_last = F.lag("_last").over(ws)
    summ = summ.withColumn("_first_new", (prev_last.isNull() | (F.col("_first") - prev_last > gap_seconds))
                           .cast("int"))
    summ = summ.withColumn("_off", F.coalesce(F.sum(F.col("_n_in") + F.col("_first_new")).over(
        ws.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = e.join(summ.select("_u", BUCKET, "_off", "_first_new"), ["_u", BUCKET])
    local = F.sum("_start_in").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    j = j.withColumn("_sid", F.col("_off") + F.col("_first_new") + local)
    return j.groupBy(F.col("_u").alias(user_col), F.col("_sid").alias("session_id")).agg(
        F.min("_ts").alias("start"), F.max("_ts").alias("end"), F.count(F.lit(1)).alias("n_events"))


def user_activity(events: DataFrame, ts_col: str = "timestamp", user_col: str = "visitorid",
                  gap_seconds: float = 1800.0) -> DataFrame:
    """Per day: active users, new users (first seen that day), users retained from the
    previous day, sessions started that day and their mean length in whole seconds."""
    ev = events.select(F.col(user_col).alias("u"), F.col(ts_col).cast("timestamp").alias("ts"))
    days = ev.select("u", F.to_date("ts").alias("day")).distinct()
    first = days.groupBy("u").agg(F.min("day").alias("first_day"))
    prev = days.select("u", F.date_add("day", 1).alias("day"), F.lit(1).alias("_prev"))
    d = days.join(first, "u").join(prev, ["u", "day"], "left")
    per_day = d.groupBy("day").agg(F.count(F.lit(1)).alias("active_users"),
                                   F.count_if(F.col("day") == F.col("first_day")).alias("new_users"),
                                   F.count_if(F.col("_prev") == 1).alias("retained_users"))
    sess = sessionize(ev, "u", "ts", gap_seconds)
    slen = sess.groupBy(F.to_date("start").alias("day")).agg(
        F.count(F.lit(1)).alias("sessions"),
        F.avg(F.unix_timestamp("end") - F.unix_timestamp("start")).alias("mean_session_seconds"))
    return per_day.join(slen, "day", "left")


def latency_percentiles(df: DataFrame, latency_col: str, group_cols: list[str], warn_ms: float = 500.0,
                        critical_ms: float = 1000.0) -> DataFrame:
    """Exact p50 / p95 / p99 per group with warning / critical flags on p95."""
    q = quantile_columns(df.select(*group_cols, F.col(latency_col).cast("double").alias("_lat")), "_lat",
                         {"p50": 0.5, "p95": 0.95, "p99": 0.99}, group_cols)
    return q.withColumn("status", F.when(F.col("p95") > critical_ms, "critical")
                        .when(F.col("p95") > warn_ms, "warning").otherwise("ok"))


def input_quality(df: DataFrame, day_col: Column, value_col: str, check_cols: list[str],
                  z_outlier: float = 3.0) -> DataFrame:
    """Per day: rows, missing rate of each checked column, mean / population std of the
    value and rows farther than ``z_outlier`` stds from that day's mean."""
    base = df.withColumn("_day", day_col)
    stats = base.groupBy("_day").agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[(F.count_if(F.col(c).isNull()) / F.count(F.lit(1))).alias(f"missing_rate_{c}") for c in check_cols],
        F.avg(value_col).alias("mean_value"), F.stddev_pop(value_col).alias("std_value"))
    j = base.select("_day", value_col).join(stats.select("_day", "mean_value", "std_value"), "_day")
    out = j.groupBy("_day").agg(F.count_if((F.col("std_value") > 0) & (
        F.abs(F.col(value_col) - F.col("mean_value")) > z_outlier * F.col("std_value"))).alias("n_outliers"))
    return stats.join(out, "_day").withColumnRenamed("_day", "day")


def group_fairness(df: DataFrame, group_cols: list[str], y_true="y_true", y_pred="y_pred") -> DataFrame:
    """Accuracy / precision / recall / F1 per sensitive group (and model)."""
    return M.class_metrics(df, group_cols, y_true, y_pred).join(
        df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias("support")), group_cols)
