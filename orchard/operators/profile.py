"""Table profiling: missing values, describe, class balance, crosstabs, group rates,
correlations, histograms, box statistics, event-log and catalog summaries.

Everything is a grouped aggregate (map-side combined); quantiles are exact and
distributed (``prefix.exact_quantiles``), never a whole group in one buffer.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orchard.operators.prefix import quantile_columns, value_counts
from orchard.session import cut_lineage


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _rows_of(df: DataFrame, rows: list[list], keep: list[str] | None = None) -> DataFrame:
    """Turn each input row into len(rows) output rows (one projection, no self-union)."""
    keep = list(keep or [])
    arr = F.array(*[F.struct(*r) for r in rows])
    return df.select(*keep, F.explode(arr).alias("_r")).select(*keep, "_r.*")


def missing_counts(df: DataFrame) -> DataFrame:
    """(column, n_missing): one aggregate pass, unpivoted."""
    agg = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return agg.unpivot([], df.columns, "column", "n_missing")


def table_shape(df: DataFrame) -> DataFrame:
    """(n_rows, n_columns)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).cast("long").alias("n_columns"))


def column_types(df: DataFrame) -> list[tuple[str, str]]:
    return list(df.dtypes)


def describe_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (exact, linear), max per column.

    The input is read once: columns are unpivoted to (column, value) and collapsed to
    (column, value, count), materialised; moments (two-pass: mean first, then squared
    deviations), extremes and quantiles all come from that table.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "column", "value")
    # the count table feeds moments, extremes and the ranking job: materialise it once
    freq = cut_lineage(value_counts(long, "value", ["column"]))
    n = F.col("_n").cast("double")
    m = freq.groupBy("column").agg(F.sum("_n").alias("count"), (F.sum(n * F.col("value")) / F.sum(n)).alias("mean"),
                                   F.min("value").alias("min"), F.max("value").alias("max"))
    dev = freq.join(m.select("column", "mean"), "column").groupBy("column").agg(
        F.sum(n * (F.col("value") - F.col("mean")) ** 2).alias("_ss"))
    stats = m.join(dev, "column").withColumn(
        "std", F.when(F.col("count") > 1, F.sqrt(F.col("_ss") / (F.col("count") - 1))))
    qs = quantile_columns(None, "value", {"p25": 0.25, "p50": 0.5, "p75": 0.75}, ["column"], counts=freq)
    return stats.join(qs, "column", "left").select("column", "count", "mean", "std", "min", "p25", "p50",
                                                   "p75", "max")


def key_numeric_stats(df: DataFrame, columns: list[str]) -> DataFrame:
    """mean, median, sample std, min, max per column."""
    d = describe_numeric(df, columns)
    return d.select("column", "mean", F.col("p50").alias("median"), "std", "min", "max")


def target_distribution(df: DataFrame, label_col: str) -> DataFrame:
    """Count and percent per class; the total is a scalar subquery."""
    total = df.select(F.count(F.lit(1))).scalar()
    return (df.groupBy(label_col).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("percent", F.col("count") * 100.0 / total))


def imbalance_ratio(df: DataFrame, label_col: str, positive="Yes") -> DataFrame:
    """Majority / minority counts, ratio and positive-class percent (one row)."""
    pos = F.count_if(F.col(label_col) == F.lit(positive))
    neg = F.count_if(F.col(label_col) != F.lit(positive))
    n = F.count(F.lit(1))
    return df.agg(n.alias("n"), pos.alias("n_pos"), neg.alias("n_neg"),
                  (F.greatest(pos, neg) / F.least(pos, neg)).alias("imbalance_ratio"),
                  (pos * 100.0 / n).alias("pos_percent"))


def crosstab_counts(df: DataFrame, dim: str, label_col: str, classes=("No", "Yes")) -> DataFrame:
    """Counts dim x class as columns count_<class> (pivot with known values: no extra job)."""
    p = df.groupBy(dim).pivot(label_col, list(classes)).agg(F.count(F.lit(1)))
    return p.select(dim, *[F.coalesce(F.col(c), F.lit(0)).alias(f"count_{c.lower()}") for c in classes])


def crosstab_rate(df: DataFrame, dim: str, label_col: str, classes=("No", "Yes"), digits: int = 2) -> DataFrame:
    """Row-normalised percent per class, rounded."""
    ct = crosstab_counts(df, dim, label_col, classes)
    tot = reduce(lambda a, b: a + b, [F.col(f"count_{c.lower()}") for c in classes])
    return ct.select(dim, *[F.round(F.col(f"count_{c.lower()}") * 100.0 / tot, digits).alias(f"pct_{c.lower()}")
                            for c in classes])


def group_churn_rate(df: DataFrame, group_col: str, label_col: str = "churn_label", positive="Yes",
                     id_col: str = "customerid", min_n: int = 10) -> DataFrame:
    """Positives, customers and rate % (2 decimals) per group; groups below ``min_n`` dropped."""
    return (df.groupBy(group_col)
            .agg(F.count_if(F.col(label_col) == positive).alias("churn_count"),
                 F.count(id_col).alias("total_customers"))
            .where(F.col("total_customers") >= min_n)
            .withColumn("churn_rate", F.round(F.col("churn_count") * 100.0 / F.col("total_customers"), 2)))


def top_bottom_groups(rates: DataFrame, group_col: str, rate_col: str = "churn_rate",
                      top: int = 20, bottom: int = 15) -> DataFrame:
    """Best ``top`` and worst ``bottom`` groups by rate (ties by name), with their rank.

    Each side is a TakeOrdered (k rows per task); the rank is numbered over <= k rows.
    """
    hi = rates.orderBy(F.col(rate_col).desc(), F.col(group_col).asc()).limit(top)
    lo = rates.orderBy(F.col(rate_col).asc(), F.col(group_col).desc()).limit(bottom)
    w_hi = Window.orderBy(F.col(rate_col).desc(), F.col(group_col).asc())
    w_lo = Window.orderBy(F.col(rate_col).asc(), F.col(group_col).desc())
    return (hi.select(F.lit("top").alias("side"), F.row_number().over(w_hi).cast("long").alias("rank"), "*")
            .unionByName(lo.select(F.lit("bottom").alias("side"), F.row_number().over(w_lo).cast("long").alias("rank"),
                                   "*")))


def group_rate_summary(rates: DataFrame, rate_col: str = "churn_rate") -> DataFrame:
    """Number of groups, highest / lowest rate, spread and mean rate (one row)."""
    return rates.agg(F.count(F.lit(1)).alias("n_groups"), F.max(rate_col).alias("max_rate"),
                     F.min(rate_col).alias("min_rate"),
                     (F.max(rate_col) - F.min(rate_col)).alias("spread"),
                     F.avg(rate_col).alias("mean_rate"))


def geo_summary(df: DataFrame, state_col="state", city_col="city", lat="latitude", lon="longitude") -> DataFrame:
    return df.agg(F.count_distinct(state_col).alias("n_states"), F.count_distinct(city_col).alias("n_cities"),
                  F.min(lat).alias("min_latitude"), F.max(lat).alias("max_latitude"),
                  F.min(lon).alias("min_longitude"), F.max(lon).alias("max_longitude"))


def value_counts_top(df: DataFrame, col: str, k: int | None = None) -> DataFrame:
    """(col, count) ordered by count desc, value asc; top k if given."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    out = out.orderBy(F.col("count").desc(), F.col(col).asc())
    return out.limit(k) if k else out


def group_mean_std(df: DataFrame, label_col: str, columns: list[str]) -> DataFrame:
    """Mean and sample std of each column per class, long form (label, column, mean, std)."""
    aggs = []
    for c in columns:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    wide = df.groupBy(label_col).agg(*aggs)
    return _rows_of(wide, [[F.lit(c).alias("column"), F.col(f"{c}__mean").alias("mean"),
                            F.col(f"{c}__std").alias("std")] for c in columns], keep=[label_col])


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair (including both orders and the diagonal), long form."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1:]]
    one = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}__{b}") for a, b in pairs])
    rows = []
    for a, b in pairs:
        rows.append([F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), F.col(f"{a}__{b}").alias("corr")])
        rows.append([F.lit(b).alias("col_a"), F.lit(a).alias("col_b"), F.col(f"{a}__{b}").alias("corr")])
    rows += [[F.lit(c).alias("col_a"), F.lit(c).alias("col_b"), F.lit(1.0).alias("corr")] for c in columns]
    return _rows_of(one, rows)


def target_correlation(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    one = df.agg(*[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns])
    return one.unpivot([], columns, "column", "corr")


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max]; the maximum falls in the last bin; empty bins kept."""
    x = F.col(col).cast("double")
    lim = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi"))
    lo, hi = lim.select("lo").scalar(), lim.select("hi").scalar()
    width = (hi - lo) / bins
    b = F.when(hi > lo, F.least(F.floor((x - lo) / (hi - lo) * bins), F.lit(bins - 1))).otherwise(F.lit(0))
    counts = df.where(x.isNotNull()).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    all_bins = lim.select(F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (all_bins.join(counts, "bin", "left")
            .select("bin", (lo + F.col("bin") * width).alias("lower"), (lo + (F.col("bin") + 1) * width).alias("upper"),
                    F.coalesce(F.col("count"), F.lit(0)).alias("count")))


def box_stats(df: DataFrame, col: str, label_col: str) -> DataFrame:
    """Quartiles, IQR, whiskers (extreme values inside the 1.5 IQR fences) and outlier count
    per class - all from one (class, value, count) table, so the input is read once."""
    x = F.col(col).cast("double")
    freq = cut_lineage(value_counts(df.select(label_col, x.alias(col)), col, [label_col]))
    q = quantile_columns(None, col, {"q1": 0.25, "median": 0.5, "q3": 0.75}, [label_col], counts=freq)
    iqr = F.col("q3") - F.col("q1")
    q = q.withColumn("iqr", iqr).withColumn("lo_fence", F.col("q1") - 1.5 * iqr) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * iqr)
    j = freq.join(q, label_col)
    inside = (F.col(col) >= F.col("lo_fence")) & (F.col(col) <= F.col("hi_fence"))
    return (j.groupBy(label_col, "q1", "median", "q3", "iqr")
            .agg(F.min(F.when(inside, F.col(col))).alias("whisker_low"),
                 F.max(F.when(inside, F.col(col))).alias("whisker_high"),
                 F.sum(F.when(~inside, F.col("_n")).otherwise(0)).alias("n_outliers")))


def event_summary(events: DataFrame, user_col="visitorid") -> DataFrame:
    return events.agg(F.count(F.lit(1)).alias("n_events"), F.count_distinct(user_col).alias("n_users"))


def event_summary_approx(events: DataFrame, user_col="visitorid", rsd: float = 0.01) -> DataFrame:
    """Same with HyperLogLog++ distinct users: constant memory per task at any scale."""
    return events.agg(F.count(F.lit(1)).alias("n_events"),
                      F.approx_count_distinct(user_col, rsd).alias("n_users_approx"))


def property_summary(props: DataFrame, item_col="itemid") -> DataFrame:
    return props.agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct(item_col).alias("n_items"))


def top_parents(tree: DataFrame, k: int = 10, parent_col="parentid", id_col="categoryid") -> DataFrame:
    """Number of children per parent, top k, null parents excluded."""
    return (tree.where(F.col(parent_col).isNotNull()).groupBy(parent_col)
            .agg(F.count(id_col).alias("n_children"))
            .orderBy(F.col("n_children").desc(), F.col(parent_col).asc()).limit(k))


def split_summary(df: DataFrame, split_col: str = "split", label_col: str = "label",
                  n_features: int | None = None) -> DataFrame:
    """Rows, feature count and positive rate per split."""
    nf = n_features if n_features is not None else len(df.columns) - 2
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"),
                                     F.lit(nf).alias("n_features"),
                                     F.avg(F.col(label_col).cast("double")).alias("positive_rate"))


def distinct_sample(df: DataFrame, col: str, n: int = 10) -> DataFrame:
    """First n distinct values in ascending order (partial dedup per task, then TakeOrdered)."""
    return df.select(col).distinct().orderBy(F.col(col).asc_nulls_first()).limit(n)
