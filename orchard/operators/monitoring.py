"""Score monitoring over an append-only prediction log
``(ts, batch_id, seq, user_id, item_id, score)``.

* recent window: the latest n scores (TakeOrdered on (ts, seq) desc - n rows per task)
* statistics: mean, population std, min, max, count
* baseline: the window statistics and the latest batch as of a past batch
* performance drift: z = |mean - baseline mean| / baseline std, flag z > threshold,
  one-sided p = 1 - Phi(z)
* data shift: two-sample Kolmogorov-Smirnov between the baseline's latest batch and the
  current latest batch; D from distributed running counts, p from lattice paths (small samples) or
  the asymptotic series
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.operators.prefix import running_sums

WINDOW = 1000
DRIFT_THRESHOLD = 2.0
KS_ALPHA = 0.05


def record_predictions(scores: DataFrame, dest: str, batch_id: int | Column | None = None) -> str:
    """Append scored rows to the prediction log with a timestamp, a sequence number and a batch id.

    The log is partitioned by ``batch_id`` (0 where none is given), so that later reads of a few batches skip the
    rest. ``seq`` orders rows of one timestamp: the rows of a write in partition order.
    """
    out = scores.withColumn("ts", F.current_timestamp())
    if "seq" not in scores.columns:
        out = out.withColumn("seq", F.monotonically_increasing_id())
    if batch_id is not None:
        out = out.withColumn("batch_id", batch_id if isinstance(batch_id, Column) else F.lit(batch_id))
    elif "batch_id" not in scores.columns:
        out = out.withColumn("batch_id", F.lit(0))
    out.write.mode("append").partitionBy("batch_id").parquet(dest)
    return dest


def recent_window(log: DataFrame, n: int = WINDOW) -> DataFrame:
    """The latest n log rows by (ts, seq)."""
    return log.orderBy(F.col("ts").desc(), F.col("seq").desc()).limit(n)


def score_stats(window: DataFrame, score_col: str = "score") -> DataFrame:
    """mean, population std, min, max, count (one row)."""
    s = F.col(score_col)
    return window.agg(F.avg(s).alias("mean"), F.stddev_pop(s).alias("std"), F.min(s).alias("min"),
                      F.max(s).alias("max"), F.count(s).alias("count"))


def as_of(log: DataFrame, batch: Column | int) -> DataFrame:
    """The log as it was when ``batch`` was the latest batch."""
    b = batch if isinstance(batch, Column) else F.lit(batch)
    return log.where(F.col("batch_id") <= b)


def baseline_snapshot(log: DataFrame, batch: Column | int, n: int = WINDOW) -> DataFrame:
    """Frozen baseline: window stats and the latest batch as of ``batch`` (one row)."""
    past = as_of(log, batch)
    st = score_stats(recent_window(past, n)).select(F.col("mean").alias("baseline_mean"),
                                                   F.col("std").alias("baseline_std"),
                                                   F.col("count").alias("baseline_count"))
    latest = past.select(F.max("batch_id")).scalar()
    return st.withColumn("baseline_batch", latest)


def erfc(x: Column) -> Column:
    """Complementary error function (Chebyshev fit, fractional error < 1.2e-7)."""
    z = F.abs(x)
    t = 1.0 / (1.0 + 0.5 * z)
    coeffs = [-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398,
              1.48851587, -0.82215223, 0.17087277]
    poly = F.lit(coeffs[-1])
    for c in reversed(coeffs[:-1]):
        poly = F.lit(c) + t * poly
    ans = t * F.exp(-z * z + poly)
    return F.when(x >= 0, ans).otherwise(2.0 - ans)


def normal_sf(z: Column) -> Column:
    """1 - Phi(z)."""
    return 0.5 * erfc(z / math.sqrt(2.0))


def performance_drift(current: DataFrame, baseline: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
    """current: score_stats row; baseline: baseline_snapshot row. Zero baseline std -> null z,
    no drift, and a reason."""
    cur_mean = current.select("mean").scalar()
    z = F.when(F.col("baseline_std") > 0, F.abs(cur_mean - F.col("baseline_mean")) / F.col("baseline_std"))
    return baseline.select(
        F.lit("model_drift").alias("shift_type"),
        F.coalesce(z > threshold, F.lit(False)).alias("has_shift"),
        z.alias("statistic"), normal_sf(z).alias("p_value"), F.lit(float(threshold)).alias("threshold"),
        "baseline_mean", "baseline_std", cur_mean.alias("current_mean"),
        F.when(F.col("baseline_std").isNull() | (F.col("baseline_std") <= 0), F.lit("zero baseline std"))
        .alias("reason"))


def kolmogorov_sf(lam: Column, terms: int = 100) -> Column:
    """Q_KS(lambda) = 2 sum_{k>=1} (-1)^(k-1) exp(-2 k^2 lambda^2); 1 for lambda < 0.2."""
    series = F.aggregate(F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
                         lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0)
                         * F.exp(-2.0 * k * k * lam * lam))
    return F.when(lam < 0.2, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2.0 * series)))


EXACT_KS = 10_000  # largest sample for which the p-value counts lattice paths


def ks_exact_p(n_a: int, n_b: int, statistic: float) -> float:
    """P(D >= ``statistic``) of two samples from one continuous law, by lattice paths.

    Merging the samples is a path from (0, 0) to (n_a, n_b), all paths alike. The path takes a step for a with
    probability (a's left) / (all left); the probability that it ever is ``statistic`` off the diagonal is summed
    up diagonal by diagonal, over the band that is still inside.
    """
    n = n_a + n_b
    d = round(statistic * n_a * n_b)
    if d <= 0:
        return 1.0
    mass, low, outside = np.ones(1), 0, 0.0  # mass[x]: path inside so far with low + x steps for a
    for s in range(n):
        i = np.arange(low, low + len(mass))
        grown = np.append(mass * (n_b - (s - i)) / (n - s), 0.0)
        grown[1:] += mass * (n_a - i) / (n - s)
        first, last = max(low, ((s + 1) * n_a - d) // n + 1), min(low + len(mass), -(-((s + 1) * n_a + d) // n) - 1)
        kept = grown[first - low:last - low + 1]
        outside += grown[:first - low].sum() + grown[last - low + 1:].sum()
        mass, low = kept, first
        if not len(mass):
            break
    return float(min(1.0, outside))


@F.pandas_udf(T.DoubleType())
def _exact_ks(n_a: pd.Series, n_b: pd.Series, statistic: pd.Series) -> pd.Series:
    return pd.Series([ks_exact_p(int(a), int(b), d) if max(a, b) <= EXACT_KS and min(a, b) > 0 else np.nan
                      for a, b, d in zip(n_a.fillna(0), n_b.fillna(0), statistic.fillna(0))], dtype="float64")


def ks_two_sample(a: DataFrame, b: DataFrame, score_col: str = "score") -> DataFrame:
    """D = max |F_a - F_b| over the pooled scores, sizes, p-value (one row).

    The p-value is exact for samples of at most ``EXACT_KS`` scores and asymptotic beyond.

    Scores are collapsed to (score, n_a, n_b) and the empirical CDFs come from distributed
    running counts, so neither sample is ever held by one task.
    """
    return ks_from_flags(a.select(F.col(score_col).alias("score"), F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(F.col(score_col).alias("score"), F.lit(0).alias("_a"), F.lit(1).alias("_b"))))


def ks_from_flags(rows: DataFrame) -> DataFrame:
    """``ks_two_sample`` of rows (score, _a, _b) that say which samples they belong to."""
    from orchard.session import cut_lineage
    # the counts are read by the cut points, the windows and the totals: materialise them once
    pooled = cut_lineage(rows.where(F.col("score").isNotNull())
                         .groupBy("score").agg(F.sum("_a").alias("n_a"), F.sum("_b").alias("n_b")))
    run = running_sums(pooled, "score", ["n_a", "n_b"])
    na = pooled.select(F.sum("n_a")).scalar()
    nb = pooled.select(F.sum("n_b")).scalar()
    d = run.agg(F.max(F.abs(F.col("n_a_cum") / na - F.col("n_b_cum") / nb)).alias("statistic"))
    d = d.select("statistic", na.cast("long").alias("n_a"), nb.cast("long").alias("n_b"))
    en = (F.col("n_a") * F.col("n_b")).cast("double") / (F.col("n_a") + F.col("n_b"))
    small = F.greatest("n_a", "n_b") <= EXACT_KS
    return d.withColumn("p_value", F.when(small, _exact_ks("n_a", "n_b", "statistic")).otherwise(
        kolmogorov_sf(F.sqrt(en) * F.col("statistic"))))


def data_shift(log: DataFrame, baseline: DataFrame, alpha: float = KS_ALPHA) -> DataFrame:
    """KS test of the current latest batch against the baseline's latest batch.

    The two batch ids are single values read once and used as literals, so the log is read with
    one pushed-down filter for both batches."""
    base_batch = baseline.select("baseline_batch").first()[0]
    latest = log.agg(F.max("batch_id")).first()[0]
    both = log.where(F.col("batch_id").isin([base_batch, latest]))
    ks = ks_from_flags(both.select("score", (F.col("batch_id") == F.lit(base_batch)).cast("int").alias("_a"),
                                   (F.col("batch_id") == F.lit(latest)).cast("int").alias("_b")))
    return ks.select(F.lit("data_shift").alias("shift_type"), (F.col("p_value") < alpha).alias("has_shift"),
                     "statistic", "p_value", F.lit(float(alpha)).alias("threshold"), "n_a", "n_b")


def check_shifts(log: DataFrame, baseline: DataFrame | None, n: int = WINDOW,
                 drift_threshold: float = DRIFT_THRESHOLD, alpha: float = KS_ALPHA) -> DataFrame | None:
    """Both checks when a baseline exists: (shift_type, has_shift, statistic, p_value, threshold)."""
    if baseline is None:
        return None
    cols = ["shift_type", "has_shift", "statistic", "p_value", "threshold"]
    perf = performance_drift(score_stats(recent_window(log, n)), baseline, drift_threshold).select(*cols)
    ds = data_shift(log, baseline, alpha).select(*cols)
    return perf.unionByName(ds)


def monitoring_summary(log: DataFrame, baseline: DataFrame | None, n: int = WINDOW) -> DataFrame:
    """Window stats, has_baseline, window size, history size, number of batches (one row)."""
    st = score_stats(recent_window(log, n))
    sizes = log.agg(F.count(F.lit(1)).alias("log_size"), F.count_distinct("batch_id").alias("metrics_history_size"))
    return st.select("*", F.lit(baseline is not None).alias("has_baseline"), F.lit(n).alias("window_size"),
                     F.least(sizes.select("log_size").scalar(), F.lit(n)).alias("history_size"),
                     sizes.select("metrics_history_size").scalar().alias("metrics_history_size"))
