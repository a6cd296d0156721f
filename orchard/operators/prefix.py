"""Distributed ordered scans: running sums and dense ranks without a one-task window.

``Window.orderBy(x)`` with no partition pulls every row into one task. Here the ordered
column is cut into value ranges whose boundaries come from ``percentile_approx`` (one
small row, fixed for the plan, so recomputation after a lost executor assigns the same
ranges). Each range is scanned by its own task; range totals (at most ``n_buckets``
rows per group) are turned into offsets and joined back.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BUCKET = "_range_bucket"


def default_buckets(df: DataFrame) -> int:
    """Value ranges per ordered scan: one per shuffle partition, 8 at least."""
    return max(8, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def with_range_bucket(df: DataFrame, col: str, n_buckets: int | None = None, accuracy: int = 10000) -> DataFrame:
    """Add ``_range_bucket``: equal values always share a bucket, buckets follow ``col`` order.

    Cut points are approximate quantiles from a scalar subquery of the same query, fixed once
    per execution so that a recomputed task lands rows in the same buckets. A row finds its
    place in two steps - among every m-th cut point, then among the m that follow, with m
    the square root of their number - so thousands of ranges cost a row few comparisons.
    Nulls take the lowest bucket.
    """
    n_buckets = n_buckets or default_buckets(df)
    if n_buckets <= 1:
        return df.withColumn(BUCKET, F.lit(0))
    x = F.col(col).cast("double")
    probs = [i / n_buckets for i in range(1, n_buckets)]
    step = math.isqrt(n_buckets - 1) + 1
    q = F.array_distinct(F.percentile_approx(x, probs, max(accuracy, 10 * n_buckets)))
    cuts = df.select(q.alias("q")).select(F.struct(
        "q", F.filter("q", lambda _, i: i % step == 0).alias("coarse")).alias("cuts")).scalar()
    k = F.size(F.filter("_range_cuts.coarse", lambda b: b < x))
    fine = F.size(F.filter(F.slice("_range_cuts.q", (k - 1) * step + 1, F.lit(step)), lambda b: b < x))
    bucket = F.when(k > 0, (k - 1) * step + fine).otherwise(0)
    return (df.withColumn("_range_cuts", cuts).withColumn(BUCKET, F.coalesce(bucket, F.lit(0)))
            .drop("_range_cuts"))


def running_sums(df: DataFrame, order_col: str, value_cols: list[str],
                 group_cols: list[str] | None = None, n_buckets: int | None = None,
                 descending: bool = False, suffix: str = "_cum",
                 tiebreak: list[str] | None = None) -> DataFrame:
    """Inclusive running sums of ``value_cols`` ordered by ``order_col`` within ``group_cols``.

    ``order_col`` (plus ``tiebreak`` columns, ascending) must be unique within a group
    (aggregate ties first, or name tie-break columns). Each value range
    is one task; offsets from the preceding ranges come from a table of at most
    ``n_buckets`` rows per group.
    """
    group_cols = list(group_cols or [])
    b = with_range_bucket(df, order_col, n_buckets)
    if descending:
        b = b.withColumn(BUCKET, -F.col(BUCKET))
    okey = F.col(order_col).desc() if descending else F.col(order_col).asc()
    tb = [F.col(c).asc() for c in (tiebreak or [])]
    local_w = (Window.partitionBy(*group_cols, BUCKET).orderBy(okey, *tb)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = b.select("*", *[F.sum(c).over(local_w).alias(f"_loc_{c}") for c in value_cols])
    totals = b.groupBy(*group_cols, BUCKET).agg(*[F.sum(c).alias(f"_tot_{c}") for c in value_cols])
    off_w = (Window.partitionBy(*group_cols).orderBy(BUCKET)
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*group_cols, BUCKET, *[
        F.coalesce(F.sum(f"_tot_{c}").over(off_w), F.lit(0)).alias(f"_off_{c}") for c in value_cols])
    # left join: an inner join would add an inferred not-null filter on the bucket below the
    # aggregation, which makes the two branches differ and blocks shuffle reuse
    out = local.join(offsets, [*group_cols, BUCKET], "left")
    return out.select(
        *[c for c in df.columns],
        *[(F.coalesce(F.col(f"_off_{c}"), F.lit(0)) + F.col(f"_loc_{c}")).alias(f"{c}{suffix}") for c in value_cols])


def dense_index(df: DataFrame, col: str, index_col: str, n_buckets: int | None = None) -> DataFrame:
    """Distinct values of ``col`` numbered 0..n-1 in ascending order, as (col, index_col)."""
    ids = df.select(col).where(F.col(col).isNotNull()).distinct().withColumn("_one", F.lit(1))
    ranked = running_sums(ids, col, ["_one"], n_buckets=n_buckets)
    return ranked.select(col, (F.col("_one_cum") - 1).cast("long").alias(index_col))


def value_counts(df: DataFrame, col: str, group_cols: list[str] | None = None, count_col: str = "_n") -> DataFrame:
    """(group..., value, count) of non-null values: the input of the count-based helpers."""
    g = list(group_cols or [])
    return df.where(F.col(col).isNotNull()).groupBy(*g, col).agg(F.count(F.lit(1)).alias(count_col))


def exact_quantiles(df: DataFrame, col: str, probs: list[float], group_cols: list[str] | None = None,
                    n_buckets: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (position (n-1)q) without buffering a group.

    Values are first collapsed to a (value, count) table, positions come from distributed
    running counts, and each quantile reads the one or two values around its position.
    Returns (group..., q, value).
    """
    return quantiles_from_counts(value_counts(df, col, group_cols), col, probs, group_cols, n_buckets=n_buckets)


def quantiles_from_counts(freq: DataFrame, col: str, probs: list[float], group_cols: list[str] | None = None,
                          count_col: str = "_n", n_buckets: int | None = None) -> DataFrame:
    """``exact_quantiles`` over an already collapsed (group..., value, count) table."""
    g = list(group_cols or [])
    freq = freq.select(*g, col, F.col(count_col).alias("_n"))
    run = running_sums(freq, col, ["_n"], group_cols=g, n_buckets=n_buckets)
    if g:
        run = run.join(freq.groupBy(*g).agg(F.sum("_n").alias("_tot")), g)
    else:
        run = run.withColumn("_tot", freq.select(F.sum("_n")).scalar())
    start = F.col("_n_cum") - F.col("_n")
    end = F.col("_n_cum") - 1
    pos = [F.struct(F.lit(float(q)).alias("q"),
                    ((F.col("_tot") - 1) * F.lit(float(q))).alias("h")) for q in probs]
    ex = run.select(*g, col, start.alias("_s"), end.alias("_e"), F.explode(F.array(*pos)).alias("_p"))
    lo = F.floor(F.col("_p.h"))
    hi = F.ceil(F.col("_p.h"))
    ex = ex.select(*g, col, "_s", "_e", F.col("_p.q").alias("q"), F.col("_p.h").alias("h"),
                   lo.alias("_lo"), hi.alias("_hi"))
    hit_lo = (F.col("_lo") >= F.col("_s")) & (F.col("_lo") <= F.col("_e"))
    hit_hi = (F.col("_hi") >= F.col("_s")) & (F.col("_hi") <= F.col("_e"))
    agg = (ex.where(hit_lo | hit_hi).groupBy(*g, "q")
           .agg(F.max(F.when(hit_lo, F.col(col))).alias("_vlo"),
                F.max(F.when(hit_hi, F.col(col))).alias("_vhi"),
                F.first("h").alias("h"), F.first("_lo").alias("_lo")))
    vlo = F.col("_vlo").cast("double")
    vhi = F.col("_vhi").cast("double")
    return agg.select(*g, "q", (vlo + (F.col("h") - F.col("_lo")) * (vhi - vlo)).alias("value"))


def quantile_columns(df: DataFrame, col: str, probs: dict[str, float],
                     group_cols: list[str] | None = None, counts: DataFrame | None = None) -> DataFrame:
    """Exact quantiles of ``col`` as named columns: (group..., name1, name2, ...).

    ``counts`` may pass a precomputed ``value_counts`` table (then ``df`` is not read)."""
    g = list(group_cols or [])
    q = (quantiles_from_counts(counts, col, list(probs.values()), g) if counts is not None
         else exact_quantiles(df, col, list(probs.values()), g))
    return q.groupBy(*g).agg(*[F.max(F.when(F.col("q") == float(p), F.col("value"))).alias(name)
                               for name, p in probs.items()])


def dense_rank_sorted(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
                      index_col: str = "rank0") -> DataFrame:
    """0-based rank of distinct rows ordered by ``order_cols`` within ``group_cols``, for any
    orderable type (strings included).

    Rows are range-partitioned on (group, order) and frozen with a reliable checkpoint (so a
    recomputed task sees the same partitions); per-(partition, group) counts - at most
    partitions x groups rows - give offsets, and each partition numbers its own rows.
    """
    from orchard.session import cut_lineage
    g = list(group_cols or [])
    keys = [*g, *order_cols]
    rows = df.select(*keys).distinct()
    n = default_buckets(df)
    r = cut_lineage(rows.repartitionByRange(n, *keys).withColumn("_pid", F.spark_partition_id()))
    counts = r.groupBy("_pid", *g).agg(F.count(F.lit(1)).alias("_c"))
    w = Window.partitionBy(*g).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offs = counts.select("_pid", *g, F.coalesce(F.sum("_c").over(w), F.lit(0)).alias("_off"))
    local = r.withColumn("_ln", F.row_number().over(Window.partitionBy("_pid", *g).orderBy(*order_cols)))
    out = local.join(offs, ["_pid", *g], "left")
    return out.select(*keys, (F.coalesce(F.col("_off"), F.lit(0)) + F.col("_ln") - 1).cast("long").alias(index_col))
