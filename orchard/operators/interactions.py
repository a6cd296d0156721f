"""Event log -> weighted interactions, dense ids, popularity.

Row order does not exist in Spark, so the dense index numbers ids in ascending order
(0-based) instead of order of first appearance.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.operators.dictionary import sorted_index
from orchard.operators.prefix import dense_index as _dense_index

# Default event weights and positive events of the strategies.
DEFAULT_WEIGHTS: dict[str, float] = {"view": 1.0, "addtocart": 2.0, "transaction": 3.0}
POSITIVE_EVENTS: tuple[str, ...] = ("addtocart", "transaction")


def _weight_of(weights: dict[str, float], col: str = "event") -> Column:
    """CASE event WHEN ... THEN weight ... END (null for unknown types); codegen-friendly."""
    expr = None
    for k, v in weights.items():
        cond = F.col(col) == F.lit(k)
        expr = F.when(cond, F.lit(float(v))) if expr is None else expr.when(cond, F.lit(float(v)))
    return expr if expr is not None else F.lit(None).cast("double")


def with_load_weights(events: DataFrame) -> DataFrame:
    """Weight of the plain event loader: known types 1/2/3, unknown types stay null."""
    return events.withColumn("weight", _weight_of(DEFAULT_WEIGHTS))


def weighted_interactions(events: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Weight per event type; unknown types get 0.0 and stay. Empty weights -> defaults."""
    w = weights or DEFAULT_WEIGHTS
    return events.withColumn("weight", F.coalesce(_weight_of(w), F.lit(0.0)))


def binary_interactions(events: DataFrame, positive_events: tuple[str, ...] | None = None) -> DataFrame:
    """Keep positive event types only, weight 1.0."""
    pos = list(positive_events or POSITIVE_EVENTS)
    return events.where(F.col("event").isin(pos)).withColumn("weight", F.lit(1.0))


def implicit_interactions(events: DataFrame) -> DataFrame:
    """Every event is a positive with weight 1.0."""
    return events.withColumn("weight", F.lit(1.0))


def min_interactions(df: DataFrame, n: int, user_col: str = "visitorid",
                     item_col: str = "itemid") -> DataFrame:
    """Single-pass filter: user and item counts from the same unfiltered frame, ANDed.

    Skipped for n <= 1. Counts are map-side combined; the two semi joins use key tables
    with one row per user / item.
    """
    if n <= 1:
        return df
    users = df.groupBy(user_col).count().where(F.col("count") >= n).select(user_col)
    items = df.groupBy(item_col).count().where(F.col("count") >= n).select(item_col)
    return df.join(users, user_col, "left_semi").join(items, item_col, "left_semi")


def dense_index(df: DataFrame, col: str, index_col: str, n_buckets: int | None = None) -> DataFrame:
    """Distinct ids -> 0-based dense index in ascending id order: (col, index_col).

    Numbers are cut into value ranges by quantiles, other ids by splits sampled from their own type.
    """
    if not isinstance(df.schema[col].dataType, T.NumericType):
        return sorted_index(df, col, index_col)
    return _dense_index(df, col, index_col, n_buckets=n_buckets)


def apply_index(df: DataFrame, user_index: DataFrame, item_index: DataFrame,
                user_col: str = "visitorid", item_col: str = "itemid") -> DataFrame:
    """Attach user_idx / item_idx; rows whose ids are not in an index are dropped."""
    return df.join(user_index, user_col, "inner").join(item_index, item_col, "inner")


StrategyFn = Callable[..., DataFrame]

STRATEGIES: dict[str, StrategyFn] = {
    "weighted": weighted_interactions,
    "binary": binary_interactions,
    "implicit": implicit_interactions,
}


def process(events: DataFrame, strategy: str | StrategyFn = "weighted", min_count: int = 1,
            **kwargs) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Strategy -> min-interaction filter -> dense indexes (materialised) -> indexed interactions.

    ``strategy`` is a registered name or any function DataFrame -> DataFrame adding a
    ``weight`` column. Returns (interactions, user_index, item_index).
    """
    if callable(strategy):
        fn = strategy
    else:
        if strategy not in STRATEGIES:
            raise ValueError(f"Unknown strategy '{strategy}'. Available: {sorted(STRATEGIES)}")
        fn = STRATEGIES[strategy]
    # the filtered rows are read by both indexes and the join, and each table of ids by the cut
    # points, the windows and the totals of its ranking: materialise each of them once
    from orchard.session import cut_lineage
    df = cut_lineage(min_interactions(fn(events, **kwargs), min_count))
    users = cut_lineage(dense_index(cut_lineage(df.select("visitorid").distinct()), "visitorid", "user_idx"))
    items = cut_lineage(dense_index(cut_lineage(df.select("itemid").distinct()), "itemid", "item_idx"))
    return apply_index(df, users, items), users, items


def popular_items(interactions: DataFrame, item_col: str = "itemid", weight_col: str | None = "weight",
                  out_col: str = "popularity") -> DataFrame:
    """Per-item sum of weights (or counts) divided by the maximum; raw sums when max is 0.

    The maximum is a scalar subquery over the per-item table, evaluated once.
    """
    val = F.sum(weight_col).cast("double") if weight_col else F.count(F.lit(1)).cast("double")
    per_item = interactions.groupBy(item_col).agg(val.alias("_s"))
    mx = per_item.select(F.max("_s")).scalar()
    return per_item.select(item_col, F.when(mx > 0, F.col("_s") / mx).otherwise(F.col("_s")).alias(out_col))


def popular_top_k(popularity: DataFrame, k: int, item_col: str = "itemid",
                  score_col: str = "popularity") -> DataFrame:
    """Global top-k by score, ties to the lower id (TakeOrdered: k rows per task, then merge)."""
    return popularity.orderBy(F.col(score_col).desc(), F.col(item_col).asc()).limit(k)


def interaction_summary(events: DataFrame, strategies: tuple[str, ...] = ("weighted", "binary", "implicit"),
                        min_count: int = 1) -> DataFrame:
    """Users, items and rows per strategy.

    Without a minimum-interaction filter every strategy is a row subset of the events (all
    rows, or the positive types), so one scan with conditional distinct counts serves all of
    them; with a filter each strategy is filtered separately.
    """
    if min_count <= 1:
        pos = F.col("event").isin(list(POSITIVE_EVENTS))
        keep = {"weighted": F.lit(True), "implicit": F.lit(True), "binary": pos}
        aggs = []
        for st in strategies:
            c = keep[st]
            aggs += [F.count_distinct(F.when(c, F.col("visitorid"))).alias(f"{st}__u"),
                     F.count_distinct(F.when(c, F.col("itemid"))).alias(f"{st}__i"),
                     F.count_if(c).alias(f"{st}__n")]
        one = events.agg(*aggs)
        rows = F.array(*[F.struct(F.lit(st).alias("strategy"), F.col(f"{st}__u").alias("n_users"),
                                  F.col(f"{st}__i").alias("n_items"), F.col(f"{st}__n").alias("n_rows"))
                         for st in strategies])
        return one.select(F.explode(rows).alias("r")).select("r.*")
    parts = []
    for st in strategies:
        df = min_interactions(STRATEGIES[st](events), min_count)
        parts.append(df.agg(F.lit(st).alias("strategy"),
                            F.count_distinct("visitorid").alias("n_users"),
                            F.count_distinct("itemid").alias("n_items"),
                            F.count(F.lit(1)).alias("n_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
