"""Helpers shared by the query catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.operators import clean as C
from orchard.sources import fixtures as fx

DIGITS = 6


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every double column (float sums differ in the last bits between engines)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def customers_clean(spark, sf_dir) -> DataFrame:
    """customers_raw with total_charges parsed (blank -> 0.0)."""
    return C.coerce_numeric(fx.customers_raw(spark, sf_dir), "total_charges", 0.0)


# Oracle side ---------------------------------------------------------------------------

NUM_RE = C.NUMERIC_PATTERN


def sql_parse(col: str) -> str:
    return f"CASE WHEN regexp_matches(trim({col}), '{NUM_RE}') THEN TRY_CAST(trim({col}) AS DOUBLE) END"


CUSTOMERS_CLEAN_CTE = (
    "customers_clean AS (SELECT * REPLACE (coalesce("
    + sql_parse("total_charges") + ", 0e0) AS total_charges) FROM customers_raw)")


def r(expr: str, alias: str, digits: int = DIGITS) -> str:
    return f"round({expr}, {digits}) AS {alias}"


def rank_metrics_sql(p: str, truth: str, tk: str, k: int = 10, variant: str = "model",
                     per_user: bool = False, suffix: bool = True) -> str:
    """CTEs ``{p}t .. {p}rm`` computing hit_rate/ndcg/precision/recall/mrr (DuckDB side)."""
    hits = "hd" if variant == "model" else "hdup"
    hr = "avg(CASE WHEN hdup > 0 THEN 1e0 ELSE 0e0 END)" if per_user else "sum(hdup) / sum(n_true)"
    s = f"_{k}" if suffix else ""
    return f"""{p}t AS (SELECT user_idx, item_idx, count(*) AS mult FROM {truth} GROUP BY user_idx, item_idx),
{p}nt AS (SELECT user_idx, sum(mult) AS n_true FROM {p}t GROUP BY user_idx),
{p}h AS (SELECT {tk}.user_idx, count(*) AS hd, sum(mult) AS hdup, sum(1 / log2(rank + 1)) AS dcg, min(rank) AS fr
  FROM {tk} JOIN {p}t USING (user_idx, item_idx) WHERE rank <= {k} GROUP BY {tk}.user_idx),
{p}pu AS (SELECT {p}nt.user_idx, n_true, coalesce(hd, 0) AS hd, coalesce(hdup, 0) AS hdup, coalesce(dcg, 0e0) AS dcg,
  CASE WHEN least(n_true, {k}) > 0 THEN
    list_sum(list_transform(range(1, CAST(least(n_true, {k}) AS BIGINT) + 1), lambda i: 1 / log2(i + 1))) ELSE 0e0 END
    AS idcg,
  CASE WHEN fr IS NOT NULL THEN 1 / fr ELSE 0e0 END AS rr FROM {p}nt LEFT JOIN {p}h USING (user_idx)),
{p}rm AS (SELECT coalesce({hr}, 0e0) AS hit_rate{s},
  coalesce(avg(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0e0 END), 0e0) AS ndcg{s},
  coalesce(avg({hits} / {k}), 0e0) AS precision{s}, coalesce(avg({hits} / n_true), 0e0) AS recall{s},
  coalesce(avg(rr), 0e0) AS mrr{s} FROM {p}pu)"""
