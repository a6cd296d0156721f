"""Queries: cleaning checks and table profiling (customers, events, item catalog)."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.operators import clean as C
from orchard.operators import profile as P
from orchard.plans.common import CUSTOMERS_CLEAN_CTE, customers_clean, r, round_doubles, sql_parse
from orchard.plans.registry import register
from orchard.sources import fixtures as fx

NUMERIC = ["tenure_months", "monthly_charges", "total_charges"]
CITY_MIN_N = 60  # keeps a subset of cities at sf0.01 (minimum there is 43)


def _cust(sql: str) -> str:
    body = sql.strip()
    if body.upper().startswith("WITH "):
        body = f"WITH {CUSTOMERS_CLEAN_CTE},\n{body[5:]}"
    else:
        body = f"WITH {CUSTOMERS_CLEAN_CTE}\n{body}"
    return fx.with_views(body, "customers_raw")


# --- B: cleaning -------------------------------------------------------------------------

@register("coerce_numeric", _cust("SELECT customerid, total_charges FROM customers_clean"))
def q_coerce(spark, sf_dir):
    return customers_clean(spark, sf_dir).select("customerid", "total_charges")


@register("coercion_report", fx.with_views(f"""
SELECT count_if(total_charges IS NULL) AS nulls_before,
       count_if(({sql_parse('total_charges')}) IS NULL) AS nulls_after_coerce,
       count_if(coalesce({sql_parse('total_charges')}, 0e0) IS NULL) AS nulls_after_fill
FROM customers_raw""", "customers_raw"))
def q_coercion_report(spark, sf_dir):
    return C.coercion_report(fx.customers_raw(spark, sf_dir), "total_charges")


@register("bad_numeric_values", fx.with_views(f"""
SELECT total_charges AS value, count(*) AS n FROM customers_raw
WHERE total_charges IS NOT NULL AND ({sql_parse('total_charges')}) IS NULL GROUP BY total_charges""",
                                              "customers_raw"))
def q_bad_numeric(spark, sf_dir):
    return C.bad_numeric_values(fx.customers_raw(spark, sf_dir), "total_charges")


@register("zero_tenure_audit", fx.with_views(f"""
SELECT count_if(tenure_months = 0) AS n_zero_tenure,
       count_if(tenure_months = 0 AND ({sql_parse('total_charges')}) IS NULL) AS n_zero_tenure_null_charges
FROM customers_raw""", "customers_raw"))
def q_zero_tenure(spark, sf_dir):
    return C.zero_tenure_audit(fx.customers_raw(spark, sf_dir))


@register("select_features", _cust("""
SELECT gender, senior_citizen, contract, internet_service, payment_method, tenure_months,
       monthly_charges, total_charges, churn_value AS label FROM customers_clean"""))
def q_select_features(spark, sf_dir):
    return C.select_features(customers_clean(spark, sf_dir))


@register("schema_checks", _cust("""
SELECT customerid,
  list_filter([CASE WHEN tenure_months IS NULL THEN 'missing tenure_months' END,
               CASE WHEN monthly_charges IS NULL THEN 'missing monthly_charges' END,
               CASE WHEN contract IS NULL THEN 'missing contract' END,
               CASE WHEN NOT coalesce(tenure_months >= 0, false) THEN 'tenure_months>=0' END,
               CASE WHEN NOT coalesce(monthly_charges > 0, false) THEN 'monthly_charges>0' END,
               CASE WHEN NOT coalesce(total_charges > 0, false) THEN 'total_charges>0' END],
              lambda x: x IS NOT NULL) AS reject_reasons
FROM customers_clean"""))
def q_schema_checks(spark, sf_dir):
    df = C.schema_checks(customers_clean(spark, sf_dir), ["tenure_months", "monthly_charges", "contract"],
                         {"tenure_months>=0": F.col("tenure_months") >= 0,
                          "monthly_charges>0": F.col("monthly_charges") > 0,
                          "total_charges>0": F.col("total_charges") > 0})
    return df.select("customerid", "reject_reasons")


@register("non_numeric_properties", fx.with_views("""
SELECT property, count(*) AS n FROM item_properties_all
WHERE NOT regexp_matches(property, '^[0-9]+$') GROUP BY property""", "item_properties_all"))
def q_non_numeric_props(spark, sf_dir):
    return C.non_numeric_properties(fx.item_properties_all(spark, sf_dir))


@register("predict_class", fx.with_views("""
SELECT model, id, CAST(y_proba > 0.5 AS INT) AS y_pred FROM scored""", "scored"))
def q_predict_class(spark, sf_dir):
    return C.predict_class(fx.scored(spark, sf_dir), 0.5).select("model", "id", "y_pred")


@register("combine_parts", fx.with_views("""
SELECT * FROM item_properties_all WHERE itemid % 2 = 0
UNION ALL SELECT * FROM item_properties_all WHERE itemid % 2 = 1""", "item_properties_all"))
def q_combine_parts(spark, sf_dir):
    from orchard.sources.io import combine_parts
    return combine_parts(fx.item_property_parts(spark, sf_dir))


# --- D: profiling ------------------------------------------------------------------------

@register("missing_counts", fx.with_views(f"""
WITH c AS (SELECT * REPLACE (({sql_parse('total_charges')}) AS total_charges) FROM customers_raw)
UNPIVOT (SELECT {', '.join(f"count_if({c} IS NULL) AS {c}" for c in [
    'customerid', 'cnt', 'city', 'state', 'latitude', 'longitude', 'gender', 'senior_citizen', 'contract',
    'internet_service', 'payment_method', 'tenure_months', 'monthly_charges', 'total_charges', 'churn_value',
    'churn_label'])} FROM c)
ON COLUMNS(*) INTO NAME "column" VALUE n_missing""", "customers_raw"))
def q_missing_counts(spark, sf_dir):
    df = C.coerce_numeric(fx.customers_raw(spark, sf_dir), "total_charges", fill=None)
    return P.missing_counts(df)


@register("table_shape", fx.with_views("SELECT count(*) AS n_rows, CAST(16 AS BIGINT) AS n_columns FROM customers_raw",
                                       "customers_raw"))
def q_table_shape(spark, sf_dir):
    return P.table_shape(fx.customers_raw(spark, sf_dir))


_DESCRIBE_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, count({c}) AS count, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')},
  {r(f'min({c})', 'min')}, {r(f'quantile_cont({c}, 0.25)', 'p25')}, {r(f'quantile_cont({c}, 0.5)', 'p50')},
  {r(f'quantile_cont({c}, 0.75)', 'p75')}, {r(f'max({c})', 'max')}
FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM customers_clean)""" for c in NUMERIC)


@register("describe_numeric", _cust(_DESCRIBE_SQL))
def q_describe(spark, sf_dir):
    return round_doubles(P.describe_numeric(customers_clean(spark, sf_dir), NUMERIC))


@register("key_numeric_stats", _cust("\nUNION ALL\n".join(
    f"""SELECT '{c}' AS column, {r(f'avg({c})', 'mean')}, {r(f'quantile_cont({c}, 0.5)', 'median')},
  {r(f'stddev_samp({c})', 'std')}, {r(f'min({c})', 'min')}, {r(f'max({c})', 'max')}
FROM (SELECT CAST({c} AS DOUBLE) AS {c} FROM customers_clean)""" for c in NUMERIC)))
def q_key_stats(spark, sf_dir):
    return round_doubles(P.key_numeric_stats(customers_clean(spark, sf_dir), NUMERIC))


@register("target_distribution", fx.with_views("""
SELECT churn_label, count(*) AS count, count(*) * 100e0 / (SELECT count(*) FROM customers_raw) AS percent
FROM customers_raw GROUP BY churn_label""", "customers_raw"))
def q_target_dist(spark, sf_dir):
    return P.target_distribution(fx.customers_raw(spark, sf_dir), "churn_label")


@register("imbalance_ratio", fx.with_views("""
SELECT count(*) AS n, count_if(churn_label = 'Yes') AS n_pos, count_if(churn_label <> 'Yes') AS n_neg,
  greatest(count_if(churn_label = 'Yes'), count_if(churn_label <> 'Yes'))
    / least(count_if(churn_label = 'Yes'), count_if(churn_label <> 'Yes')) AS imbalance_ratio,
  count_if(churn_label = 'Yes') * 100e0 / count(*) AS pos_percent
FROM customers_raw""", "customers_raw"))
def q_imbalance(spark, sf_dir):
    return P.imbalance_ratio(fx.customers_raw(spark, sf_dir), "churn_label")


@register("crosstab_counts", fx.with_views("""
SELECT contract, count_if(churn_label = 'No') AS count_no, count_if(churn_label = 'Yes') AS count_yes
FROM customers_raw GROUP BY contract""", "customers_raw"))
def q_crosstab_counts(spark, sf_dir):
    return P.crosstab_counts(fx.customers_raw(spark, sf_dir), "contract", "churn_label")


def _rate_sql(dim):
    return fx.with_views(f"""
SELECT {dim}, round(count_if(churn_label = 'No') * 100e0 / count(*), 2) AS pct_no,
       round(count_if(churn_label = 'Yes') * 100e0 / count(*), 2) AS pct_yes
FROM customers_raw GROUP BY {dim}""", "customers_raw")


for _dim, _key in [("contract", "crosstab_rate_contract"), ("internet_service", "crosstab_rate_internet"),
                   ("payment_method", "crosstab_rate_payment")]:
    register(_key, _rate_sql(_dim))(
        lambda spark, sf_dir, _d=_dim: P.crosstab_rate(fx.customers_raw(spark, sf_dir), _d, "churn_label"))

_CITY_SQL = f"""
city_rates AS (SELECT city, count_if(churn_label = 'Yes') AS churn_count, count(customerid) AS total_customers,
    round(count_if(churn_label = 'Yes') * 100e0 / count(customerid), 2) AS churn_rate
  FROM customers_raw GROUP BY city HAVING count(customerid) >= {CITY_MIN_N})"""


def _city_rates(spark, sf_dir):
    return P.group_churn_rate(fx.customers_raw(spark, sf_dir), "city", min_n=CITY_MIN_N)


register("city_churn_rate", fx.with_views(f"WITH {_CITY_SQL} SELECT * FROM city_rates", "customers_raw"))(
    _city_rates)


@register("top_bottom_groups", fx.with_views(f"""
WITH {_CITY_SQL}
SELECT * FROM (SELECT 'top' AS side, row_number() OVER (ORDER BY churn_rate DESC, city ASC) AS rank, *
               FROM city_rates) WHERE rank <= 20
UNION ALL
SELECT * FROM (SELECT 'bottom' AS side, row_number() OVER (ORDER BY churn_rate ASC, city DESC) AS rank, *
               FROM city_rates) WHERE rank <= 15""", "customers_raw"))
def q_top_bottom(spark, sf_dir):
    return P.top_bottom_groups(_city_rates(spark, sf_dir), "city")


@register("group_rate_summary", fx.with_views(f"""
WITH {_CITY_SQL}
SELECT count(*) AS n_groups, max(churn_rate) AS max_rate, min(churn_rate) AS min_rate,
       max(churn_rate) - min(churn_rate) AS spread, {r('avg(churn_rate)', 'mean_rate')} FROM city_rates""",
                                              "customers_raw"))
def q_group_rate_summary(spark, sf_dir):
    return round_doubles(P.group_rate_summary(_city_rates(spark, sf_dir)))


@register("geo_summary", fx.with_views("""
SELECT count(DISTINCT state) AS n_states, count(DISTINCT city) AS n_cities, min(latitude) AS min_latitude,
  max(latitude) AS max_latitude, min(longitude) AS min_longitude, max(longitude) AS max_longitude
FROM customers_raw""", "customers_raw"))
def q_geo(spark, sf_dir):
    return P.geo_summary(fx.customers_raw(spark, sf_dir))


@register("top_states", fx.with_views("""
SELECT state, count(*) AS count FROM customers_raw GROUP BY state ORDER BY count DESC, state LIMIT 10""",
                                      "customers_raw"))
def q_top_states(spark, sf_dir):
    return P.value_counts_top(fx.customers_raw(spark, sf_dir), "state", 10)


@register("group_mean_std", _cust("\nUNION ALL\n".join(
    f"SELECT churn_label, '{c}' AS column, {r(f'avg({c})', 'mean')}, {r(f'stddev_samp({c})', 'std')} "
    f"FROM customers_clean GROUP BY churn_label" for c in NUMERIC)))
def q_group_mean_std(spark, sf_dir):
    return round_doubles(P.group_mean_std(customers_clean(spark, sf_dir), "churn_label", NUMERIC))


_CORR_COLS = ["latitude", "longitude", "tenure_months", "monthly_charges", "total_charges"]


def _corr_sql():
    parts = []
    for i, a in enumerate(_CORR_COLS):
        for b in _CORR_COLS[i + 1:]:
            parts.append(f"SELECT '{a}' AS col_a, '{b}' AS col_b, {r(f'corr({a}, {b})', 'corr')} FROM customers_clean")
            parts.append(f"SELECT '{b}', '{a}', {r(f'corr({a}, {b})', 'corr')} FROM customers_clean")
    for c in _CORR_COLS:
        parts.append(f"SELECT '{c}', '{c}', 1e0")
    return _cust("\nUNION ALL\n".join(parts))


@register("correlation_matrix", _corr_sql())
def q_corr(spark, sf_dir):
    return round_doubles(P.correlation_matrix(customers_clean(spark, sf_dir), _CORR_COLS))


@register("target_correlation", _cust("\nUNION ALL\n".join(
    f"SELECT '{c}' AS column, {r(f'corr({c}, churn_value)', 'corr')} FROM customers_clean" for c in NUMERIC)))
def q_target_corr(spark, sf_dir):
    return round_doubles(P.target_correlation(customers_clean(spark, sf_dir), NUMERIC, "churn_value"))


@register("histogram", fx.with_views("""
WITH lim AS (SELECT min(monthly_charges) AS lo, max(monthly_charges) AS hi FROM customers_raw),
b AS (SELECT CAST(CASE WHEN hi > lo THEN least(floor((monthly_charges - lo) / (hi - lo) * 30), 29) ELSE 0 END AS INT)
        AS bin FROM customers_raw, lim WHERE monthly_charges IS NOT NULL),
c AS (SELECT bin, count(*) AS count FROM b GROUP BY bin)
SELECT s.bin, round(lo + s.bin * (hi - lo) / 30, 6) AS lower, round(lo + (s.bin + 1) * (hi - lo) / 30, 6) AS upper,
       coalesce(c.count, 0) AS count
FROM (SELECT CAST(range AS INT) AS bin FROM range(30)) s CROSS JOIN lim LEFT JOIN c ON c.bin = s.bin""",
                                     "customers_raw"))
def q_histogram(spark, sf_dir):
    return round_doubles(P.histogram(fx.customers_raw(spark, sf_dir), "monthly_charges", 30))


@register("box_stats", fx.with_views("""
WITH q AS (SELECT churn_label, quantile_cont(monthly_charges, 0.25) AS q1, quantile_cont(monthly_charges, 0.5) AS median,
             quantile_cont(monthly_charges, 0.75) AS q3 FROM customers_raw GROUP BY churn_label),
j AS (SELECT c.churn_label, c.monthly_charges AS x, q.q1, q.median, q.q3, q.q3 - q.q1 AS iqr FROM customers_raw c
      JOIN q USING (churn_label))
SELECT churn_label, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
  round(min(CASE WHEN x >= q1 - 1.5 * iqr AND x <= q3 + 1.5 * iqr THEN x END), 6) AS whisker_low,
  round(max(CASE WHEN x >= q1 - 1.5 * iqr AND x <= q3 + 1.5 * iqr THEN x END), 6) AS whisker_high,
  count_if(NOT (x >= q1 - 1.5 * iqr AND x <= q3 + 1.5 * iqr)) AS n_outliers
FROM j GROUP BY churn_label, q1, median, q3, iqr""", "customers_raw"))
def q_box(spark, sf_dir):
    return round_doubles(P.box_stats(fx.customers_raw(spark, sf_dir), "monthly_charges", "churn_label"))


@register("event_type_counts", fx.with_views("""
SELECT event, count(*) AS count FROM interactions_raw GROUP BY event""", "interactions_raw"))
def q_event_types(spark, sf_dir):
    return P.value_counts_top(fx.interactions_raw(spark, sf_dir), "event")


@register("property_counts", fx.with_views("""
SELECT property, count(*) AS count FROM item_properties_all GROUP BY property""", "item_properties_all"))
def q_property_counts(spark, sf_dir):
    return P.value_counts_top(fx.item_properties_all(spark, sf_dir), "property")


@register("top_parents", fx.with_views("""
SELECT parentid, count(categoryid) AS n_children FROM category_tree WHERE parentid IS NOT NULL
GROUP BY parentid ORDER BY n_children DESC, parentid LIMIT 10""", "category_tree"))
def q_top_parents(spark, sf_dir):
    return P.top_parents(fx.category_tree(spark, sf_dir))


@register("event_summary", fx.with_views("""
SELECT count(*) AS n_events, count(DISTINCT visitorid) AS n_users FROM interactions_raw""", "interactions_raw"))
def q_event_summary(spark, sf_dir):
    return P.event_summary(fx.interactions_raw(spark, sf_dir))


@register("property_summary", fx.with_views("""
SELECT count(*) AS n_rows, count(DISTINCT itemid) AS n_items FROM item_properties_all""", "item_properties_all"))
def q_property_summary(spark, sf_dir):
    return P.property_summary(fx.item_properties_all(spark, sf_dir))


@register("distinct_sample", _cust("""
SELECT DISTINCT total_charges FROM customers_clean ORDER BY total_charges LIMIT 10"""))
def q_distinct_sample(spark, sf_dir):
    return P.distinct_sample(customers_clean(spark, sf_dir), "total_charges", 10)
