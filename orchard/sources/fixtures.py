"""Input views over the driver's star-schema tables.

The driver's tables contain no customer-churn or retail event table, so these views
derive tables of the schema our jobs expect (see FIXTURES.md). They rename and reshape
columns, and the customer view sums up each customer's orders; none of the jobs' work
happens here.

Each view exists twice: as a DataFrame builder for Spark and as SQL text for the DuckDB
oracle (``DUCKDB_VIEWS``), so that every registered query can be checked side by side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _item_from_props(col: str = "props"):
    return F.regexp_extract(F.col(col), r"([0-9]+)", 1).cast("bigint")


def interactions_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event log in the retail schema: timestamp, visitorid, event, itemid, transactionid."""
    ev = table(spark, sf_dir, "events")
    et = F.col("event_type")
    return ev.select(
        "event_id",
        F.col("ts").alias("timestamp"),
        F.col("user_id").alias("visitorid"),
        _item_from_props().alias("itemid"),
        F.when(et == "view", "view").when(et == "click", "addtocart")
        .when(et == "purchase", "transaction").otherwise(et).alias("event"),
        F.when(et == "purchase", F.col("event_id")).alias("transactionid"),
    )


def customers_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer table in the churn schema (total_charges arrives as a string)."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    orders = table(spark, sf_dir, "orders")
    o = orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("f"), F.max("o_orderdate").alias("l"),
        F.max("o_totalprice").alias("mx"),
        F.sum(F.floor("o_totalprice").cast("bigint")).alias("tot"))
    last_order = orders.select(F.max("o_orderdate")).scalar()
    tenure_days = F.datediff(last_order.cast("date"), F.col("f").cast("date"))
    days_since_last = F.datediff(last_order.cast("date"), F.col("l").cast("date"))
    key = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    nk = F.col("c_nationkey")
    churn = days_since_last > 180
    return (c.join(n, n.n_nationkey == c.c_nationkey)
            .join(r, r.r_regionkey == n.n_regionkey)
            .join(o, o.o_custkey == c.c_custkey, "left")
            .select(
                F.concat(F.lit("C"), key.cast("string")).alias("customerid"),
                F.lit(1).alias("cnt"),
                F.col("n_name").alias("city"), F.col("r_name").alias("state"),
                F.col("n_nationkey").cast("double").alias("latitude"),
                (-F.col("n_regionkey")).cast("double").alias("longitude"),
                F.when(key % 2 == 0, "Male").otherwise("Female").alias("gender"),
                F.when(key % 8 == 0, "Yes").otherwise("No").alias("senior_citizen"),
                F.when(seg.isin("BUILDING", "HOUSEHOLD"), "Month-to-month")
                .when(seg == "AUTOMOBILE", "Two year").otherwise("One year").alias("contract"),
                F.when(nk % 3 == 0, "DSL").when(nk % 3 == 1, "Fiber optic")
                .otherwise("No").alias("internet_service"),
                F.when(nk % 4 == 0, "Electronic check").when(nk % 4 == 1, "Mailed check")
                .when(nk % 4 == 2, "Bank transfer (automatic)")
                .otherwise("Credit card (automatic)").alias("payment_method"),
                F.floor(tenure_days / 30).cast("int").alias("tenure_months"),
                (F.col("mx") / 1000e0).alias("monthly_charges"),
                F.when(tenure_days < 60, F.lit(" ")).otherwise(F.col("tot").cast("string"))
                .alias("total_charges"),
                F.when(churn, 1).otherwise(0).alias("churn_value"),
                F.when(churn, "Yes").otherwise("No").alias("churn_label"),
            ))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Binary predictions of two models: model, id, y_true, y_proba."""
    lab = table(spark, sf_dir, "labels")
    d, t = F.col("doc_id"), F.col("toxic")
    m1 = lab.select(F.lit("m1").alias("model"), d.alias("id"), t.alias("y_true"),
                    (((d * 7919) % 100 + 40 * t) / 140e0).alias("y_proba"))
    m2 = lab.select(F.lit("m2").alias("model"), d.alias("id"), t.alias("y_true"),
                    (((d * 104729) % 100 + 20 * t) / 120e0).alias("y_proba"))
    return m1.unionByName(m2)


def user_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.where(F.col("vec_id") % 5 == 0).select(
        F.col("vec_id").alias("user_idx"),
        F.col("embedding").cast("array<double>").alias("factors"),
        (F.col("label") / 10e0).alias("bias"))


def item_factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "embeddings")
    return e.where(F.col("vec_id") % 5 != 0).select(
        F.col("vec_id").alias("item_idx"),
        F.col("embedding").cast("array<double>").alias("factors"),
        (F.col("label") / 10e0).alias("bias"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Relevant (user_idx, item_idx) pairs: (31u + 17i) % 97 = 0.

    For a user u the matching items are i = 21u (mod 97) (21 = -31 * 17^-1 mod 97), so the
    pairs are generated per user and semi-joined with the item ids - no user x item product.
    Users are dealt by hash before their pairs are generated and the item ids (8 bytes each) are
    broadcast: rows arrive partitioned by user and are never shuffled.
    """
    users = user_factors(spark, sf_dir).select("user_idx")
    items = item_factors(spark, sf_dir).select("item_idx")
    max_item = items.select(F.max("item_idx")).scalar()
    start = (F.col("user_idx") * 21) % 97
    # as many partitions as a shuffle has: a given number is kept, user ids alone would be merged into one task
    dealt = users.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "user_idx")
    cand = dealt.select(
        "user_idx",
        F.explode(F.when(start <= max_item, F.sequence(start, max_item, F.lit(97).cast("bigint")))
                  .otherwise(F.array().cast("array<bigint>"))).alias("item_idx"))
    return cand.join(F.broadcast(items), "item_idx", "left_semi").select("user_idx", "item_idx")


def item_properties_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey").alias("itemid")
    return (p.select(k, F.lit("brand").alias("property"), F.col("p_brand").alias("value"))
            .unionByName(p.select(k, F.lit("categoryid").alias("property"), F.col("p_type").alias("value")))
            .unionByName(p.select(k, F.lit("790").alias("property"),
                                  F.col("p_size").cast("string").alias("value")))
            .unionByName(p.where(F.col("p_partkey") % 3 == 0).select(
                k, F.lit("available").alias("property"),
                F.when(F.col("p_size") > 25, "1").otherwise("0").alias("value"))))


def item_property_parts(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The property table split into its two part files (even / odd item ids)."""
    allp = item_properties_all(spark, sf_dir)
    return [allp.where(F.col("itemid") % 2 == 0), allp.where(F.col("itemid") % 2 == 1)]


def category_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    return (n.select((100 + F.col("n_nationkey")).alias("categoryid"), F.col("n_regionkey").alias("parentid"))
            .unionByName(r.select(F.col("r_regionkey").alias("categoryid"),
                                  F.lit(None).cast("int").alias("parentid"))))


def prediction_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "ts", F.floor(F.col("event_id") / 1000e0).cast("bigint").alias("batch_id"),
        F.col("event_id").alias("seq"), "user_id",
        _item_from_props().alias("item_id"),
        (F.col("value") / 500e0).alias("score"))


def requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scoring requests: one row per visitor with the distinct items it touched.

    user_id / item_ids are raw event ids; users and items without a factor row are the
    natural cold users and unknown items. k differs between requests, from 1 to 15.
    """
    ev = table(spark, sf_dir, "events")
    return (ev.select(F.col("user_id"), _item_from_props().alias("item_id"))
            .groupBy("user_id")
            .agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
            .select("user_id", "item_ids", (F.col("user_id") % 15 + 1).cast("int").alias("k")))


# ---------------------------------------------------------------------------
# DuckDB twins of the views above (oracle side only).
# ---------------------------------------------------------------------------

DUCKDB_VIEWS: dict[str, str] = {
    "interactions_raw": """
SELECT event_id, ts AS timestamp, user_id AS visitorid,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS itemid,
  CASE event_type WHEN 'view' THEN 'view' WHEN 'click' THEN 'addtocart'
    WHEN 'purchase' THEN 'transaction' ELSE event_type END AS event,
  CASE WHEN event_type = 'purchase' THEN event_id END AS transactionid
FROM events""",
    "customers_raw": """
SELECT concat('C', CAST(c.c_custkey AS VARCHAR)) AS customerid, 1 AS cnt,
  n.n_name AS city, r.r_name AS state, CAST(n.n_nationkey AS DOUBLE) AS latitude,
  CAST(-n.n_regionkey AS DOUBLE) AS longitude,
  CASE WHEN c.c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
  CASE WHEN c.c_custkey % 8 = 0 THEN 'Yes' ELSE 'No' END AS senior_citizen,
  CASE c.c_mktsegment WHEN 'BUILDING' THEN 'Month-to-month' WHEN 'HOUSEHOLD' THEN 'Month-to-month'
    WHEN 'AUTOMOBILE' THEN 'Two year' ELSE 'One year' END AS contract,
  CASE c.c_nationkey % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS internet_service,
  CASE c.c_nationkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
    WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS payment_method,
  CAST(floor(date_diff('day', o.f, g.m) / 30) AS INT) AS tenure_months,
  o.mx / 1000e0 AS monthly_charges,
  CASE WHEN date_diff('day', o.f, g.m) < 60 THEN ' ' ELSE CAST(o.tot AS VARCHAR) END AS total_charges,
  CASE WHEN date_diff('day', o.l, g.m) > 180 THEN 1 ELSE 0 END AS churn_value,
  CASE WHEN date_diff('day', o.l, g.m) > 180 THEN 'Yes' ELSE 'No' END AS churn_label
FROM customer c
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN region r ON r.r_regionkey = n.n_regionkey
LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS f, max(o_orderdate) AS l, max(o_totalprice) AS mx,
        sum(CAST(floor(o_totalprice) AS BIGINT)) AS tot FROM orders GROUP BY o_custkey) o
  ON o.o_custkey = c.c_custkey
CROSS JOIN (SELECT max(o_orderdate) AS m FROM orders) g""",
    "scored": """
SELECT 'm1' AS model, doc_id AS id, toxic AS y_true, ((doc_id * 7919) % 100 + 40 * toxic) / 140e0 AS y_proba FROM labels
UNION ALL
SELECT 'm2', doc_id, toxic, ((doc_id * 104729) % 100 + 20 * toxic) / 120e0 FROM labels""",
    "user_factors": """
SELECT vec_id AS user_idx, CAST(embedding AS DOUBLE[]) AS factors, label / 10e0 AS bias
FROM embeddings WHERE vec_id % 5 = 0""",
    "item_factors": """
SELECT vec_id AS item_idx, CAST(embedding AS DOUBLE[]) AS factors, label / 10e0 AS bias
FROM embeddings WHERE vec_id % 5 <> 0""",
    "truth": """
SELECT u.vec_id AS user_idx, i.vec_id AS item_idx FROM embeddings u CROSS JOIN embeddings i
WHERE u.vec_id % 5 = 0 AND i.vec_id % 5 <> 0 AND (u.vec_id * 31 + i.vec_id * 17) % 97 = 0""",
    "item_properties_all": """
SELECT p_partkey AS itemid, 'brand' AS property, p_brand AS value FROM part
UNION ALL SELECT p_partkey, 'categoryid', p_type FROM part
UNION ALL SELECT p_partkey, '790', CAST(p_size AS VARCHAR) FROM part
UNION ALL SELECT p_partkey, 'available', CASE WHEN p_size > 25 THEN '1' ELSE '0' END FROM part
  WHERE p_partkey % 3 = 0""",
    "category_tree": """
SELECT 100 + n_nationkey AS categoryid, n_regionkey AS parentid FROM nation
UNION ALL SELECT r_regionkey, CAST(NULL AS INT) FROM region""",
    "prediction_log": """
SELECT ts, CAST(floor(event_id / 1000e0) AS BIGINT) AS batch_id, event_id AS seq, user_id,
  CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS item_id, value / 500e0 AS score FROM events""",
    "requests": """
SELECT user_id, list_sort(list(DISTINCT CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT))) AS item_ids,
  CAST(user_id % 15 + 1 AS INT) AS k
FROM events GROUP BY user_id""",
}



def with_views(sql: str, *names: str) -> str:
    """Prefix ``sql`` with the DuckDB CTEs of the named fixture views."""
    if not names:
        return sql
    ctes = ",\n".join(f"{n} AS ({DUCKDB_VIEWS[n]}\n)" for n in names)
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
