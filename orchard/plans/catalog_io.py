"""Queries over readers and sinks: each writes a table under the shared folder and reads it back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from orchard.operators import clean as C
from orchard.operators import interactions as I
from orchard.operators import monitoring as MO
from orchard.plans.common import CUSTOMERS_CLEAN_CTE, customers_clean, round_doubles
from orchard.plans.registry import register
from orchard.session import ensure_checkpoint_dir
from orchard.sources import fixtures as fx
from orchard.sources import io


def _folder(spark, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/io-{name}-{uuid.uuid4().hex}"


def _events(spark, sf_dir):
    """The event log in the types of its CSV file: times as milliseconds."""
    return fx.interactions_raw(spark, sf_dir).select(
        F.unix_millis(F.col("timestamp").cast("timestamp")).alias("timestamp"), "visitorid", "event", "itemid",
        F.col("transactionid").cast("long").alias("transactionid"))


_EVENTS_SQL = """SELECT CAST(epoch_us(timestamp) // 1000 AS BIGINT) AS timestamp, visitorid, event, itemid,
  CAST(transactionid AS BIGINT) AS transactionid FROM interactions_raw"""


def _csv(df, path: str) -> str:
    df.write.option("header", True).csv(path)
    return path


@register("load_events_csv", fx.with_views(f"""WITH e AS ({_EVENTS_SQL})
SELECT *, CASE event WHEN 'view' THEN 1e0 WHEN 'addtocart' THEN 2e0 WHEN 'transaction' THEN 3e0 END AS weight FROM e""",
                                           "interactions_raw"))
def q_load_events_csv(spark, sf_dir):
    """The event log as a CSV file, read by the event loader with its schema and weights."""
    return io.load_events(spark, _csv(_events(spark, sf_dir), _folder(spark, "events")))


@register("load_customers_csv", fx.with_views("""SELECT customerid, gender, senior_citizen, contract, internet_service,
  payment_method, tenure_months, round(monthly_charges, 6) AS monthly_charges, total_charges, churn_value
FROM customers_raw""", "customers_raw"))
def q_load_customers_csv(spark, sf_dir):
    """The customer table as a CSV file, read with the customer schema."""
    df = fx.customers_raw(spark, sf_dir).select(*io.CUSTOMER_SCHEMA.names)
    path = _folder(spark, "customers")
    # blanks are values here: a missing charge stays one blank, not a null
    df.write.option("header", True).option("ignoreLeadingWhiteSpace", False).option(
        "ignoreTrailingWhiteSpace", False).csv(path)
    return round_doubles(io.load_customers(spark, path))


@register("ingest_tables", fx.with_views("""
SELECT itemid, property, value FROM item_properties_all""", "item_properties_all"))
def q_ingest_tables(spark, sf_dir):
    """Two property part files ingested as one typed catalog table, read back by name."""
    folder = _folder(spark, "ingest")
    parts = [_csv(p, f"{folder}/part{k}") for k, p in enumerate(fx.item_property_parts(spark, sf_dir))]
    name = f"io_{uuid.uuid4().hex}"
    table, = io.ingest_tables(spark, {name: parts}, "default")
    return io.extract_table(spark, table).select(F.col("itemid").cast("long").alias("itemid"), "property", "value")


@register("ingest_new_files", fx.with_views("""
SELECT property, count_if(TRY_CAST(value AS DOUBLE) IS NOT NULL) AS n_rows, count_if(TRY_CAST(value AS DOUBLE) IS NULL) AS n_rejected,
  sum(TRY_CAST(value AS DOUBLE)) AS total FROM item_properties_all GROUP BY property""", "item_properties_all"))
def q_ingest_new_files(spark, sf_dir):
    """The property part files as numbers, one run per part: a run loads only the files that are new, other values are rejects."""
    folder = _folder(spark, "ingest-new")
    for k, part in enumerate(fx.item_property_parts(spark, sf_dir)):
        _csv(part, f"{folder}/files/part{k}")
        io.ingest_new_files(spark, f"{folder}/files/*", "itemid bigint, property string, value double",
                            f"{folder}/table", f"{folder}/checkpoint")
    lines = io.load_ingested(spark, f"{folder}/table")
    return lines.groupBy("property").agg(F.count_if(~F.col("rejected")).alias("n_rows"),
                                         F.count_if("rejected").alias("n_rejected"), F.sum("value").alias("total"))


@register("extract_query", fx.with_views("""
SELECT event, CAST(count(*) AS BIGINT) AS n FROM interactions_raw GROUP BY event""", "interactions_raw"))
def q_extract_query(spark, sf_dir):
    """A grouped SQL query over the event log, extracted to CSV and read back."""
    view = f"io_{uuid.uuid4().hex}"
    fx.interactions_raw(spark, sf_dir).createOrReplaceTempView(view)
    dest = io.extract_query(spark, f"SELECT event, count(*) AS n FROM {view} GROUP BY event", _folder(spark, "extract"))
    return spark.read.option("header", True).schema("event string, n long").csv(dest)


@register("save_load_processed", fx.with_views("""
WITH u AS (SELECT visitorid, row_number() OVER (ORDER BY visitorid) - 1 AS user_idx FROM (SELECT DISTINCT visitorid FROM interactions_raw)),
i AS (SELECT itemid, row_number() OVER (ORDER BY itemid) - 1 AS item_idx FROM (SELECT DISTINCT itemid FROM interactions_raw)),
p AS (SELECT itemid, CAST(count(*) AS DOUBLE) AS s FROM interactions_raw GROUP BY itemid)
SELECT e.event_id, u.user_idx, i.item_idx, round(p.s / (SELECT max(s) FROM p), 6) AS popularity
FROM interactions_raw e JOIN u USING (visitorid) JOIN i USING (itemid) JOIN p USING (itemid)""", "interactions_raw"))
def q_save_load_processed(spark, sf_dir):
    """The four preprocessing tables written, read back and joined."""
    inter, users, items = I.process(fx.interactions_raw(spark, sf_dir), "implicit")
    base = _folder(spark, "processed")
    io.save_processed(base, inter.select("event_id", "user_idx", "item_idx"), users, items,
                      I.popular_items(inter, item_col="item_idx"))
    t = io.load_processed(spark, base)
    return round_doubles(t["interactions"].join(t["popularity"], "item_idx").select(
        "event_id", "user_idx", "item_idx", "popularity"))


@register("save_clean_customers", fx.with_views(f"""WITH {CUSTOMERS_CLEAN_CTE}
SELECT customerid, total_charges FROM customers_clean""", "customers_raw"))
def q_save_clean_customers(spark, sf_dir):
    """The cleaned customer table written as Parquet and read back, names normalised."""
    messy = customers_clean(spark, sf_dir).select(F.col("customerid").alias(" Customerid "),
                                                  F.col("total_charges").alias("Total Charges"))
    path = io.save_clean_customers(C.normalize_columns(messy), _folder(spark, "clean"))
    return io.load_customers(spark, path, "parquet")


@register("append_run_metrics", fx.with_views("""
SELECT event AS run, 'n' AS metric, CAST(2 * count(*) AS DOUBLE) AS total FROM interactions_raw GROUP BY event""",
                                              "interactions_raw"))
def q_append_run_metrics(spark, sf_dir):
    """Per-event counts appended to a run table twice, then summed."""
    rows = fx.interactions_raw(spark, sf_dir).groupBy(F.col("event").alias("run")).agg(
        F.count(F.lit(1)).cast("double").alias("value")).withColumn("metric", F.lit("n"))
    dest = _folder(spark, "runs")
    for _ in range(2):
        io.append_run_metrics(rows, dest)
    return spark.read.parquet(dest).groupBy("run", "metric").agg(F.sum("value").alias("total"))


@register("record_predictions", fx.with_views("""
SELECT CAST(batch_id % 4 AS BIGINT) AS batch_id, CAST(count(*) AS BIGINT) AS n, round(avg(score), 6) AS mean,
  CAST(count(*) AS BIGINT) AS n_seq FROM prediction_log GROUP BY batch_id % 4""", "prediction_log"))
def q_record_predictions(spark, sf_dir):
    """Scores recorded batch by batch in a partitioned log; rows, mean and distinct seq of each batch."""
    scores = fx.prediction_log(spark, sf_dir).select("user_id", "item_id", "score", (F.col("batch_id") % 4).alias("batch_id"))
    log = spark.read.parquet(MO.record_predictions(scores, _folder(spark, "log")))
    return round_doubles(log.groupBy(F.col("batch_id").cast("long").alias("batch_id")).agg(
        F.count(F.lit(1)).alias("n"), F.avg("score").alias("mean"), F.count_distinct("seq").alias("n_seq")))


_LINE = ("l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax l_returnflag l_linestatus "
         "l_shipdate").split()  # the SQL's columns; the query reads them from the table


@register("feature_types", """WITH n AS ({})
SELECT d.column_name AS "column", CASE WHEN d.column_type = 'VARCHAR' THEN 'categorical' ELSE 'numeric' END AS kind, n.n_missing,
  n.n_values FROM (DESCRIBE lineitem) d JOIN n USING (column_name)
WHERE d.column_type IN ('VARCHAR', 'DOUBLE', 'FLOAT', 'BIGINT', 'INTEGER', 'SMALLINT', 'TINYINT') OR d.column_type LIKE 'DECIMAL%'""".format(
    " UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_missing, count(DISTINCT {c}) AS n_values FROM lineitem"
                       for c in _LINE)))
def q_feature_types(spark, sf_dir):
    """Kind of each feature column of a table with text, whole and floating numbers and times (times are no
    features), with its missing and distinct values."""
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    cat, num = C.feature_types(df)
    kinds = {**dict.fromkeys(cat, "categorical"), **dict.fromkeys(num, "numeric")}
    one = df.agg(*[F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.count_if(F.col(c).isNull()).alias("n_missing"),
                            F.count_distinct(c).alias("n_values")).alias(c) for c, k in kinds.items()])
    return one.select(F.inline(F.array(*[F.col(c) for c in kinds])))
