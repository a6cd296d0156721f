"""Readers and sinks: event CSV, part files, export with skip, ingest with prefix, artifacts."""

import os

import pytest
from pyspark.sql import functions as F

from orchard.sources import io


def test_load_events_csv(spark, tmp_path):
    p = tmp_path / "events.csv"
    p.write_text("timestamp,visitorid,event,itemid,transactionid\n1,1,view,10,\n2,1,addtocart,10,\n"
                 "3,2,transaction,20,7\n")
    ws = [r.weight for r in io.load_events(spark, str(p)).orderBy("timestamp").collect()]
    assert ws == [1.0, 2.0, 3.0]


def test_combine_parts_and_missing(spark, tmp_path):
    a, b = tmp_path / "p1.csv", tmp_path / "p2.csv"
    a.write_text("item_id,item_property\n1,A\n")
    b.write_text("item_id,item_property\n2,B\n")
    df = io.combine_parts([str(a), str(b)], spark)
    assert sorted((r.item_id, r.item_property) for r in df.collect()) == [("1", "A"), ("2", "B")]
    with pytest.raises(FileNotFoundError):
        io.combine_parts([str(a), str(tmp_path / "nope.csv")], spark)


def test_extract_query_skips_existing(spark, tmp_path):
    spark.createDataFrame([(1, 100), (2, 101)], "event_id int, user_id int").createOrReplaceTempView("ev_t")
    dest = str(tmp_path / "out")
    io.extract_query(spark, "SELECT * FROM ev_t", dest)
    first = sorted(tuple(r) for r in spark.read.option("header", True).csv(dest).collect())
    assert first == [("1", "100"), ("2", "101")]
    spark.createDataFrame([(3, 102)], "event_id int, user_id int").createOrReplaceTempView("ev_t")
    io.extract_query(spark, "SELECT * FROM ev_t", dest)  # existing output is kept
    assert sorted(tuple(r) for r in spark.read.option("header", True).csv(dest).collect()) == first
    io.extract_query(spark, "SELECT * FROM ev_t", dest, force=True)
    assert [tuple(r) for r in spark.read.option("header", True).csv(dest).collect()] == [("3", "102")]


def test_collect_sources_prefix(tmp_path):
    s = io.collect_sources(str(tmp_path), prefix="raw_")
    assert set(s) == {"raw_events", "raw_item_properties", "raw_category_tree"}
    assert len(s["raw_item_properties"]) == 2


def test_processed_roundtrip_and_missing(spark, tmp_path):
    df = spark.createDataFrame([(1, 0)], "visitorid long, user_idx long")
    base = str(tmp_path / "proc")
    io.save_processed(base, df, df, df, df)
    got = io.load_processed(spark, base)
    assert got["user_index"].first().user_idx == 0
    with pytest.raises(FileNotFoundError):
        io.load_processed(spark, str(tmp_path / "none"))


def test_export_samples_partitioned(spark, tmp_path):
    df = spark.createDataFrame([(0, 1, 1.0, "train"), (1, 2, 0.0, "validation")],
                               "user_idx long, item_idx long, label double, split string")
    dest = io.export_samples(df, str(tmp_path / "s"))
    assert {d for d in os.listdir(dest) if d.startswith("split=")} == {"split=train", "split=validation"}


def test_load_customers_and_save_clean(spark, tmp_path):
    p = tmp_path / "c.csv"
    p.write_text("customerid,gender,senior_citizen,contract,internet_service,payment_method,tenure_months,"
                 "monthly_charges,total_charges,churn_value\nA,Male,No,One year,DSL,Mailed check,0,20.5, ,1\n")
    df = io.load_customers(spark, str(p))
    r = df.first()
    assert r.tenure_months == 0 and r.monthly_charges == 20.5 and r.total_charges == " "
    dest = io.save_clean_customers(df, str(tmp_path / "clean"))
    assert io.load_customers(spark, dest, fmt="parquet").count() == 1


def test_ingest_tables_with_prefix(spark, tmp_path):
    (tmp_path / "events.csv").write_text("timestamp,visitorid,event,itemid,transactionid\n1,1,view,10,\n")
    (tmp_path / "item_properties_part1.csv").write_text("itemid,property,value\n1,a,x\n")
    (tmp_path / "item_properties_part2.csv").write_text("itemid,property,value\n2,b,y\n")
    (tmp_path / "category_tree.csv").write_text("categoryid,parentid\n1,\n")
    names = io.ingest_tables(spark, io.collect_sources(str(tmp_path)), "retail_db", prefix="raw_")
    assert names == ["retail_db.raw_events", "retail_db.raw_item_properties", "retail_db.raw_category_tree"]
    assert io.extract_table(spark, "retail_db.raw_item_properties").count() == 2


def test_append_run_metrics(spark, tmp_path):
    m = spark.createDataFrame([("r1", 1, "loss", 0.5)], "run string, epoch int, metric string, value double")
    dest = str(tmp_path / "runs")
    io.append_run_metrics(m, dest)
    io.append_run_metrics(m, dest)
    assert spark.read.parquet(dest).count() == 2


def test_record_predictions_appends(spark, tmp_path):
    from orchard.operators.monitoring import record_predictions
    s = spark.createDataFrame([(1, 10, 0.3)], "user_id long, item_id long, score double")
    dest = str(tmp_path / "log")
    record_predictions(s, dest, batch_id=0)
    record_predictions(s, dest, batch_id=1)
    got = spark.read.parquet(dest)
    assert got.count() == 2 and {r.batch_id for r in got.collect()} == {0, 1} and "ts" in got.columns


def test_normalize_columns_and_feature_types(spark):
    from orchard.operators import clean as C
    df = spark.createDataFrame([("x", 1, 2.0)], "`Customer ID` string, ` Tenure Months ` int, `Monthly Charges` double")
    out = C.normalize_columns(df)
    assert out.columns == ["customer_id", "tenure_months", "monthly_charges"]
    cat, num = C.feature_types(out)
    assert cat == ["customer_id"] and num == ["tenure_months", "monthly_charges"]


def test_coerce_numeric_rules(spark):
    from orchard.operators import clean as C
    vals = ["12", "abc", " 7 ", "nan", "inf", "n5.000", "1e3", "5d", "", None]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [r.s for r in C.coerce_numeric(df, "s", fill=None).collect()]
    assert got[:9] == [12.0, None, 7.0, None, float("inf"), None, 1000.0, None, None]
    bad = {r.value for r in C.bad_numeric_values(df, "s").collect()}
    assert bad == {"abc", "nan", "n5.000", "5d", ""}


def test_preprocess_job_bucketed_join_has_no_shuffle(spark):
    from orchard.plans.jobs import preprocess_job
    from orchard.sources import fixtures as fx
    events = fx.interactions_raw(spark, "/root/testdata/sf0.001")
    t = preprocess_job(spark, events, "proc_db", "weighted", n_buckets=4)
    inter, users = spark.table(t["interactions"]), spark.table(t["user_index"])
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the bucketed sort-merge join
    try:
        joined = inter.join(users, "user_idx")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "hashpartitioning" not in plan
        assert joined.count() == inter.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert spark.table(t["popularity"]).count() == spark.table(t["item_index"]).count()


def test_evaluate_churn_monitor_jobs(spark, tmp_path):
    from pyspark.sql import functions as F

    from orchard.plans.common import customers_clean
    from orchard.plans.jobs import churn_job, evaluate_job, monitor_job, preprocess_job
    from orchard.sources import fixtures as fx
    sf = "/root/testdata/sf0.001"
    t = preprocess_job(spark, fx.interactions_raw(spark, sf), "eval_db", "weighted", n_buckets=4)
    runs = evaluate_job(spark, t, str(tmp_path / "runs"))
    assert {r.run for r in runs.collect()} == {"popularity_weighted", "mf_weighted"}
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 10
    cust = customers_clean(spark, sf).withColumn("cid", F.substring("customerid", 2, 20).cast("long"))
    out = churn_job(spark, cust)
    m = out["metrics"].first()
    assert 0.0 <= m.roc_auc <= 1.0 and out["sweep"].count() == 18 and out["best_threshold"].count() == 1
    checks = monitor_job(spark, fx.prediction_log(spark, sf), 0, str(tmp_path / "checks"), window=100)
    assert {r.shift_type for r in checks.collect()} == {"model_drift", "data_shift"}


def test_ingest_new_files_loads_each_file_once(spark, tmp_path):
    files, table, ckpt = tmp_path / "files", str(tmp_path / "table"), str(tmp_path / "ckpt")
    files.mkdir()

    def run():
        io.ingest_new_files(spark, str(files), "id bigint, name string, price double", table, ckpt)
        return sorted((r.id, r.name, r.price, r.rejected_line) for r in io.load_ingested(spark, table).collect())

    (files / "a.csv").write_text("id,name,price\n1,x,2.5\n2,,\n3,y,dear\n")
    first = [(1, "x", 2.5, None), (2, None, None, None), (3, "y", None, "3,y,dear")]
    assert run() == first
    assert run() == first  # nothing new
    (files / "b.csv").write_text("id,name,price\n4,z,1\n")
    assert run() == [*first, (4, "z", 1.0, None)]
    lines = io.load_ingested(spark, table)
    assert {r.source_file.rsplit("/", 1)[1]: r.n for r in lines.groupBy("source_file").agg(F.count("*").alias("n")).collect()} == {
        "a.csv": 3, "b.csv": 1}
    with pytest.raises(ValueError):
        io.load_ingested(spark, str(tmp_path / "none"))
