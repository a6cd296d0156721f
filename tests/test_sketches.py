"""Stored day sketches: incremental writes, merged reads, stated bounds."""

from pyspark.sql import functions as F

from orchard.operators import sketches as SK

Q = {"p50": 0.5, "p99": 0.99}


def test_merged_days_hold_the_bounds_and_a_rewritten_day_counts_once(spark, tmp_path):
    path = str(tmp_path / "store")
    rows = spark.range(60_000).selectExpr(
        "CAST(id % 6 AS INT) AS day", "IF(id % 3 = 0, 'hot', concat('g', id % 4)) AS g", "pmod(xxhash64(id), 9000) AS uid",
        "CAST(pmod(xxhash64(id, 1), 100000) AS DOUBLE) AS x")
    SK.update_sketches(rows.where("day < 4"), path, "day", ["g"], "uid", "x")
    SK.update_sketches(rows.where("day >= 3"), path, "day", ["g"], "uid", "x")  # day 3 again
    store = SK.load_sketches(spark, path)
    summary = SK.merged_summary(store, ["g"], Q)
    out = SK.outside_bounds(rows, summary, ["g"], "uid", "x", Q).collect()
    counts = {r.g: r.n for r in rows.groupBy("g").agg(F.count("*").alias("n")).collect()}
    assert {r.g: r.n_rows for r in out} == counts and all(r.n_outside == 0 for r in out)
    # a wrong estimate is seen
    wrong = summary.withColumn("p50", F.col("p99"))
    assert all(r.n_outside == 1 for r in SK.outside_bounds(rows, wrong, ["g"], "uid", "x", Q).collect())


def test_nulls_and_empty_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", None, None), (1, "b", 5, 2.0)], "day int, g string, uid long, x double")
    SK.update_sketches(rows, str(tmp_path / "s"), "day", ["g"], "uid", "x")
    got = {r.g: tuple(r)[1:] for r in SK.merged_summary(SK.load_sketches(spark, str(tmp_path / "s")), ["g"], Q).collect()}
    assert got == {"a": (1, 0, None, None), "b": (1, 1, 2.0, 2.0)}
    empty = SK.merged_summary(SK.day_sketches(rows.limit(0), "day", ["g"], "uid", "x"), ["g"], Q)
    assert empty.count() == 0
