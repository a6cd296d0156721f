"""Factor joins in cells: as two plain joins, and no shuffle of rows that hold factors."""

import re

import pytest
from pyspark.sql import functions as F

from orchard.operators import classification as M
from orchard.operators import recommend as R
from orchard.plans import catalog_models as CM
from orchard.plans import catalog_recommend as CR
from orchard.sources import fixtures as fx


def _tables(spark):
    users = spark.createDataFrame([(u, [float(u), 1.0]) for u in range(30)] + [(3, [9.0, 9.0]), (4, None), (None, [1.0, 1.0])],
                                  "user_idx long, p array<double>")
    items = spark.createDataFrame([(i, [0.5, float(i)]) for i in range(40)] + [(7, [2.0, 2.0])], "item_idx long, q array<double>")
    pairs = spark.createDataFrame([(u, i, u * i) for u in range(35) for i in range(0, 45, 3)] + [(3, 7, 1)] * 5
                                  + [(None, 7, 2), (3, None, 3), (None, None, 4)], "user_idx int, item_idx long, n int")
    return pairs, users, items


@pytest.mark.parametrize("how", ["inner", "left"])
def test_cells_join_like_two_plain_joins(spark, how):
    pairs, users, items = _tables(spark)
    plain = pairs.join(users, "user_idx", how).join(items, "item_idx", how)
    for block_rows in (5, 1000):
        cells = R.with_factors(pairs, users, items, how, plain_rows=0, block_rows=block_rows).select(*plain.columns)
        assert cells.exceptAll(plain).count() == plain.exceptAll(cells).count() == 0
        assert cells.count() == plain.count()


def test_pairs_with_factors_are_not_shuffled(spark):
    pairs, users, items = _tables(spark)
    out = R.with_factors(pairs, users, items, plain_rows=0).select("n", (F.element_at("p", 1) * F.element_at("q", 1)).alias("x"))
    out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 3, plan  # the pairs, the users and the items, before they meet
    assert "SortMergeJoin" not in plan and "CartesianProduct" not in plan


def test_no_factors_at_all(spark):
    pairs, users, items = _tables(spark)
    assert R.with_factors(pairs, users.limit(0), items, plain_rows=0).count() == 0
    assert R.with_factors(pairs, users.limit(0), items, "left", plain_rows=0).count() == pairs.join(items, "item_idx", "left").count()


@pytest.mark.parametrize("copies", [1, 2])
def test_sampled_user_eval_counts_each_pair_once(spark, tmp_path, copies):
    rows = [(v, [float((v * 7 + j) % 13) / 13 - 0.5 for j in range(4)], v % 3) for v in range(240)] * copies
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    d = str(tmp_path)
    uf, itf, truth = fx.user_factors(spark, d), fx.item_factors(spark, d), fx.truth(spark, d)
    tk = R.top_k_scores(uf, itf, 10).join(truth.select("user_idx").distinct(), "user_idx", "left_semi")
    ev = truth.withColumn("y", F.lit(1)).unionByName(tk.select("user_idx", "item_idx", F.lit(0).alias("y")))
    sc = R.score_pairs(ev.groupBy("user_idx", "item_idx").agg(F.max("y").alias("y_true")), uf, itf).withColumnRenamed("score", "y_proba")
    got = CR.q_sampled_user_eval(spark, d).first()
    assert got.roc_auc == pytest.approx(M.roc_auc(sc).first()[0], abs=2e-6)
    assert got.average_precision == pytest.approx(M.average_precision(sc).first()[0], abs=2e-6)


@pytest.mark.parametrize("query", [CR.q_gmf_score, CR.q_top_k_exclude_seen])
def test_pairs_that_a_view_makes_are_not_broadcast(spark, tmp_path, query):
    rows = [(v, [float((v * 7 + j) % 13) / 13 - 0.5 for j in range(64)], v % 3) for v in range(240)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    out = query(spark, str(tmp_path))
    assert out.collect()
    plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # the pairs stand left; Spark takes them for a row per user, as it does not count what an explode makes
    assert "Generate explode" in plan and "BuildLeft" not in plan, plan


def test_ncf_score_does_not_broadcast_its_pairs(spark, tmp_path, monkeypatch):
    rows = [(v, [float((v * 7 + j) % 13) / 13 - 0.5 for j in range(64)], v % 3) for v in range(240)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    monkeypatch.setattr(CM, "FEW_PAIRS", 10, raising=False)
    plans, cut = [], CM.cut_lineage

    def keep(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut(df)

    monkeypatch.setattr(CM, "cut_lineage", keep)
    monkeypatch.setattr(CM.H, "negative_sampling", lambda *a, **k: 1 / 0)  # what follows is not looked at
    with pytest.raises(ZeroDivisionError):
        CM.q_ncf_score(spark, str(tmp_path))
    pairs = [p for p in plans if "Generate explode" in p]
    assert pairs and all("BuildLeft" not in p for p in pairs), pairs
