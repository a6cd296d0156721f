"""Forests that are grown on the executors: MLlib's trees where nothing is random, the same votes wherever nodes are split."""

import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from orchard.operators import forest as FO
from orchard.operators import models as ML


def _rows(spark, n, values, classes=2, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = (rng.randrange(values) if values else rng.random() * 20 for _ in range(3))
        rows.append((i, float(a), float(b), float(c), 1.0, float(int(a + b / 2 + rng.randrange(6)) // 9 % classes)))
    return ML.assemble(spark.createDataFrame(rows, "customerid long, a double, b double, c double, d double, label double"),
                       ["a", "b", "c", "d"])


def _votes(grown, df):
    rows = df.withColumn("_row", F.col("customerid"))
    return {r._row: list(r._votes) for r in grown.votes(rows).collect()}


@pytest.mark.parametrize("classes, settings, local_rows", [
    (2, {}, 60), (3, {"minInstancesPerNode": 9}, 60), (2, {"impurity": "entropy", "maxDepth": 4}, 10000)])
def test_a_tree_without_chance_is_mllibs(spark, classes, settings, local_rows):
    df = _rows(spark, 700, 19, classes)
    rf = RandomForestClassifier(**({"numTrees": 1, "bootstrap": False, "maxDepth": 5} | settings))
    grown = FO.Grown(rf, df, local_rows)
    assert (grown.trees.count() > 1) == (local_rows == 60)
    told = {r.customerid: r.v for r in rf.fit(df).transform(df).select("customerid", vector_to_array("rawPrediction").alias("v")).collect()}
    own = _votes(grown, df)
    assert own.keys() == told.keys()
    shares = {k: [x / sum(v) for x in v] for k, v in told.items()}
    assert all(own[k] == pytest.approx(shares[k]) for k in own)


def test_votes_do_not_depend_on_where_a_node_is_split(spark, monkeypatch):
    df = _rows(spark, 900, 0)
    rf = RandomForestClassifier(numTrees=12, maxDepth=30, seed=5)
    one = _votes(FO.Grown(rf, df), df)
    monkeypatch.setattr(FO, "DEALT_ROWS", 5 * 900)  # three groups of trees
    monkeypatch.setattr(FO, "VOTES", 2000)  # several buckets and chunks
    monkeypatch.setattr(FO, "LOCAL_ROWS", 200)
    many = FO.Grown(rf, df, 90)
    again = _votes(many, df)
    assert len(one) == 900 and one.keys() == again.keys() and all(one[k] == pytest.approx(again[k]) for k in one)
    assert all(sum(v) == pytest.approx(12) for v in one.values()) and len({tuple(v) for v in one.values()}) > 20


def test_large_forests_are_not_fitted_tree_by_tree(spark, monkeypatch):
    df = _rows(spark, ML.GROUP_ROWS + 500, 0).repartition(4).cache()
    train = df.where("customerid >= 300")
    forest = ML.train_random_forest(train, num_trees=30)
    forest.nodes = 1 << 12
    monkeypatch.setattr(ML.Forest, "groups", lambda self: pytest.fail("a job for each level of some trees"))
    out = ML.predictions(forest, df.where("customerid < 300"), keep=("customerid",)).collect()
    assert sorted(r.customerid for r in out) == list(range(300))
    whole = RandomForestClassifier(numTrees=30, maxDepth=30, seed=42).fit(train)
    theirs = ML.predictions(whole, df.where("customerid < 300"), keep=("customerid",)).collect()
    hits = [sum(r.y_true == r.y_pred for r in rows) for rows in (out, theirs)]
    assert abs(hits[0] - hits[1]) < 15


def test_settings_of_mllib_alone_stay_with_mllib(spark):
    df = _rows(spark, 50, 5)
    assert FO.supported(RandomForestClassifier(), df)
    assert not FO.supported(RandomForestClassifier(weightCol="a"), df) and not FO.supported(RandomForestClassifier().setThresholds([0.3, 0.7]), df)
    assert [FO.subset_size(x, 9, 5) for x in ("auto", "all", "log2", "onethird", "4", "0.5")] == [3, 9, 4, 3, 4, 5]
    assert FO.subset_size("auto", 9, 1) == 9
