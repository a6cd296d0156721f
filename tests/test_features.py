"""Splits, encoders, scaler, negative sampling, SMOTE, MLP weight layout."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import features as H
from orchard.operators import models as ML


def test_stratified_split_exact(spark):
    rows = [(i, 1 if i % 4 == 0 else 0) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, label int")
    out = H.stratified_split(df, "label", "id", 0.2)
    c = {(r.label, r.split): r["count"] for r in out.groupBy("label", "split").count().collect()}
    assert c[(1, "test")] == 50 and c[(0, "test")] == 150
    again = H.stratified_split(df, "label", "id", 0.2)
    assert out.where("split='test'").select("id").exceptAll(again.where("split='test'").select("id")).count() == 0


def test_label_encode_and_unseen_raises(spark):
    tr = spark.createDataFrame([("b",), ("a",), ("c",)], "x string")
    dom = H.fit_label_domains(tr, ["x"])
    enc = {r.x for r in H.label_encode(tr, dom, ["x"]).collect()}
    assert enc == {0, 1, 2}
    bad = spark.createDataFrame([("z",)], "x string")
    with pytest.raises(Exception, match="unseen"):
        H.label_encode(bad, dom, ["x"]).collect()


def test_scaler_population_std(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0)], "a double, b double")
    st = H.fit_scaler(df, ["a", "b"])
    out = H.standard_scale(df, st).collect()
    assert [round(r.a, 6) for r in out] == [round(-1 / np.sqrt(2 / 3), 6), 0.0, round(1 / np.sqrt(2 / 3), 6)]
    assert {r.b for r in out} == {0.0}


def test_one_hot_if_binary(spark):
    df = spark.createDataFrame([("M", "a"), ("F", "b"), ("F", "c")], "g string, t string")
    cats = H.fit_one_hot(df, ["g", "t"])
    out = H.one_hot_if_binary(df, cats)
    assert out.columns == ["g_M", "t_a", "t_b", "t_c"]
    unk = H.one_hot_if_binary(spark.createDataFrame([("X", "z")], "g string, t string"), cats).first()
    assert sum(unk) == 0


@pytest.mark.parametrize("pos,n_items,expected_rows", [([(0, 0), (0, 1), (1, 0)], 3, 9),
                                                        ([(0, 0), (1, 1), (2, 2)], 5, 9)])
def test_negative_sampling_invariants(spark, pos, n_items, expected_rows):
    df = spark.createDataFrame(pos, "user_idx long, item_idx long")
    out = H.negative_sampling(df, n_items, 2)
    assert out.count() == expected_rows
    negs = out.where("label = 0.0")
    assert negs.join(df, ["user_idx", "item_idx"]).count() == 0
    assert negs.where((F.col("item_idx") < 0) | (F.col("item_idx") >= n_items)).count() == 0


def test_smote_parity(spark):
    rng = np.random.default_rng(0)
    rows = [(float(x), float(y), 1 if i < 30 else 0) for i, (x, y) in enumerate(rng.normal(size=(100, 2)))]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    out = H.smote(df, ["a", "b"], "label", k=5)
    c = {r.label: r["count"] for r in out.groupBy("label").count().collect()}
    assert c[0] == c[1] == 70


def test_mlp_weights_match_mllib(spark):
    rng = np.random.default_rng(1)
    rows = [([float(v) for v in rng.normal(size=4)], float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, "x array<double>, label double")
    from pyspark.ml.functions import array_to_vector, vector_to_array
    tr = df.withColumn("features", array_to_vector("x"))
    m = ML.train_mlp(tr, 4, hidden=(5, 3), max_iter=20)
    ref = m.transform(tr).select(vector_to_array("probability")[1].alias("p")).collect()
    ours = ML.ncf_score(df.withColumn("i", F.monotonically_increasing_id()), ML.mlp_weights(m), "x",
                        keep=("i",)).orderBy("i").collect()
    assert [round(r.p, 6) for r in ref] == [round(r.score, 6) for r in ours]


def test_negatives_avoid_the_other_split(spark):
    pos = [(u, (u * 3 + j) % 11, u * 100 + j, "train" if j % 3 else "validation") for u in range(20) for j in range(8)]
    df = spark.createDataFrame(pos, "user_idx long, item_idx long, event_id long, split string")
    for split in ("train", "validation"):
        out = H.negative_sampling(df.where(F.col("split") == split), 11, 4, known=df, row_col="event_id").where("label = 0")
        assert out.count() == 4 * df.where(F.col("split") == split).count()
        assert out.join(df, ["user_idx", "item_idx"], "left_semi").count() == 0
        assert out.select("item_idx").distinct().count() == 11


def test_one_draw_for_both_splits_is_the_draws_of_each(spark):
    pos = [(u, (u * 3 + j) % 11, u * 100 + j, "train" if j % 3 else "validation") for u in range(20) for j in range(8)]
    df = spark.createDataFrame(pos, "user_idx long, item_idx long, event_id long, split string")
    both = H.negative_sampling(df, 11, 4, known=df, row_col="event_id", keep=("split",))
    for split in ("train", "validation"):
        own = H.negative_sampling(df.where(F.col("split") == split), 11, 4, known=df, row_col="event_id")
        part = both.where(F.col("split") == split).drop("split")
        assert part.columns == own.columns
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, own.collect()))


def test_large_ids_do_not_overflow(spark):
    rows = [(2 * 10**15 + i, 10**15 + i % 7, i % 2, i) for i in range(50)]
    df = spark.createDataFrame(rows, "user_idx long, item_idx long, label int, event_id long")
    assert H.stratified_split(df, "label", "user_idx").where("split = 'test'").count() == 10
    assert H.sample_split(df, ["user_idx", "item_idx"]).count() == 50
    out = H.negative_sampling(df.withColumn("event_id", F.col("event_id") + 2 * 10**15), 2 * 10**15, 2, row_col="event_id")
    assert out.count() == 150


def test_mode_table_breaks_ties_by_value(spark):
    df = spark.createDataFrame([("b", "x"), ("a", "x"), (None, "y"), ("b", None), ("a", "z")], "p string, q string")
    assert {r["column"]: r["mode"] for r in H.mode_table(df, ["p", "q"]).collect()} == {"p": "a", "q": "x"}


def test_one_hot_vectors(spark):
    df = spark.createDataFrame([(1, "b", "u"), (2, "a", None), (3, "zz", "v")], "id long, p string, q string")
    dom = H.fit_label_domains(df.where("id < 3").unionAll(df.where("id = 3").selectExpr("id", "'c'", "q")), ["p", "q"])
    got = {r.id: (r.size, r.indices, r["values"]) for r in H.one_hot_vectors(df, dom, ["p", "q"], "id").collect()}
    assert got == {1: (5, [1, 3], [1.0, 1.0]), 2: (5, [0], [1.0]), 3: (5, [4], [1.0])}


def test_loader_like_split_and_scaling(spark):
    """10 customers, 20 % stratified test: 8 train / 2 test, scaled train means 0."""
    rows = [(i, ["a", "b"][i % 2], float(i * 3 + 1), 1 if i < 5 else 0) for i in range(10)]
    df = spark.createDataFrame(rows, "id long, cat string, x double, label int")
    sp = H.stratified_split(df, "label", "id", 0.2)
    counts = {r.split: r["count"] for r in sp.groupBy("split").count().collect()}
    assert counts == {"train": 8, "test": 2}
    train = sp.where("split = 'train'")
    dom = H.fit_label_domains(train, ["cat"])
    enc = H.label_encode(train, dom, ["cat"])
    scaled = H.standard_scale(enc, H.fit_scaler(enc, ["cat", "x"]))
    means = scaled.agg(F.avg("cat").alias("c"), F.avg("x").alias("x")).first()
    assert abs(means.c) < 1e-9 and abs(means.x) < 1e-9


def test_negative_sampling_user_owning_almost_everything(spark):
    # user 0 owns 98 of 100 items: random draws rarely hit the 2 free items
    pos = [(0, i) for i in range(98)] + [(1, 5)]
    df = spark.createDataFrame(pos, "user_idx long, item_idx long")
    out = H.negative_sampling(df, 100, 4)
    negs = out.where("label = 0.0")
    per_user = {r.user_idx: r["count"] for r in negs.groupBy("user_idx").count().collect()}
    assert per_user == {0: 98 * 4, 1: 4}
    assert {r.item_idx for r in negs.where("user_idx = 0").collect()} <= {98, 99}


def test_smote_neighbours_are_exact(spark):
    # minority points on a line: the nearest neighbours of each are its line neighbours
    rows = [(float(i * i), 0.0, 1) for i in range(8)] + [(100.0 + i, 50.0, 0) for i in range(20)]
    df = spark.createDataFrame(rows, "a double, b double, label int")
    out = H.smote(df, ["a", "b"], "label", k=1).where("label = 1")
    assert out.count() == 20
    xs = sorted(r.a for r in out.collect())
    pts = [float(i * i) for i in range(8)]
    # with k = 1 every synthetic point lies between a point and its nearest neighbour
    nearest = {p: min((q for q in pts if q != p), key=lambda q: (abs(q - p), q)) for p in pts}
    segs = [(min(p, q), max(p, q)) for p, q in nearest.items()]
    assert all(any(lo - 1e-9 <= v <= hi + 1e-9 for lo, hi in segs) for v in xs)


def test_one_hot_has_no_domain_limit(spark):
    df = spark.createDataFrame([(str(i),) for i in range(50)], "c string")
    assert len(H.fit_one_hot(df, ["c"])["c"]) == 50


def test_forest_is_fitted_in_groups_of_trees(spark):
    """No group holds more nodes than asked for, the trees are as many as set, and the votes add up over all of them."""
    import random

    from pyspark.ml.functions import vector_to_array

    from orchard.operators import models as ML

    rng = random.Random(3)
    rows = [(i, rng.random(), rng.random()) for i in range(400)]
    df = ML.assemble(spark.createDataFrame([(i, a, b, float(a + 0.3 * rng.random() > b)) for i, a, b in rows],
                                           "customerid long, a double, b double, label double"), ["a", "b"])
    forest = ML.train_random_forest(df, num_trees=9)
    forest.nodes = 200
    fits = list(forest.groups())
    assert sum(m.getNumTrees for m in fits) == 9 and len(fits) > 2
    assert all(m.totalNumNodes <= 2 * 200 for m in fits[1:])
    assert len({tuple(t.toDebugString for t in m.trees) for m in fits}) == len(fits)
    out = ML.predictions(forest, df, keep=("customerid",)).collect()
    assert len(out) == 400 and sum(r.y_true == r.y_pred for r in out) > 380
    votes = [0.0] * 400
    for m in fits:
        for r in m.transform(df).select("customerid", vector_to_array("rawPrediction")[1].alias("v")).collect():
            votes[r.customerid] += r.v
    assert all(abs(votes[r.customerid] / 9 - r.y_proba) < 1e-9 for r in out)
