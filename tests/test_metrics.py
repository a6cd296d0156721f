"""Classification and money metrics on the reference's small prediction fixtures."""

import pytest

from orchard.operators import business as B
from orchard.operators import classification as M

TYPICAL = dict(y_true=[0, 0, 0, 0, 0, 1, 1, 1, 1, 1], y_pred=[0, 0, 1, 0, 0, 1, 0, 1, 1, 1],
               y_proba=[.1, .2, .6, .3, .15, .8, .4, .75, .85, .9])
WORST = dict(y_true=[0, 0, 1, 1], y_pred=[1, 1, 0, 0], y_proba=[.9, .85, .1, .15])
ALL_NEG = dict(y_true=[0, 1, 0, 1, 0], y_pred=[0, 0, 0, 0, 0], y_proba=[.1, .2, .3, .2, .1])


def frame(spark, d):
    rows = [("m", t, p, s) for t, p, s in zip(d["y_true"], d["y_pred"], d["y_proba"])]
    return spark.createDataFrame(rows, "model string, y_true int, y_pred int, y_proba double")


def one(df):
    return df.first().asDict()


def test_typical(spark):
    df = frame(spark, TYPICAL)
    m = one(B.all_churn_metrics(df, ["model"]))
    assert (m["tp"], m["fp"], m["fn"], m["tn"]) == (4, 1, 1, 4)
    for k in ("accuracy", "precision", "recall", "f1"):
        assert m[k] == pytest.approx(0.8)
    assert m["roc_auc"] == pytest.approx(0.96)
    assert m["average_precision"] == pytest.approx(0.966667, abs=1e-6)
    assert m["churn_avoided_revenue"] == 8320 and m["false_positive_cost"] == 20
    assert m["retention_cost"] == 200 and m["net_benefit"] == 8100
    assert m["roi_percent"] == pytest.approx(3681.8182, abs=1e-4)


def test_worst(spark):
    df = frame(spark, WORST)
    m = one(B.all_churn_metrics(df, ["model"]))
    assert m["roc_auc"] == pytest.approx(0.0)
    assert m["average_precision"] == pytest.approx(0.416667, abs=1e-6)
    assert m["net_benefit"] == -40 and m["roi_percent"] == pytest.approx(-100.0)


def test_all_negative_predictions(spark):
    m = one(B.all_churn_metrics(frame(spark, ALL_NEG), ["model"]))
    assert m["precision"] == 0 and m["recall"] == 0 and m["f1"] == 0
    assert m["roi_percent"] == 0 and m["net_benefit"] == 0


def test_perfect(spark):
    d = dict(y_true=[0, 0, 0, 0, 1, 1, 1, 1], y_pred=[0, 0, 0, 0, 1, 1, 1, 1],
             y_proba=[.1, .2, .3, .4, .6, .7, .8, .9])
    m = one(B.all_churn_metrics(frame(spark, d), ["model"]))
    for k in ("accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"):
        assert m[k] == pytest.approx(1.0)


def test_auc_ap_ungrouped_and_many_buckets(spark):
    import random
    random.seed(3)
    rows = [(random.randint(0, 1), round(random.random(), 2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "y_true int, y_proba double")
    auc = M.roc_auc(df).first().roc_auc
    # brute force with tie handling
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    num = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert auc == pytest.approx(num / (len(pos) * len(neg)), abs=1e-9)
    # AP brute force: descending distinct thresholds
    ths = sorted({s for _, s in rows}, reverse=True)
    P = len(pos)
    ap = 0.0
    for t in ths:
        tp = sum(1 for y, s in rows if s >= t and y == 1)
        fp = sum(1 for y, s in rows if s >= t and y == 0)
        dp = sum(1 for y, s in rows if s == t and y == 1)
        ap += dp / P * tp / (tp + fp)
    assert M.average_precision(df).first().average_precision == pytest.approx(ap, abs=1e-9)


def test_threshold_sweep_and_best(spark):
    df = frame(spark, TYPICAL)
    sw = M.threshold_sweep(df, ["model"])
    rows = sw.orderBy("threshold").collect()
    assert len(rows) == 18 and rows[0].threshold == 0.10 and rows[-1].threshold == 0.95
    r15 = [r for r in rows if r.threshold == 0.15][0]
    assert (r15.tp, r15.fp) == (5, 4) and r15.net_benefit == 5 * 2000 - 4 * 50
    best = M.best_threshold(sw, ["model"]).first()
    assert best.net_benefit == max(r.net_benefit for r in rows)
    assert best.threshold == min(r.threshold for r in rows if r.net_benefit == best.net_benefit)


def test_classification_report(spark):
    rep = {r["class"]: r for r in M.classification_report(frame(spark, TYPICAL), ["model"]).collect()}
    assert rep["1"].precision == pytest.approx(0.8) and rep["0"].support == 5
    assert rep["macro avg"].f1 == pytest.approx(0.8) and rep["accuracy"].f1 == pytest.approx(0.8)


def test_log_loss_clamped(spark):
    df = spark.createDataFrame([(1, 0.0), (0, 1.0), (1, 1.0)], "y_true int, y_proba double")
    assert M.log_loss(df).first().log_loss == pytest.approx(200 / 3)
