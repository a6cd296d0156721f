"""Monitoring (KS, drift) and experiment bookkeeping (early stopping, pending, champion)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orchard.operators import experiments as X
from orchard.operators import monitoring as MO


def test_ks_statistic_golden(spark):
    a = spark.createDataFrame([(0.8,), (0.9,), (0.7,)], "score double")
    b = spark.createDataFrame([(0.75,), (0.85,), (0.65,)], "score double")
    r = MO.ks_two_sample(a, b).first()
    assert r.statistic == pytest.approx(1 / 3)
    assert r.p_value > 0.05


def test_ks_identical_samples(spark):
    a = spark.createDataFrame([(float(i),) for i in range(50)], "score double")
    r = MO.ks_two_sample(a, a).first()
    assert r.statistic == 0.0 and r.p_value == 1.0


def _log(spark, scores, batch):
    base = dt.datetime(2024, 1, 1)
    rows = [(base + dt.timedelta(seconds=i), b, i, s) for i, (s, b) in enumerate(zip(scores, batch))]
    return spark.createDataFrame(rows, "ts timestamp, batch_id long, seq long, score double")


def test_drift_golden(spark):
    log = _log(spark, [.8, .9, .7, .85, .75, .88], [0, 0, 0, 0, 1, 1])
    base = MO.baseline_snapshot(log, 0, 1000)
    b = base.first()
    assert b.baseline_mean == pytest.approx(0.8125) and b.baseline_std == pytest.approx(0.073951, abs=1e-6)
    cur = MO.score_stats(MO.recent_window(log, 1000))
    d = MO.performance_drift(cur, base).first()
    assert d.current_mean == pytest.approx(0.813333, abs=1e-6)
    assert d.statistic == pytest.approx(0.011269, abs=1e-6) and not d.has_shift
    from math import erfc, sqrt
    assert d.p_value == pytest.approx(0.5 * erfc(d.statistic / sqrt(2)), abs=1e-6)


def test_zero_std_baseline_has_reason(spark):
    log = _log(spark, [.5, .5, .9], [0, 0, 1])
    d = MO.performance_drift(MO.score_stats(MO.recent_window(log, 10)), MO.baseline_snapshot(log, 0)).first()
    assert d.statistic is None and not d.has_shift and d.reason == "zero baseline std"


def test_recent_window_is_latest(spark):
    log = _log(spark, [float(i) for i in range(10)], [0] * 10)
    assert sorted(r.score for r in MO.recent_window(log, 3).collect()) == [7.0, 8.0, 9.0]


def _epochs(spark, runs):
    rows = [(run, e + 1, "loss", v) for run, vals in runs.items() for e, v in enumerate(vals)]
    return spark.createDataFrame(rows, "run string, epoch int, metric string, value double")


def test_early_stopping_golden(spark):
    em = _epochs(spark, {"min": [.5, .6, .7], "delta": [.5, .45, .55]})
    r = {x.run: x for x in X.early_stop_point(em, patience=2, mode="min").collect()}
    assert r["min"].stop_epoch == 3 and r["min"].num_bad_epochs == 2 and r["min"].best_value == 0.5
    r2 = {x.run: x for x in X.early_stop_point(em, patience=2, mode="min", min_delta=0.1).collect()}
    assert r2["delta"].stop_epoch == 3 and r2["delta"].best_value == 0.5
    mx = X.early_stop_point(_epochs(spark, {"max": [.8, .7, .6]}), patience=2, mode="max").first()
    assert mx.stop_epoch == 3 and mx.best_value == 0.8
    off = X.early_stop_point(_epochs(spark, {"off": [.5, .6, .7]}), patience=0).first()
    assert off.stop_epoch is None


def test_pending_and_champion(spark):
    rm = spark.createDataFrame([("a", "mf", "weighted", "ndcg", 0.3), ("b", "mf", "binary", "ndcg", 0.2),
                                ("c", "gmf", "binary", "auc", 0.9)],
                               "run string, model_type string, processor string, metric string, value double")
    grid = X.experiment_grid(spark, ["mf", "gmf"], ["weighted", "binary"])
    pend = {(r.model_type, r.processor) for r in X.pending_experiments(grid, rm).collect()}
    assert pend == {("gmf", "weighted")}
    dec = {r.run: r.promote for r in X.champion_decision(rm, "ndcg", "a").collect()}
    assert dec == {"b": False, "c": False}
    none = {r.run: r.promote for r in X.champion_decision(rm, "ndcg", None).collect()}
    assert none["a"] and none["b"] and not none["c"]


def replay(values, patience, min_delta):
    best = stop = None
    at = bad = 0
    for k, v in enumerate(values, 1):
        if best is None or v < best - min_delta:
            best, at, bad = v, k, 0
        else:
            bad += 1
            if bad >= patience:
                return best, at, bad, k
    return best, at, bad, stop


def test_early_stopping_across_segments(spark, monkeypatch):
    import random
    monkeypatch.setattr(X, "SEGMENT", 16)
    r = random.Random(3)
    runs = {}
    for n in (1, 2, 15, 16, 17, 200, 500):
        for drift in (0.0, 0.02, 0.2):
            runs[f"{n}-{drift}"] = [round(5 - drift * k + r.gauss(0, 0.5), 3) for k in range(n)]
    em = _epochs(spark, runs).repartition(4)
    for patience, delta in ((1, 0.0), (3, 0.0), (4, 0.3), (9, 0.05)):
        got = {x.run: (x.best_value, x.best_epoch, x.num_bad_epochs, x.stop_epoch)
               for x in X.early_stop_point(em, patience, "min", delta).collect()}
        assert got == {k: replay(v, patience, delta) for k, v in runs.items()}


def test_exact_ks_against_all_merges():
    from itertools import combinations
    for n, m in ((1, 1), (3, 3), (4, 2), (5, 4), (2, 7)):
        seen = []
        for own in combinations(range(n + m), n):
            a = b = d = 0
            for k in range(n + m):
                a, b = a + (k in own), b + (k not in own)
                d = max(d, abs(a * m - b * n))
            seen.append(d)
        for d in sorted(set(seen)):
            assert MO.ks_exact_p(n, m, d / (n * m)) == pytest.approx(sum(x >= d for x in seen) / len(seen))
    assert MO.ks_exact_p(5, 5, 0.0) == 1.0
    assert MO.ks_exact_p(1000, 900, 0.06) == pytest.approx(0.0640, abs=0.004)


def test_ks_small_samples_are_exact(spark):
    a = spark.createDataFrame([(x,) for x in (0.1, 0.2, 0.3, 0.4)], "score double")
    b = spark.createDataFrame([(x,) for x in (0.5, 0.6, 0.7, 0.8)], "score double")
    assert MO.ks_two_sample(a, b).first().p_value == pytest.approx(2 / 70)
