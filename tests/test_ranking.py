"""Top-K and ranking metrics (hand case, empty case, brute-force top-k)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from orchard.operators import ranking as N
from orchard.operators import recommend as R
from orchard.sources import fixtures as fx


def test_hand_ranking_case(spark):
    # top-3 = a, b, c ; truth = b, z  (items as ints: a=1 b=2 c=3 z=26)
    topk = spark.createDataFrame([(0, 1, 1), (0, 2, 2), (0, 3, 3)], "user_idx long, item_idx long, rank long")
    truth = spark.createDataFrame([(0, 2), (0, 26)], "user_idx long, item_idx long")
    m = N.ranking_metrics(topk, truth, k=3).first()
    assert m.hit_rate_3 == pytest.approx(0.5)
    assert m.precision_3 == pytest.approx(1 / 3)
    assert m.recall_3 == pytest.approx(0.5)
    assert m.mrr_3 == pytest.approx(0.5)
    assert m.ndcg_3 == pytest.approx((1 / math.log2(3)) / (1 + 1 / math.log2(3)), abs=1e-6)
    assert m.ndcg_3 == pytest.approx(0.386853, abs=1e-6)


def test_duplicates_model_vs_baseline(spark):
    topk = spark.createDataFrame([(0, 1, 1), (0, 2, 2)], "user_idx long, item_idx long, rank long")
    truth = spark.createDataFrame([(0, 1), (0, 1), (0, 5)], "user_idx long, item_idx long")
    mo = N.ranking_metrics(topk, truth, k=2, variant="model").first()
    ba = N.ranking_metrics(topk, truth, k=2, variant="baseline").first()
    assert mo.precision_2 == pytest.approx(0.5) and ba.precision_2 == pytest.approx(1.0)
    assert mo.recall_2 == pytest.approx(1 / 3) and ba.recall_2 == pytest.approx(2 / 3)
    assert mo.hit_rate_2 == pytest.approx(2 / 3)


def test_empty_truth_gives_zero(spark):
    topk = spark.createDataFrame([(0, 1, 1)], "user_idx long, item_idx long, rank long")
    truth = spark.createDataFrame([], "user_idx long, item_idx long")
    m = N.ranking_metrics(topk, truth, k=1).first()
    assert all(v == 0.0 for v in m.asDict().values())


def _factors(spark, n, d, seed, name):
    rng = np.random.default_rng(seed)
    F_ = rng.normal(size=(n, d)).round(3)
    b = rng.normal(size=n).round(2)
    rows = [(i * 3 + 1, [float(x) for x in F_[i]], float(b[i])) for i in range(n)]
    return spark.createDataFrame(rows, f"{name} long, factors array<double>, bias double"), F_, b


@pytest.mark.parametrize("block", [1 << 26, 400])
def test_top_k_matches_brute_force(spark, block):
    users, P, bu = _factors(spark, 23, 5, 1, "user_idx")
    items, Q, bi = _factors(spark, 41, 5, 2, "item_idx")
    out = R.top_k_scores(users, items, 4, block_bytes=block).collect()
    S = P @ Q.T + bu[:, None] + bi[None, :]
    got = {}
    for r in out:
        got.setdefault(r.user_idx, []).append((r.rank, r.item_idx))
    for u in range(23):
        order = sorted(range(41), key=lambda j: (-S[u, j], j))[:4]
        assert [it for _, it in sorted(got[u * 3 + 1])] == [j * 3 + 1 for j in order]


def test_users_leave_when_norms_cannot_reach_their_best():
    """Tiles behind the bound are not scored, and the result is that of scoring all."""
    rng = np.random.default_rng(3)
    P, Q = rng.normal(size=(50, 6)), rng.normal(size=(4000, 6)) * rng.exponential(size=(4000, 1))
    bu, bi = rng.normal(size=50), rng.normal(size=4000) / 10
    block = R._UserBlock(list(range(50)), list(P), list(bu), 5, 0.25)
    norm = np.sqrt((Q ** 2).sum(1) + bi ** 2)
    scored, none = 0, (np.zeros(0, np.int64), np.zeros(0, np.int64))
    for t in np.split(np.argsort(-norm), 80):
        if len(block.open):
            block.meet(t, Q[t], bi[t], norm[t[0]], none)
            scored += len(block.open)
    S = P @ Q.T + bu[:, None] + bi + 0.25
    assert scored < 0.5 * 50 * 80
    for u in range(50):
        assert block.best_ids[u].tolist() == sorted(range(4000), key=lambda j: (-S[u, j], j))[:5]


def test_top_k_many_blocks(spark):
    users, P, bu = _factors(spark, 300, 4, 5, "user_idx")
    items, Q, bi = _factors(spark, 60, 4, 6, "item_idx")
    seen = spark.createDataFrame([(u * 3 + 1, j * 3 + 1) for u in range(0, 300, 7) for j in range(0, 60, 2)], "user_idx long, item_idx long")
    out = R.top_k_scores(users, items, 6, 0.5, block_bytes=300, block_users=40, exclude_seen=seen)
    assert "BroadcastNestedLoopJoin" not in out._jdf.queryExecution().toString()
    S = P @ Q.T + bu[:, None] + bi[None, :] + 0.5
    got = {}
    for r in out.collect():
        got.setdefault(r.user_idx, []).append((r.rank, r.item_idx))
    for u in range(300):
        allowed = [j for j in range(60) if u % 7 or j % 2]
        assert [i for _, i in sorted(got[u * 3 + 1])] == [j * 3 + 1 for j in sorted(allowed, key=lambda j: (-S[u, j], j))[:6]]


def test_items_travel_once_per_core_whatever_the_shuffle_partitions(spark):
    cores = spark.sparkContext.defaultParallelism
    assert R.user_blocks(spark, 64 * 10_000) == max(cores, 10)
    assert R.user_blocks(spark, 100) == 1 and R.user_blocks(spark, 0) == 1
    assert R.user_blocks(spark, 64 * 10_000, 1000) == max(cores, 640)
    users, *_ = _factors(spark, 64 * 2 * cores, 2, 5, "user_idx")
    items, *_ = _factors(spark, 3, 2, 6, "item_idx")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", str(4 * cores))
        plan = R.top_k_scores(users, items, 2)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert "RepartitionByExpression [block" in plan and f"], {cores}" in plan


def test_top_k_ties_prefer_smaller_item(spark):
    users = spark.createDataFrame([(0, [1.0], 0.0)], "user_idx long, factors array<double>, bias double")
    items = spark.createDataFrame([(i, [1.0], 0.0) for i in (9, 3, 5, 1)], "item_idx long, factors array<double>, bias double")
    for block in (1 << 26, 24):
        out = R.top_k_scores(users, items, 2, block_bytes=block).orderBy("rank").collect()
        assert [r.item_idx for r in out] == [1, 3]


def test_k_larger_than_catalog_returns_fewer(spark):
    users = spark.createDataFrame([(0, [1.0], 0.0)], "user_idx long, factors array<double>, bias double")
    items = spark.createDataFrame([(1, [2.0], 0.0), (2, [1.0], 0.0)], "item_idx long, factors array<double>, bias double")
    assert R.top_k_scores(users, items, 5).count() == 2


def test_cold_start_popularity(spark):
    users = spark.createDataFrame([(1, [1.0], 0.0)], "user_idx long, factors array<double>, bias double")
    items = spark.createDataFrame([(10, [1.0], 0.0), (20, [0.5], 0.0)], "item_idx long, factors array<double>, bias double")
    pop = spark.createDataFrame([(10, 5.0), (20, 3.0)], "itemid long, popularity double")
    req = spark.createDataFrame([(2, [10, 20, 30], 1)], "user_id long, item_ids array<long>, k int")
    scores = {r.item_id: r.score for r in R.cold_start_route(req, users, items, pop).collect()}
    assert scores == {10: 5.0, 20: 3.0, 30: 0.0}
    rec = R.recommend(req.select("user_id"), users, items, pop, 1).collect()
    assert [(r.item_id, r.cold_start) for r in rec] == [(10, True)]


def test_sessionize_matches_session_window(spark):
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    from orchard.operators.extensions import sessionize
    random.seed(5)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for u in range(4):
        t = 0
        for _ in range(300 if u == 0 else 20):  # user 0 is the hot key
            t += random.choice([10, 60, 600, 1799, 1800, 1801, 7200])
            rows.append((u, base + dt.timedelta(seconds=t)))
    df = spark.createDataFrame(rows, "u long, ts timestamp")
    ours = sessionize(df, "u", "ts", 1800.0, n_buckets=8)
    ref = df.groupBy("u", F.session_window("ts", "1800 seconds").alias("s")).agg(
        F.min("ts").alias("start"), F.max("ts").alias("end"), F.count(F.lit(1)).alias("n_events"))
    a = sorted((r.u, r.start, r.end, r.n_events) for r in ours.collect())
    b = sorted((r.u, r.start, r.end, r.n_events) for r in ref.collect())
    assert a == b


@pytest.mark.parametrize("block", [1 << 26, 200])
def test_top_k_exclude_seen(spark, block):
    users, P, bu = _factors(spark, 9, 4, 3, "user_idx")
    items, Q, bi = _factors(spark, 15, 4, 4, "item_idx")
    S = P @ Q.T + bu[:, None] + bi[None, :]
    seen_rows = [(u * 3 + 1, j * 3 + 1) for u in range(9) for j in range(15) if (u + j) % 3 == 0]
    seen = spark.createDataFrame(seen_rows, "user_idx long, item_idx long")
    out = R.top_k_scores(users, items, 3, block_bytes=block, exclude_seen=seen).collect()
    got = {}
    for r in out:
        got.setdefault(r.user_idx, []).append((r.rank, r.item_idx))
    for u in range(9):
        allowed = [j for j in range(15) if (u + j) % 3 != 0]
        order = sorted(allowed, key=lambda j: (-S[u, j], j))[:3]
        assert [it for _, it in sorted(got[u * 3 + 1])] == [j * 3 + 1 for j in order]


def test_top_k_slices_and_ties(spark, monkeypatch):
    monkeypatch.setattr(R, "SLICE", 16)
    rng = np.random.default_rng(9)
    P, Q = rng.integers(-1, 2, (7, 3)).astype(float), rng.integers(-1, 2, (200, 3)).astype(float)
    for k in (1, 3, 40):
        best, ids = R._block_top_k(P, np.zeros(7), np.arange(200), Q, np.zeros(200), k, 0.0, None)
        S = P @ Q.T
        for u in range(7):
            order = sorted(range(200), key=lambda j: (-S[u, j], j))[:k]
            assert ids[u].tolist() == order and best[u].tolist() == S[u, order].tolist()


def test_each_request_has_its_own_k(spark):
    users = spark.createDataFrame([(1, [1.0], 0.0)], "user_idx long, factors array<double>, bias double")
    items = spark.createDataFrame([(i, [float(i)], 0.0) for i in range(9)], "item_idx long, factors array<double>, bias double")
    pop = spark.createDataFrame([(i, float(i)) for i in range(9)], "itemid long, popularity double")
    req = spark.createDataFrame([(1, 2), (2, 4), (3, None), (4, 0)], "user_id long, k int")
    got = {r.user_id: r.n for r in R.recommend(req, users, items, pop, 3).groupBy("user_id").agg(
        F.count("*").alias("n")).collect()}
    assert got == {1: 2, 2: 4, 3: 3}
    assert [r.user_id for r in R.invalid_k(req).collect()] == [4]


def test_truth_pairs_are_not_shuffled(spark, tmp_path):
    """The truth view has users x items / 97 rows: it is dealt by user before its pairs exist."""
    spark.createDataFrame([(v, [float(v % 7), 1.0], v % 10) for v in range(400)],
                          "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    truth = fx.truth(spark, str(tmp_path))
    topk = spark.createDataFrame([(0, 97, 1)], "user_idx long, item_idx long, rank long")
    plan = N.per_user_ranking(topk, truth, 10)._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "item_idx" in line]
    assert not moved, plan
    expected = sorted((u, i) for u in range(0, 400, 5) for i in range(400) if i % 5 and (31 * u + 17 * i) % 97 == 0)
    assert sorted(map(tuple, truth.collect())) == expected


def test_truth_hits_with_repeated_rows_and_nulls(spark):
    pairs = "user_idx long, item_idx long"
    truth = spark.createDataFrame([(1, 5), (1, 5), (1, 6), (2, 5), (None, 5), (3, None)], pairs)
    topk = spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, 7, 3), (4, 5, 1)], pairs + ", rank long")
    hits = sorted((r.item_idx, r.rank, r.mult) for r in N.truth_hits(topk, truth).where("rank is not null").collect())
    assert hits == [(5, 1, 2), (5, 2, 2)]
    rows = {r.user_idx: (r.n_true, r.hits_distinct, r.hits_dup, r.rr) for r in N.per_user_ranking(topk, truth, 10).collect()}
    assert rows == {1: (3, 2, 4, 1.0), 2: (1, 0, 0, 0.0), None: (1, 0, 0, 0.0), 3: (1, 0, 0, 0.0)}
