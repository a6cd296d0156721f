"""Distributed ordered scans against brute force (property-based)."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orchard.operators.prefix import dense_index, exact_quantiles, running_sums

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 2), st.integers(-50, 50), st.integers(0, 9)), min_size=1, max_size=120),
       st.integers(1, 9))
def test_running_sums_grouped(spark, rows, buckets):
    # unique (g, x) order keys: aggregate duplicates first, as the helper requires
    agg = {}
    for g, x, v in rows:
        agg[(g, x)] = agg.get((g, x), 0) + v
    data = [(g, x, v) for (g, x), v in agg.items()]
    df = spark.createDataFrame(data, "g int, x int, v long")
    got = {(r.g, r.x): r.v_cum for r in running_sums(df, "x", ["v"], ["g"], n_buckets=buckets).collect()}
    for g in {g for g, _, _ in data}:
        acc = 0
        for x in sorted(x for gg, x, _ in data if gg == g):
            acc += agg[(g, x)]
            assert got[(g, x)] == acc


@SETTINGS
@given(st.lists(st.floats(-1e3, 1e3, allow_nan=False), min_size=1, max_size=200),
       st.lists(st.sampled_from([0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 0.99, 1.0]), min_size=1, max_size=4, unique=True))
def test_exact_quantiles_linear(spark, xs, qs):
    df = spark.createDataFrame([(float(x),) for x in xs], "x double")
    got = {r.q: r.value for r in exact_quantiles(df, "x", qs, n_buckets=5).collect()}
    for q in qs:
        assert got[q] == pytest.approx(float(np.quantile(np.array(xs), q, method="linear")), rel=1e-9, abs=1e-9)


@SETTINGS
@given(st.lists(st.integers(-10**12, 10**12), min_size=1, max_size=150))
def test_dense_index_any_ids(spark, ids):
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = sorted((r.id, r.idx) for r in dense_index(df, "id", "idx", n_buckets=7).collect())
    assert got == list(zip(sorted(set(ids)), range(len(set(ids)))))


def test_running_sums_descending(spark):
    df = spark.createDataFrame([(x, 1) for x in range(20)], "x int, v long")
    got = {r.x: r.v_cum for r in running_sums(df, "x", ["v"], n_buckets=4, descending=True).collect()}
    assert got == {x: 20 - x for x in range(20)}


def test_many_buckets_use_binary_search_path(spark):
    import random
    random.seed(11)
    ids = random.sample(range(10**9), 5000)
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    got = sorted((r.id, r.idx) for r in dense_index(df, "id", "idx", n_buckets=300).collect())
    assert got == list(zip(sorted(ids), range(len(ids))))
    qs = {r.q: r.value for r in exact_quantiles(df, "id", [0.5, 0.9], n_buckets=300).collect()}
    assert qs[0.5] == pytest.approx(float(np.quantile(np.array(ids, dtype=float), 0.5)))


def test_dense_rank_sorted_strings(spark):
    from orchard.operators.prefix import dense_rank_sorted
    import random
    random.seed(3)
    rows = [(random.choice(["a", "b", "c"]), "".join(random.choice("xyzw") for _ in range(4))) for _ in range(800)]
    df = spark.createDataFrame(rows, "g string, v string")
    got = {(r.g, r.v): r.rank0 for r in dense_rank_sorted(df, ["v"], ["g"]).collect()}
    for g in "abc":
        vals = sorted({v for gg, v in rows if gg == g})
        assert [got[(g, v)] for v in vals] == list(range(len(vals)))


def test_running_sums_with_null_order_values_many_buckets(spark):
    rows = [(None, 1)] + [(float(i), 1) for i in range(500)]
    df = spark.createDataFrame(rows, "x double, v long")
    got = running_sums(df, "x", ["v"], n_buckets=100).where("x IS NOT NULL").orderBy("x").collect()
    assert [r.v_cum for r in got][-1] == 501 and got[0].v_cum == 2
