"""Event strategies, minimum-interaction filter, dense index, popularity (golden cases)."""

import pytest
from pyspark.sql import functions as F

from orchard.operators import interactions as I

EVENTS = [(1, 10, "view"), (1, 20, "view"), (1, 30, "transaction"), (2, 10, "addtocart"),
          (2, 40, "transaction"), (3, 20, "view"), (3, 30, "view"), (3, 50, "addtocart"),
          (3, 60, "transaction"), (4, 10, "view")]


@pytest.fixture()
def events(spark):
    return spark.createDataFrame(EVENTS, "visitorid long, itemid long, event string")


def test_weighted_keeps_all_rows(events):
    out = I.weighted_interactions(events)
    assert out.count() == 10
    w = {(r.visitorid, r.itemid): r.weight for r in out.collect()}
    assert w[(1, 30)] == 3.0 and w[(2, 10)] == 2.0 and w[(1, 10)] == 1.0


def test_unknown_event_weight_zero_and_custom_weights(spark, events):
    extra = events.unionByName(spark.createDataFrame([(5, 70, "click")], events.schema))
    out = I.weighted_interactions(extra)
    assert out.where("event = 'click'").first().weight == 0.0
    custom = I.weighted_interactions(events, {"view": 5.0})
    assert {r.weight for r in custom.collect()} == {0.0, 5.0}
    assert {r.weight for r in I.weighted_interactions(events, {}).collect()} == {1.0, 2.0, 3.0}


def test_load_weights_leave_unknown_null(spark):
    df = spark.createDataFrame([(1, 1, "view"), (1, 2, "addtocart"), (1, 3, "transaction"), (1, 4, "other")],
                               "visitorid long, itemid long, event string")
    ws = [r.weight for r in I.with_load_weights(df).orderBy("itemid").collect()]
    assert ws == [1.0, 2.0, 3.0, None]


def test_binary_and_implicit(events):
    b = I.binary_interactions(events)
    assert b.count() == 5 and {r.weight for r in b.collect()} == {1.0}
    assert I.implicit_interactions(events).count() == 10


def test_min_interactions_single_pass(events):
    out = I.min_interactions(I.weighted_interactions(events), 3).collect()
    assert [(r.visitorid, r.itemid) for r in out] == [(1, 10)]
    assert I.min_interactions(events, 1).count() == 10


def test_process_dispatch_and_unknown_strategy(events):
    inter, users, items = I.process(events, "binary")
    assert inter.count() == 5
    assert sorted(r.user_idx for r in users.collect()) == list(range(users.count()))
    with pytest.raises(ValueError, match="Available"):
        I.process(events, "nope")
    inter2, _, _ = I.process(events, lambda df: df.withColumn("weight", F.lit(2.0)))
    assert {r.weight for r in inter2.collect()} == {2.0}


def test_dense_index_ascending(spark):
    import random
    random.seed(1)
    ids = random.sample(range(10_000_000), 3000)
    df = spark.createDataFrame([(i,) for i in ids], "id long")
    idx = I.dense_index(df, "id", "idx", n_buckets=16).collect()
    got = sorted((r.id, r.idx) for r in idx)
    assert got == list(zip(sorted(ids), range(len(ids))))


def test_popularity_golden(events):
    pop = {r.itemid: r.popularity for r in I.popular_items(I.weighted_interactions(events)).collect()}
    assert pop == {10: 1.0, 20: 0.5, 30: 1.0, 40: 0.75, 50: 0.5, 60: 0.75}
    top = I.popular_top_k(I.popular_items(I.weighted_interactions(events)), 3).collect()
    assert [r.itemid for r in top] == [10, 30, 40]


def test_popularity_zero_max_keeps_raw(spark):
    df = spark.createDataFrame([(1, 1, "x"), (1, 2, "y")], "visitorid long, itemid long, event string")
    pop = I.popular_items(I.weighted_interactions(df)).collect()
    assert {r.popularity for r in pop} == {0.0}
