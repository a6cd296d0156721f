"""Queries over the event log: strategies, filters, indexes, popularity."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from orchard.operators import interactions as I
from orchard.operators.dictionary import update_index
from orchard.plans.registry import register
from orchard.session import ensure_checkpoint_dir
from orchard.sources import fixtures as fx

MIN_N = 5  # minimum interactions of a user and of an item, the default of the training configuration

_W_CASE = ("CASE event WHEN 'view' THEN 1e0 WHEN 'addtocart' THEN 2e0 "
           "WHEN 'transaction' THEN 3e0 ELSE 0e0 END")

_FILTERED = f"""
w AS (SELECT *, {_W_CASE} AS weight FROM interactions_raw),
f AS (SELECT * FROM w
      WHERE visitorid IN (SELECT visitorid FROM w GROUP BY visitorid HAVING count(*) >= {MIN_N})
        AND itemid IN (SELECT itemid FROM w GROUP BY itemid HAVING count(*) >= {MIN_N}))"""


def flagship(spark, sf_dir, min_count: int = MIN_N, k: int = 10):
    """Weighted events -> min-interaction filter -> popularity -> global top-k."""
    ev = I.weighted_interactions(fx.interactions_raw(spark, sf_dir))
    pop = I.popular_items(I.min_interactions(ev, min_count))
    return I.popular_top_k(pop, k)


register("popular_top10", fx.with_views(f"""
WITH {_FILTERED},
p AS (SELECT itemid, sum(weight) AS s FROM f GROUP BY itemid)
SELECT itemid, CASE WHEN (SELECT max(s) FROM p) > 0 THEN s / (SELECT max(s) FROM p) ELSE s END AS popularity
FROM p ORDER BY popularity DESC, itemid LIMIT 10""", "interactions_raw"))(flagship)


@register("load_events", fx.with_views("""
SELECT *, CASE event WHEN 'view' THEN 1e0 WHEN 'addtocart' THEN 2e0 WHEN 'transaction' THEN 3e0 END AS weight
FROM interactions_raw""", "interactions_raw"))
def q_load_events(spark, sf_dir):
    return I.with_load_weights(fx.interactions_raw(spark, sf_dir))


@register("weighted_interactions", fx.with_views(f"""
SELECT *, {_W_CASE} AS weight FROM interactions_raw""", "interactions_raw"))
def q_weighted(spark, sf_dir):
    return I.weighted_interactions(fx.interactions_raw(spark, sf_dir))


@register("binary_interactions", fx.with_views("""
SELECT *, 1e0 AS weight FROM interactions_raw WHERE event IN ('addtocart', 'transaction')""",
                                               "interactions_raw"))
def q_binary(spark, sf_dir):
    return I.binary_interactions(fx.interactions_raw(spark, sf_dir))


@register("implicit_interactions", fx.with_views("""
SELECT *, 1e0 AS weight FROM interactions_raw""", "interactions_raw"))
def q_implicit(spark, sf_dir):
    return I.implicit_interactions(fx.interactions_raw(spark, sf_dir))


@register("min_interactions", fx.with_views(f"WITH {_FILTERED} SELECT * FROM f", "interactions_raw"))
def q_min_interactions(spark, sf_dir):
    return I.min_interactions(I.weighted_interactions(fx.interactions_raw(spark, sf_dir)), MIN_N)


@register("dense_index_users", fx.with_views("""
SELECT visitorid, CAST(row_number() OVER (ORDER BY visitorid) - 1 AS BIGINT) AS user_idx
FROM (SELECT DISTINCT visitorid FROM interactions_raw)""", "interactions_raw"))
def q_dense_users(spark, sf_dir):
    return I.dense_index(fx.interactions_raw(spark, sf_dir), "visitorid", "user_idx")


@register("dense_index_items", fx.with_views("""
SELECT itemid, CAST(row_number() OVER (ORDER BY itemid) - 1 AS BIGINT) AS item_idx
FROM (SELECT DISTINCT itemid FROM interactions_raw)""", "interactions_raw"))
def q_dense_items(spark, sf_dir):
    return I.dense_index(fx.interactions_raw(spark, sf_dir), "itemid", "item_idx")


@register("dense_index_text", fx.with_views("""
SELECT uid, CAST(row_number() OVER (ORDER BY uid) - 1 AS BIGINT) AS user_idx
FROM (SELECT DISTINCT 'u' || CAST(visitorid AS VARCHAR) AS uid FROM interactions_raw)""", "interactions_raw"))
def q_dense_text(spark, sf_dir):
    """Dense index of ids that are text."""
    ids = fx.interactions_raw(spark, sf_dir).select(F.concat(F.lit("u"), F.col("visitorid").cast("string")).alias("uid"))
    return I.dense_index(ids, "uid", "user_idx")


@register("index_versions", fx.with_views("""
WITH e AS (SELECT 'u' || CAST(visitorid AS VARCHAR) AS uid, event FROM interactions_raw),
v AS (SELECT uid, min(CASE event WHEN 'transaction' THEN 1 WHEN 'addtocart' THEN 2 ELSE 3 END) AS version FROM e GROUP BY uid)
SELECT uid, CAST(row_number() OVER (ORDER BY version, uid) - 1 AS BIGINT) AS user_idx FROM v""", "interactions_raw"))
def q_index_versions(spark, sf_dir):
    """A dictionary in three runs: buyers, then cart users, then everybody; earlier numbers stay."""
    ev = fx.interactions_raw(spark, sf_dir).withColumn("uid", F.concat(F.lit("u"), F.col("visitorid").cast("string")))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/index-{uuid.uuid4().hex}"
    for kinds in (("transaction",), ("transaction", "addtocart")):
        update_index(ev.where(F.col("event").isin(*kinds)), "uid", "user_idx", path)
    return update_index(ev, "uid", "user_idx", path)


@register("apply_index", fx.with_views(f"""
WITH {_FILTERED},
u AS (SELECT visitorid, CAST(row_number() OVER (ORDER BY visitorid) - 1 AS BIGINT) AS user_idx
      FROM (SELECT DISTINCT visitorid FROM f)),
i AS (SELECT itemid, CAST(row_number() OVER (ORDER BY itemid) - 1 AS BIGINT) AS item_idx
      FROM (SELECT DISTINCT itemid FROM f))
SELECT f.*, u.user_idx, i.item_idx FROM f JOIN u USING (visitorid) JOIN i USING (itemid)""",
                                       "interactions_raw"))
def q_apply_index(spark, sf_dir):
    out, _, _ = I.process(fx.interactions_raw(spark, sf_dir), "weighted", min_count=MIN_N)
    return out


@register("interaction_summary", fx.with_views("""
SELECT 'weighted' AS strategy, count(DISTINCT visitorid) AS n_users, count(DISTINCT itemid) AS n_items,
       count(*) AS n_rows FROM interactions_raw
UNION ALL
SELECT 'binary', count(DISTINCT visitorid), count(DISTINCT itemid), count(*) FROM interactions_raw
WHERE event IN ('addtocart', 'transaction')
UNION ALL
SELECT 'implicit', count(DISTINCT visitorid), count(DISTINCT itemid), count(*) FROM interactions_raw""",
                                               "interactions_raw"))
def q_interaction_summary(spark, sf_dir):
    return I.interaction_summary(fx.interactions_raw(spark, sf_dir))


@register("popular_items", fx.with_views(f"""
WITH p AS (SELECT itemid, sum({_W_CASE}) AS s FROM interactions_raw GROUP BY itemid)
SELECT itemid, CASE WHEN (SELECT max(s) FROM p) > 0 THEN s / (SELECT max(s) FROM p) ELSE s END AS popularity
FROM p""", "interactions_raw"))
def q_popular_items(spark, sf_dir):
    return I.popular_items(I.weighted_interactions(fx.interactions_raw(spark, sf_dir)))


@register("popular_items_count", fx.with_views("""
WITH p AS (SELECT itemid, CAST(count(*) AS DOUBLE) AS s FROM interactions_raw
           WHERE event IN ('addtocart', 'transaction') GROUP BY itemid)
SELECT itemid, s / (SELECT max(s) FROM p) AS popularity FROM p""", "interactions_raw"))
def q_popular_items_count(spark, sf_dir):
    """Count-based popularity over binary positives (the trainer's variant)."""
    ev = I.binary_interactions(fx.interactions_raw(spark, sf_dir))
    return I.popular_items(ev, weight_col=None)
