"""Queries: factor scoring, top-K, cold-start routing, ranking metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.functions.expressions import gmf_score
from orchard.operators import classification as M
from orchard.operators import interactions as I
from orchard.operators import ranking as N
from orchard.operators import recommend as R
from orchard.plans.common import round_doubles
from orchard.plans.registry import register
from orchard.session import cut_lineage
from orchard.sources import fixtures as fx

K = 10
# model parameters of the GMF scorer used by the gmf_score query (a fitted model supplies them)
GMF_WEIGHTS = [((j % 7) - 3) / 10.0 for j in range(64)]
GMF_BIAS = 0.1

_FIX = ("user_factors", "item_factors", "truth")


def _sql(body: str, *extra: str) -> str:
    return fx.with_views(body, *_FIX, *extra)


_TOPK = f"""s AS (SELECT u.user_idx, i.item_idx, u.bias + i.bias + list_dot_product(u.factors, i.factors) AS logit
  FROM user_factors u, item_factors i),
tk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY logit DESC, item_idx) AS rank FROM s)
  WHERE rank <= {K})"""


def _rank_sql(variant: str = "model", per_user: bool = False, truth: str = "truth", tk: str = "tk") -> str:
    hits = "hd" if variant == "model" else "hdup"
    hr = ("avg(CASE WHEN hdup > 0 THEN 1e0 ELSE 0e0 END)" if per_user else "sum(hdup) / sum(n_true)")
    return f"""t AS (SELECT user_idx, item_idx, count(*) AS mult FROM {truth} GROUP BY user_idx, item_idx),
nt AS (SELECT user_idx, sum(mult) AS n_true FROM t GROUP BY user_idx),
h AS (SELECT {tk}.user_idx, count(*) AS hd, sum(mult) AS hdup, sum(1 / log2(rank + 1)) AS dcg, min(rank) AS fr
  FROM {tk} JOIN t USING (user_idx, item_idx) WHERE rank <= {K} GROUP BY {tk}.user_idx),
pu AS (SELECT nt.user_idx, n_true, coalesce(hd, 0) AS hd, coalesce(hdup, 0) AS hdup, coalesce(dcg, 0e0) AS dcg,
  CASE WHEN least(n_true, {K}) > 0 THEN
    list_sum(list_transform(range(1, CAST(least(n_true, {K}) AS BIGINT) + 1), lambda i: 1 / log2(i + 1))) ELSE 0e0 END
    AS idcg,
  CASE WHEN fr IS NOT NULL THEN 1 / fr ELSE 0e0 END AS rr FROM nt LEFT JOIN h USING (user_idx)),
rm AS (SELECT coalesce({hr}, 0e0) AS hit_rate_{K},
  coalesce(avg(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0e0 END), 0e0) AS ndcg_{K},
  coalesce(avg({hits} / {K}), 0e0) AS precision_{K}, coalesce(avg({hits} / n_true), 0e0) AS recall_{K},
  coalesce(avg(rr), 0e0) AS mrr_{K} FROM pu)"""


def _rm_select(cols=("hit_rate", "ndcg", "precision", "recall", "mrr")) -> str:
    return "SELECT " + ", ".join(f"round({c}_{K}, 6) AS {c}_{K}" for c in cols) + " FROM rm"


def top_k(spark, sf_dir, **kw):
    return R.top_k_scores(fx.user_factors(spark, sf_dir), fx.item_factors(spark, sf_dir), K, **kw)


# --- G: scoring expressions -------------------------------------------------------------------

@register("mf_score", _sql("""
SELECT t.user_idx, t.item_idx, round(1 / (1 + exp(-(u.bias + i.bias + list_dot_product(u.factors, i.factors)))), 6)
  AS score
FROM truth t JOIN user_factors u USING (user_idx) JOIN item_factors i USING (item_idx)"""))
def q_mf_score(spark, sf_dir):
    return round_doubles(R.score_pairs(fx.truth(spark, sf_dir), fx.user_factors(spark, sf_dir),
                                       fx.item_factors(spark, sf_dir)))


_W = "[" + ", ".join(repr(w) for w in GMF_WEIGHTS) + "]::DOUBLE[]"


@register("gmf_score", _sql(f"""
SELECT t.user_idx, t.item_idx, round(1 / (1 + exp(-(list_sum(list_transform(range(1, 65),
  lambda j: u.factors[j] * i.factors[j] * ({_W})[j])) + {GMF_BIAS}))), 6) AS score
FROM truth t JOIN user_factors u USING (user_idx) JOIN item_factors i USING (item_idx)"""))
def q_gmf_score(spark, sf_dir):
    u = fx.user_factors(spark, sf_dir).select("user_idx", F.col("factors").alias("p"))
    i = fx.item_factors(spark, sf_dir).select("item_idx", F.col("factors").alias("q"))
    j = R.with_factors(fx.truth(spark, sf_dir), u, i)
    return round_doubles(j.select("user_idx", "item_idx", gmf_score("p", "q", GMF_WEIGHTS, GMF_BIAS).alias("score")))


# --- E1: top-K per user ---------------------------------------------------------------------

_TOPK_OUT = "SELECT user_idx, item_idx, round(logit, 6) AS logit, round(1 / (1 + exp(-logit)), 6) AS score, rank FROM tk"


@register("top_k_per_user", _sql(f"WITH {_TOPK} {_TOPK_OUT}"))
def q_top_k(spark, sf_dir):
    return round_doubles(top_k(spark, sf_dir))


@register("top_k_blocked", _sql(f"WITH {_TOPK} {_TOPK_OUT}"))
def q_top_k_blocked(spark, sf_dir):
    """Same result with small item blocks, so that several passes meet in the final window."""
    return round_doubles(top_k(spark, sf_dir, block_bytes=1 << 16))


@register("top_k_explicit", _sql(f"""WITH s AS (SELECT t.user_idx, t.item_idx,
  round(1 / (1 + exp(-(u.bias + i.bias + list_dot_product(u.factors, i.factors)))), 6) AS score
  FROM truth t JOIN user_factors u USING (user_idx) JOIN item_factors i USING (item_idx))
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, item_idx) AS rank FROM s)
WHERE rank <= 3"""))
def q_top_k_explicit(spark, sf_dir):
    """Top-3 of an explicit score table (here: the scored truth pairs of each user)."""
    scores = round_doubles(R.score_pairs(fx.truth(spark, sf_dir), fx.user_factors(spark, sf_dir),
                                         fx.item_factors(spark, sf_dir)))
    return R.top_k_per_user(scores, 3)


# --- C: routing, lookups, rejects ------------------------------------------------------------

_PAIRS = "pr AS (SELECT user_id, unnest(item_ids) AS item_id FROM requests)"


def _popularity(spark, sf_dir):
    return I.popular_items(I.weighted_interactions(fx.interactions_raw(spark, sf_dir)))


@register("popularity_lookup", _sql(f"""WITH p0 AS (SELECT itemid, sum(CASE event WHEN 'view' THEN 1e0
  WHEN 'addtocart' THEN 2e0 WHEN 'transaction' THEN 3e0 ELSE 0e0 END) AS s FROM interactions_raw GROUP BY itemid),
pop AS (SELECT itemid, CASE WHEN (SELECT max(s) FROM p0) > 0 THEN s / (SELECT max(s) FROM p0) ELSE s END
  AS popularity FROM p0), {_PAIRS}
SELECT pr.user_id, pr.item_id, coalesce(pop.popularity, 0e0) AS score FROM pr LEFT JOIN pop ON pop.itemid = pr.item_id""",
                                     "interactions_raw", "requests"))
def q_pop_lookup(spark, sf_dir):
    pairs = R.explode_requests(fx.requests(spark, sf_dir))
    return R.popularity_lookup(pairs, _popularity(spark, sf_dir))


_P0 = """p0 AS (SELECT itemid, sum(CASE event WHEN 'view' THEN 1e0 WHEN 'addtocart' THEN 2e0 WHEN 'transaction' THEN 3e0
  ELSE 0e0 END) AS s FROM interactions_raw GROUP BY itemid),
pop AS (SELECT itemid, CASE WHEN (SELECT max(s) FROM p0) > 0 THEN s / (SELECT max(s) FROM p0) ELSE s END
  AS popularity FROM p0)"""


@register("cold_start_route", _sql(f"""WITH {_P0}, {_PAIRS}
SELECT pr.user_id, pr.item_id,
  round(1 / (1 + exp(-(u.bias + i.bias + list_dot_product(u.factors, i.factors)))), 6) AS score, false AS cold_start
FROM pr JOIN user_factors u ON u.user_idx = pr.user_id JOIN item_factors i ON i.item_idx = pr.item_id
UNION ALL
SELECT pr.user_id, pr.item_id, round(coalesce(pop.popularity, 0e0), 6), true FROM pr LEFT JOIN pop ON pop.itemid = pr.item_id
WHERE pr.user_id NOT IN (SELECT user_idx FROM user_factors)""", "interactions_raw", "requests"))
def q_cold_start(spark, sf_dir):
    return round_doubles(R.cold_start_route(fx.requests(spark, sf_dir), fx.user_factors(spark, sf_dir),
                                            fx.item_factors(spark, sf_dir), _popularity(spark, sf_dir)))


@register("unknown_item_rejects", _sql(f"""WITH {_PAIRS}
SELECT user_id, item_id, 'unknown item' AS reason FROM pr
WHERE user_id IN (SELECT user_idx FROM user_factors) AND item_id NOT IN (SELECT item_idx FROM item_factors)""",
                                        "requests"))
def q_rejects(spark, sf_dir):
    return R.unknown_item_rejects(fx.requests(spark, sf_dir), fx.item_factors(spark, sf_dir),
                                  fx.user_factors(spark, sf_dir))


@register("score_requests", _sql(f"""WITH {_PAIRS}
SELECT pr.user_id AS user_idx, pr.item_id AS item_idx,
  round(1 / (1 + exp(-(u.bias + i.bias + list_dot_product(u.factors, i.factors)))), 6) AS score
FROM pr JOIN user_factors u ON u.user_idx = pr.user_id JOIN item_factors i ON i.item_idx = pr.item_id""", "requests"))
def q_score_requests(spark, sf_dir):
    return round_doubles(R.score_requests(fx.requests(spark, sf_dir), fx.user_factors(spark, sf_dir),
                                          fx.item_factors(spark, sf_dir)))


@register("recommend", _sql(f"""WITH {_P0},
s AS (SELECT u.user_idx, i.item_idx, u.bias + i.bias + list_dot_product(u.factors, i.factors) AS logit
  FROM user_factors u, item_factors i WHERE u.user_idx IN (SELECT user_id FROM requests)),
tk AS (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY logit DESC, item_idx) AS rank FROM s),
ptop AS (SELECT itemid, popularity, row_number() OVER (ORDER BY popularity DESC, itemid) AS rank FROM pop)
SELECT tk.user_idx AS user_id, tk.item_idx AS item_id, round(1 / (1 + exp(-logit)), 6) AS score, rank,
  false AS cold_start FROM tk JOIN requests q ON q.user_id = tk.user_idx WHERE rank <= q.k
UNION ALL
SELECT q.user_id, ptop.itemid, round(ptop.popularity, 6), ptop.rank, true FROM requests q JOIN ptop ON ptop.rank <= q.k
WHERE q.user_id NOT IN (SELECT user_idx FROM user_factors)""", "interactions_raw", "requests"))
def q_recommend(spark, sf_dir):
    """As many recommendations for each request as its own k."""
    req = fx.requests(spark, sf_dir)
    return round_doubles(R.recommend(req, fx.user_factors(spark, sf_dir), fx.item_factors(spark, sf_dir),
                                     _popularity(spark, sf_dir), K))


@register("decode_index", fx.with_views("""
WITH w AS (SELECT *, CASE event WHEN 'view' THEN 1e0 WHEN 'addtocart' THEN 2e0 WHEN 'transaction' THEN 3e0 ELSE 0e0 END
  AS weight FROM interactions_raw),
i AS (SELECT itemid, CAST(row_number() OVER (ORDER BY itemid) - 1 AS BIGINT) AS item_idx FROM (SELECT DISTINCT itemid FROM w)),
p AS (SELECT item_idx, sum(weight) AS s FROM w JOIN i USING (itemid) GROUP BY item_idx),
t AS (SELECT item_idx, s / (SELECT max(s) FROM p) AS popularity FROM p ORDER BY popularity DESC, item_idx LIMIT 10)
SELECT i.itemid, t.popularity FROM t JOIN i USING (item_idx)""", "interactions_raw"))
def q_decode(spark, sf_dir):
    """Popularity ranked in index space, then decoded back to external item ids."""
    inter, _, items = I.process(fx.interactions_raw(spark, sf_dir), "weighted")
    top = I.popular_top_k(I.popular_items(inter, item_col="item_idx"), K, item_col="item_idx")
    return R.decode_index(top, items, "item_idx", "itemid").select("itemid", "popularity")


# --- N: ranking metrics ------------------------------------------------------------------------

def _metrics(spark, sf_dir, variant="model", per_user=False, truth=None):
    tr = truth if truth is not None else fx.truth(spark, sf_dir)
    return round_doubles(N.ranking_metrics(top_k(spark, sf_dir), tr, K, variant=variant, per_user=per_user))


for _name in ("hit_rate", "ndcg", "precision", "recall", "mrr"):
    register(f"{_name}_at_k", _sql(f"WITH {_TOPK}, {_rank_sql()} {_rm_select((_name,))}"))(
        lambda spark, sf_dir, _n=_name: _metrics(spark, sf_dir).select(f"{_n}_{K}"))

register("ranking_metrics", _sql(f"WITH {_TOPK}, {_rank_sql()} {_rm_select()}"))(_metrics)
register("baseline_ranking_metrics", _sql(f"WITH {_TOPK}, {_rank_sql('baseline')} {_rm_select()}"))(
    lambda spark, sf_dir: _metrics(spark, sf_dir, "baseline"))
register("hit_rate_per_user", _sql(f"WITH {_TOPK}, {_rank_sql(per_user=True)} {_rm_select(('hit_rate',))}"))(
    lambda spark, sf_dir: _metrics(spark, sf_dir, per_user=True).select(f"hit_rate_{K}"))

@register("ndcg_sampled", _sql(f"""WITH {_TOPK},
st AS (SELECT user_idx, item_idx FROM truth),
{_rank_sql(truth='st')} {_rm_select(('ndcg',))}"""))
def q_ndcg_sampled(spark, sf_dir):
    """NDCG@10 through the sampling operator, with every positive in the sample."""
    st = N.hash_sample(fx.truth(spark, sf_dir), None, ["user_idx", "item_idx"])
    return _metrics(spark, sf_dir, truth=st).select(f"ndcg_{K}")


@register("ndcg_sampled_100", _sql(f"""WITH {_TOPK},
st AS (SELECT user_idx, item_idx FROM truth
  ORDER BY ((user_idx * 7919 + item_idx * 104729 + 42 * 1299709) % 1000003) / 1000003e0, user_idx, item_idx LIMIT 100),
{_rank_sql(truth='st')} {_rm_select(('ndcg',))}"""))
def q_ndcg_sampled_100(spark, sf_dir):
    """NDCG@10 on a sample of 100 positives."""
    st = N.hash_sample(fx.truth(spark, sf_dir), 100, ["user_idx", "item_idx"])
    return _metrics(spark, sf_dir, truth=st).select(f"ndcg_{K}")


@register("sampled_users_20", _sql(f"""WITH {_TOPK},
su AS (SELECT user_idx FROM (SELECT DISTINCT user_idx FROM truth)
  ORDER BY ((user_idx * 7919 + 42 * 1299709) % 1000003) / 1000003e0, user_idx LIMIT 20),
st AS (SELECT * FROM truth WHERE user_idx IN (SELECT user_idx FROM su)),
{_rank_sql('baseline', truth='st')} {_rm_select()}"""))
def q_sampled_users_20(spark, sf_dir):
    """Baseline ranking metrics of a sample of 20 users."""
    truth = N.sampled_truth_users(fx.truth(spark, sf_dir), 20)
    return _metrics(spark, sf_dir, "baseline", truth=truth)


@register("sampled_user_eval", _sql(f"""WITH {_TOPK},
su AS (SELECT DISTINCT user_idx FROM truth),
st AS (SELECT * FROM truth WHERE user_idx IN (SELECT user_idx FROM su)),
ev AS (SELECT user_idx, item_idx, max(y) AS y_true FROM (
  SELECT user_idx, item_idx, 1 AS y FROM st UNION ALL
  SELECT user_idx, item_idx, 0 FROM tk WHERE user_idx IN (SELECT user_idx FROM su)) GROUP BY user_idx, item_idx),
sc AS (SELECT ev.*, 1 / (1 + exp(-(u.bias + i.bias + list_dot_product(u.factors, i.factors)))) AS y_proba
  FROM ev JOIN user_factors u USING (user_idx) JOIN item_factors i USING (item_idx)),
g AS (SELECT y_proba AS score, CAST(sum(y_true) AS DOUBLE) AS pos, CAST(count(*) - sum(y_true) AS DOUBLE) AS neg
  FROM sc GROUP BY y_proba),
ca AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS nc,
  sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS pcd,
  sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ncd FROM g),
au AS (SELECT sum(pos * (nc - neg + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc,
  sum(pos * pcd / (pcd + ncd)) / sum(pos) AS average_precision FROM ca),
{_rank_sql('baseline', truth='st')}
SELECT round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision,
  {', '.join(f'round({c}_{K}, 6) AS {c}_{K}' for c in ('hit_rate', 'ndcg', 'precision', 'recall', 'mrr'))}
FROM au, rm"""))
def q_sampled_user_eval(spark, sf_dir):
    """AUC / AP of truth vs recommended pairs and baseline ranking metrics through the user
    sampling operator, with every user in the sample."""
    truth = N.sampled_truth_users(fx.truth(spark, sf_dir))
    users = truth.select("user_idx").distinct()
    uf, itf = fx.user_factors(spark, sf_dir), fx.item_factors(spark, sf_dir)
    # read by the unseen pairs and the metrics: written once
    tk = cut_lineage(R.top_k_scores(uf.join(users, "user_idx", "left_semi"), itf, K))
    unseen = tk.join(N.truth_hits(tk, truth), ["user_idx", "item_idx"], "left_anti").select("user_idx", "item_idx").distinct()
    # truth rows are counted where they are made; they leave as ids for their scores and as counts by score after that
    ev = (truth.groupBy("user_idx", "item_idx").agg(F.lit(1).alias("y_true"))
          .unionByName(unseen.select("user_idx", "item_idx", F.lit(0).alias("y_true"))))
    sc = R.score_pairs(ev, uf, itf).select("y_true", F.col("score").alias("y_proba"))
    rm = N.ranking_metrics(tk, truth, K, variant="baseline")
    # attach the two rank metrics, one row, as scalar subqueries
    ranks = cut_lineage(M.rank_scores(sc))
    return round_doubles(rm.select(ranks.select("roc_auc").scalar().alias("roc_auc"),
                                   ranks.select("average_precision").scalar().alias("average_precision"), "*"))


@register("unseen_pairs", _sql(f"""WITH {_TOPK}
SELECT user_idx, item_idx, rank FROM tk WHERE NOT EXISTS
  (SELECT 1 FROM truth t WHERE t.user_idx = tk.user_idx AND t.item_idx = tk.item_idx)"""))
def q_unseen_pairs(spark, sf_dir):
    """Recommended (user, item) candidates that are not known positives (anti join)."""
    tk = cut_lineage(top_k(spark, sf_dir).select("user_idx", "item_idx", "rank"))
    return tk.join(N.truth_hits(tk, fx.truth(spark, sf_dir)), ["user_idx", "item_idx"], "left_anti")


@register("discount", _sql(f"""WITH {_TOPK}
SELECT user_idx, item_idx, rank, round(1 / log2(rank + 1), 6) AS discount FROM tk"""))
def q_discount(spark, sf_dir):
    """DCG position discount 1 / log2(rank + 1) of every top-k position."""
    from orchard.functions.expressions import discount
    tk = top_k(spark, sf_dir).select("user_idx", "item_idx", "rank")
    return round_doubles(tk.withColumn("discount", discount("rank")))


@register("top_k_exclude_seen", _sql(f"""WITH s AS (SELECT u.user_idx, i.item_idx,
  u.bias + i.bias + list_dot_product(u.factors, i.factors) AS logit FROM user_factors u, item_factors i
  WHERE NOT EXISTS (SELECT 1 FROM truth t WHERE t.user_idx = u.user_idx AND t.item_idx = i.item_idx)),
tk AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY logit DESC, item_idx) AS rank FROM s)
  WHERE rank <= {K})
{_TOPK_OUT}"""))
def q_top_k_exclude_seen(spark, sf_dir):
    """Top-10 per user with the user's known positives (truth pairs) excluded."""
    return round_doubles(top_k(spark, sf_dir, exclude_seen=fx.truth(spark, sf_dir)))
