"""Queries: run metrics computed from the event log, pending grid, champion decision,
early stopping, comparison table, flat report."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.operators import experiments as X
from orchard.plans.catalog_features import negatives_sql
from orchard.plans.common import rank_metrics_sql, round_doubles
from orchard.plans.registry import register
from orchard.sources import fixtures as fx

K = 10
STRATEGIES = ("weighted", "binary", "implicit")
MODEL_TYPES = ["mf", "gmf", "ncf", "popularity"]


def run_metrics(spark, sf_dir):
    return X.popularity_run_metrics(fx.interactions_raw(spark, sf_dir), STRATEGIES, K)


def _strategy_ctes(s: str) -> str:
    where = "WHERE event IN ('addtocart', 'transaction')" if s == "binary" else ""
    p = f"{s[0]}_"
    return f"""{p}b AS (SELECT * FROM interactions_raw {where}),
{p}ui AS (SELECT visitorid, CAST(row_number() OVER (ORDER BY visitorid) - 1 AS BIGINT) AS user_idx
  FROM (SELECT DISTINCT visitorid FROM {p}b)),
{p}ii AS (SELECT itemid, CAST(row_number() OVER (ORDER BY itemid) - 1 AS BIGINT) AS item_idx
  FROM (SELECT DISTINCT itemid FROM {p}b)),
{p}x AS (SELECT event_id, u.user_idx, i.item_idx,
  CASE WHEN ((u.user_idx * 7919 + i.item_idx * 104729 + 42 * 1299709) % 1000003) / 1000003e0 < 0.8
  THEN 'train' ELSE 'validation' END AS split FROM {p}b JOIN {p}ui u USING (visitorid) JOIN {p}ii i USING (itemid)),
{p}pc AS (SELECT item_idx, CAST(count(*) AS DOUBLE) AS s FROM {p}x WHERE split = 'train' GROUP BY item_idx),
{p}pop AS (SELECT item_idx, CASE WHEN (SELECT max(s) FROM {p}pc) > 0 THEN s / (SELECT max(s) FROM {p}pc) ELSE s END
  AS popularity FROM {p}pc),
{p}top AS (SELECT item_idx, row_number() OVER (ORDER BY popularity DESC, item_idx) AS rank FROM {p}pop
  ORDER BY popularity DESC, item_idx LIMIT {K}),
{p}val AS (SELECT event_id, user_idx, item_idx FROM {p}x WHERE split = 'validation'),
{negatives_sql(p, f"{p}val", f"{p}x", f"{p}ii", X.N_NEGATIVES)},
{p}sc AS (SELECT coalesce(popularity, 0e0) AS score, y FROM (SELECT item_idx, 1 AS y FROM {p}val
  UNION ALL SELECT item_idx, 0 FROM {p}neg) LEFT JOIN {p}pop USING (item_idx)),
{p}g AS (SELECT score, CAST(sum(y) AS DOUBLE) AS pos, CAST(count(*) - sum(y) AS DOUBLE) AS neg FROM {p}sc GROUP BY score),
{p}ca AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS UNBOUNDED PRECEDING) AS nc,
  sum(pos) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS pcd,
  sum(neg) OVER (ORDER BY score DESC ROWS UNBOUNDED PRECEDING) AS ncd FROM {p}g),
{p}au AS (SELECT sum(pos * (nc - neg + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc,
  sum(pos * pcd / (pcd + ncd)) / sum(pos) AS average_precision FROM {p}ca),
{p}tk AS (SELECT v.user_idx, t.item_idx, t.rank FROM (SELECT DISTINCT user_idx FROM {p}val) v, {p}top t),
{rank_metrics_sql(p, f"{p}val", f"{p}tk", K, "baseline", suffix=False)},
{p}wide AS (SELECT * FROM {p}rm, {p}au),
{p}long AS (UNPIVOT {p}wide ON hit_rate, ndcg, precision, recall, mrr, roc_auc, average_precision INTO NAME metric VALUE value)"""


_RUN_METRICS = ",\n".join(_strategy_ctes(s) for s in STRATEGIES) + ",\nrm_all AS (" + "\nUNION ALL\n".join(
    f"SELECT 'popularity_{s}' AS run, 'popularity' AS model_type, '{s}' AS processor, metric, value "
    f"FROM {s[0]}_long" for s in STRATEGIES) + ")"


def _sql(body: str) -> str:
    body = body.strip()
    body = f"WITH {_RUN_METRICS},\n{body[5:]}" if body.upper().startswith("WITH ") else f"WITH {_RUN_METRICS}\n{body}"
    return fx.with_views(body, "interactions_raw")


@register("popularity_run_metrics", _sql("SELECT run, model_type, processor, metric, round(value, 6) AS value FROM rm_all"))
def q_run_metrics(spark, sf_dir):
    return round_doubles(run_metrics(spark, sf_dir))


@register("pending_experiments", _sql(
    "SELECT m.model_type, p.processor FROM (SELECT unnest(['" + "', '".join(MODEL_TYPES) + "']) AS model_type) m, "
    "(SELECT unnest(['" + "', '".join(STRATEGIES) + "']) AS processor) p "
    "WHERE NOT EXISTS (SELECT 1 FROM rm_all r WHERE r.model_type = m.model_type AND r.processor = p.processor)"))
def q_pending(spark, sf_dir):
    grid = X.experiment_grid(spark, MODEL_TYPES, list(STRATEGIES))
    return X.pending_experiments(grid, run_metrics(spark, sf_dir))


@register("champion_decision", _sql("""
WITH inc AS (SELECT max(value) AS v FROM rm_all WHERE run = 'popularity_weighted' AND metric = 'ndcg'),
cand AS (SELECT r.run, (SELECT max(value) FROM rm_all m WHERE m.run = r.run AND m.metric = 'ndcg') AS candidate_value
  FROM (SELECT DISTINCT run FROM rm_all WHERE run <> 'popularity_weighted') r)
SELECT run, round(candidate_value, 6) AS candidate_value, round((SELECT v FROM inc), 6) AS incumbent_value,
  CASE WHEN candidate_value IS NULL THEN false WHEN (SELECT v FROM inc) IS NULL THEN true
       ELSE candidate_value > (SELECT v FROM inc) END AS promote FROM cand"""))
def q_champion(spark, sf_dir):
    """Challengers vs the incumbent (the weighted-strategy run) on NDCG."""
    return round_doubles(X.champion_decision(run_metrics(spark, sf_dir), "ndcg", "popularity_weighted", True))


@register("comparison_table", _sql(f"""
SELECT run, model_type, processor, {', '.join(f"round(max(CASE WHEN metric = '{m}' THEN value END), 6) AS {m}"
                                              for m in X.METRICS)}
FROM rm_all GROUP BY run, model_type, processor"""))
def q_comparison(spark, sf_dir):
    return round_doubles(X.comparison_table(run_metrics(spark, sf_dir)))


@register("metrics_report", _sql("SELECT run || '_' || metric AS key, round(value, 6) AS value FROM rm_all"))
def q_report(spark, sf_dir):
    return round_doubles(X.metrics_report(run_metrics(spark, sf_dir)))


def epoch_metrics(spark, sf_dir):
    """Per-epoch metric sequences derived from the prediction log: run = user_id mod 4,
    epoch = batch_id + 1, value = mean score of that batch."""
    log = fx.prediction_log(spark, sf_dir)
    return (log.groupBy(F.concat(F.lit("run_"), (F.col("user_id") % 4).cast("string")).alias("run"),
                        (F.col("batch_id") + 1).cast("int").alias("epoch"))
            .agg(F.avg("score").alias("value")).withColumn("metric", F.lit("train_loss")))


_EPOCH_SQL = """em AS (SELECT 'run_' || CAST(user_id % 4 AS VARCHAR) AS run, CAST(batch_id + 1 AS INT) AS epoch,
  avg(score) AS value FROM prediction_log GROUP BY ALL),
e1 AS (SELECT *, min(value) OVER (PARTITION BY run ORDER BY epoch ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
  AS prev_best FROM em),
e2 AS (SELECT *, prev_best IS NULL OR value < prev_best AS improved FROM e1),
e3 AS (SELECT *, max(CASE WHEN improved THEN epoch END) OVER (PARTITION BY run ORDER BY epoch
  ROWS UNBOUNDED PRECEDING) AS last_imp FROM e2),
e4 AS (SELECT *, epoch - last_imp AS bad FROM e3),
stop AS (SELECT run, min(CASE WHEN bad >= 3 THEN epoch END) AS stop_epoch FROM e4 GROUP BY run),
fin AS (SELECT e4.run, e4.epoch, e4.bad, e4.last_imp, s.stop_epoch FROM e4 JOIN stop s USING (run)
  WHERE e4.epoch = coalesce(s.stop_epoch, (SELECT max(epoch) FROM em m WHERE m.run = e4.run)))"""


@register("early_stop_point", fx.with_views(f"""WITH {_EPOCH_SQL}
SELECT f.run, round((SELECT value FROM em WHERE em.run = f.run AND em.epoch = f.last_imp), 6) AS best_value,
  CAST(f.last_imp AS INT) AS best_epoch, CAST(f.bad AS INT) AS num_bad_epochs, CAST(f.stop_epoch AS INT) AS stop_epoch
FROM fin f""", "prediction_log"))
def q_early_stop(spark, sf_dir):
    """Early stopping (mode min, patience 3) replayed over each run's epoch sequence."""
    return round_doubles(X.early_stop_point(epoch_metrics(spark, sf_dir), patience=3, mode="min"))


@register("early_stop_min_delta", fx.with_views("""WITH em AS (
  SELECT 'run_' || CAST(user_id % 4 AS VARCHAR) AS run, CAST(batch_id + 1 AS INT) AS epoch, round(avg(score), 4) AS value
  FROM prediction_log GROUP BY ALL)
SELECT e.run, r.best_value, r.best_epoch, r.num_bad_epochs, r.stop_epoch
FROM (SELECT DISTINCT run FROM em) e, LATERAL (WITH RECURSIVE st AS (
  SELECT 1 AS n, value AS best, epoch AS hit, 0 AS bad, CAST(NULL AS INT) AS stop FROM em WHERE em.run = e.run AND epoch = 1
  UNION ALL
  SELECT n + 1, CASE WHEN value > best + 0.002 THEN value ELSE best END, CASE WHEN value > best + 0.002 THEN epoch ELSE hit END,
    CASE WHEN value > best + 0.002 THEN 0 ELSE bad + 1 END,
    CASE WHEN value <= best + 0.002 AND bad + 1 >= 2 THEN epoch END
  FROM st JOIN em ON em.run = e.run AND em.epoch = st.n + 1 WHERE stop IS NULL)
  SELECT arg_max(best, n) AS best_value, arg_max(hit, n) AS best_epoch, arg_max(bad, n) AS num_bad_epochs,
    max(stop) AS stop_epoch FROM st) r""", "prediction_log"))
def q_early_stop_min_delta(spark, sf_dir):
    """Early stopping of a metric that shall rise by more than 0.002, patience 2, over each run's epochs."""
    em = epoch_metrics(spark, sf_dir).withColumn("value", F.round("value", 4))
    return X.early_stop_point(em, patience=2, mode="max", min_delta=0.002)
