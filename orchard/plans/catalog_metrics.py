"""Queries: classification and money metrics over the two-model prediction table."""

from __future__ import annotations

from orchard.operators import business as B
from orchard.operators import classification as M
from orchard.operators.clean import predict_class
from orchard.plans.common import round_doubles
from orchard.plans.registry import register
from orchard.sources import fixtures as fx

G = ["model"]


def scored_pred(spark, sf_dir):
    return predict_class(fx.scored(spark, sf_dir), 0.5)


def _sql(body: str) -> str:
    body = body.strip()
    head = "sp AS (SELECT *, CAST(y_proba > 0.5 AS INT) AS y_pred FROM scored)"
    if body.upper().startswith("WITH "):
        body = f"WITH {head},\n{body[5:]}"
    else:
        body = f"WITH {head}\n{body}"
    return fx.with_views(body, "scored")


_CM = """cm AS (SELECT model, count_if(y_true = 0 AND y_pred = 0) AS tn, count_if(y_true = 0 AND y_pred = 1) AS fp,
  count_if(y_true = 1 AND y_pred = 0) AS fn, count_if(y_true = 1 AND y_pred = 1) AS tp FROM sp GROUP BY model)"""

_CLS = """cls AS (SELECT model, CASE WHEN tp + tn + fp + fn > 0 THEN (tp + tn) / (tp + tn + fp + fn) ELSE 0e0 END AS accuracy,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0e0 END AS f1 FROM cm)"""

_COUNTS = """g AS (SELECT model, y_proba AS score, CAST(sum(y_true) AS DOUBLE) AS pos,
  CAST(count(*) - sum(y_true) AS DOUBLE) AS neg FROM sp GROUP BY model, y_proba)"""

_AUC0 = """ca AS (SELECT *, sum(neg) OVER (PARTITION BY model ORDER BY score ROWS UNBOUNDED PRECEDING) AS neg_cum FROM g),
auc AS (SELECT model, sum(pos * (neg_cum - neg + 0.5 * neg)) / (sum(pos) * sum(neg)) AS roc_auc FROM ca GROUP BY model)"""

_DESC0 = """cd AS (SELECT *, sum(pos) OVER w AS pos_cum, sum(neg) OVER w AS neg_cum,
  sum(pos) OVER (PARTITION BY model) AS P, sum(neg) OVER (PARTITION BY model) AS N FROM g
  WINDOW w AS (PARTITION BY model ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""

_AUC = _COUNTS + ",\n" + _AUC0
_DESC = _COUNTS + ",\n" + _DESC0

_AP = """ap AS (SELECT model, sum(pos * pos_cum / (pos_cum + neg_cum)) / sum(pos) AS average_precision FROM cd GROUP BY model)"""

_BIZ = """biz AS (SELECT *, tp * 2080e0 AS churn_avoided_revenue, fp * 20e0 AS false_positive_cost,
  tp * 50e0 AS retention_cost, tp * 2080e0 - fp * 20e0 - tp * 50e0 AS net_benefit,
  CASE WHEN fp * 20e0 + tp * 50e0 > 0 THEN (tp * 2080e0 - fp * 20e0 - tp * 50e0) / (fp * 20e0 + tp * 50e0) * 100
       ELSE 0e0 END AS roi_percent FROM cm)"""

_SWEEP = """th AS (SELECT (10 + 5 * range) / 100e0 AS threshold FROM range(18)),
sw0 AS (SELECT model, threshold, count_if(y_proba >= threshold AND y_true = 1) AS tp,
  count_if(y_proba >= threshold AND y_true = 0) AS fp, count_if(y_true = 1) AS P, count_if(y_true = 0) AS N
  FROM sp, th GROUP BY model, threshold),
sw AS (SELECT model, threshold, tp, fp, P - tp AS fn, N - fp AS tn,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END AS precision,
  CASE WHEN P > 0 THEN tp / P ELSE 0e0 END AS recall, fp * 50e0 AS fp_cost, (P - tp) * 2000e0 AS fn_cost,
  tp * 2000e0 - fp * 50e0 AS net_benefit FROM sw0),
best AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY net_benefit DESC, threshold)
  AS rn FROM sw) WHERE rn = 1)"""


@register("confusion_matrix", _sql(f"WITH {_CM} SELECT * FROM cm"))
def q_cm(spark, sf_dir):
    return M.confusion_matrix(scored_pred(spark, sf_dir), G)


@register("class_metrics", _sql(f"""WITH {_CM}, {_CLS}
SELECT model, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(f1, 6) AS f1 FROM cls"""))
def q_class_metrics(spark, sf_dir):
    return round_doubles(M.class_metrics(scored_pred(spark, sf_dir), G))


@register("classification_report", _sql(f"""WITH {_CM},
p AS (SELECT model, tp, fp, fn, tn, tp + fp + fn + tn AS n,
  CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0e0 END AS p0, CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0e0 END AS r0,
  CASE WHEN 2 * tn + fn + fp > 0 THEN 2 * tn / (2 * tn + fn + fp) ELSE 0e0 END AS f0, tn + fp AS s0,
  CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0e0 END AS p1, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0e0 END AS r1,
  CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0e0 END AS f1, tp + fn AS s1 FROM cm)
SELECT model, '0' AS class, round(p0, 6) AS precision, round(r0, 6) AS recall, round(f0, 6) AS f1, s0 AS support FROM p
UNION ALL SELECT model, '1', round(p1, 6), round(r1, 6), round(f1, 6), s1 FROM p
UNION ALL SELECT model, 'accuracy', NULL, NULL, round(CASE WHEN n > 0 THEN (tp + tn) / n ELSE 0e0 END, 6), n FROM p
UNION ALL SELECT model, 'macro avg', round((p0 + p1) / 2, 6), round((r0 + r1) / 2, 6), round((f0 + f1) / 2, 6), n FROM p
UNION ALL SELECT model, 'weighted avg', round((p0 * s0 + p1 * s1) / n, 6), round((r0 * s0 + r1 * s1) / n, 6),
  round((f0 * s0 + f1 * s1) / n, 6), n FROM p"""))
def q_class_report(spark, sf_dir):
    return round_doubles(M.classification_report(scored_pred(spark, sf_dir), G))


@register("roc_auc", _sql(f"WITH {_AUC} SELECT model, round(roc_auc, 6) AS roc_auc FROM auc"))
def q_auc(spark, sf_dir):
    return round_doubles(M.roc_auc(fx.scored(spark, sf_dir), G))


@register("average_precision", _sql(f"WITH {_DESC}, {_AP} SELECT model, round(average_precision, 6) AS average_precision FROM ap"))
def q_ap(spark, sf_dir):
    return round_doubles(M.average_precision(fx.scored(spark, sf_dir), G))


@register("roc_curve", _sql(f"""WITH {_DESC}
SELECT model, score AS threshold, round(CASE WHEN N > 0 THEN neg_cum / N ELSE 0e0 END, 6) AS fpr,
  round(CASE WHEN P > 0 THEN pos_cum / P ELSE 0e0 END, 6) AS tpr FROM cd"""))
def q_roc_curve(spark, sf_dir):
    return round_doubles(M.roc_curve(fx.scored(spark, sf_dir), G))


@register("pr_curve", _sql(f"""WITH {_DESC}
SELECT model, score AS threshold, round(pos_cum / (pos_cum + neg_cum), 6) AS precision,
  round(CASE WHEN P > 0 THEN pos_cum / P ELSE 0e0 END, 6) AS recall FROM cd"""))
def q_pr_curve(spark, sf_dir):
    return round_doubles(M.pr_curve(fx.scored(spark, sf_dir), G))


@register("log_loss", _sql("""
SELECT model, round(avg(-(y_true * greatest(CASE WHEN y_proba > 0 THEN ln(y_proba) END, -100e0)
  + (1 - y_true) * greatest(CASE WHEN y_proba < 1 THEN ln(1 - y_proba) END, -100e0))), 6) AS log_loss
FROM sp GROUP BY model"""))
def q_log_loss(spark, sf_dir):
    return round_doubles(M.log_loss(fx.scored(spark, sf_dir), G))


@register("business_metrics", _sql(f"WITH {_CM}, {_BIZ} SELECT * REPLACE (round(roi_percent, 6) AS roi_percent) FROM biz"))
def q_business(spark, sf_dir):
    return round_doubles(B.business_metrics(scored_pred(spark, sf_dir), G))


@register("all_churn_metrics", _sql(f"""WITH {_CM}, {_CLS}, {_BIZ}, {_COUNTS}, {_AUC0}, {_DESC0}, {_AP}
SELECT model, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision,
  round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  tn, fp, fn, tp, churn_avoided_revenue, false_positive_cost, retention_cost, net_benefit,
  round(roi_percent, 6) AS roi_percent
FROM auc JOIN ap USING (model) JOIN cls USING (model) JOIN biz USING (model)"""))
def q_all_churn(spark, sf_dir):
    return round_doubles(B.all_churn_metrics(scored_pred(spark, sf_dir), G))


@register("threshold_sweep", _sql(f"""WITH {_SWEEP}
SELECT * REPLACE (round(precision, 6) AS precision, round(recall, 6) AS recall) FROM sw"""))
def q_sweep(spark, sf_dir):
    return round_doubles(M.threshold_sweep(fx.scored(spark, sf_dir), G))


@register("best_threshold", _sql(f"""WITH {_SWEEP}
SELECT * REPLACE (round(precision, 6) AS precision, round(recall, 6) AS recall) FROM best"""))
def q_best_threshold(spark, sf_dir):
    return round_doubles(M.best_threshold(M.threshold_sweep(fx.scored(spark, sf_dir), G), G))


@register("recommended_model", _sql(f"""WITH {_SWEEP}
SELECT * REPLACE (round(precision, 6) AS precision, round(recall, 6) AS recall) FROM best
ORDER BY net_benefit DESC, model LIMIT 1"""))
def q_recommended(spark, sf_dir):
    best = M.best_threshold(M.threshold_sweep(fx.scored(spark, sf_dir), G), G)
    return round_doubles(M.recommended_model(best))


@register("leaderboard", _sql(f"""WITH {_CM}, {_CLS}, {_COUNTS}, {_AUC0}, {_DESC0}, {_AP}
SELECT model, round(roc_auc, 6) AS roc_auc, round(average_precision, 6) AS average_precision,
  round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
  row_number() OVER (ORDER BY roc_auc DESC, model) AS rank
FROM auc JOIN ap USING (model) JOIN cls USING (model)"""))
def q_leaderboard(spark, sf_dir):
    return round_doubles(M.leaderboard(scored_pred(spark, sf_dir), G))
