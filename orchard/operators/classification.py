"""Binary-classification metrics over (group..., y_true, y_pred / y_proba) tables.

All metrics are grouped aggregates keyed by ``group_cols`` (e.g. ``model``) so several
models are evaluated in one pass. Rank metrics (ROC AUC, average precision, curves) first
collapse rows to one row per distinct score and then use distributed running sums, so
ties are exact and no global ``ORDER BY`` runs in a single task.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.operators.prefix import running_sums
from orchard.session import cut_lineage


def _safe_div(a: Column, b: Column) -> Column:
    return F.when(b != 0, a / b).otherwise(F.lit(0.0))


def confusion_matrix(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true",
                     y_pred="y_pred") -> DataFrame:
    """tn, fp, fn, tp per group (conditional counts, one pass)."""
    g = list(group_cols or [])
    t, p = F.col(y_true), F.col(y_pred)
    return df.groupBy(*g).agg(F.count_if((t == 0) & (p == 0)).alias("tn"),
                              F.count_if((t == 0) & (p == 1)).alias("fp"),
                              F.count_if((t == 1) & (p == 0)).alias("fn"),
                              F.count_if((t == 1) & (p == 1)).alias("tp"))


def metrics_from_confusion(cm: DataFrame) -> DataFrame:
    """accuracy, precision, recall, F1 from tn/fp/fn/tp; an undefined ratio is 0."""
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    prec = _safe_div(tp, tp + fp)
    rec = _safe_div(tp, tp + fn)
    return (cm.withColumn("accuracy", _safe_div(tp + tn, tp + tn + fp + fn))
            .withColumn("precision", prec).withColumn("recall", rec)
            .withColumn("f1", _safe_div(2 * tp, 2 * tp + fp + fn)))


def class_metrics(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true",
                  y_pred="y_pred") -> DataFrame:
    g = list(group_cols or [])
    m = metrics_from_confusion(confusion_matrix(df, g, y_true, y_pred))
    return m.select(*g, "accuracy", "precision", "recall", "f1")


def classification_report(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true",
                          y_pred="y_pred") -> DataFrame:
    """Per class precision / recall / F1 / support, accuracy, macro and weighted averages."""
    g = list(group_cols or [])
    cm = confusion_matrix(df, g, y_true, y_pred)
    tp, fp, fn, tn = (F.col(c).cast("double") for c in ("tp", "fp", "fn", "tn"))
    # class 1 is the positive class as is; class 0 swaps the roles
    c1 = (_safe_div(tp, tp + fp), _safe_div(tp, tp + fn), _safe_div(2 * tp, 2 * tp + fp + fn), tp + fn)
    c0 = (_safe_div(tn, tn + fn), _safe_div(tn, tn + fp), _safe_div(2 * tn, 2 * tn + fn + fp), tn + fp)
    n = tp + fp + fn + tn

    def row(label, p, r, f, s):
        return F.struct(F.lit(label).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1"), s.cast("long").alias("support"))

    rows = F.array(
        row("0", *c0), row("1", *c1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), _safe_div(tp + tn, n), n),
        row("macro avg", (c0[0] + c1[0]) / 2, (c0[1] + c1[1]) / 2, (c0[2] + c1[2]) / 2, n),
        row("weighted avg", _safe_div(c0[0] * c0[3] + c1[0] * c1[3], n), _safe_div(c0[1] * c0[3] + c1[1] * c1[3], n),
            _safe_div(c0[2] * c0[3] + c1[2] * c1[3], n), n))
    return cm.select(*g, F.explode(rows).alias("r")).select(*g, "r.*")


def score_counts(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true",
                 score="y_proba") -> DataFrame:
    """One row per (group, distinct score): pos / neg counts as doubles."""
    g = list(group_cols or [])
    return df.groupBy(*g, F.col(score).alias("score")).agg(
        F.sum(F.col(y_true).cast("double")).alias("pos"),
        F.sum((1 - F.col(y_true)).cast("double")).alias("neg"))


def _ranked_counts(df, group_cols, y_true, score, descending):
    # read by the cut points, the windows and the range totals: materialised once
    sc = cut_lineage(score_counts(df, group_cols, y_true, score))
    return running_sums(sc, "score", ["pos", "neg"], group_cols=group_cols, descending=descending)


def _with_totals(rc: DataFrame, g: list[str]) -> DataFrame:
    """Attach per-group positive / negative totals (_P, _N)."""
    if not g:
        return rc.withColumn("_P", rc.select(F.sum("pos")).scalar()).withColumn(
            "_N", rc.select(F.sum("neg")).scalar())
    return rc.join(rc.groupBy(*g).agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N")), g)


def roc_auc(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true", score="y_proba") -> DataFrame:
    """Tie-aware ROC AUC: sum over scores of pos * (neg below + neg tied / 2) / (P * N)."""
    g = list(group_cols or [])
    rc = _ranked_counts(df, g, y_true, score, descending=False)
    neg_below = F.col("neg_cum") - F.col("neg")
    return rc.groupBy(*g).agg(
        (F.sum(F.col("pos") * (neg_below + 0.5 * F.col("neg"))) / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def average_precision(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true",
                      score="y_proba") -> DataFrame:
    """Step-wise AP: sum over thresholds (descending) of recall gain x precision."""
    g = list(group_cols or [])
    rc = _ranked_counts(df, g, y_true, score, descending=True)
    prec = F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))
    return rc.groupBy(*g).agg((F.sum(F.col("pos") * prec) / F.sum("pos")).alias("average_precision"))


def rank_scores(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true", score="y_proba") -> DataFrame:
    """``roc_auc`` and ``average_precision`` from one ranking: a descending count is the total less those below."""
    g = list(group_cols or [])
    rc = _with_totals(_ranked_counts(df, g, y_true, score, descending=False), g)
    above_pos = F.col("_P") - F.col("pos_cum") + F.col("pos")
    above_neg = F.col("_N") - F.col("neg_cum") + F.col("neg")
    neg_below = F.col("neg_cum") - F.col("neg")
    return rc.groupBy(*g).agg(
        (F.sum(F.col("pos") * (neg_below + 0.5 * F.col("neg"))) / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"),
        (F.sum(F.col("pos") * (above_pos / (above_pos + above_neg))) / F.sum("pos")).alias("average_precision"))


def roc_curve(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true", score="y_proba") -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score (predict 1 when score >= threshold)."""
    g = list(group_cols or [])
    rc = _ranked_counts(df, g, y_true, score, descending=True)
    j = _with_totals(rc, g)
    return j.select(*g, F.col("score").alias("threshold"),
                    _safe_div(F.col("neg_cum"), F.col("_N")).alias("fpr"),
                    _safe_div(F.col("pos_cum"), F.col("_P")).alias("tpr"))


def pr_curve(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true", score="y_proba") -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    g = list(group_cols or [])
    rc = _ranked_counts(df, g, y_true, score, descending=True)
    j = _with_totals(rc, g)
    return j.select(*g, F.col("score").alias("threshold"),
                    (F.col("pos_cum") / (F.col("pos_cum") + F.col("neg_cum"))).alias("precision"),
                    _safe_div(F.col("pos_cum"), F.col("_P")).alias("recall"))


def log_loss(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true", score="y_proba") -> DataFrame:
    """Mean binary cross-entropy with each log clamped at -100 (log 0 -> -100)."""
    g = list(group_cols or [])
    y = F.col(y_true).cast("double")
    p = F.col(score).cast("double")
    lp = F.greatest(F.when(p > 0, F.log(p)), F.lit(-100.0))
    lq = F.greatest(F.when(p < 1, F.log(1 - p)), F.lit(-100.0))
    return df.groupBy(*g).agg(F.avg(-(y * lp + (1 - y) * lq)).alias("log_loss"))


def sweep_thresholds(n: int = 18, start: int = 10, step: int = 5) -> list[float]:
    """0.10, 0.15, ..., 0.95 built as (10 + 5 i) / 100."""
    return [(start + step * i) / 100.0 for i in range(n)]


def threshold_sweep(df: DataFrame, group_cols: list[str] | None = None, thresholds: list[float] | None = None,
                    cost_fp: float = 50.0, cost_fn: float = 2000.0, y_true="y_true",
                    score="y_proba") -> DataFrame:
    """Confusion counts, precision, recall, costs and net benefit (tp*cost_fn - fp*cost_fp)
    at each threshold (predict 1 when score >= threshold).

    One scan with two conditional counters per threshold, then one row per threshold.
    """
    g = list(group_cols or [])
    ths = thresholds or sweep_thresholds()
    y, s = F.col(y_true), F.col(score)
    aggs = [F.count_if(y == 1).alias("_P"), F.count_if(y == 0).alias("_N")]
    for i, t in enumerate(ths):
        aggs += [F.count_if((s >= t) & (y == 1)).alias(f"_tp{i}"), F.count_if((s >= t) & (y == 0)).alias(f"_fp{i}")]
    wide = df.groupBy(*g).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"_tp{i}").alias("tp"), F.col(f"_fp{i}").alias("fp"))
                     for i, t in enumerate(ths)])
    long = wide.select(*g, "_P", "_N", F.explode(rows).alias("r")).select(*g, "_P", "_N", "r.*")
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("_P") - tp
    tn = F.col("_N") - fp
    return long.select(
        *g, "threshold", "tp", "fp", fn.alias("fn"), tn.alias("tn"),
        _safe_div(tp.cast("double"), (tp + fp).cast("double")).alias("precision"),
        _safe_div(tp.cast("double"), F.col("_P").cast("double")).alias("recall"),
        (fp * F.lit(cost_fp)).alias("fp_cost"), (fn * F.lit(cost_fn)).alias("fn_cost"),
        (tp * F.lit(cost_fn) - fp * F.lit(cost_fp)).alias("net_benefit"))


def best_threshold(sweep: DataFrame, group_cols: list[str]) -> DataFrame:
    """First maximum of net benefit per group (ties -> lowest threshold)."""
    w = Window.partitionBy(*group_cols).orderBy(F.col("net_benefit").desc(), F.col("threshold").asc())
    return sweep.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def recommended_model(best: DataFrame, model_col: str = "model") -> DataFrame:
    """The model with the greatest best net benefit (ties -> first model name)."""
    return best.orderBy(F.col("net_benefit").desc(), F.col(model_col).asc()).limit(1)


def rank_and_class_summary(df: DataFrame, group_cols: list[str], y_true="y_true", y_pred="y_pred",
                           score="y_proba", keep_confusion: bool = False) -> DataFrame:
    """AUC, AP, accuracy, precision, recall, F1 per group from ONE pass over the predictions.

    Rows collapse to (group, score, y_pred) counts; confusion counts come from that small
    table, and AUC and AP from one ascending running-sum pass over its distinct scores
    (AP uses the counts at or above each score: P - positives below, N - negatives below).
    """
    g = list(group_cols)
    t = F.col(y_true)
    sc = cut_lineage(df.groupBy(*g, F.col(score).alias("score"), F.col(y_pred).alias("_yp")).agg(
        F.sum(t.cast("double")).alias("pos"), F.sum((1 - t).cast("double")).alias("neg")))
    cm = sc.groupBy(*g).agg(
        F.sum(F.when(F.col("_yp") == 0, F.col("neg")).otherwise(0.0)).cast("long").alias("tn"),
        F.sum(F.when(F.col("_yp") == 1, F.col("neg")).otherwise(0.0)).cast("long").alias("fp"),
        F.sum(F.when(F.col("_yp") == 0, F.col("pos")).otherwise(0.0)).cast("long").alias("fn"),
        F.sum(F.when(F.col("_yp") == 1, F.col("pos")).otherwise(0.0)).cast("long").alias("tp"))
    per_score = sc.groupBy(*g, "score").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    rc = _with_totals(running_sums(per_score, "score", ["pos", "neg"], group_cols=g), g)
    pos_below = F.col("pos_cum") - F.col("pos")
    neg_below = F.col("neg_cum") - F.col("neg")
    tp_at = F.col("_P") - pos_below
    fp_at = F.col("_N") - neg_below
    rk = rc.groupBy(*g).agg(
        (F.sum(F.col("pos") * (neg_below + 0.5 * F.col("neg"))) / (F.first("_P") * F.first("_N"))).alias("roc_auc"),
        (F.sum(F.col("pos") * tp_at / (tp_at + fp_at)) / F.first("_P")).alias("average_precision"))
    cls = metrics_from_confusion(cm).select(*g, "accuracy", "precision", "recall", "f1", *(
        ["tn", "fp", "fn", "tp"] if keep_confusion else []))
    return rk.join(cls, g)


def model_summary(df: DataFrame, group_cols: list[str], y_true="y_true", y_pred="y_pred",
                  score="y_proba") -> DataFrame:
    """AUC, AP, accuracy, precision, recall, F1 per group."""
    return rank_and_class_summary(df, group_cols, y_true, y_pred, score)


def leaderboard(df: DataFrame, group_cols: list[str], y_true="y_true", y_pred="y_pred",
                score="y_proba") -> DataFrame:
    """Models ranked by ROC AUC (rank 1 = best; ties by name)."""
    s = model_summary(df, group_cols, y_true, y_pred, score)
    w = Window.orderBy(F.col("roc_auc").desc(), *[F.col(c).asc() for c in group_cols])
    return s.withColumn("rank", F.row_number().over(w).cast("long"))
