"""Money view of a churn classifier: value of retained customers against campaign costs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import classification as M

# Reporting cost model (customer lifetime value, retention cost per
# contacted churner, cost of a campaign sent to a non-churner).
CUSTOMER_LTV = 2080.0
RETENTION_COST = 50.0
FALSE_POSITIVE_COST = 20.0


def business_from_confusion(cm: DataFrame, ltv: float = CUSTOMER_LTV, retention: float = RETENTION_COST,
                            fp_unit: float = FALSE_POSITIVE_COST) -> DataFrame:
    """Avoided revenue, FP cost, retention cost, net benefit and ROI % (0 without cost)."""
    tp, fp = F.col("tp").cast("double"), F.col("fp").cast("double")
    avoided = tp * ltv
    fp_cost = fp * fp_unit
    ret = tp * retention
    net = avoided - fp_cost - ret
    spent = fp_cost + ret
    return cm.select("*", avoided.alias("churn_avoided_revenue"), fp_cost.alias("false_positive_cost"),
                     ret.alias("retention_cost"), net.alias("net_benefit"),
                     F.when(spent > 0, net / spent * 100).otherwise(F.lit(0.0)).alias("roi_percent"))


def business_metrics(df: DataFrame, group_cols: list[str] | None = None, y_true="y_true", y_pred="y_pred",
                     **costs) -> DataFrame:
    g = list(group_cols or [])
    return business_from_confusion(M.confusion_matrix(df, g, y_true, y_pred), **costs)


def all_churn_metrics(df: DataFrame, group_cols: list[str], y_true="y_true", y_pred="y_pred",
                      score="y_proba", **costs) -> DataFrame:
    """Technical (AUC, AP, accuracy, precision, recall, F1) and money metrics, one row per
    group, from one pass over the predictions."""
    summ = M.rank_and_class_summary(df, group_cols, y_true, y_pred, score, keep_confusion=True)
    return business_from_confusion(summ, **costs)
