"""End-to-end jobs composed from the operators (the reference's stage scripts as Spark jobs)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orchard.operators import interactions as I
from orchard.sources import io


def preprocess_job(spark: SparkSession, events: DataFrame, database: str, strategy: str = "weighted",
                   min_count: int = 1, n_buckets: int | None = None, prefix: str = "") -> dict[str, str]:
    """events -> strategy -> min-interaction filter -> dense indexes -> popularity, saved as
    catalog tables. Interactions and the user index are bucketed by ``user_idx``, the item
    index and popularity by ``item_idx`` (same bucket count), so the joins of later stages
    (scoring, sampling, evaluation) on those keys need no shuffle."""
    n = n_buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    inter, users, items = I.process(events, strategy, min_count=min_count)
    pop = I.popular_items(inter, item_col="item_idx")
    t = {}
    t["interactions"] = io.write_bucketed(inter, f"{database}.{prefix}interactions", ["user_idx"], n)
    t["user_index"] = io.write_bucketed(users, f"{database}.{prefix}user_index", ["user_idx"], n)
    t["item_index"] = io.write_bucketed(items, f"{database}.{prefix}item_index", ["item_idx"], n)
    t["popularity"] = io.write_bucketed(pop, f"{database}.{prefix}popularity", ["item_idx"], n)
    return t


def evaluate_job(spark: SparkSession, tables: dict[str, str], runs_path: str, k: int = 10,
                 strategy: str = "weighted", seed: int = 42) -> DataFrame:
    """Processed tables -> pair split -> popularity and implicit-ALS recommenders -> ranking
    metrics at k; the rows (run, model_type, processor, metric, value) are appended to
    ``runs_path`` and returned."""
    from pyspark.sql import functions as F

    from orchard.operators import models as ML
    from orchard.operators import ranking as N
    from orchard.operators import recommend as R
    from orchard.operators.experiments import RANKING, run_rows
    from orchard.operators.features import sample_split
    from orchard.session import cut_lineage

    inter = spark.table(tables["interactions"])
    sx = cut_lineage(sample_split(inter, ["user_idx", "item_idx"], 0.8, seed))
    train = sx.where("split = 'train'")
    val = sx.where("split = 'validation'").select("user_idx", "item_idx")
    val_users = val.select("user_idx").distinct()
    pop = I.popular_items(train, item_col="item_idx", weight_col=None)
    top = R.popular_top_k_array(pop, k, item_col="item_idx").scalar()
    pop_topk = val_users.select("user_idx", F.explode(top).alias("t")).select(
        "user_idx", F.col("t.item").alias("item_idx"), F.col("t.rank").alias("rank"))
    u, i = ML.als_factor_tables(ML.train_als(train, seed=seed))
    als_topk = R.top_k_scores(u.join(val_users, "user_idx", "left_semi"), i, k)
    rows = []
    for model, topk in (("popularity", pop_topk), ("mf", als_topk)):
        m = N.ranking_metrics(topk, val, k, variant="baseline", suffix=False)
        rows.append(run_rows(m, f"{model}_{strategy}", model, strategy, RANKING))
    out = cut_lineage(rows[0].unionByName(rows[1]))
    io.append_run_metrics(out, runs_path)
    return out


def churn_job(spark: SparkSession, customers: DataFrame, id_col: str = "cid", label_col: str = "churn_value",
              categorical: list[str] | None = None, numeric: list[str] | None = None,
              test_fraction: float = 0.2) -> dict[str, DataFrame]:
    """Customers -> exact stratified split -> class-weighted churn model -> test metrics,
    threshold sweep and the best threshold (first maximum of net benefit)."""
    from pyspark.sql import functions as F

    from orchard.operators import classification as M
    from orchard.operators import features as H
    from orchard.operators import models as ML
    from orchard.session import cut_lineage

    cat = categorical or ["gender", "senior_citizen", "contract", "internet_service", "payment_method"]
    num = numeric or ["tenure_months", "monthly_charges", "total_charges"]
    sp = cut_lineage(H.stratified_split(customers, label_col, id_col, test_fraction).withColumnRenamed(label_col, "label"))
    model = ML.train_churn(sp.where("split = 'train'"), cat, num)
    pred = cut_lineage(ML.predictions(model, sp.where("split = 'test'")).withColumn("model", F.lit("churn")))
    sweep = M.threshold_sweep(pred, ["model"])
    return {"model": model, "metrics": M.model_summary(pred, ["model"]), "sweep": sweep,
            "best_threshold": M.best_threshold(sweep, ["model"])}


def monitor_job(spark: SparkSession, log: DataFrame, baseline_batch: int, checks_path: str,
                window: int = 1000) -> DataFrame:
    """Prediction log -> baseline as of ``baseline_batch`` -> drift and KS checks, appended to
    ``checks_path`` with the time of the check."""
    from orchard.operators import monitoring as MO

    base = MO.baseline_snapshot(log, baseline_batch, window)
    checks = MO.check_shifts(log, base, window)
    checks.write.mode("append").parquet(checks_path)
    return spark.read.parquet(checks_path)
