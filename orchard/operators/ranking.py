"""Ranking metrics at K from a per-user top-K table and a truth table.

Inputs: ``topk(user_idx, item_idx, rank)`` with 1-based ranks <= k (see
``recommend.top_k_scores`` / ``top_k_per_user``) and ``truth(user_idx, item_idx)`` whose
duplicate rows count as separate interactions. Users are those present in the truth table.

variant="model"    precision / recall count distinct recommended hits
variant="baseline" they count every truth row that is hit (duplicates included)
Hit rate is per interaction (hits / truth rows) in both; ``per_user=True`` gives the share of
users with at least one hit. Everything is joins and grouped aggregates keyed by user: a truth table
that is partitioned by user is not shuffled, any other one once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.functions.expressions import discount, hash_unit, ideal_dcg


def truth_hits(topk: DataFrame, truth: DataFrame) -> DataFrame:
    """Truth rows counted by the top-K entry that they hit: user_idx, place, item_idx, rank, mult, n_true.

    One row per entry that is hit (``mult`` truth rows) and one per user for the rest (place, item_idx and rank null).
    ``n_true`` summed over a user's rows is the number of its truth rows. A user's entries, k of them, meet its truth
    rows as one array, so the join is on the user alone and keeps a partitioning by user.
    """
    lists = topk.groupBy("user_idx").agg(F.collect_list(F.struct("item_idx", "rank")).alias("_list")).select(
        "user_idx", F.transform("_list", lambda e, n: F.struct(n.alias("place"), e.item_idx.alias("item"), e["rank"].alias("rank")))
        .alias("_top"))
    j = truth.select("user_idx", "item_idx").join(lists.hint("shuffle_hash"), "user_idx", "left")
    rows = j.select("user_idx", F.posexplode_outer(F.filter("_top", lambda e: e["item"] == F.col("item_idx"))).alias("_n", "_hit"))
    return rows.select("user_idx", "_n", F.col("_hit.place").alias("place"), F.col("_hit.item").alias("item_idx"),
                       F.col("_hit.rank").alias("rank")).groupBy("user_idx", "place", "item_idx", "rank").agg(
        F.count(F.lit(1)).alias("mult"), F.count_if(F.coalesce("_n", F.lit(0)) == 0).alias("n_true"))


def per_user_ranking(topk: DataFrame, truth: DataFrame, k: int) -> DataFrame:
    """Per user: n_true, distinct hits, hits with duplicates, DCG, ideal DCG, reciprocal rank."""
    j = truth_hits(topk.where(F.col("rank") <= k), truth).groupBy("user_idx").agg(
        F.sum("n_true").alias("n_true"), F.count("rank").alias("hits_distinct"),
        F.sum(F.when(F.col("rank").isNotNull(), F.col("mult"))).alias("hits_dup"),
        F.sum(discount("rank")).alias("dcg"), F.min("rank").alias("first_rank"))
    return j.select(
        "user_idx", "n_true",
        F.coalesce("hits_distinct", F.lit(0)).alias("hits_distinct"),
        F.coalesce("hits_dup", F.lit(0)).alias("hits_dup"),
        F.coalesce("dcg", F.lit(0.0)).alias("dcg"),
        ideal_dcg("n_true", k).alias("idcg"),
        F.when(F.col("first_rank").isNotNull(), 1.0 / F.col("first_rank")).otherwise(F.lit(0.0)).alias("rr"))


def ranking_metrics(topk: DataFrame, truth: DataFrame, k: int = 10, variant: str = "model",
                    per_user: bool = False, suffix: bool = True) -> DataFrame:
    """hit_rate, ndcg, precision, recall, mrr at k (one row; names suffixed with _k)."""
    pu = per_user_ranking(topk, truth, k)
    hits = F.col("hits_distinct") if variant == "model" else F.col("hits_dup")
    if variant not in ("model", "baseline"):
        raise ValueError("variant must be 'model' or 'baseline'")
    hr = (F.avg(F.when(F.col("hits_dup") > 0, 1.0).otherwise(0.0)) if per_user
          else F.sum("hits_dup") / F.sum("n_true"))
    s = f"_{k}" if suffix else ""
    return pu.agg(
        F.coalesce(hr.cast("double"), F.lit(0.0)).alias(f"hit_rate{s}"),
        F.coalesce(F.avg(F.when(F.col("idcg") > 0, F.col("dcg") / F.col("idcg")).otherwise(0.0)), F.lit(0.0))
        .alias(f"ndcg{s}"),
        F.coalesce(F.avg(hits / k), F.lit(0.0)).alias(f"precision{s}"),
        F.coalesce(F.avg(hits / F.col("n_true")), F.lit(0.0)).alias(f"recall{s}"),
        F.coalesce(F.avg("rr"), F.lit(0.0)).alias(f"mrr{s}"))


def hash_sample(df: DataFrame, n: int | None, key_cols: list[str], seed: int = 42) -> DataFrame:
    """A reproducible sample of n rows: the n smallest hash values of the key columns
    (TakeOrdered: n rows per task, then merge). Ties broken by the keys. None: all rows."""
    if n is None:
        return df
    h = hash_unit(*key_cols, seed=seed)
    return (df.withColumn("_h", h).orderBy(F.col("_h").asc(), *[F.col(c).asc() for c in key_cols])
            .limit(n).drop("_h"))


def sampled_truth_users(truth: DataFrame, n_users: int | None = None, seed: int = 42) -> DataFrame:
    """Truth rows of ``n_users`` users chosen by hash order (semi join); of all users by default."""
    if n_users is None:
        return truth
    users = hash_sample(truth.select("user_idx").distinct(), n_users, ["user_idx"], seed)
    return truth.join(users, "user_idx", "left_semi")
