"""Experiment bookkeeping as DataFrame jobs: run metrics, pending grid cells, champion
decision, early-stopping points, comparison tables and flat metric reports."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import classification as M
from orchard.operators import interactions as I
from orchard.operators import ranking as N
from orchard.operators.features import negative_sampling, sample_split
from orchard.operators.prefix import running_sums
from orchard.operators.recommend import popular_top_k_array, popularity_lookup

RANKING = ("hit_rate", "ndcg", "precision", "recall", "mrr")
METRICS = (*RANKING, "roc_auc", "average_precision")
N_NEGATIVES = 4  # per validation positive, for AUC and average precision


def run_rows(values: DataFrame, run: str, model_type: str, processor: str, metrics=METRICS) -> DataFrame:
    """One wide row of metrics -> long rows (run, model_type, processor, metric, value)."""
    return values.unpivot([], list(metrics), "metric", "value").select(
        F.lit(run).alias("run"), F.lit(model_type).alias("model_type"), F.lit(processor).alias("processor"),
        "metric", "value")


def popularity_run_metrics(events: DataFrame, strategies=("weighted", "binary", "implicit"), k: int = 10,
                           min_count: int = 1, seed: int = 42) -> DataFrame:
    """Evaluate the popularity recommender under each interaction strategy.

    strategy -> dense indexes -> pair-keyed train / validation split -> item popularity on
    the training rows -> the same global top-k for every validation user -> ranking metrics
    (duplicate-counting variant); AUC and average precision over the validation positives and
    ``N_NEGATIVES`` unowned items for each. Returns long rows (run, model_type, processor,
    metric, value).
    """
    from orchard.session import cut_lineage

    parts = []
    for s in strategies:
        inter, _, items = I.process(events, s, min_count=min_count)
        # read by the popularity fit, the sampling and the metrics
        sx = cut_lineage(sample_split(inter, ["user_idx", "item_idx"], 0.8, seed).select(
            "event_id", "user_idx", "item_idx", "split"))
        train = sx.where("split = 'train'")
        val = sx.where("split = 'validation'").select("user_idx", "item_idx")
        pop = cut_lineage(I.popular_items(train, item_col="item_idx", weight_col=None))
        top = popular_top_k_array(pop, k, item_col="item_idx").scalar()
        topk = val.select("user_idx").distinct().select(
            "user_idx", F.explode(top).alias("t")).select("user_idx", F.col("t.item").alias("item_idx"),
                                                          F.col("t.rank").alias("rank"))
        m = N.ranking_metrics(topk, val, k, variant="baseline", suffix=False)
        samples = negative_sampling(sx.where("split = 'validation'"), items.count(), N_NEGATIVES, seed, known=sx,
                                    row_col="event_id")
        scored = cut_lineage(popularity_lookup(samples, pop, "item_idx", "item_idx").select(
            F.col("label").cast("int").alias("y_true"), F.col("score").alias("y_proba")))
        m = m.select("*", M.roc_auc(scored).select("roc_auc").scalar().alias("roc_auc"),
                     M.average_precision(scored).select("average_precision").scalar().alias("average_precision"))
        parts.append(run_rows(m, f"popularity_{s}", "popularity", s))
    return reduce(lambda a, b: a.unionByName(b), parts)


def experiment_grid(spark, model_types: list[str], processors: list[str]) -> DataFrame:
    """All (model_type, processor) cells: two exploded literal lists (no join)."""
    return (spark.range(1).select(F.explode(F.array(*[F.lit(m) for m in model_types])).alias("model_type"))
            .select("model_type", F.explode(F.array(*[F.lit(p) for p in processors])).alias("processor")))


def pending_experiments(grid: DataFrame, run_metrics: DataFrame) -> DataFrame:
    """Grid cells without a finished run (anti join on the pair)."""
    done = run_metrics.select("model_type", "processor").distinct()
    return grid.join(done, ["model_type", "processor"], "left_anti")


def champion_decision(run_metrics: DataFrame, metric: str, incumbent_run: str | None,
                      higher_is_better: bool = True) -> DataFrame:
    """Per candidate run: its metric, the incumbent's, and whether to promote.

    No incumbent value -> promote; candidate without the metric -> do not promote.
    """
    m = run_metrics.where(F.col("metric") == metric)
    inc = m.where(F.col("run") == F.lit(incumbent_run)).select(F.max("value")).scalar() if incumbent_run \
        else F.lit(None).cast("double")
    runs = run_metrics.select("run").distinct()
    if incumbent_run:
        runs = runs.where(F.col("run") != F.lit(incumbent_run))
    cand = runs.join(m.groupBy("run").agg(F.max("value").alias("candidate_value")), "run", "left")
    better = (F.col("candidate_value") > F.col("incumbent_value")) if higher_is_better \
        else (F.col("candidate_value") < F.col("incumbent_value"))
    return cand.withColumn("incumbent_value", inc).withColumn(
        "promote", F.when(F.col("candidate_value").isNull(), F.lit(False))
        .when(F.col("incumbent_value").isNull(), F.lit(True)).otherwise(better))


SEGMENT = 1 << 16  # epochs that one task of the stopper's scan holds


def _hops(values: np.ndarray, patience: int, min_delta: float) -> np.ndarray:
    """Place of the first value within ``patience`` places that is below each value by more than ``min_delta``; -1: none."""
    n = len(values)
    hop = np.full(n, -1, np.int64)
    for step in range(1, min(patience, n - 1) + 1):
        better = np.zeros(n, bool)
        better[:n - step] = values[step:] < values[:n - step] - min_delta
        hop[better & (hop < 0)] = step
    return np.where(hop > 0, np.arange(n) + hop, -1)


def early_stop_point(epoch_metrics: DataFrame, patience: int = 3, mode: str = "min",
                     min_delta: float = 0.0) -> DataFrame:
    """Per run, replay early stopping over its epochs in order.

    Returns run, best_value, best_epoch, num_bad_epochs (when stopping / at the end) and
    stop_epoch (null: never stopped). patience <= 0 disables the stopper (no tracking).
    Null and NaN values improve on nothing, and every other value improves on them.

    A segmented scan: an improvement is followed by the next one within ``patience`` epochs or by the
    stop, so a segment of ``SEGMENT`` epochs is entered at one of its first ``patience`` ones. Each
    segment is a task that says, for each of these entries, where the chain of improvements leaves it;
    a run's segments, ``patience`` rows each, are then followed from the first.
    """
    if mode not in ("min", "max"):
        raise ValueError(f"mode must be 'min' or 'max', got {mode!r}")
    schema = "run {}, best_value double, best_epoch int, num_bad_epochs int, stop_epoch int".format(
        epoch_metrics.schema["run"].dataType.simpleString())
    rows = epoch_metrics.select("run", F.col("epoch").cast("int").alias("epoch"), F.col("value").cast("double").alias("value"))
    if patience <= 0:
        return rows.groupBy("run").agg(F.lit(None).cast("double").alias("best_value"), F.lit(None).cast("int").alias("best_epoch"),
                                       F.lit(0).alias("num_bad_epochs"), F.lit(None).cast("int").alias("stop_epoch"))
    length = max(SEGMENT, 4 * patience)
    sign = 1.0 if mode == "min" else -1.0
    placed = running_sums(rows.withColumn("_one", F.lit(1).cast("long")), "epoch", ["_one"], group_cols=["run"],
                          tiebreak=["value"]).withColumn("place", F.col("_one_cum") - 1)
    own = F.floor(F.col("place") / length).cast("long")
    ahead = (F.col("place") % length < patience) & (own > 0)  # a segment also sees the first epochs of the next
    segments = F.when(ahead, F.array(own - 1, own)).otherwise(F.array(own))
    dealt = placed.select("run", F.explode(segments).alias("segment"), "place", "epoch", "value")

    def leave(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("place")
        epoch, value = pdf["epoch"].to_numpy(), pdf["value"].to_numpy(np.float64)
        v = np.where(np.isnan(value), np.inf, sign * value)
        n, inner = len(v), min(len(v), length)
        hop = _hops(v, patience, min_delta)
        last = np.arange(n)  # where the chain through each place ends or leaves the segment
        for j in range(inner - 1, -1, -1):
            if hop[j] >= 0:
                last[j] = hop[j] if hop[j] >= inner else last[hop[j]]
        out = []
        for j in range(min(patience, inner)) if key[1] else (0,):
            end = int(last[j])
            if end >= inner:
                out.append((end - inner, None, None, None, None))
            else:
                stop = end + patience
                out.append((None, value[end], epoch[end], min(patience, n - 1 - end), epoch[stop] if stop < n else None))
        found = pd.DataFrame(out, columns=["leaves", "best_value", "best_epoch", "num_bad_epochs", "stop_epoch"], dtype=object)
        found.insert(0, "entry", np.arange(len(out)))
        found.insert(0, "segment", key[1])
        found.insert(0, "run", key[0])
        return found

    chains = dealt.groupBy("run", "segment").applyInPandas(
        leave, schema.replace(", best_value", ", segment long, entry int, leaves int, best_value", 1))

    def follow(pdf: pd.DataFrame) -> pd.DataFrame:
        table = pdf.set_index(["segment", "entry"])
        segment, entry = 0, 0
        while pd.notna(table.at[(segment, entry), "leaves"]):
            segment, entry = segment + 1, int(table.at[(segment, entry), "leaves"])
        return table.loc[[(segment, entry)], ["run", "best_value", "best_epoch", "num_bad_epochs", "stop_epoch"]]

    return chains.groupBy("run").applyInPandas(follow, schema)


def comparison_table(run_metrics: DataFrame, metrics=METRICS) -> DataFrame:
    """One row per run, one column per metric (pivot with known values)."""
    return (run_metrics.groupBy("run", "model_type", "processor").pivot("metric", list(metrics))
            .agg(F.first("value")))


def metrics_report(run_metrics: DataFrame) -> DataFrame:
    """Flat (key, value) rows with key = <run>_<metric>."""
    return run_metrics.select(F.concat_ws("_", "run", "metric").alias("key"), "value")
