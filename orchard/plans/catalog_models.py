"""Model queries (rows-only checks: trained models have no SQL twin)."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from orchard.functions.expressions import mf_logit, sigmoid
from orchard.operators import classification as M
from orchard.operators import experiments as X
from orchard.operators import features as H
from orchard.operators import interactions as I
from orchard.operators import models as ML
from orchard.operators import ranking as N
from orchard.operators import recommend as R
from orchard.plans.catalog_features import _BIN_IDX, _SX, CAT, FEATS, NUM, _split, loader_features
from orchard.plans.common import round_doubles
from orchard.plans.registry import register
from orchard.session import cut_lineage, side_by_side, spread
from orchard.sources import fixtures as fx

K = 10


def _xy(spark, sf_dir):
    """Encoded + scaled churn features, assembled; materialised once for several fits."""
    lp = spread(cut_lineage(ML.assemble(loader_features(spark, sf_dir), FEATS)), "customerid")
    return lp.where("split = 'train'"), lp.where("split = 'test'")


def _eval(model, test, name):
    return ML.predictions(model, test, keep=("customerid",)).withColumn("model", F.lit(name))


@register("logreg")
def q_logreg(spark, sf_dir):
    """Plain logistic regression; test-split predictions."""
    tr, te = _xy(spark, sf_dir)
    return _eval(ML.train_logreg(tr), te, "logreg")


@register("logreg_balanced")
def q_logreg_balanced(spark, sf_dir):
    tr, te = _xy(spark, sf_dir)
    return _eval(ML.train_logreg(H.balanced_weights(tr), weight_col="weight"), te, "logreg_balanced")


@register("logreg_smote")
def q_logreg_smote(spark, sf_dir):
    tr, te = _xy(spark, sf_dir)
    sm = ML.assemble(H.smote(tr.select(*FEATS, "label"), FEATS, "label"), FEATS)
    return _eval(ML.train_logreg(sm), te, "logreg_smote")


@register("random_forest")
def q_rf(spark, sf_dir):
    tr, te = _xy(spark, sf_dir)
    return _eval(ML.train_random_forest(tr), te, "random_forest")


@register("gbt")
def q_gbt(spark, sf_dir):
    tr, te = _xy(spark, sf_dir)
    return _eval(ML.train_gbt(tr), te, "gbt")


@register("mlp")
def q_mlp(spark, sf_dir):
    """128-64-32 perceptron with the positive class repeated to its weight, stopped early."""
    tr, te = _xy(spark, sf_dir)
    return _eval(ML.train_mlp_early_stop(tr, len(FEATS), "customerid"), te, "mlp")


N_ITER = 10  # cells that a random search tries


def _random_search(estimator, grid, train, n_iter=N_ITER, folds=3, seed=42):
    """``n_iter`` cells of the grid, chosen by a seeded shuffle, by mean accuracy over the folds."""
    import random
    cells = random.Random(seed).sample(grid, min(n_iter, len(grid)))
    cv = CrossValidator(estimator=estimator, estimatorParamMaps=cells, numFolds=folds, seed=seed, parallelism=4,
                        evaluator=MulticlassClassificationEvaluator(labelCol="label", metricName="accuracy"))
    return cv.fit(train).bestModel


def _search_rf(tr):
    """Trees 100 / 200 / 300, depth unlimited (30, MLlib's limit) / 10 / 20, leaf size 1 / 2 / 4, bootstrap or not.

    MLlib has no minimum split size; a split of at least s rows needs leaves, so the grid's split sizes
    2 / 5 / 10 are covered by the leaf sizes alone."""
    rf = ML.ForestClassifier(featuresCol="features", labelCol="label", cacheNodeIds=True, seed=42)
    grid = (ParamGridBuilder().addGrid(rf.numTrees, [100, 200, 300]).addGrid(rf.maxDepth, [30, 10, 20])
            .addGrid(rf.minInstancesPerNode, [1, 2, 4]).addGrid(rf.bootstrap, [True, False]).build())
    return _random_search(rf, grid, tr)


def _search_gbt(tr, n_iter=N_ITER):
    """Rounds 100 / 200 / 300 at most, depth 3 / 5 / 7, rate 0.01 / 0.1 / 0.2, row share 0.8 / 1, column
    share 0.8 / 1. A tenth of the rows, chosen by hash, tells when more rounds stop helping."""
    from pyspark.ml.classification import GBTClassifier
    tr = cut_lineage(tr.withColumn("held", H.hash_unit(F.xxhash64("customerid")) < 0.1))
    gbt = GBTClassifier(featuresCol="features", labelCol="label", seed=42, validationIndicatorCol="held")
    grid = (ParamGridBuilder().addGrid(gbt.maxIter, [100, 200, 300]).addGrid(gbt.maxDepth, [3, 5, 7])
            .addGrid(gbt.stepSize, [0.01, 0.1, 0.2]).addGrid(gbt.subsamplingRate, [0.8, 1.0])
            .addGrid(gbt.featureSubsetStrategy, ["0.8", "all"]).build())
    return _random_search(gbt, grid, tr, n_iter)


@register("random_search_rf")
def q_random_search(spark, sf_dir):
    """3-fold random search over the random-forest grid by accuracy; test-split predictions of the best."""
    tr, te = _xy(spark, sf_dir)
    return _eval(_search_rf(tr), te, "random_search_rf")


@register("controlled_experiment")
def q_controlled(spark, sf_dir):
    """All churn models on one split and one scaling; leaderboard by AUC."""
    tr, te = _xy(spark, sf_dir)
    sm = ML.assemble(H.smote(tr.select(*FEATS, "label"), FEATS, "label"), FEATS)
    preds = side_by_side(spark, [
        lambda: _eval(ML.train_logreg(tr), te, "logreg"),
        lambda: _eval(ML.train_logreg(H.balanced_weights(tr), weight_col="weight"), te, "logreg_balanced"),
        lambda: _eval(ML.train_logreg(sm), te, "logreg_smote"),
        lambda: _eval(ML.train_random_forest(tr, num_trees=100), te, "random_forest"),
        lambda: _eval(ML.train_gbt(tr), te, "gbt"),
        lambda: _eval(ML.train_mlp_early_stop(tr, len(FEATS), "customerid"), te, "mlp"),
        lambda: H.majority_baseline(tr, te).select("customerid", F.col("label").alias("y_true"), "y_pred", "y_proba")
        .withColumn("model", F.lit("majority"))])
    allp = cut_lineage(reduce(lambda a, b: a.unionByName(b), preds))
    return round_doubles(M.leaderboard(allp, ["model"]))


@register("top_coefficients")
def q_top_coef(spark, sf_dir):
    tr, _ = _xy(spark, sf_dir)
    return ML.top_coefficients(ML.train_logreg(tr), FEATS, 10, spark)


def _churn_model(spark, sf_dir):
    sp = cut_lineage(_split(spark, sf_dir).withColumnRenamed("churn_value", "label").select(
        "customerid", "split", "label", *FEATS))
    return ML.train_churn(sp.where("split = 'train'"), CAT, NUM), sp


@register("churn_model_fit")
def q_churn_model_fit(spark, sf_dir):
    """Impute / one-hot / scale + class-weighted LR fitted on the training rows; test metrics (one row)."""
    model, sp = _churn_model(spark, sf_dir)
    p = cut_lineage(ML.predictions(model, sp.where("split = 'test'")).withColumn("model", F.lit("churn_model")))
    return round_doubles(M.model_summary(p, ["model"]))


@register("churn_batch_score")
def q_churn_batch(spark, sf_dir):
    """Class, P(churn) and confidence for a batch (the test split) from the fitted pipeline."""
    model, sp = _churn_model(spark, sf_dir)
    return ML.churn_batch_score(model, sp.where("split = 'test'"))


def _indexed(spark, sf_dir, strategy="weighted"):
    inter, users, items = I.process(fx.interactions_raw(spark, sf_dir), strategy)
    sx = cut_lineage(H.sample_split(inter, ["user_idx", "item_idx"], 0.8))
    # the index tables are read by several fits below: materialise them once
    return sx, cut_lineage(users), cut_lineage(items)


def _samples(sx, items):
    """Labelled samples of both splits; negatives are drawn against the positives of both."""
    n = items.count()
    pos = sx.select("user_idx", "item_idx", "event_id", "split")
    # a draw depends on its row and on what the user owns in both splits: one pass serves both
    drawn = cut_lineage(H.negative_sampling(pos, n, 4, known=pos, row_col="event_id", keep=("split",)))
    return {s: spread(drawn.where(F.col("split") == s).drop("split"), "user_idx", "item_idx") for s in ("train", "validation")}


RANK = 64  # factors
HIDDEN = (128, 64, 32)
EPOCHS = 10  # passes over the samples, as the training configuration has them
FEW_PAIRS = 1 << 17  # pairs (2 MB) whose join is left to Spark


def _factors(sx, rank=RANK):
    """User and item factors fitted on the training split, written once."""
    tr = sx.where("split = 'train'")
    if "weight" not in tr.columns:
        tr = tr.withColumn("weight", F.lit(1.0))
    u, i = ML.als_factor_tables(ML.train_als(tr, rank=rank))
    return cut_lineage(u), cut_lineage(i)


def _fit_recommender(kind, factors, samples, rank=RANK):
    """Fits one model kind on fitted factors and the training samples; returns (users, items, mu, score)
    with ``score`` a function from samples to (y_true, y_proba) that keeps every sample."""
    u, i = factors
    if kind == "matrix_factorization":
        mu, u, i = ML.als_biases(samples["train"], u, i)

        def score(rows):
            # users and items without factors have no bias either: mu alone
            zero = F.array_repeat(F.lit(0.0), rank)
            p = u.select("user_idx", F.col("factors").alias("_p"), F.col("bias").alias("_bu"))
            q = i.select("item_idx", F.col("factors").alias("_q"), F.col("bias").alias("_bi"))
            j = R.with_factors(rows, p, q, "left")
            logit = mf_logit(F.coalesce("_p", zero), F.coalesce("_q", zero), F.coalesce("_bu", F.lit(0.0)),
                             F.coalesce("_bi", F.lit(0.0)), mu)
            return j.select(F.col("label").cast("int").alias("y_true"), sigmoid(logit).alias("y_proba"))

        return u, i, mu, score
    features = ML.pair_features(samples["train"], u, i, kind, rank)
    # a perceptron's fit reads its rows once and keeps them in blocks of its own
    fit = ML.train_logreg(cut_lineage(features), max_iter=100) if kind == "gmf" else ML.train_mlp(
        features, 2 * rank, hidden=HIDDEN, max_iter=EPOCHS)
    return u, i, 0.0, lambda rows: ML.predictions(fit, ML.pair_features(rows, u, i, kind, rank)).select("y_true", "y_proba")


@register("mf_train")
def q_mf(spark, sf_dir):
    """Implicit ALS with fitted biases; top-10 ranking metrics on all validation pairs."""
    sx, _, items = _indexed(spark, sf_dir)
    u, i, mu, _ = _fit_recommender("matrix_factorization", _factors(sx), _samples(sx, items))
    val = sx.where("split = 'validation'").select("user_idx", "item_idx")
    users = u.join(val.select("user_idx").distinct(), "user_idx", "left_semi")
    return round_doubles(N.ranking_metrics(R.top_k_scores(users, i, K, mu), val, K))


def _summary(spark, sf_dir, kind):
    sx, _, items = _indexed(spark, sf_dir, "binary")
    samples = _samples(sx, items)
    p = _fit_recommender(kind, _factors(sx), samples)[3](samples["validation"])
    p = cut_lineage(p.withColumn("y_pred", (F.col("y_proba") > 0.5).cast("int")).withColumn("model", F.lit(kind)))
    return round_doubles(M.model_summary(p, ["model"]))


@register("gmf_train")
def q_gmf(spark, sf_dir):
    """GMF re-aimed: ALS factors -> element-wise product features -> logistic regression; AUC/AP."""
    return _summary(spark, sf_dir, "gmf")


@register("ncf_train")
def q_ncf(spark, sf_dir):
    """NCF re-aimed: ALS factors -> concat(p, q) -> 128-64-32 perceptron; AUC/AP."""
    return _summary(spark, sf_dir, "ncf")


@register("recommender_sample_counts", fx.with_views(f"""WITH {_BIN_IDX}, {_SX}
SELECT split, CAST(count(*) AS BIGINT) AS n_positives, CAST(4 * count(*) AS BIGINT) AS n_negatives,
  CAST(5 * count(*) AS BIGINT) AS n_featured FROM sx GROUP BY split""", "interactions_raw"))
def q_sample_counts(spark, sf_dir):
    """What the recommender fits read: samples by split and label, and how many keep their row through
    the factor join (all, cold users and items included)."""
    sx, _, items = _indexed(spark, sf_dir, "binary")
    samples = _samples(sx, items)
    u, i = ML.als_factor_tables(ML.train_als(sx.where("split = 'train'"), rank=RANK))
    parts = [ML.pair_features(rows, u, i, "gmf", RANK).agg(
        F.lit(s).alias("split"), F.count_if(F.col("label") == 1).alias("n_positives"),
        F.count_if(F.col("label") == 0).alias("n_negatives"), F.count("features").alias("n_featured"))
        for s, rows in samples.items()]
    return parts[0].unionByName(parts[1])


@register("ncf_score")
def q_ncf_score(spark, sf_dir):
    """Score every truth pair with a perceptron over concat(user, item) factors in Arrow batches."""
    uf, itf, truth = fx.user_factors(spark, sf_dir), fx.item_factors(spark, sf_dir), fx.truth(spark, sf_dir)
    # items of the factor table in dense order, so that negatives are drawn over all of them
    ids = cut_lineage(I.dense_index(itf, "item_idx", "pos"))
    # Spark takes the pairs for a row per user, as it does not count what an explode makes, and would broadcast them all
    placed = truth.join(ids if truth.count() <= FEW_PAIRS else ids.hint("shuffle_hash"), "item_idx")
    pairs = cut_lineage(placed.select("user_idx", F.col("pos").alias("item_idx")))
    drawn = H.negative_sampling(pairs, ids.count(), 1, known=pairs)
    back = drawn.join(ids.withColumnRenamed("item_idx", "id"), F.col("item_idx") == F.col("pos"))
    train = ML.pair_features(back.select("user_idx", F.col("id").alias("item_idx"), "label"), uf, itf, "ncf")
    # the fit reads its rows once and keeps them in blocks of its own: the features, 1 KB a row, are not written before
    mlp = ML.train_mlp(train, 2 * RANK, hidden=HIDDEN, max_iter=EPOCHS)
    feats = R.with_factors(truth, uf.select("user_idx", F.col("factors").alias("p")),
                           itf.select("item_idx", F.col("factors").alias("q"))).withColumn("x", F.concat("p", "q"))
    return round_doubles(ML.ncf_score(feats, ML.mlp_weights(mlp), "x", keep=("user_idx", "item_idx")))


@register("logreg_recommender")
def q_logreg_rec(spark, sf_dir):
    """Logistic regression on one-hot (user, item) pair vectors; validation AUC/AP."""
    sx, users, items = _indexed(spark, sf_dir, "binary")
    samples = _samples(sx, items)
    # the design matrix is read once per iteration and by the row count: materialise it
    train = cut_lineage(H.pair_one_hot_vectors(samples["train"], users, items))
    fit = ML.train_logreg(train, max_iter=100)  # as the baseline: 100
    # predictions feed several metric passes: materialise them once
    p = cut_lineage(ML.predictions(fit, H.pair_one_hot_vectors(samples["validation"], users, items)).withColumn(
        "model", F.lit("logreg_recommender")))
    return round_doubles(M.model_summary(p, ["model"]))


GRID_MODELS = ("ncf", "gmf", "matrix_factorization")
GRID_METRICS = (*X.METRICS, "final_loss", "training_latency")


def experiment_runs(spark, sf_dir, cells, finished=(), rank=RANK):
    """Long run metrics of every (model kind, strategy) cell that is not among ``finished`` runs.

    Ranking metrics of the factor top-k, AUC, average precision and log loss over the validation
    samples, and the seconds that fitting took (the factors, which the kinds of one strategy
    share, count for each). Kinds run side by side, so the seconds include waiting for each other."""
    todo = [(m, s) for m, s in cells if f"{m}_{s}" not in finished]

    def prepare(strategy):
        sx, _, items = _indexed(spark, sf_dir, strategy)
        samples = _samples(sx, items)
        started = time.perf_counter()
        factors = _factors(sx, rank)
        return sx, samples, factors, time.perf_counter() - started

    def run(kind, strategy, sx, samples, factors, shared):
        val = sx.where("split = 'validation'").select("user_idx", "item_idx")
        started = time.perf_counter()
        u, i, mu, score = _fit_recommender(kind, factors, samples, rank)
        took = shared + time.perf_counter() - started
        scored = cut_lineage(score(samples["validation"]).withColumn("y_pred", (F.col("y_proba") > 0.5).cast("int")))
        rank_row = M.model_summary(scored.withColumn("model", F.lit(kind)), ["model"]).first()
        users = u.join(val.select("user_idx").distinct(), "user_idx", "left_semi")
        m = N.ranking_metrics(R.top_k_scores(users, i, K, mu), val, K, variant="baseline", suffix=False)
        m = m.select("*", *[F.lit(rank_row[c]).cast("double").alias(c) for c in ("roc_auc", "average_precision")],
                     M.log_loss(scored).select("log_loss").scalar().alias("final_loss"),
                     F.lit(took).alias("training_latency"))
        return cut_lineage(X.run_rows(m, f"{kind}_{strategy}", kind, strategy, GRID_METRICS))

    # samples and factors of all strategies at once; fits of one strategy at a time, as their feature rows take disk
    strategies = list(dict.fromkeys(s for _, s in todo))
    ready = side_by_side(spark, [lambda s=s: prepare(s) for s in strategies])
    rows = []
    for strategy, parts in zip(strategies, ready):
        rows += side_by_side(spark, [lambda kind=m: run(kind, strategy, *parts) for m, s in todo if s == strategy])
    return rows


@register("experiment_grid")
def q_experiment_grid(spark, sf_dir):
    """NCF, GMF and MF under each strategy: one row per run, all metrics (popularity: ``comparison_table``)."""
    cells = [(m, s) for m in GRID_MODELS for s in ("weighted", "binary", "implicit")]
    rows = experiment_runs(spark, sf_dir, cells)
    return round_doubles(X.comparison_table(reduce(lambda a, b: a.unionByName(b), rows), GRID_METRICS))


@register("gbt_tuned")
def q_gbt_tuned(spark, sf_dir):
    """Boosted trees with the tuned setting: 150 rounds, depth 6, rate 0.05, subsample 0.8."""
    tr, te = _xy(spark, sf_dir)
    return _eval(ML.train_gbt(tr, max_iter=150, max_depth=6, step=0.05, subsample=0.8), te, "gbt_tuned")


@register("random_search_gbt")
def q_random_search_gbt(spark, sf_dir):
    """3-fold random search over the boosted-trees grid by accuracy; test-split predictions of the best."""
    tr, te = _xy(spark, sf_dir)
    return _eval(_search_gbt(tr), te, "random_search_gbt")


@register("event_summary_approx")
def q_event_summary_approx(spark, sf_dir):
    """Events and HyperLogLog++ distinct users (constant memory per task)."""
    from orchard.operators.profile import event_summary_approx
    return event_summary_approx(fx.interactions_raw(spark, sf_dir))
