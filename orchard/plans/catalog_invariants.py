"""What must hold of every trained model, checked against SQL: rows scored, labels among them, probabilities
and classes, and metrics that a second implementation gives from the same stored predictions."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import classification as M
from orchard.operators import features as H
from orchard.operators import models as ML
from orchard.plans import catalog_models as CM
from orchard.plans.catalog_features import _BIN_IDX, _SX, FEATS
from orchard.plans.catalog_features import _sql as _split_sql
from orchard.plans.common import round_doubles
from orchard.plans.registry import register
from orchard.session import cut_lineage, side_by_side
from orchard.sources import fixtures as fx


def prediction_digest(preds: DataFrame, threshold: float = 0.5) -> DataFrame:
    """model, n_rows, n_positive, n_outside, n_wrong_class, n_auc_gap of (model, y_true, y_pred, y_proba) rows.

    ``n_outside``: probabilities that are missing or not from 0 to 1; ``n_wrong_class``: classes that do not follow from
    the probability; ``n_auc_gap``: 1 where MLlib's own area under the ROC curve differs from the library's.
    """
    p = F.col("y_proba")
    preds = cut_lineage(preds.select("model", "y_true", "y_pred", "y_proba"))
    counts = preds.groupBy("model").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("y_true") == 1).alias("n_positive"),
        F.count_if(p.isNull() | F.isnan(p) | ~p.between(0, 1)).alias("n_outside"),
        F.count_if(F.col("y_pred") != (p > threshold).cast("int")).alias("n_wrong_class"))
    own = {r.model: r.roc_auc for r in M.model_summary(preds, ["model"]).collect()}  # one row per model
    judge = BinaryClassificationEvaluator(rawPredictionCol="raw", labelCol="label", numBins=0)
    gaps = []
    for model, auc in own.items():
        one = preds.where(F.col("model") == model).select(
            array_to_vector(F.array(1 - p, p)).alias("raw"), F.col("y_true").cast("double").alias("label"))
        gaps.append((model, int(abs(judge.evaluate(one) - auc) > 1e-6)))
    return counts.join(preds.sparkSession.createDataFrame(gaps, "model string, n_auc_gap long"), "model")


def _all(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), [p.select("model", "y_true", "y_pred", "y_proba") for p in parts])


def _digest_sql(models: list[str], counts: str) -> str:
    names = ", ".join(f"'{m}'" for m in models)
    return f"""SELECT m.model, c.n_rows, c.n_positive, CAST(0 AS BIGINT) AS n_outside, CAST(0 AS BIGINT) AS n_wrong_class,
  CAST(0 AS BIGINT) AS n_auc_gap FROM (SELECT unnest([{names}]) AS model) m, ({counts}) c"""


_TEST = "SELECT count(*) AS n_rows, count_if(churn_value = 1) AS n_positive FROM sp WHERE split = 'test'"
_CHURN = ["logreg", "logreg_balanced", "logreg_smote", "random_forest", "gbt", "gbt_tuned", "mlp"]


@register("churn_model_invariants", _split_sql(_digest_sql(_CHURN, _TEST)))
def q_churn_invariants(spark, sf_dir):
    """Every churn classifier scores each test row once, with the split's labels."""
    tr, te = CM._xy(spark, sf_dir)

    def smote():
        return ML.assemble(H.smote(tr.select(*FEATS, "label"), FEATS, "label"), FEATS)

    fits = {"logreg": lambda: ML.train_logreg(tr), "logreg_smote": lambda: ML.train_logreg(smote()),
            "logreg_balanced": lambda: ML.train_logreg(H.balanced_weights(tr), weight_col="weight"),
            "random_forest": lambda: ML.train_random_forest(tr), "gbt": lambda: ML.train_gbt(tr),
            "gbt_tuned": lambda: ML.train_gbt(tr, max_iter=150, max_depth=6, step=0.05, subsample=0.8),
            "mlp": lambda: ML.train_mlp_early_stop(tr, len(FEATS), "customerid")}
    # a forest is fitted where it scores: fit and scores of a model are one job
    return prediction_digest(_all(side_by_side(spark, [
        lambda name=name, fit=fit: CM._eval(fit(), te, name) for name, fit in fits.items()])))


@register("search_invariants", _split_sql(_digest_sql(["random_search_rf", "random_search_gbt"], _TEST)))
def q_search_invariants(spark, sf_dir):
    """The best models of both random searches, held to the same rules."""
    tr, te = CM._xy(spark, sf_dir)
    searches = {"random_search_rf": CM._search_rf, "random_search_gbt": CM._search_gbt}
    # a forest is fitted where it scores: search and scores are one job
    return prediction_digest(_all(side_by_side(spark, [
        lambda name=name, search=search: CM._eval(search(tr), te, name) for name, search in searches.items()])))


@register("churn_pipeline_invariants", _split_sql("""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_outside, CAST(0 AS BIGINT) AS n_wrong_class,
  CAST(0 AS BIGINT) AS n_wrong_confidence, CAST(0 AS BIGINT) AS n_wrong_metric FROM sp WHERE split = 'test'"""))
def q_pipeline_invariants(spark, sf_dir):
    """The churn pipeline: customers scored once, class and confidence follow from the probability, and the
    fit's reported metrics are those of the batch scores."""
    model, sp = CM._churn_model(spark, sf_dir)
    test = sp.where("split = 'test'")
    scored = cut_lineage(ML.churn_batch_score(model, test).join(test.select("customerid", "label"), "customerid"))
    p = F.col("churn_probability")
    again = scored.select(F.lit("churn_model").alias("model"), F.col("label").cast("int").alias("y_true"),
                          F.col("churn_class").alias("y_pred"), p.alias("y_proba"))
    told = round_doubles(M.model_summary(ML.predictions(model, test).withColumn("model", F.lit("churn_model")), ["model"]))
    wrong = told.exceptAll(round_doubles(M.model_summary(again, ["model"]))).count()  # one row at most
    return scored.agg(
        F.count_distinct("customerid").alias("n_rows"), F.count_if(p.isNull() | ~p.between(0, 1)).alias("n_outside"),
        F.count_if(F.col("churn_class") != (p > 0.5).cast("int")).alias("n_wrong_class"),
        F.count_if(F.abs(F.col("confidence") - F.greatest(p, 1 - p)) > 1e-9).alias("n_wrong_confidence"),
        F.lit(wrong).cast("long").alias("n_wrong_metric"))


@register("coefficient_invariants", _split_sql(f"""
SELECT CAST({len(FEATS)} AS BIGINT) AS n_features, CAST(0 AS BIGINT) AS n_wrong_importance, CAST(0 AS BIGINT) AS n_wrong_order,
  count(*) AS n_train FROM sp WHERE split = 'train'"""))
def q_coefficient_invariants(spark, sf_dir):
    """Top coefficients: one per feature, importance is the size of the coefficient, in descending order; and the rows fitted."""
    tr, _ = CM._xy(spark, sf_dir)
    top = ML.top_coefficients(ML.train_logreg(tr), FEATS, 10, spark).collect()  # ten rows at most
    order = [r.importance for r in top]
    bad = sum(abs(abs(r.coefficient) - r.importance) > 1e-12 for r in top)
    return tr.agg(F.lit(len({r.feature for r in top})).cast("long").alias("n_features"), F.lit(bad).cast("long").alias("n_wrong_importance"),
                  F.lit(int(order != sorted(order, reverse=True))).cast("long").alias("n_wrong_order"),
                  F.count(F.lit(1)).alias("n_train"))


_VALIDATION = "SELECT 5 * count(*) AS n_rows, count(*) AS n_positive FROM sx WHERE split = 'validation'"
_KINDS = ["als_biases", "fm_log_loss", "gmf", "ncf", "logreg_recommender"]


def recommender_scores(spark, sf_dir) -> DataFrame:
    """Validation scores of every recommender kind on the same samples, fitted on the binary strategy."""
    sx, users, items = CM._indexed(spark, sf_dir, "binary")
    samples = CM._samples(sx, items)
    factors = CM._factors(sx)
    train = cut_lineage(H.pair_one_hot_vectors(samples["train"], users, items))
    valid = cut_lineage(H.pair_one_hot_vectors(samples["validation"], users, items))
    fits = {kind: lambda name=name: CM._fit_recommender(name, factors, samples)[3](samples["validation"])
            for kind, name in (("als_biases", "matrix_factorization"), ("gmf", "gmf"), ("ncf", "ncf"))}
    fits["logreg_recommender"] = lambda: ML.predictions(ML.train_logreg(train, max_iter=100), valid)
    fits["fm_log_loss"] = lambda: ML.predictions(ML.train_fm(train, CM.RANK, index=(users, items)), valid)
    parts = dict(zip(fits, side_by_side(spark, list(fits.values()))))
    return _all([p.withColumn("model", F.lit(kind)).withColumn("y_pred", (F.col("y_proba") > 0.5).cast("int"))
                 for kind, p in parts.items()])


@register("recommender_invariants", fx.with_views(f"WITH {_BIN_IDX}, {_SX} " + _digest_sql(_KINDS, _VALIDATION), "interactions_raw"))
def q_recommender_invariants(spark, sf_dir):
    """Every recommender scores each validation sample once: the positives and four negatives for each."""
    return prediction_digest(recommender_scores(spark, sf_dir))


@register("mf_log_loss")
def q_mf_log_loss(spark, sf_dir):
    """Matrix factorisation with biases learned on the log loss beside ALS with fitted biases: AUC, AP and log loss."""
    sx, users, items = CM._indexed(spark, sf_dir, "binary")
    samples = CM._samples(sx, items)
    vectors = {s: H.pair_one_hot_vectors(rows, users, items) for s, rows in samples.items()}
    fits = {"als_biases": lambda: CM._fit_recommender("matrix_factorization", CM._factors(sx), samples)[3](samples["validation"]),
            "fm_log_loss": lambda: ML.predictions(ML.train_fm(cut_lineage(vectors["train"]), CM.RANK, index=(users, items)),
                                                  vectors["validation"])}
    scored = dict(zip(fits, side_by_side(spark, list(fits.values()))))
    p = cut_lineage(_all([s.withColumn("model", F.lit(kind)).withColumn("y_pred", (F.col("y_proba") > 0.5).cast("int"))
                          for kind, s in scored.items()]))
    losses = reduce(lambda a, b: a.unionByName(b), [
        M.log_loss(p.where(F.col("model") == kind)).select(F.lit(kind).alias("model"), "log_loss") for kind in scored])
    return round_doubles(M.model_summary(p, ["model"]).join(losses, "model"))


@register("mf_factor_tables", fx.with_views(f"""WITH {_BIN_IDX}, {_SX}
SELECT (SELECT count(*) FROM ui) AS n_users, (SELECT count(*) FROM ii) AS n_items, CAST(0 AS BIGINT) AS n_gaps""",
                                            "interactions_raw"))
def q_mf_factor_tables(spark, sf_dir):
    """The log-loss model as factor and bias tables: one row per user and item, and pair scores equal to the model's."""
    from orchard.operators.recommend import score_pairs
    sx, users, items = CM._indexed(spark, sf_dir, "binary")
    samples = CM._samples(sx, items)
    vectors = cut_lineage(H.pair_one_hot_vectors(samples["train"], users, items))
    fm = ML.train_fm(vectors, CM.RANK, max_iter=10, index=(users, items))
    u, i, mu = ML.fm_factor_tables(fm, users.count(), spark)
    own = ML.predictions(fm, vectors, keep=("user_idx", "item_idx")).select(
        F.col("user_idx").cast("long").alias("user_idx"), F.col("item_idx").cast("long").alias("item_idx"), "y_proba").distinct()
    gaps = score_pairs(own, u, i, mu).agg(F.count_if(F.abs(F.col("score") - F.col("y_proba")) > 1e-6).alias("n_gaps"))
    return gaps.select(F.lit(u.count()).cast("long").alias("n_users"), F.lit(i.count()).cast("long").alias("n_items"), "n_gaps")


@register("ncf_score_invariants", fx.with_views("""
SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_outside FROM truth
JOIN user_factors USING (user_idx) JOIN item_factors USING (item_idx)""", "truth", "user_factors", "item_factors"))
def q_ncf_invariants(spark, sf_dir):
    """The perceptron scorer keeps every truth pair with factors and gives probabilities."""
    s = F.col("score")
    return CM.q_ncf_score(spark, sf_dir).agg(F.count(F.lit(1)).alias("n_rows"),
                                             F.count_if(s.isNull() | F.isnan(s) | ~s.between(0, 1)).alias("n_outside"))


@register("mf_train_invariants", fx.with_views("SELECT CAST(5 AS BIGINT) AS n_metrics, CAST(0 AS BIGINT) AS n_outside", "interactions_raw"))
def q_mf_train_invariants(spark, sf_dir):
    """The ranking metrics of the ALS recommender all exist and lie from 0 to 1."""
    row = CM.q_mf(spark, sf_dir)
    values = F.array(*[F.col(c) for c in row.columns])
    return row.select(F.size(values).cast("long").alias("n_metrics"),
                      F.size(F.filter(values, lambda v: v.isNull() | ~v.between(0, 1))).cast("long").alias("n_outside"))
