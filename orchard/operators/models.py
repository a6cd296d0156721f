"""Model jobs on MLlib: churn classifiers, the churn pipeline, batch scoring, recommender
factor models, and the Arrow-batched NCF scorer.

Every trainer returns a fitted MLlib model; ``predictions`` turns it into the
(y_true, y_pred, y_proba) table that the metric operators consume. Hyper-parameters follow
the reference models (sklearn / xgboost / torch defaults re-expressed in MLlib terms).
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.base import Model
from pyspark.ml.classification import (GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier,
                                       RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.recommendation import ALS
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.operators import features as H

FEATURES = "features"


def assemble(df: DataFrame, feature_cols: list[str], out: str = FEATURES) -> DataFrame:
    return VectorAssembler(inputCols=feature_cols, outputCol=out, handleInvalid="keep").transform(df)


def predictions(model, df: DataFrame, label_col: str = "label", keep: tuple[str, ...] = (),
                threshold: float = 0.5) -> DataFrame:
    """(keep..., y_true, y_pred, y_proba) with y_pred = P(1) > threshold."""
    out = model.transform(df)
    p1 = vector_to_array("probability")[1]
    return out.select(*keep, F.col(label_col).cast("int").alias("y_true"),
                      (p1 > threshold).cast("int").alias("y_pred"), p1.alias("y_proba"))


def train_logreg(train: DataFrame, label_col: str = "label", weight_col: str | None = None,
                 max_iter: int = 1000, tol: float = 1e-4):
    """L2 logistic regression equivalent to C = 1 on the summed loss: regParam = 1 / n
    (sklearn's default tolerance 1e-4)."""
    n = train.count()
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=label_col, regParam=1.0 / max(n, 1),
                            elasticNetParam=0.0, standardization=False, maxIter=max_iter, tol=tol)
    if weight_col:
        lr = lr.setWeightCol(weight_col)
    return lr.fit(train)


TREE_NODES = 1 << 17  # nodes of one fit that the driver holds at once, as far as they can be told before
GROUP_ROWS = 1 << 12  # training rows up to which a larger forest is fitted group by group


class Forest(Model):
    """A forest whose trees never stand on the driver together.

    MLlib's forest is an object on the driver with every node and its statistics, and each level of a tree is a job. A forest
    that counts on ``nodes`` nodes at most, one for every other row, is MLlib's own. Beyond that the trees are grown and kept on
    the executors (``operators.forest``), in a few jobs for all of them. Small tables, and settings that are MLlib's alone, take
    MLlib's fits of some trees each: ``transform`` adds their class votes to the rows, writes the rows and drops the trees
    before the next ones; the votes sum up to those of one forest with all the trees.
    """

    def __init__(self, settings: RandomForestClassifier, train: DataFrame, nodes: int = TREE_NODES):
        super().__init__()
        self.settings, self.train, self.nodes = settings, train, nodes
        self._grown = None

    def copy(self, extra=None) -> Forest:
        return self

    def _first_group(self, rows: int) -> int:
        """Trees that the first of MLlib's fits may have."""
        return max(1, self.nodes // max(1, min(rows // 2, 2 << self.settings.getMaxDepth())))

    def grown(self):
        """The forest on the executors; None where it is fitted by MLlib."""
        from orchard.operators import forest
        if self._grown is None:
            rows = self.train.count()
            if rows > GROUP_ROWS and self._first_group(rows) < self.settings.getNumTrees() and forest.supported(self.settings, self.train):
                self._grown = forest.Grown(self.settings, self.train)
        return self._grown

    def groups(self):
        """The fitted forests of a few trees each, one after the other; ``numTrees`` trees in all."""
        rf = self.settings
        total, done = rf.getNumTrees(), 0
        size = self._first_group(self.train.count())
        # what "auto" means for the whole forest: MLlib would take all features where a fit has one tree
        subset = "sqrt" if rf.getFeatureSubsetStrategy() == "auto" and total > 1 else rf.getFeatureSubsetStrategy()
        while done < total:
            size = min(size, total - done)
            model = rf.copy({rf.numTrees: size, rf.seed: rf.getSeed() + done, rf.featureSubsetStrategy: subset}).fit(self.train)
            yield model
            done += size
            size = max(1, self.nodes * size // max(model.totalNumNodes, 1))

    def _transform(self, df: DataFrame) -> DataFrame:
        from orchard.session import cut_lineage
        votes, rows = None, df
        if (grown := self.grown()) is not None:
            numbered = cut_lineage(df.withColumn("_row", F.monotonically_increasing_id()))
            rows = cut_lineage(numbered.join(grown.votes(numbered), "_row").drop("_row"))
        else:
            for model in self.groups():
                out = model.transform(rows)
                own = vector_to_array(model.getRawPredictionCol())
                total = own if votes is None else F.zip_with("_votes", own, lambda a, b: a + b)
                rows = votes = cut_lineage(out.select(*df.columns, total.alias("_votes")))
        total = F.aggregate("_votes", F.lit(0.0), lambda a, b: a + b)
        rf, best = self.settings, F.array_max("_votes")
        return rows.select(*df.columns, array_to_vector("_votes").alias(rf.getRawPredictionCol()),
                           array_to_vector(F.transform("_votes", lambda v: v / total)).alias(rf.getProbabilityCol()),
                           (F.array_position("_votes", best) - 1).cast("double").alias(rf.getPredictionCol()))


class ForestClassifier(RandomForestClassifier):
    """MLlib's random forest with all its settings, fitted as a ``Forest``."""

    def _fit(self, dataset: DataFrame) -> Forest:
        plain = RandomForestClassifier(**{p.name: v for p, v in self.extractParamMap().items()})
        return Forest(plain, dataset)


def train_random_forest(train: DataFrame, label_col: str = "label", num_trees: int = 100, max_depth: int = 30,
                        seed: int = 42) -> Forest:
    return ForestClassifier(featuresCol=FEATURES, labelCol=label_col, numTrees=num_trees, maxDepth=max_depth,
                            cacheNodeIds=True, seed=seed).fit(train)


def train_gbt(train: DataFrame, label_col: str = "label", max_iter: int = 100, max_depth: int = 5,
              step: float = 0.1, subsample: float = 1.0, seed: int = 42):
    return GBTClassifier(featuresCol=FEATURES, labelCol=label_col, maxIter=max_iter, maxDepth=max_depth,
                         stepSize=step, subsamplingRate=subsample, seed=seed).fit(train)


def train_mlp(train: DataFrame, n_features: int, label_col: str = "label", hidden=(128, 64, 32),
              max_iter: int = 100, seed: int = 42, initial=None):
    layers = [n_features, *hidden, 2]
    mlp = MultilayerPerceptronClassifier(featuresCol=FEATURES, labelCol=label_col, layers=layers,
                                         maxIter=max_iter, seed=seed)
    return (mlp if initial is None else mlp.setInitialWeights(initial)).fit(train)


def repeat_positives(train: DataFrame, key: str, label_col: str = "label") -> DataFrame:
    """Every positive row n_negative / n_positive times: the positive-class weight as repetition.

    MLlib's perceptron takes no weights. The fraction is spread over rows by a hash of ``key``.
    """
    weight = H.pos_weight(train, label_col).first()[0] or 1.0
    extra = H.hash_unit(F.xxhash64(key)) < weight - int(weight)
    times = F.when(F.col(label_col) == 1, F.lit(int(weight)) + extra.cast("int")).otherwise(1)
    rows = train.withColumn("_times", times).where("_times > 0")
    return rows.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).drop("_times", "_copy")


def train_mlp_early_stop(train: DataFrame, n_features: int, key: str, label_col: str = "label", hidden=(128, 64, 32),
                         epochs: int = 100, step: int = 10, patience: int = 2, seed: int = 42):
    """Perceptron with repeated positives that stops when the validation loss stops falling.

    A fifth of the rows, chosen by hash of ``key``, is the validation set. Training goes on in
    steps of ``step`` iterations from the last weights; after ``patience`` steps without a
    lower log loss it ends with the best model. The reference counts single epochs; MLlib's solver
    restarts its curvature history at each step, so steps are longer.
    """
    from orchard.operators.classification import log_loss
    part = H.hash_unit(F.xxhash64(key), seed=seed)
    fit = repeat_positives(train.where(part >= 0.2), key, label_col)
    validation = train.where(part < 0.2)
    best, best_loss, bad, weights = None, float("inf"), 0, None
    for _ in range(max(1, epochs // step)):
        model = train_mlp(fit, n_features, label_col, hidden, step, seed, weights)
        weights = model.weights
        loss = log_loss(predictions(model, validation, label_col)).first()["log_loss"]
        if loss is None or loss < best_loss:
            best, best_loss, bad = model, loss if loss is not None else best_loss, 0
        else:
            bad += 1
        if bad >= patience:
            break
    return best


def top_coefficients(model, feature_names: list[str], n: int = 10, spark=None) -> DataFrame:
    """Features ranked by |coefficient| (linear) or importance (trees); n rows."""
    if hasattr(model, "coefficients"):
        vals = model.coefficients.toArray()
    else:
        vals = model.featureImportances.toArray()
    rows = sorted(((f, float(v), abs(float(v))) for f, v in zip(feature_names, vals)),
                  key=lambda r: (-r[2], r[0]))[:n]
    spark = spark or __import__("pyspark.sql", fromlist=["SparkSession"]).SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, coefficient double, importance double")


# --- churn pipeline ---------------------------------------------------------------------------

@dataclass
class ChurnModel:
    """Preprocessing fitted on training rows and the classifier on top of it."""

    modes: dict[str, str]
    categories: dict[str, list[str]]
    means: dict[str, float]
    scaler: H.ScalerStats
    classifier: object = None

    @property
    def columns(self) -> list[str]:
        """Feature columns in order: one-hot columns, then scaled numerics."""
        hot = [f"{c}_{v}" for c, cats in self.categories.items() for v in (cats[1:] if len(cats) == 2 else cats)]
        return hot + list(self.means)

    def matrix(self, df: DataFrame) -> DataFrame:
        """``df`` with imputed, one-hot and scaled feature columns in place of the raw ones."""
        filled = H.impute(df.select(*[F.col(c).cast("double").alias(c) if c in self.means else F.col(c)
                                      for c in df.columns]), {**self.modes, **self.means})
        return H.standard_scale(H.one_hot_if_binary(filled, self.categories), self.scaler)

    def transform(self, df: DataFrame) -> DataFrame:
        return self.classifier.transform(assemble(self.matrix(df), self.columns))


def fit_churn_preprocessor(train: DataFrame, categorical: list[str], numeric: list[str]) -> ChurnModel:
    """Categoricals: mode imputing, one-hot that drops one column of binaries and ignores unknown
    values. Numerics: mean imputing, scaling by mean and population deviation. All from ``train``."""
    modes = {r["column"]: r["mode"] for r in H.mode_table(train, categorical).collect()}
    means = H.fit_means(train, numeric)
    filled = H.impute(train.select(*categorical, *[F.col(c).cast("double").alias(c) for c in numeric]), {**modes, **means})
    categories = H.fit_one_hot(filled, categorical)
    return ChurnModel(modes, {c: categories[c] for c in categorical}, means, H.fit_scaler(filled, numeric))


def train_churn(train: DataFrame, categorical: list[str], numeric: list[str], label_col: str = "label") -> ChurnModel:
    """Preprocessing, then logistic regression with balanced class weights and C = 1.

    The weights come from the training rows alone and sum to their number n, so C = 1 on
    the summed loss is regParam = 1 / n on MLlib's weighted mean.
    """
    model = fit_churn_preprocessor(train, categorical, numeric)
    rows = H.balanced_weights(train, label_col)
    model.classifier = train_logreg(assemble(model.matrix(rows), model.columns), label_col, weight_col="weight")
    return model


def churn_batch_score(model: ChurnModel, batch: DataFrame, id_col: str = "customerid") -> DataFrame:
    """Class, P(churn) and confidence (max class probability) for a batch of customers."""
    out = model.transform(batch)
    p = vector_to_array("probability")
    return out.select(id_col, F.col("prediction").cast("int").alias("churn_class"),
                      p[1].alias("churn_probability"), F.array_max(p).alias("confidence"))


# --- recommender factor models ----------------------------------------------------------------

def train_als(interactions: DataFrame, rank: int = 64, max_iter: int = 10, reg: float = 0.1, alpha: float = 1.0,
              seed: int = 42, user_col: str = "user_idx", item_col: str = "item_idx", rating_col: str = "weight"):
    """Implicit-feedback matrix factorisation (ALS) on (user, item, weight).

    Rows with weight <= 0 (unknown event types) carry no preference and are left out: a user
    with only such rows would get an unregularised, singular normal equation.
    """
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, alpha=alpha, implicitPrefs=True, seed=seed,
              userCol=user_col, itemCol=item_col, ratingCol=rating_col, coldStartStrategy="drop",
              nonnegative=False)
    return als.fit(interactions.where(F.col(rating_col) > 0).select(F.col(user_col).cast("int").alias(user_col),
                                       F.col(item_col).cast("int").alias(item_col),
                                       F.col(rating_col).cast("float").alias(rating_col)))


def als_factor_tables(model, user_col: str = "user_idx", item_col: str = "item_idx"):
    """ALS factors as (id, factors array<double>, bias 0.0) tables for ``recommend.top_k_scores``."""
    u = model.userFactors.select(F.col("id").cast("long").alias(user_col),
                                 F.col("features").cast("array<double>").alias("factors"),
                                 F.lit(0.0).alias("bias"))
    i = model.itemFactors.select(F.col("id").cast("long").alias(item_col),
                                 F.col("features").cast("array<double>").alias("factors"),
                                 F.lit(0.0).alias("bias"))
    return u, i


def als_biases(samples: DataFrame, users: DataFrame, items: DataFrame, sweeps: int = 2,
               reg: float = 10.0) -> tuple[float, DataFrame, DataFrame]:
    """Global, user and item biases for fitted factors: (mu, users, items) with ``bias`` filled.

    MLlib's ALS has no biases. mu is the mean residual label - p.q over labelled samples;
    user and item biases are, in turn, the regularised mean of what is left
    (sum / (count + ``reg``)), by grouped aggregates and equi joins.
    """
    p = users.select("user_idx", F.col("factors").alias("_p"))
    q = items.select("item_idx", F.col("factors").alias("_q"))
    from orchard.functions.expressions import dot
    from orchard.operators.recommend import with_factors
    from orchard.session import cut_lineage
    rest = cut_lineage(with_factors(samples, p, q).select(
        "user_idx", "item_idx", (F.col("label") - dot("_p", "_q")).alias("_r")))
    mu = float(rest.agg(F.avg("_r")).first()[0] or 0.0)

    def mean_by(key: str, other: str, biases: DataFrame | None) -> DataFrame:
        left = rest if biases is None else rest.join(biases, other)
        value = F.col("_r") - mu - (F.lit(0.0) if biases is None else F.col("_b"))
        return left.groupBy(key).agg((F.sum(value) / (F.count(F.lit(1)) + reg)).alias("_b"))

    by_user = by_item = None
    for _ in range(sweeps):
        # each is read by the next and by the result: written once
        by_user = cut_lineage(mean_by("user_idx", "item_idx", by_item))
        by_item = cut_lineage(mean_by("item_idx", "user_idx", by_user))

    def filled(table: DataFrame, key: str, biases: DataFrame) -> DataFrame:
        return cut_lineage(table.join(biases, key, "left").select(key, "factors", F.coalesce("_b", F.lit(0.0)).alias("bias")))

    return mu, filled(users, "user_idx", by_user), filled(items, "item_idx", by_item)


FM_DRIVER_BYTES = 256 << 20  # gradients that MLlib's factorisation machine may send to the driver in one fit


def train_fm(train: DataFrame, rank: int = 64, label_col: str = "label", max_iter: int = 100, step: float = 0.02,
             reg: float = 1e-3, seed: int = 42, index: tuple[DataFrame, DataFrame] | None = None,
             driver_bytes: int = FM_DRIVER_BYTES):
    """Matrix factorisation with global, user and item biases, all learned on the log loss.

    A factorisation machine over [one-hot(user) | one-hot(item)] vectors scores mu + b_u + b_i + p_u . q_i. MLlib
    sends (users + items) x (rank + 1) numbers to the driver in each iteration. Where these exceed ``driver_bytes`` in all,
    ``factorisation.fit_pairs`` takes the same steps on the executors, from first factors of its own; it needs the
    ``index`` tables of users and items and the rows' user_idx and item_idx.
    """
    from pyspark.ml.classification import FMClassifier
    if index is not None and sum(t.count() for t in index) * (rank + 1) * 8 * max_iter > driver_bytes:
        from orchard.operators.factorisation import fit_pairs
        return fit_pairs(train, *index, rank, label_col, max_iter, step, reg, seed)
    return FMClassifier(featuresCol=FEATURES, labelCol=label_col, factorSize=rank, fitIntercept=True, fitLinear=True,
                        regParam=reg, maxIter=max_iter, stepSize=step, solver="adamW", seed=seed, initStd=0.05).fit(train)


def fm_factor_tables(model, n_users: int, spark, user_col: str = "user_idx", item_col: str = "item_idx"):
    """(users, items, mu) of a fitted factorisation machine: (id, factors, bias) tables for ``recommend``."""
    if hasattr(model, "users"):  # has them as tables
        return (model.users.withColumnRenamed("user_idx", user_col), model.items.withColumnRenamed("item_idx", item_col),
                model.intercept)
    factors, linear = model.factors.toArray(), model.linear.toArray()

    def table(a: int, b: int, col: str) -> DataFrame:
        rows = [(k - a, factors[k].tolist(), float(linear[k])) for k in range(a, b)]
        return spark.createDataFrame(rows, f"{col} long, factors array<double>, bias double")

    return table(0, n_users, user_col), table(n_users, len(linear), item_col), float(model.intercept)


def pair_features(samples: DataFrame, users: DataFrame, items: DataFrame, kind: str = "gmf",
                  rank: int = 64) -> DataFrame:
    """Factor features of (user, item) samples: GMF = p * q element-wise, NCF = concat(p, q).

    Users and items without fitted factors have zeros, so every sample keeps its row.
    """
    u = users.select("user_idx", F.col("factors").alias("_p"))
    i = items.select("item_idx", F.col("factors").alias("_q"))
    zero = F.array_repeat(F.lit(0.0), rank)
    from orchard.operators.recommend import with_factors
    j = with_factors(samples, u, i, "left").withColumns(
        {"_p": F.coalesce("_p", zero), "_q": F.coalesce("_q", zero)})
    feat = F.zip_with("_p", "_q", lambda a, b: a * b) if kind == "gmf" else F.concat("_p", "_q")
    return j.withColumn(FEATURES, array_to_vector(feat)).drop("_p", "_q")


# --- NCF scoring with broadcast weights -------------------------------------------------------

def mlp_weights(model) -> list[tuple[np.ndarray, np.ndarray]]:
    """(W, b) per layer of a fitted MultilayerPerceptronClassificationModel."""
    layers = list(model.getLayers())
    w = model.weights.toArray()
    out, pos = [], 0
    for a, b in zip(layers[:-1], layers[1:]):
        W = w[pos:pos + a * b].reshape((b, a), order="F").T  # stored as (out x in), column-major
        pos += a * b
        bias = w[pos:pos + b]
        pos += b
        out.append((W, bias))
    return out


def ncf_score(features: DataFrame, weights: list[tuple[np.ndarray, np.ndarray]], array_col: str = "x",
              keep: tuple[str, ...] = (), hidden: str = "sigmoid") -> DataFrame:
    """Forward pass of a perceptron over an array column, in Arrow batches; the weights (small,
    fixed by the architecture) are broadcast once. Returns keep... + score = P(class 1).

    ``hidden``: the activation of the hidden layers, "sigmoid" as MLlib fits them or "relu". The
    output is a sigmoid for one output unit, else the softmax of two.
    """
    if hidden not in ("sigmoid", "relu"):
        raise ValueError("hidden must be 'sigmoid' or 'relu'")
    spark = features.sparkSession
    bc = spark.sparkContext.broadcast(weights)

    def fwd(it):
        ws = bc.value
        for pdf in it:
            if len(pdf) == 0:
                continue
            h = np.stack([np.asarray(v, dtype=np.float64) for v in pdf[array_col].to_numpy()])
            for li, (W, b) in enumerate(ws):
                z = h @ W + b
                if li < len(ws) - 1:
                    h = 1.0 / (1.0 + np.exp(-z)) if hidden == "sigmoid" else np.maximum(z, 0.0)
                elif z.shape[1] == 1:
                    h = 1.0 / (1.0 + np.exp(-z))
                else:
                    e = np.exp(z - z.max(axis=1, keepdims=True))
                    h = e / e.sum(axis=1, keepdims=True)
            out = pdf[list(keep)].copy()
            out["score"] = h[:, -1]
            yield out

    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}" for f in features.select(*keep).schema.fields]
                       + ["score double"])
    return features.select(*keep, array_col).mapInPandas(fwd, schema)
