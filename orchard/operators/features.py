"""Feature preparation: splits, encoders, imputers, scaler, class weights, negatives, SMOTE.

Estimator-style pieces follow the fit / transform split of MLlib: ``fit_*`` runs one
aggregate and returns a small, bounded statistics object (one row of means / stds, a
category domain); ``transform`` applies it as literals or as a join with a small table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orchard.functions.expressions import hash_unit
from orchard.operators.prefix import running_sums

SPLIT_PRIME = 2147483647  # 2^31 - 1


def split_hash(id_col: str | Column, seed: int = 42) -> Column:
    """Integer permutation of ids below 2^31-1: ((id * 7919 + seed * 1299709) mod p).

    The id is reduced modulo p first, so that large ids do not overflow."""
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.pmod(F.pmod(c.cast("long"), F.lit(SPLIT_PRIME)) * 7919 + seed * 1299709, F.lit(SPLIT_PRIME))


def stratified_split(df: DataFrame, label_col: str, id_col: str, test_fraction: float = 0.2,
                     seed: int = 42, split_col: str = "split") -> DataFrame:
    """Exact stratified split: per class, the round(f * n_class) rows with the smallest
    hash(id) (ties by id) are 'test', the rest 'train'.

    Ranks come from distributed running counts per class (value ranges of the hash are
    separate tasks), so a class holding most rows is still spread over many tasks.
    """
    h = df.withColumn("_h", split_hash(id_col, seed)).withColumn("_one", F.lit(1))
    ranked = running_sums(h, "_h", ["_one"], group_cols=[label_col], tiebreak=[id_col])
    n_class = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
    j = ranked.join(n_class, label_col)
    test = F.col("_one_cum") <= F.round(F.col("_n") * float(test_fraction))
    return j.withColumn(split_col, F.when(test, "test").otherwise("train")).drop("_h", "_one", "_one_cum", "_n")


def sample_split(df: DataFrame, key_cols: list[str], train_fraction: float = 0.8, seed: int = 42,
                 split_col: str = "split") -> DataFrame:
    """Per-row deterministic split: train when hash(key) < fraction (no ordering, no shuffle).

    Pass (user, item) as the key to keep every copy of a pair on one side.
    """
    return df.withColumn(split_col, F.when(hash_unit(*key_cols, seed=seed) < train_fraction, "train")
                         .otherwise("validation"))


# --- label encoding -----------------------------------------------------------------------

def fit_label_domains(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, value, code): lexicographic rank of each distinct value per column, 0-based."""
    long = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns
    ])).alias("kv")).select("kv.column", "kv.value").where(F.col("value").isNotNull()).distinct()
    # ranks come from a range-partitioned sort, so no column's domain sits in one task
    from orchard.operators.prefix import dense_rank_sorted
    return dense_rank_sorted(long, ["value"], ["column"], "code")


def label_encode(df: DataFrame, domains: DataFrame, columns: list[str]) -> DataFrame:
    """Replace each column by its code; an unseen value fails the job (raise_error)."""
    out = df
    for c in columns:
        d = domains.where(F.col("column") == c).select(F.col("value").alias(f"_v_{c}"),
                                                       F.col("code").alias(f"_c_{c}"))
        out = out.join(d, out[c].cast("string") == d[f"_v_{c}"], "left")
        code = F.when(F.col(f"_c_{c}").isNull() & F.col(c).isNotNull(),
                      F.raise_error(F.concat(F.lit(f"unseen value for {c}: "), F.col(c).cast("string"))))\
            .otherwise(F.col(f"_c_{c}"))
        out = out.withColumn(c, code.cast("long")).drop(f"_v_{c}", f"_c_{c}")
    return out


# --- imputers -----------------------------------------------------------------------------

def fit_means(df: DataFrame, columns: list[str]) -> dict[str, float]:
    """One aggregate -> one row of means (bounded by the number of columns)."""
    row = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def impute(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.select(*[F.coalesce(F.col(c), F.lit(values[c])).alias(c) if c in values else F.col(c)
                       for c in df.columns])


def mode_table(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, mode) as a DataFrame: most frequent non-null value, ties -> smallest.

    One scan for all columns: unpivot, count, and the largest (count, value) per column.
    """
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in columns])).alias("kv")).select("kv.*").where("value is not null")
    counts = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("_n"))
    # max of n, then min of value: the count orders first, the smallest value breaks ties
    top = counts.groupBy("column").agg(F.max("_n").alias("_n"))
    return counts.join(top, ["column", "_n"]).groupBy("column").agg(F.min("value").alias("mode"))


# --- one-hot ------------------------------------------------------------------------------

def fit_one_hot(df: DataFrame, columns: list[str]) -> dict[str, list[str]]:
    """Sorted categories per column, for ``one_hot_if_binary``.

    They come to the driver because they name the columns of its result. For columns with too
    many categories to be columns use ``one_hot_vectors``.
    """
    dom = (df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value"))
                                         for c in columns])).alias("kv"))
           .select("kv.*").where(F.col("value").isNotNull()).distinct().collect())
    out: dict[str, list[str]] = {c: [] for c in columns}
    for r in dom:
        out[r["column"]].append(r["value"])
    return {c: sorted(v) for c, v in out.items()}


def one_hot_if_binary(df: DataFrame, categories: dict[str, list[str]], drop_original: bool = True) -> DataFrame:
    """One 0/1 column per category; binary columns drop their first category; an unknown
    value gives all zeros."""
    new = [F.coalesce((F.col(c).cast("string") == F.lit(v)).cast("double"), F.lit(0.0)).alias(f"{c}_{v}")
           for c, cats in categories.items() for v in (cats[1:] if len(cats) == 2 else cats)]
    keep = [c for c in df.columns if not (drop_original and c in categories)]
    return df.select(*keep, *new)


def one_hot_vectors(df: DataFrame, domains: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """(id, size, indices, values): one sparse vector per row over all categories of ``columns``.

    ``domains`` is the table of ``fit_label_domains``, of any size: categories are joined, not
    collected. A column's categories follow those of the columns before it; an unknown or
    null value adds nothing.
    """
    place = F.array_position(F.array(*[F.lit(c) for c in columns]), F.col("column"))
    sizes = domains.groupBy("column").agg(F.count(F.lit(1)).alias("n")).withColumn("_k", place)
    before = Window.orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)  # one row per column
    first = sizes.select("column", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_first"))
    names = sizes.agg(F.sum("n")).scalar()
    long = df.select(id_col, F.explode(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns])).alias("kv"))
    long = long.select(id_col, "kv.*").join(domains, ["column", "value"], "left").join(F.broadcast(first), "column", "left")
    hit = long.select(id_col, (F.col("_first") + F.col("code")).alias("at"))
    out = hit.groupBy(id_col).agg(F.array_sort(F.collect_list("at")).alias("indices"))  # one per column at most
    return out.select(id_col, names.alias("size"), "indices", F.transform("indices", lambda _: F.lit(1.0)).alias("values"))


# --- scaler -------------------------------------------------------------------------------

@dataclass
class ScalerStats:
    mean: dict[str, float]
    std: dict[str, float]


def fit_scaler(df: DataFrame, columns: list[str]) -> ScalerStats:
    """Means and population standard deviations from one aggregate (zero std -> 1)."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"{c}__m"), F.stddev_pop(x).alias(f"{c}__s")]
    row = df.agg(*aggs).first()
    mean = {c: row[f"{c}__m"] for c in columns}
    std = {c: (row[f"{c}__s"] if row[f"{c}__s"] not in (None, 0.0) else 1.0) for c in columns}
    return ScalerStats(mean, std)


def standard_scale(df: DataFrame, stats: ScalerStats) -> DataFrame:
    return df.select(*[((F.col(c).cast("double") - F.lit(stats.mean[c])) / F.lit(stats.std[c])).alias(c)
                       if c in stats.mean else F.col(c) for c in df.columns])


# --- class weights --------------------------------------------------------------------------

def balanced_weights(df: DataFrame, label_col: str = "label", weight_col: str = "weight") -> DataFrame:
    """weight = n / (n_classes * n_class) joined back by class (class-count table is tiny)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("_nc"))
    n = df.select(F.count(F.lit(1))).scalar()
    k = counts.select(F.count(F.lit(1))).scalar()
    w = counts.select(label_col, (n / (k * F.col("_nc"))).alias(weight_col))
    return df.join(w, label_col)


def pos_weight(df: DataFrame, label_col: str = "label") -> DataFrame:
    """n_negative / n_positive (one row)."""
    return df.agg((F.count_if(F.col(label_col) == 0) / F.count_if(F.col(label_col) == 1)).alias("pos_weight"))


# --- negative sampling ----------------------------------------------------------------------

def draw_hash(row: Column, j: Column, seed: int) -> Column:
    """Pseudo-random integer below 2^31 - 1 of a row key and a draw number, in integer arithmetic
    that SQL elsewhere can repeat: two rounds of h -> (48271 h + c) mod (2^31 - 1)."""
    p = F.lit(SPLIT_PRIME)
    h = F.pmod(F.pmod(row.cast("long"), p) * 48271 + j.cast("long") * 69621 + seed * 16807, p)
    return F.pmod(F.pmod(h, F.lit(65537)) * 48271 + h * 69621 + 12345, p)


def draw_hash_sql(row: str, j: str, seed: int) -> str:
    """``draw_hash`` as DuckDB SQL (non-negative row keys)."""
    h = f"((({row}) % {SPLIT_PRIME} * 48271 + ({j}) * 69621 + {seed * 16807}) % {SPLIT_PRIME})"
    return f"(({h} % 65537 * 48271 + {h} * 69621 + 12345) % {SPLIT_PRIME})"


def negative_sampling(positives: DataFrame, num_items: int | Column, n_neg: int = 4, seed: int = 42,
                      known: DataFrame | None = None, user_col: str = "user_idx", item_col: str = "item_idx",
                      row_col: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``n_neg`` negatives per positive row, uniform over the items of [0, num_items) that the
    user does not own; negatives may repeat (as in uniform redraws).

    ``known`` holds all (user, item) pairs that must not be drawn - every interaction, also
    those of another split; by default the positives themselves.

    A user who owns m items has num_items - m others. A hash of the row draws the rank r of one
    of them, and the r-th item not owned is r + (number of owned items o_i, in order from
    i = 0, with o_i - i <= r). That number is a running count over the owned items and the
    draws of a user in order, taken by value ranges (``running_sums``), so there is no
    redrawing, no enumeration of the catalogue and no task that holds a whole user. A user who
    owns everything gets no negatives. Returns (user, item, label, keep...): positives with label 1.0,
    negatives with 0.0; ``keep`` names columns of a positive that its negatives take over.

    ``row_col`` names a unique row key (e.g. an event id). Without it, row ids are assigned
    and frozen with a reliable checkpoint so that a recomputed task draws the same items.
    """
    from orchard.session import cut_lineage
    if row_col is not None:
        pos = positives.select(user_col, item_col, F.col(row_col).alias("_row"), *keep)
    else:
        pos = cut_lineage(positives.select(user_col, item_col, *keep).withColumn("_row", F.monotonically_increasing_id()))
    own = (positives if known is None else known).select(user_col, F.col(item_col).cast("long").alias(item_col)).distinct()
    # read by the counts and by the running sums
    own = cut_lineage(own.withColumn("_one", F.lit(1).cast("long")))
    n_items = (F.lit(num_items) if not isinstance(num_items, Column) else num_items).cast("long")
    owned = own.groupBy(user_col).agg(F.count(F.lit(1)).alias("_owned"))
    draws = (pos.join(owned, user_col, "left")
             .withColumn("_free", n_items - F.coalesce("_owned", F.lit(0))).where("_free > 0")
             .select(user_col, "_row", *keep, "_free", F.explode(F.sequence(F.lit(0), F.lit(n_neg - 1))).alias("_j"))
             .select(user_col, F.pmod(draw_hash(F.col("_row"), F.col("_j"), seed), F.col("_free")).alias("_at"),
                     F.lit(0).cast("long").alias("_mark"), "_row", F.col("_j").cast("long").alias("_j"), *keep))
    ranked = running_sums(own, item_col, ["_one"], group_cols=[user_col])
    marks = ranked.select(user_col, (F.col(item_col) - (F.col("_one_cum") - 1)).alias("_at"),
                          F.lit(1).cast("long").alias("_mark"),
                          F.lit(None).cast(draws.schema["_row"].dataType).alias("_row"), F.col(item_col).alias("_j"),
                          *[F.lit(None).cast(draws.schema[c].dataType).alias(c) for c in keep])
    # both the window and the range totals read the draws: materialise them once
    both = cut_lineage(marks.unionAll(draws).withColumn("_late", 1 - F.col("_mark")))
    counted = running_sums(both, "_at", ["_mark"], group_cols=[user_col], tiebreak=["_late", "_row", "_j"])
    negs = counted.where("_mark = 0").select(user_col, (F.col("_at") + F.col("_mark_cum")).alias(item_col), *keep)
    return (pos.select(user_col, F.col(item_col).cast("long").alias(item_col), F.lit(1.0).alias("label"), *keep)
            .unionByName(negs.select(user_col, item_col, F.lit(0.0).alias("label"), *keep)))


# --- pair one-hot ---------------------------------------------------------------------------

def pair_one_hot_entries(pairs: DataFrame, num_users: int | Column, user_col="user_idx",
                         item_col="item_idx", row_col="row_id") -> DataFrame:
    """Sparse design matrix of (user, item) pairs in coordinate form: (row, col, value)
    with columns user and num_users + item."""
    nu = F.lit(num_users) if not isinstance(num_users, Column) else num_users
    return pairs.select(row_col, F.explode(F.array(F.col(user_col), nu + F.col(item_col))).alias("col"),
                        F.lit(1.0).alias("value"))


def pair_one_hot_vectors(pairs: DataFrame, user_index: DataFrame, item_index: DataFrame,
                         user_col="user_idx", item_col="item_idx", out_col="features") -> DataFrame:
    """[one-hot(user) | one-hot(item)] as a SparseVector column, JVM-side.

    ``OneHotEncoder`` (dropLast=False) is fitted on the full index tables, so the vector sizes
    are the catalogue sizes even when a sample misses some ids; ``VectorAssembler`` concatenates.
    """
    from pyspark.ml.feature import OneHotEncoder, VectorAssembler
    u = OneHotEncoder(inputCol=user_col, outputCol="_u_oh", dropLast=False).fit(
        user_index.select(F.col(user_col).cast("double")))
    i = OneHotEncoder(inputCol=item_col, outputCol="_i_oh", dropLast=False).fit(
        item_index.select(F.col(item_col).cast("double")))
    df = pairs.withColumn(user_col, F.col(user_col).cast("double")).withColumn(item_col, F.col(item_col).cast("double"))
    out = VectorAssembler(inputCols=["_u_oh", "_i_oh"], outputCol=out_col).transform(i.transform(u.transform(df)))
    return out.drop("_u_oh", "_i_oh")


# --- majority baseline ----------------------------------------------------------------------

def majority_baseline(train: DataFrame, test: DataFrame, label_col: str = "label") -> DataFrame:
    """Predict the most frequent training class for every test row; P(positive) is constant
    (1.0 if the majority is positive else 0.0)."""
    maj = (train.groupBy(label_col).agg(F.count(F.lit(1)).alias("_n"))
           .orderBy(F.col("_n").desc(), F.col(label_col).asc()).limit(1).select(label_col))
    m = maj.scalar()
    return test.withColumn("y_pred", m.cast("int")).withColumn("y_proba", m.cast("double"))


# --- SMOTE ----------------------------------------------------------------------------------

def smote(df: DataFrame, feature_cols: list[str], label_col: str = "label", k: int = 5, seed: int = 42) -> DataFrame:
    """Oversample the minority class to parity by interpolating towards one of the k nearest
    minority neighbours (exact Euclidean kNN).

    The neighbours come from the pivot search of ``knn``: cells and triangle bounds in place of all
    distances. Each row gets floor(need / n_min) synthetic rows, plus one for the first (need mod
    n_min) rows in hash order; a synthetic row is x + lambda * (neighbour - x) with a hash-seeded
    neighbour rank and lambda in [0, 1).
    """
    from orchard.operators.knn import nearest_neighbours
    from orchard.session import cut_lineage

    counts = {r[label_col]: r["n"] for r in df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) < 2:
        return df.select(*feature_cols, label_col)
    minority = min(counts, key=lambda c: (counts[c], c))
    n_min = counts[minority]
    need = max(counts.values()) - n_min
    if need <= 0:
        return df.select(*feature_cols, label_col)
    # several passes follow; the row ids must stay fixed, so materialise once
    mino = cut_lineage(df.where(F.col(label_col) == minority).select(*feature_cols)
                       .withColumn("_id", F.monotonically_increasing_id()))
    x = F.array(*[F.col(c).cast("double") for c in feature_cols])
    nn = nearest_neighbours(mino.select("_id", x.alias("x")), k, "_id").select(
        F.col("id").alias("_id"), F.col("rank").alias("_g"), F.col("nb").alias("_nb"))
    ranked = running_sums(mino.withColumn("_h", F.xxhash64("_id", F.lit(seed))).withColumn("_one", F.lit(1)),
                          "_h", ["_one"], tiebreak=["_id"])
    base, rem = divmod(need, n_min)
    n_syn = F.lit(base) + F.when(F.col("_one_cum") <= rem, 1).otherwise(0)
    ex = ranked.where(n_syn > 0).select("_id", *feature_cols, F.explode(F.sequence(F.lit(0), n_syn - 1)).alias("_j"))
    n_nb = min(k, n_min - 1)
    if n_nb <= 0:  # a single minority row: copies of itself
        synth = ex.select(*feature_cols)
    else:
        ex = ex.withColumn("_g", (F.pmod(F.xxhash64("_id", "_j", F.lit(seed)), F.lit(n_nb)) + 1).cast("long"))
        nb = mino.select(F.col("_id").alias("_nb"), *[F.col(c).alias(f"_n_{c}") for c in feature_cols])
        j = ex.join(nn, ["_id", "_g"]).join(nb, "_nb")
        lam = F.pmod(F.xxhash64("_id", "_j", F.lit(seed + 1)), F.lit(1000003)).cast("double") / 1000003.0
        synth = j.select(*[(F.col(c) + lam * (F.col(f"_n_{c}") - F.col(c))).alias(c) for c in feature_cols])
    return df.select(*feature_cols, label_col).unionByName(synth.withColumn(label_col, F.lit(minority)))
