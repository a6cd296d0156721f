"""Queries: splits, encoders, imputers, scaler, class weights, feature pipelines, samples."""

from __future__ import annotations

from pyspark.sql import functions as F

from orchard.operators import clean as C
from orchard.operators import features as H
from orchard.operators import interactions as I
from orchard.operators import recommend as R
from orchard.plans.common import CUSTOMERS_CLEAN_CTE, customers_clean, rank_metrics_sql, round_doubles, sql_parse
from orchard.plans.registry import register
from orchard.session import cut_lineage
from orchard.sources import fixtures as fx

CAT = ["gender", "senior_citizen", "contract", "internet_service", "payment_method"]
NUM = ["tenure_months", "monthly_charges", "total_charges"]
FEATS = CAT + NUM


def _cust_ids(spark, sf_dir, fill=True):
    df = customers_clean(spark, sf_dir) if fill else C.coerce_numeric(fx.customers_raw(spark, sf_dir),
                                                                     "total_charges", fill=None)
    return df.withColumn("cid", F.substring("customerid", 2, 20).cast("long"))


def _split(spark, sf_dir, fill=True):
    return H.stratified_split(_cust_ids(spark, sf_dir, fill), "churn_value", "cid", 0.2)


_SPLIT_CTE = f"""{CUSTOMERS_CLEAN_CTE},
cs AS (SELECT *, CAST(substr(customerid, 2) AS BIGINT) AS cid FROM customers_clean),
sr AS (SELECT *, row_number() OVER (PARTITION BY churn_value ORDER BY (cid * 7919 + 42 * 1299709) % 2147483647, cid)
  AS rn, count(*) OVER (PARTITION BY churn_value) AS ncls FROM cs),
sp AS (SELECT * EXCLUDE (rn, ncls), CASE WHEN rn <= round(ncls * 0.2) THEN 'test' ELSE 'train' END AS split FROM sr)"""


def _sql(body: str, *views: str) -> str:
    body = body.strip()
    if body.upper().startswith("WITH "):
        body = f"WITH {_SPLIT_CTE},\n{body[5:]}"
    else:
        body = f"WITH {_SPLIT_CTE}\n{body}"
    return fx.with_views(body, "customers_raw", *views)


@register("stratified_split", _sql("SELECT customerid, churn_value, split FROM sp"))
def q_strat(spark, sf_dir):
    return _split(spark, sf_dir).select("customerid", "churn_value", "split")


@register("split_summary", _sql("""
SELECT split, count(*) AS n_rows, 8 AS n_features, round(avg(CAST(churn_value AS DOUBLE)), 6) AS positive_rate
FROM sp GROUP BY split"""))
def q_split_summary(spark, sf_dir):
    from orchard.operators.profile import split_summary
    df = C.select_features(_split(spark, sf_dir).drop("cid"))
    return round_doubles(split_summary(df.select(*FEATS, "label", "split"), n_features=len(FEATS)))


@register("sample_split", fx.with_views("""
SELECT event_id, CASE WHEN ((visitorid * 7919 + itemid * 104729 + 42 * 1299709) % 1000003) / 1000003e0 < 0.8
  THEN 'train' ELSE 'validation' END AS split
FROM interactions_raw WHERE event IN ('addtocart', 'transaction')""", "interactions_raw"))
def q_sample_split(spark, sf_dir):
    ev = I.binary_interactions(fx.interactions_raw(spark, sf_dir))
    return H.sample_split(ev, ["visitorid", "itemid"], 0.8).select("event_id", "split")


_DOMAINS = """dom AS (SELECT col AS "column", value, CAST(row_number() OVER (PARTITION BY col ORDER BY value) - 1 AS BIGINT)
  AS code FROM (SELECT DISTINCT col, value FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, {c} AS value FROM sp WHERE split = 'train'" for c in CAT) + """)))"""


@register("label_domains", _sql(f"WITH {_DOMAINS} SELECT * FROM dom"))
def q_label_domains(spark, sf_dir):
    tr = _split(spark, sf_dir).where("split = 'train'")
    return H.fit_label_domains(tr, CAT)


@register("label_encode", _sql(f"""WITH {_DOMAINS}
SELECT customerid, """ + ", ".join(
    f"(SELECT code FROM dom WHERE \"column\" = '{c}' AND value = sp.{c}) AS {c}" for c in CAT) + " FROM sp"))
def q_label_encode(spark, sf_dir):
    sp = _split(spark, sf_dir)
    dom = H.fit_label_domains(sp.where("split = 'train'"), CAT)
    return H.label_encode(sp, dom, CAT).select("customerid", *CAT)


@register("impute_mean", fx.with_views(f"""
WITH c AS (SELECT * REPLACE (({sql_parse('total_charges')}) AS total_charges) FROM customers_raw),
cs AS (SELECT *, CAST(substr(customerid, 2) AS BIGINT) AS cid FROM c),
sr AS (SELECT *, row_number() OVER (PARTITION BY churn_value ORDER BY (cid * 7919 + 42 * 1299709) % 2147483647, cid)
  AS rn, count(*) OVER (PARTITION BY churn_value) AS ncls FROM cs),
sp AS (SELECT *, CASE WHEN rn <= round(ncls * 0.2) THEN 'test' ELSE 'train' END AS split FROM sr)
SELECT customerid, round(coalesce(total_charges, (SELECT avg(total_charges) FROM sp WHERE split = 'train')), 6)
  AS total_charges FROM sp""", "customers_raw"))
def q_impute_mean(spark, sf_dir):
    sp = _split(spark, sf_dir, fill=False)
    means = H.fit_means(sp.where("split = 'train'"), ["total_charges"])
    return round_doubles(H.impute(sp, means).select("customerid", "total_charges"))


@register("impute_mode", fx.with_views("\nUNION ALL\n".join(
    f"""SELECT * FROM (SELECT '{c}' AS "column", {c} AS mode FROM customers_raw WHERE {c} IS NOT NULL
  GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)""" for c in CAT), "customers_raw"))
def q_impute_mode(spark, sf_dir):
    return H.mode_table(fx.customers_raw(spark, sf_dir), CAT)


# fixed by the view definition: the sorted categories of each column at every scale
_ONEHOT_CATS = {
    "gender": ["Female", "Male"], "senior_citizen": ["No", "Yes"],
    "contract": ["Month-to-month", "One year", "Two year"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    "payment_method": ["Bank transfer (automatic)", "Credit card (automatic)", "Electronic check", "Mailed check"],
}


def _onehot_sql():
    cols = []
    for c, cats in _ONEHOT_CATS.items():
        keep = cats[1:] if len(cats) == 2 else cats
        for v in keep:
            cols.append(f"CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END AS \"{c}_{v}\"")
    return fx.with_views(f"SELECT customerid, {', '.join(cols)} FROM customers_raw", "customers_raw")


@register("one_hot_if_binary", _onehot_sql())
def q_one_hot(spark, sf_dir):
    df = fx.customers_raw(spark, sf_dir)
    cats = H.fit_one_hot(df, CAT)
    out = H.one_hot_if_binary(df.select("customerid", *CAT), cats)
    return out


_SCALE_STATS = "st AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1e0 ELSE stddev_pop({c}) END AS s_{c}"
    for c in NUM) + " FROM sp WHERE split = 'train')"


@register("standard_scale", _sql(f"""WITH {_SCALE_STATS}
SELECT customerid, """ + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in NUM) + " FROM sp, st"))
def q_scale(spark, sf_dir):
    sp = _split(spark, sf_dir)
    stats = H.fit_scaler(sp.where("split = 'train'"), NUM)
    return round_doubles(H.standard_scale(sp.select("customerid", *NUM), stats))


def loader_features(spark, sf_dir):
    """split -> label encode (train domains) -> mean impute (train) -> scale all features (train)."""
    # both the split and the encoded rows are read by several fits: materialised once
    sp = cut_lineage(_split(spark, sf_dir).withColumnRenamed("churn_value", "label").select(
        "customerid", "split", "label", *FEATS))
    dom = H.fit_label_domains(sp.where("split = 'train'"), CAT)
    enc = cut_lineage(H.label_encode(sp, dom, CAT).select("customerid", "split", "label", *FEATS))
    enc = H.impute(enc, H.fit_means(enc.where("split = 'train'"), FEATS))
    return H.standard_scale(enc, H.fit_scaler(enc.where("split = 'train'"), FEATS))


_ENC = "enc AS (SELECT customerid, split, churn_value AS label, " + ", ".join(
    f"CAST((SELECT code FROM dom WHERE \"column\" = '{c}' AND value = sp.{c}) AS DOUBLE) AS {c}" for c in CAT) + \
    ", " + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM) + " FROM sp)"
_ENC_STATS = "est AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1e0 ELSE stddev_pop({c}) END AS s_{c}"
    for c in FEATS) + " FROM enc WHERE split = 'train')"


@register("loader_features", _sql(f"""WITH {_DOMAINS}, {_ENC}, {_ENC_STATS}
SELECT customerid, split, label, """ + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in FEATS)
                                  + " FROM enc, est"))
def q_loader(spark, sf_dir):
    return round_doubles(loader_features(spark, sf_dir))


@register("balanced_weights", fx.with_views("""
SELECT customerid, churn_value AS label,
  (SELECT count(*) FROM customers_raw) / (2 * count(*) OVER (PARTITION BY churn_value)) AS weight
FROM customers_raw""", "customers_raw"))
def q_balanced(spark, sf_dir):
    df = fx.customers_raw(spark, sf_dir).select("customerid", F.col("churn_value").alias("label"))
    return H.balanced_weights(df).select("customerid", "label", "weight")


@register("pos_weight", fx.with_views("""
SELECT count_if(churn_value = 0) / count_if(churn_value = 1) AS pos_weight FROM customers_raw""", "customers_raw"))
def q_pos_weight(spark, sf_dir):
    return H.pos_weight(fx.customers_raw(spark, sf_dir).withColumnRenamed("churn_value", "label"))


@register("majority_baseline", _sql("""
WITH maj AS (SELECT churn_value FROM sp WHERE split = 'train' GROUP BY churn_value ORDER BY count(*) DESC, churn_value LIMIT 1)
SELECT customerid, CAST((SELECT churn_value FROM maj) AS INT) AS y_pred, CAST((SELECT churn_value FROM maj) AS DOUBLE) AS y_proba
FROM sp WHERE split = 'test'"""))
def q_majority(spark, sf_dir):
    sp = _split(spark, sf_dir).withColumnRenamed("churn_value", "label")
    return H.majority_baseline(sp.where("split = 'train'"), sp.where("split = 'test'")).select(
        "customerid", "y_pred", "y_proba")


_BIN_IDX = """b AS (SELECT * FROM interactions_raw WHERE event IN ('addtocart', 'transaction')),
ui AS (SELECT visitorid, CAST(row_number() OVER (ORDER BY visitorid) - 1 AS BIGINT) AS user_idx
  FROM (SELECT DISTINCT visitorid FROM b)),
ii AS (SELECT itemid, CAST(row_number() OVER (ORDER BY itemid) - 1 AS BIGINT) AS item_idx FROM (SELECT DISTINCT itemid FROM b)),
bx AS (SELECT b.event_id, ui.user_idx, ii.item_idx FROM b JOIN ui USING (visitorid) JOIN ii USING (itemid))"""


def _binary_indexed(spark, sf_dir):
    inter, users, items = I.process(fx.interactions_raw(spark, sf_dir), "binary")
    return inter, users, items


@register("pair_one_hot", fx.with_views(f"""WITH {_BIN_IDX}
SELECT event_id AS row_id, user_idx AS col, 1e0 AS value FROM bx
UNION ALL SELECT event_id, (SELECT count(*) FROM ui) + item_idx, 1e0 FROM bx""", "interactions_raw"))
def q_pair_one_hot(spark, sf_dir):
    inter, users, _ = _binary_indexed(spark, sf_dir)
    n_users = users.select(F.count(F.lit(1))).scalar()
    return H.pair_one_hot_entries(inter.withColumnRenamed("event_id", "row_id"), n_users)


@register("popularity_recommender", fx.with_views(f"""WITH {_BIN_IDX},
sx AS (SELECT *, CASE WHEN ((user_idx * 7919 + item_idx * 104729 + 42 * 1299709) % 1000003) / 1000003e0 < 0.8
  THEN 'train' ELSE 'validation' END AS split FROM bx),
pc AS (SELECT item_idx, CAST(count(*) AS DOUBLE) AS s FROM sx WHERE split = 'train' GROUP BY item_idx),
pop AS (SELECT item_idx, s / (SELECT max(s) FROM pc) AS popularity FROM pc)
SELECT sx.event_id, sx.user_idx, sx.item_idx, round(coalesce(pop.popularity, 0e0), 6) AS score
FROM sx LEFT JOIN pop USING (item_idx) WHERE split = 'validation'""", "interactions_raw"))
def q_pop_recommender(spark, sf_dir):
    """Fit popularity on the training positives, score validation pairs (unknown item -> 0)."""
    inter, _, _ = _binary_indexed(spark, sf_dir)
    sx = H.sample_split(inter, ["user_idx", "item_idx"], 0.8)
    pop = I.popular_items(sx.where("split = 'train'"), item_col="item_idx", weight_col=None)
    val = sx.where("split = 'validation'").select("event_id", "user_idx", "item_idx")
    out = R.popularity_lookup(val, pop, item_col="item_idx", pop_item_col="item_idx")
    return round_doubles(out)


@register("inference_features", _sql(f"""WITH {_DOMAINS.replace("FROM sp WHERE split = 'train'", "FROM sp")},
{_ENC.replace("FROM sp)", "FROM sp WHERE split = 'test')")},
alle AS (SELECT customerid, """ + ", ".join(
    f"CAST((SELECT code FROM dom WHERE \"column\" = '{c}' AND value = sp.{c}) AS DOUBLE) AS {c}" for c in CAT) + ", "
                                     + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in NUM) + """ FROM sp),
ast AS (SELECT """ + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1e0 ELSE stddev_pop({c}) END AS s_{c}"
    for c in FEATS) + """ FROM alle)
SELECT customerid, """ + ", ".join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in FEATS) + " FROM enc, ast"))
def q_inference(spark, sf_dir):
    """Fit domains / means / scales on the whole table, then validate, encode, impute and scale
    a batch (the test split) with the feature columns in training order."""
    sp = _split(spark, sf_dir)
    dom = H.fit_label_domains(sp, CAT)
    batch = sp.where("split = 'test'")
    valid, _ = C.valid_category_check(batch, dom.select("column", "value"), CAT, "customerid")
    enc_all = cut_lineage(H.label_encode(sp, dom, CAT).select("customerid", *FEATS))
    means = H.fit_means(enc_all, FEATS)
    stats = H.fit_scaler(H.impute(enc_all, means), FEATS)
    enc = H.impute(H.label_encode(valid, dom, CAT).select("customerid", *FEATS), means)
    return round_doubles(H.standard_scale(enc, stats))


@register("valid_category_check", _sql("""
WITH dom AS (SELECT DISTINCT col AS "column", value FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS col, {c} AS value FROM sp WHERE split = 'train' AND state = 'AMERICA'" for c in CAT + ["city"]) + """)),
lng AS (""" + " UNION ALL ".join(f"SELECT customerid, '{c}' AS \"column\", {c} AS value FROM sp WHERE split = 'test'"
                                 for c in CAT + ["city"]) + """)
SELECT customerid, "column", value, 'invalid value for ' || "column" AS reason FROM lng
WHERE NOT EXISTS (SELECT 1 FROM dom WHERE dom."column" = lng."column" AND dom.value = lng.value)"""))
def q_valid_category(spark, sf_dir):
    """Rejects of the test split against the category domains learned on the train split of one
    state: the cities of the others."""
    sp = _split(spark, sf_dir)
    dom = C.category_domains(sp.where("split = 'train' and state = 'AMERICA'"), CAT + ["city"])
    _, rejects = C.valid_category_check(sp.where("split = 'test'"), dom, CAT + ["city"], "customerid")
    return rejects


_SX = """sx AS (SELECT *, CASE WHEN ((user_idx * 7919 + item_idx * 104729 + 42 * 1299709) % 1000003) / 1000003e0 < 0.8
  THEN 'train' ELSE 'validation' END AS split FROM bx)"""


def negatives_sql(p: str, rows: str, known: str, items: str, n_neg: int = 4, seed: int = 42) -> str:
    """CTEs ending in {p}neg (the columns of ``rows``, item_idx drawn): the twin of negative_sampling."""
    return f"""{p}own AS (SELECT DISTINCT user_idx, item_idx FROM {known}),
{p}cnt AS (SELECT user_idx, (SELECT count(*) FROM {items}) - count(*) AS free FROM {p}own GROUP BY user_idx),
{p}un AS (SELECT c.user_idx, i.item_idx, row_number() OVER (PARTITION BY c.user_idx ORDER BY i.item_idx) - 1 AS r
  FROM {p}cnt c, {items} i
  WHERE NOT EXISTS (SELECT 1 FROM {p}own o WHERE o.user_idx = c.user_idx AND o.item_idx = i.item_idx)),
{p}dr AS (SELECT s.* EXCLUDE (item_idx), {H.draw_hash_sql("s.event_id", "d.j", seed)} % c.free AS r
  FROM {rows} s JOIN {p}cnt c USING (user_idx), (SELECT unnest(range(0, {n_neg})) AS j) d WHERE c.free > 0),
{p}neg AS (SELECT {p}dr.* EXCLUDE (r), {p}un.item_idx FROM {p}dr JOIN {p}un ON {p}dr.user_idx = {p}un.user_idx AND {p}dr.r = {p}un.r)"""


@register("negative_sampling", fx.with_views(f"""WITH {_BIN_IDX}, {negatives_sql("", "bx", "bx", "ii")}
SELECT user_idx, item_idx, 1e0 AS label FROM bx UNION ALL SELECT user_idx, item_idx, 0e0 FROM neg""", "interactions_raw"))
def q_negative_sampling(spark, sf_dir):
    """4 unowned items per positive row of the binary interactions."""
    inter, _, items = _binary_indexed(spark, sf_dir)
    return H.negative_sampling(inter.select("user_idx", "item_idx", "event_id"), items.count(), 4, row_col="event_id")


@register("negative_sampling_split", fx.with_views(f"""WITH {_BIN_IDX}, {_SX},
v AS (SELECT * FROM sx WHERE split = 'validation')
SELECT CAST(count(*) AS BIGINT) AS n_positives, CAST(4 * count(*) AS BIGINT) AS n_negatives, CAST(0 AS BIGINT) AS n_owned
FROM v""", "interactions_raw"))
def q_negative_sampling_split(spark, sf_dir):
    """Validation samples drawn against the positives of both splits: rows by label, and negatives that
    some interaction owns (none)."""
    inter, _, items = _binary_indexed(spark, sf_dir)
    sx = cut_lineage(H.sample_split(inter, ["user_idx", "item_idx"], 0.8).select("user_idx", "item_idx", "event_id", "split"))
    out = H.negative_sampling(sx.where("split = 'validation'"), items.count(), 4, known=sx, row_col="event_id")
    owned = sx.select("user_idx", "item_idx").distinct().withColumn("_owned", F.lit(1))
    return out.join(owned, ["user_idx", "item_idx"], "left").agg(
        F.count_if(F.col("label") == 1).alias("n_positives"), F.count_if(F.col("label") == 0).alias("n_negatives"),
        F.count_if((F.col("label") == 0) & F.col("_owned").isNotNull()).alias("n_owned"))


@register("smote_invariants", _sql("""
SELECT label, max(count(*)) OVER () AS n_rows, CAST(0 AS BIGINT) AS n_missing FROM (
  SELECT churn_value AS label FROM sp WHERE split = 'train') GROUP BY label"""))
def q_smote_invariants(spark, sf_dir):
    """Rows per class after SMOTE: as many in each as in the larger one before; none with a missing feature."""
    lp = loader_features(spark, sf_dir).where("split = 'train'")
    missing = F.array_contains(F.array(*[F.col(c).isNull() | F.isnan(c) for c in FEATS]), True)
    return H.smote(lp, FEATS, "label", k=5).groupBy("label").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(missing).alias("n_missing"))


@register("smote")
def q_smote(spark, sf_dir):
    """Minority class of the encoded training split oversampled to parity."""
    lp = loader_features(spark, sf_dir).where("split = 'train'")
    return H.smote(lp, FEATS, "label", k=5)


@register("positive_eval_pairs", fx.with_views(f"""WITH {_BIN_IDX},
sx AS (SELECT *, CASE WHEN ((user_idx * 7919 + item_idx * 104729 + 42 * 1299709) % 1000003) / 1000003e0 < 0.8
  THEN 'train' ELSE 'validation' END AS split FROM bx)
SELECT event_id, user_idx, item_idx FROM sx WHERE split = 'validation'""", "interactions_raw"))
def q_positive_eval_pairs(spark, sf_dir):
    """All validation positives."""
    inter, _, _ = _binary_indexed(spark, sf_dir)
    sx = H.sample_split(inter, ["user_idx", "item_idx"], 0.8).where("split = 'validation'")
    pos = sx.select("event_id", "user_idx", "item_idx", F.lit(1).alias("label"))
    return C.positive_eval_pairs(pos).drop("label")


@register("head_sample", _sql("SELECT * EXCLUDE (cid) FROM cs ORDER BY cid LIMIT 5"))
def q_head_sample(spark, sf_dir):
    """First rows of the cleaned customer table in id order (example input)."""
    return _cust_ids(spark, sf_dir).orderBy("cid").limit(5).drop("cid")


@register("export_samples", fx.with_views(f"""WITH {_BIN_IDX}, {_SX}, {negatives_sql("", "sx", "sx", "ii")},
ls AS (SELECT user_idx, item_idx, split, 1e0 AS label FROM sx UNION ALL SELECT user_idx, item_idx, split, 0e0 FROM neg)
SELECT ui.visitorid AS user_id, ii.itemid AS item_id, ls.label, ls.split
FROM ls JOIN ui USING (user_idx) JOIN ii USING (item_idx)""", "interactions_raw"))
def q_export_samples(spark, sf_dir):
    """Training / validation samples of both labels with external ids, as written by export_samples.

    Negatives are drawn against all positives and belong to the split of their positive."""
    from orchard.sources.io import samples_for_export
    inter, users, items = _binary_indexed(spark, sf_dir)
    sx = cut_lineage(H.sample_split(inter, ["user_idx", "item_idx"], 0.8).select("user_idx", "item_idx", "event_id", "split"))
    n = items.count()
    parts = [H.negative_sampling(sx.where(F.col("split") == s), n, 4, known=sx, row_col="event_id")
             .withColumn("split", F.lit(s)) for s in ("train", "validation")]
    return samples_for_export(parts[0].unionByName(parts[1]), users, items).select("user_id", "item_id", "label", "split")


@register("popularity_ranking_metrics", fx.with_views(f"""WITH {_BIN_IDX}, {_SX},
pc AS (SELECT item_idx, CAST(count(*) AS DOUBLE) AS s FROM sx WHERE split = 'train' GROUP BY item_idx),
top AS (SELECT item_idx, row_number() OVER (ORDER BY s DESC, item_idx) AS rank FROM pc ORDER BY s DESC, item_idx LIMIT 10),
val AS (SELECT user_idx, item_idx FROM sx WHERE split = 'validation'),
ctk AS (SELECT u.user_idx, t.item_idx, t.rank FROM (SELECT DISTINCT user_idx FROM val) u, top t),
{rank_metrics_sql("c_", "val", "ctk", 10, "model")}
SELECT {", ".join(f"round({m}_10, 6) AS {m}_10" for m in ("hit_rate", "ndcg", "precision", "recall", "mrr"))}
FROM c_rm""", "interactions_raw"))
def q_popularity_ranking(spark, sf_dir):
    """Ranking metrics at 10 of the popularity recommender over every validation row."""
    from orchard.operators import ranking as N
    from orchard.operators.recommend import popular_top_k_array
    inter, _, _ = _binary_indexed(spark, sf_dir)
    sx = cut_lineage(H.sample_split(inter, ["user_idx", "item_idx"], 0.8).select("user_idx", "item_idx", "split"))
    pop = I.popular_items(sx.where("split = 'train'"), item_col="item_idx", weight_col=None)
    truth = sx.where("split = 'validation'").select("user_idx", "item_idx")
    top = popular_top_k_array(pop, 10, item_col="item_idx").scalar()
    topk = truth.select("user_idx").distinct().select("user_idx", F.explode(top).alias("t")).select(
        "user_idx", F.col("t.item").alias("item_idx"), F.col("t.rank").alias("rank"))
    return round_doubles(N.ranking_metrics(topk, truth, 10))


_CHURN_STATS = "cst AS (SELECT " + ", ".join(
    f"avg({c}) AS m_{c}, CASE WHEN coalesce(stddev_pop({c}), 0) = 0 THEN 1e0 ELSE stddev_pop({c}) END AS s_{c}"
    for c in NUM) + " FROM cfill WHERE split = 'train')"


def _churn_matrix_sql():
    mode = {c: f"(SELECT {c} FROM sp WHERE split = 'train' AND {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)"
            for c in CAT}
    fill = ", ".join([f"coalesce({c}, {mode[c]}) AS {c}" for c in CAT]
                     + [f"coalesce({c}, (SELECT avg({c}) FROM sp WHERE split = 'train')) AS {c}" for c in NUM])
    hot = [f"CASE WHEN {c} = '{v}' THEN 1e0 ELSE 0e0 END AS \"{c}_{v}\"" for c, cats in _ONEHOT_CATS.items()
           for v in (cats[1:] if len(cats) == 2 else cats)]
    return _sql(f"""WITH cfill AS (SELECT customerid, split, {fill} FROM sp), {_CHURN_STATS}
SELECT customerid, split, {', '.join(hot)}, {', '.join(f"round(({c} - m_{c}) / s_{c}, 6) AS {c}" for c in NUM)}
FROM cfill, cst""")


@register("churn_matrix", _churn_matrix_sql())
def q_churn_matrix(spark, sf_dir):
    """The churn pipeline's feature matrix, all of it fitted on the training rows: mode and mean
    imputing, one-hot with one column per binary, scaled numerics."""
    from orchard.operators.models import fit_churn_preprocessor
    sp = cut_lineage(_split(spark, sf_dir).select("customerid", "split", *FEATS))
    model = fit_churn_preprocessor(sp.where("split = 'train'"), CAT, NUM)
    return round_doubles(model.matrix(sp).select("customerid", "split", *model.columns))
