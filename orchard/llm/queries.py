"""Registered queries of the training-data operators: thin digests over ``documents``, ``embeddings`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm import (
    decontaminate,
    embeddings,
    filter_audit,
    language,
    licenses,
    packing,
    secrets,
    sharding,
    simhash,
    substrings,
    url_rules,
    vector_codes,
    vector_packing,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pca_tiled_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, n_links, component_id, kept of every vector; equal labels, cosine from 0.98 on."""
    return embeddings.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.98)


def op2_randomness_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, counts and places of secrets in every document."""
    found = secrets.scan(_table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "secret_spans")
    spans = F.col("secret_spans")
    counts = [F.size(secrets.of_kind(spans, kind)).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS]
    return found.select("doc_id", *counts, F.sha2(secrets.joined(secrets.base_only(spans)), 256).alias("base_sha256"),
                        secrets.joined(spans).alias("spans"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset, 4096 tokens a sequence."""
    docs = _table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, packing.default_tokenizer(), capacity=4096, end_id=1)


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id of every document (3-word shingles, 3 bits)."""
    docs = _table(spark, sf_dir, "documents")
    found = simhash.near_duplicates(docs, ["doc_id"], "text", shingle=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                        F.col("component.doc_id").alias("component_id"))


def op5_license_similarity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, word count, base phrases and license labels of every document."""
    found = licenses.scan(_table(spark, sf_dir, "documents"))
    starts = F.col("phrase_starts")
    return found.select(
        "doc_id", "n_words", F.size(starts).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join("phrase_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, containment of every benchmark item found in a document."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontaminate.contaminated(docs, _table(spark, sf_dir, "benchmark"))


def op7_suffix_index_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of every document; strings of 100 bytes."""
    return substrings.deduplicate(_table(spark, sf_dir, "documents"), length=100)


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred, score, spans (lang:start:end, comma-joined) of every document."""
    docs = _table(spark, sf_dir, "documents")
    held_out = language.held_out(F.col("doc_id"))
    model = language.fit(docs.where(~held_out))
    found = docs.select("doc_id", held_out.alias("held_out"), language.label(F.col("text"), model).alias("found"))
    spans = F.transform("found.spans", lambda s: F.concat_ws(":", s["lang"], s["start"].cast("string"),
                                                             s["end"].cast("string")))
    return found.select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
                        F.array_join(spans, ",").alias("spans"))


def op9_virtual_slot_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of every document; law: bytes, 24 shards."""
    placed = sharding.shard(_table(spark, sf_dir, "documents"), n_shards=24)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "vslot", "map_version")


def op10_url_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    judged = url_rules.judge(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_vector_bin_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and offset; 4096 tokens, 256 segments a sequence."""
    limits = vector_packing.Limits(tokens=4096, segments=256, loss=4096)
    return vector_packing.pack(_table(spark, sf_dir, "documents"), packing.default_tokenizer(), limits, end_id=2)


def op12_norm_of_sum_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, code, error, label_error, codebooks_sha256 of every usable vector; 8 parts, 16 entries, 6 rounds."""
    codes = vector_codes.compress(_table(spark, sf_dir, "embeddings"), parts=8, entries=16, rounds=6, scale=4096)
    return vector_codes.label_errors(codes).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error",
        F.lit(codes.digest()).alias("codebooks_sha256"))


def op13_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kept, removed, redundant, .. per part, order of the five filters and step, over all documents."""
    return filter_audit.audit(spark, f"{sf_dir}/documents.parquet", _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_pca_tiled_embedding_dedup": op1_pca_tiled_embedding_dedup,
    "op2_randomness_secret_scan": op2_randomness_secret_scan,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_license_similarity_join": op5_license_similarity_join,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_suffix_index_dedup": op7_suffix_index_dedup,
    "op8_language_id": op8_language_id,
    "op9_virtual_slot_sharding": op9_virtual_slot_sharding,
    "op10_url_range_join": op10_url_range_join,
    "op11_vector_bin_packing": op11_vector_bin_packing,
    "op12_norm_of_sum_codes": op12_norm_of_sum_codes,
    "op13_filter_interaction_audit": op13_filter_interaction_audit,
}

ORACLE = {
    "op1_pca_tiled_embedding_dedup": embeddings.ORACLE,
    "op5_license_similarity_join": licenses.oracle(),
    "op6_benchmark_decontamination": decontaminate.ORACLE,
    "op10_url_range_join": url_rules.ORACLE,
    "op12_norm_of_sum_codes": vector_codes.oracle(),
    "op13_filter_interaction_audit": filter_audit.ORACLE,
}
