"""A training corpus made from ``documents`` in stages, each a written table.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and returns a DataFrame,
which is written as Parquet and read again as the next stage's documents. Documents leave
the corpus without a letter, as later members of a near-duplicate group, with a benchmark
item inside, or with a secret; the rest is packed into token sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm import decontaminate, language, packing, secrets, simhash
from orchard.llm.common import Scratch


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: null texts and texts without a letter go.

    Without a learned language (no row has a lang) every text with a letter stays.
    """
    model = language.fit(docs.where(~language.held_out(F.col("doc_id"))))
    found = docs.withColumn("__found", language.label(F.col("text"), model))
    return found.where(F.col("__found.letters")).drop("__found")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group: 3-word shingles, at most 3 differing bits."""
    return simhash.keep_one(docs, "text", shingle=3, radius=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item: 5-word shingles, containment below 0.8."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a secret, neither by pattern nor by randomness."""
    return secrets.scan(docs).where(F.size("secret_spans") == 0).select(*docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their sequence and place in it, 4096 tokens at most."""
    return packing.pack_documents(docs, packing.default_tokenizer())


STAGES = [
    ("language_id", language_id),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("best_fit_packing", best_fit_packing),
]

#: SQL has neither the language model nor XXH64 nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies STAGES to ``documents`` and returns the last stage's rows."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{k}-{name}")
        if k:
            scratch.drop(f"{k - 1}-{STAGES[k - 1][0]}")
    return docs
