"""SimHash near-duplicates by covering locality-sensitive hashing.

Every text gets a 64-bit fingerprint; fingerprints at a Hamming distance of at most
``radius`` link, and the connected components of the links are the groups.

Covering hashing: each of the 64 bit positions gets a non-zero vector of F2^(radius+1).
Table v (any non-zero vector) compares the positions whose vector has an odd product with
v. The vectors of ``radius`` differing positions leave some v orthogonal to all of them,
so in that table the two fingerprints agree: no pair within the radius is ever missed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orchard.llm.common import Scratch, components, forest

TILE = 1024  # fingerprints of one bucket that one comparison holds on each side
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, shingle: int = 3) -> int:
    """SimHash of UTF-8 ``text`` as an unsigned 64-bit number; 0 without words."""
    words = text.translate(_LOWER).split() if text else []
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return digest(b" ".join(words), 42)
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes)[: len(words) - shingle + 1].tolist()
    ends = ends[shingle - 1:].tolist()
    total, step = np.zeros(64, np.int64), 1 << 15
    for k in range(0, len(starts), step):
        hashes = np.array([digest(joined[s:e], 42) for s, e in zip(starts[k:k + step], ends[k:k + step])], "<u8")
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * total > len(starts)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprint_column(text, shingle: int = 3):
    """Column of fingerprints (the bits as a signed long) of a text column."""

    @F.arrow_udf("long")
    def simhash(texts: pa.Array) -> pa.Array:
        values = (fingerprint(t.as_py(), shingle) for t in texts.cast(pa.binary()))
        return pa.array(np.fromiter(values, np.uint64, len(texts)).view(np.int64))

    return simhash(text)


def covering_masks(radius: int, bits: int = 64) -> list[int]:
    """The bit masks of the 2^(radius+1) - 1 tables, as signed longs."""
    vectors = [1 + i % (2 ** (radius + 1) - 1) for i in range(bits)]
    masks = [sum(1 << i for i in range(bits) if (vectors[i] & v).bit_count() % 2) for v in range(1, 2 ** (radius + 1))]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def _linker(radius: int):
    """Links of every bucket (a: one tile; b: another tile of the bucket, or empty)."""

    def link(batches):
        for batch in batches:
            left, right = batch.column("a"), batch.column("b")
            fps = left.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            at = np.concatenate(([0], np.cumsum(left.value_lengths().to_numpy(zero_copy_only=False))))
            sizes, others = np.diff(at), right.value_lengths().to_numpy(zero_copy_only=False)
            small = (sizes <= 32) & (others == 0)
            for s in np.unique(sizes[small]):
                group = fps[at[:-1][small & (sizes == s)][:, None] + np.arange(s)]
                i, j = np.triu_indices(s, 1)
                rows, cols = np.nonzero(np.bitwise_count(group[:, i] ^ group[:, j]) <= radius)
                if len(rows):
                    yield _pairs(group[rows, i[cols]], group[rows, j[cols]])
            for k in np.flatnonzero(~small):
                x = fps[at[k]:at[k + 1]]
                y = np.array(right[int(k)].as_py(), np.int64).view(np.uint64) if others[k] else x
                i, j = np.nonzero(np.bitwise_count(x[:, None] ^ y[None, :]) <= radius)
                nodes = np.concatenate((x, y)) if others[k] else x
                root = forest(i, j + len(x) if others[k] else j, len(nodes))
                low = np.flatnonzero(root != np.arange(len(nodes)))
                if len(low):
                    yield _pairs(nodes[low], nodes[root[low]])

    return link


def _pairs(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.array(y.view(np.int64))], ["a", "b"])


def bucket_links(prints: DataFrame, radius: int) -> DataFrame:
    """Links (a, b) that join all distinct fingerprints ``fp`` within ``radius``.

    A bucket over ``TILE`` members is cut into tiles that meet pairwise, each meeting one
    row of at most two tiles; a meeting returns a spanning forest, never its pairs.
    """
    table = F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), F.col("fp").bitwiseAND(F.lit(m).cast("long")).alias("key"))
        for t, m in enumerate(covering_masks(radius))]))
    keys = prints.select("fp", table.alias("x")).select("fp", "x.t", "x.key")
    sizes = keys.groupBy("t", "key").agg(F.count("*").alias("n")).where("n > 1")
    tiles = (keys.join(sizes, ["t", "key"])
             .withColumn("tiles", F.ceil(F.col("n") / TILE))
             .withColumn("tile", F.pmod(F.xxhash64("fp"), F.col("tiles")))
             .withColumn("other", F.explode(F.expr("sequence(0L, tiles - 1)")))
             .select("t", "key", "fp", "tile", F.least("tile", "other").alias("lo"),
                     F.greatest("tile", "other").alias("hi")))
    meet = tiles.groupBy("t", "key", "lo", "hi").agg(
        F.collect_list(F.when(F.col("tile") == F.col("lo"), F.col("fp"))).alias("a"),
        F.collect_list(F.when((F.col("tile") == F.col("hi")) & (F.col("lo") != F.col("hi")), F.col("fp"))).alias("b"))
    return meet.select("a", "b").mapInArrow(_linker(radius), "a long, b long")


def near_duplicates(docs: DataFrame, id_cols: list[str], text_col: str = "text",
                    shingle: int = 3, radius: int = 3) -> DataFrame:
    """One row per row of ``docs``: ``id_cols``, fp long, component (struct of ``id_cols``).

    ``component`` is the smallest ``id_cols`` among all rows reachable by links of
    fingerprints. Words are runs of characters other than space and \\t..\\r, A-Z count as
    a-z; a text of fewer words than a shingle is one shingle; null, empty and blank texts
    have fingerprint 0 and link like any other. Nulls in ``id_cols`` sort after all other
    values. Repeated rows stay repeated; an empty table gives no rows; other columns of
    ``docs``, whatever their names, play no part.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "simhash")
    ids = F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(id_cols)])
    prints = scratch.write(docs.select(ids.alias("id"), fingerprint_column(F.col(text_col), shingle).alias("fp")),
                           "prints")
    # nulls last: a null flag before each part of the id
    order = F.struct(*[x for i in range(len(id_cols))
                       for x in (F.col(f"id.k{i}").isNull().alias(f"n{i}"), F.col(f"id.k{i}").alias(f"k{i}"))])
    distinct = scratch.write(prints.groupBy("fp").agg(F.min(order).alias("first")), "distinct")
    links = bucket_links(distinct, radius)
    roots = components(links, scratch).select(F.col("node").alias("fp"), "root")
    members = distinct.join(roots, "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    heads = members.groupBy("root").agg(F.min("first").alias("head"))
    names = members.join(heads, "root").select("fp", "head")
    back = F.struct(*[F.col(f"head.k{i}").alias(c) for i, c in enumerate(id_cols)])
    return prints.join(names, "fp").select(
        *[F.col(f"id.k{i}").alias(c) for i, c in enumerate(id_cols)], "fp", back.alias("component"))


def keep_one(docs: DataFrame, text_col: str = "text", shingle: int = 3, radius: int = 3) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the smallest doc_id.

    Rows that share it are told apart by XXH64 of all their columns; of rows equal in
    every column one stays.
    """
    tagged = docs.withColumn("__row", F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]))
    groups = near_duplicates(tagged, ["doc_id", "__row"], text_col, shingle, radius)
    heads = groups.where("doc_id <=> component.doc_id and __row = component.__row").select(
        F.col("doc_id").alias("__id"), F.col("__row").alias("__head")).distinct()
    kept = tagged.join(heads, (F.col("doc_id").eqNullSafe(F.col("__id"))) & (F.col("__row") == F.col("__head")),
                       "left_semi")
    one = F.row_number().over(Window.partitionBy("doc_id", "__row").orderBy(F.lit(0)))
    return kept.withColumn("__n", one).where("__n = 1").drop("__n", "__row")
