"""Benchmark decontamination: short test items found inside long documents.

Size-partitioned MinHash containment search. Items are partitioned by size into classes of
[2^c, 2^(c+1)) distinct shingles. An item of q shingles is found when a document holds at
least m = ceil(threshold * q) of them, so it may lack q - m, and one of the item's
q - m + 1 smallest shingle hashes (its bottom-k MinHash sketch) must be present. A
document's sketch for a class is its shingle hashes up to the class's largest sketch value;
it probes only the classes whose smallest item it is long enough to contain. No item at or
above the threshold is missed.

Items of fewer words than a shingle are one shingle of their own width, and documents are searched by runs of
that width too. The item sketches are a table that the documents' values are joined with by a shuffle; a
bit filter of fixed size, whatever the number of items, spares the values that no sketch has. Candidates
are verified on the shingles themselves.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orchard.llm.common import Scratch

FILTER_BITS = 26  # the filter has 2^26 bits, 8 MB
CACHE = 200_000  # words whose hashes a Python worker holds

_WORDS = re.compile(r"\w+").findall
_MULT = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93,
                  0xFF51AFD7ED558CCD], np.uint64)


def words_of(text: str | None) -> list[str]:
    """Words of a text: runs of letters, digits and _ in lower case."""
    return _WORDS(text.lower()) if text else []


def shingles_of(words: list[str], size: int) -> list[str]:
    """All shingles in order; fewer words than ``size`` are one shingle, none have none."""
    if not words:
        return []
    return [" ".join(words[i:i + size]) for i in range(max(1, len(words) - size + 1))]


def _mix(h: np.ndarray, width: int) -> np.ndarray:
    """Hashes of all runs of ``width`` word hashes."""
    n = len(h) - width + 1
    out = np.full(n, width, np.uint64)
    for k in range(width):
        out = (out ^ (h[k:k + n] * _MULT[k % len(_MULT)])) * np.uint64(0x9FB21C651E98DF25)
        out ^= out >> np.uint64(29)
    return out


class _Hashes(dict):
    """Word hashes, made when first asked for."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


_HASHES = _Hashes()


def _runs(words: list[str], widths: list[int]) -> dict[int, np.ndarray]:
    """Hashes (63 bits) of all runs of words of each width that the words are enough for."""
    h = np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))
    return {w: (_mix(h, w) >> np.uint64(1)).astype(np.int64) for w in widths if len(words) >= w}


def item_sketch(text: str | None, size: int, threshold: float) -> tuple[int, int, int, np.ndarray] | None:
    """(width, class, least shingles, sketch values) of an item; None without words."""
    words = words_of(text)
    if not words:
        return None
    width = min(size, len(words))
    q = len(set(shingles_of(words, size)))
    need = math.ceil(threshold * q - 1e-9)
    return width, q.bit_length(), need, np.unique(_runs(words, [width])[width])[: q - need + 1]


class Probe:
    """What a document's search needs to know of all items: class bounds and a filter of fixed size."""

    def __init__(self, cuts: list[tuple[int, int, int]], filled: list[tuple[int, int]], bits: int):
        self.cuts, self.mask = cuts, (1 << bits) - 1  # cuts: (width, least shingles, largest value) of each class
        self.widths = sorted({w for w, _, _ in cuts})
        self.filter = np.zeros(max(1, 1 << (bits - 6)), np.uint64)
        for word, value in filled:
            self.filter[word] = value & (2 ** 64 - 1)

    def find(self, text: str | None) -> np.ndarray:
        """Sketch values that ``text`` may share with an item."""
        out = [np.zeros(0, np.int64)]
        words = words_of(text)
        if words and self.widths:
            for width, h in _runs(words, self.widths).items():
                h = h[h <= max((cut for w, least, cut in self.cuts if w == width and least <= len(h)), default=-1)]
                at = (h & self.mask).astype(np.uint64)
                on = (self.filter[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1)
                out.append(np.unique(h[on == 1]))
        return np.unique(np.concatenate(out))


def shared_shingles(text: str, item: str, size: int, threshold: float) -> tuple[int, int] | None:
    """(distinct shingles of the item in the text, of the item) where the text contains the item; else None."""
    words = words_of(item)
    wanted = set(shingles_of(words, size))
    own = words_of(text)
    width = min(size, len(words))
    found = wanted.intersection(" ".join(own[i:i + width]) for i in range(len(own) - width + 1))
    return (len(found), len(wanted)) if len(found) >= math.ceil(threshold * len(wanted) - 1e-9) else None


class Search:
    """One benchmark as written tables: items with row keys, and their sketches."""

    def __init__(self, items: DataFrame, id_col: str, text_col: str, shingle: int, threshold: float, bits: int = FILTER_BITS):
        self.scratch = Scratch(items.sparkSession, "decontaminate")
        self.shingle, self.threshold = shingle, threshold
        self.items = self.scratch.write(items.select(
            F.monotonically_increasing_id().alias("item"), F.col(f"`{id_col}`").alias("item_id"),
            F.col(f"`{text_col}`").alias("item_text")), "items")

        def sketch(batches):
            for batch in batches:
                rows = []
                for item, text in zip(*batch.columns):
                    found = item_sketch(text.as_py(), shingle, threshold)
                    if found:
                        rows += [(item.as_py(), *found[:3], v) for v in found[3].tolist()]
                names = ["item", "width", "class", "least", "value"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * 5)], names)

        self.sketches = self.scratch.write(self.items.select("item", "item_text").mapInArrow(
            sketch, "item long, width long, class long, least long, value long"), "sketches")
        # bounded: a row per width and class, and the words of the filter that have a bit
        cuts = self.sketches.groupBy("width", "class").agg(F.min("least"), F.max("value")).drop("class").collect()
        at = F.col("value").bitwiseAND((1 << bits) - 1)
        filled = self.sketches.groupBy(F.shiftright(at, 6).alias("word")).agg(
            F.bit_or(F.expr("shiftleft(1L, CAST(value & 63 AS INT))")).alias("value"))
        self.shared = items.sparkSession.sparkContext.broadcast(
            Probe([tuple(r) for r in cuts], [tuple(r) for r in filled.collect()], bits))

    def probed(self, docs: DataFrame, text_col: str) -> DataFrame:
        """row (all columns of ``docs``), text and probes, the values that it may share with items."""
        shared = self.shared

        @F.arrow_udf("array<long>")
        def probe(texts: pa.Array) -> pa.Array:
            return pa.array([shared.value.find(t.as_py()) for t in texts], pa.list_(pa.int64()))

        # not deterministic for the planner only: a filter on the result shall not run it twice
        return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").alias("text"),
                           probe.asNondeterministic()(F.col(f"`{text_col}`")).alias("probes"))

    def hits(self, candidates: DataFrame) -> DataFrame:
        """key, item_id, shared, total of every item found in ``candidates`` (key, text, probes)."""
        size, threshold = self.shingle, self.threshold

        @F.arrow_udf("struct<shared:int,total:int>")
        def verify(texts: pa.Array, items: pa.Array) -> pa.Array:
            found = (shared_shingles(t.as_py(), i.as_py(), size, threshold) for t, i in zip(texts, items))
            return pa.array([f and dict(shared=f[0], total=f[1]) for f in found],
                            pa.struct([("shared", pa.int32()), ("total", pa.int32())]))

        pairs = (candidates.select("key", F.explode("probes").alias("value")).join(self.sketches.select("value", "item"), "value")
                 .select("key", "item").distinct())
        both = pairs.join(candidates.select("key", "text"), "key").join(self.items, "item")
        return both.select("key", "item_id", verify.asNondeterministic()("text", "item_text").alias("found")).where(
            "found IS NOT NULL").select("key", "item_id", "found.shared", "found.total")


def contaminated(docs: DataFrame, items: DataFrame, text_col: str = "text", shingle: int = 5, threshold: float = 0.8,
                 id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` and item found in it: the columns of ``docs`` but the text, then
    item_id, n_shared, n_shingles, containment. Columns of ``docs`` with such names give way.

    Words are runs of letters, digits and _ in lower case. Null or wordless texts contain nothing and wordless
    items are contained in nothing; repeated items are reported as often as they occur, and rows of ``docs`` that repeat or
    have no id are rows of their own.
    """
    search = Search(items, id_col, item_text_col, shingle, threshold)
    new = {"item_id", "n_shared", "n_shingles", "containment"}
    keep = [c for c in docs.columns if c != text_col and c.lower() not in new]
    candidates = search.scratch.write(search.probed(docs, text_col).where("size(probes) > 0").withColumn(
        "key", F.monotonically_increasing_id()), "candidates")
    hit = search.hits(candidates).join(candidates.select("key", "row"), "key")
    return hit.select(*[F.col(f"row.`{c}`").alias(c) for c in keep], "item_id", F.col("shared").alias("n_shared"),
                      F.col("total").alias("n_shingles"), (F.col("shared") / F.col("total")).alias("containment"))


def clean(docs: DataFrame, items: DataFrame, text_col: str = "text", shingle: int = 5, threshold: float = 0.8,
          id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that contain no item, by the rules of ``contaminated``; only rows with a candidate are shuffled."""
    search = Search(items, id_col, item_text_col, shingle, threshold)
    probed = search.scratch.write(search.probed(docs, text_col).drop("text").withColumn(
        "key", F.monotonically_increasing_id()), "probed")
    candidates = probed.where("size(probes) > 0")
    hit = search.hits(candidates.select("key", F.col(f"row.`{text_col}`").alias("text"), "probes")).select("key").distinct()
    kept = probed.where("size(probes) = 0").unionByName(candidates.join(hit, "key", "left_anti").select(*probed.columns))
    return kept.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])


# DuckDB: every shingle of every document joined with every shingle of every item, by the items' widths
ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+') AS w FROM documents),
iw AS (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{M}\p{N}_]+') AS w FROM benchmark),
sh AS (SELECT DISTINCT item_id, least(5, len(w)) AS width,
    unnest([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, greatest(2, len(w) - 3))]) AS s FROM iw WHERE len(w) > 0),
wd AS (SELECT DISTINCT width FROM sh),
ds AS (SELECT DISTINCT doc_id, width,
    unnest([array_to_string(w[i:i + width - 1], ' ') FOR i IN range(1, len(w) - width + 2)]) AS s FROM dw, wd
    WHERE len(w) >= width),
tot AS (SELECT item_id, count(*) AS n FROM sh GROUP BY item_id)
SELECT doc_id, item_id, CAST(count(*) AS INTEGER) AS n_shared, CAST(any_value(n) AS INTEGER) AS n_shingles,
       count(*) / any_value(n) AS containment
FROM ds JOIN sh USING (width, s) JOIN tot USING (item_id) GROUP BY doc_id, item_id
HAVING count(*) >= ceil(0.8 * any_value(n) - 1e-9)
"""
