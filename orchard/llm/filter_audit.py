"""Filter interaction audit by an incremental stream that retracts.

Which documents do text filters remove, which of them twice, and does their order matter? The last filter
drops copies: a document fails it when an equal text has a smaller id, anywhere in the table.

All files are read as available-now micro-batches. A document's failures of the text filters are a bit
mask; state keyed by text holds the smallest id seen, with what it counts for. Each batch counts
its documents as copies, then gives the holder of each text's smallest id its mask without the copy bit; when
a smaller id arrives later, the earlier holder's count is retracted in the same way. The counts per part, mask
and label that remain say everything about every order of the filters.

State and counts are tables written per batch (``minima/batch=N``, ``counts/batch=N``), overwritten when
a batch runs again, so a lost executor or driver changes nothing. Equal rows meet in partial sums before
each shuffle, and the state has one narrow row per text, so a text, id or source with a third of all
rows is no hot key. The stream does only work by row; the merge runs as batch queries, with adaptive
execution. With a ``folder`` of its own, a later run reads only the files that are new.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.llm.common import Scratch

COPIES = "E"


def text_filters(text: Column) -> list[tuple[str, Column]]:
    """(letter, failure) of the four text filters; words are runs without white space (space, tab to return)."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        ("A", F.size(words) < 200),
        ("B", 100 * F.size(F.array_distinct(words)).cast("long") < 50 * F.size(words).cast("long")),
        ("C", 100 * capitals.cast("long") > 3 * F.length(text).cast("long")),
        ("D", text.rlike("[#$%&*|]")),
    ]


class Audit:
    """The streaming job over one folder of state; ``counts`` is its result so far."""

    def __init__(self, spark: SparkSession, labels: DataFrame, folder: str | None = None, id_col: str = "doc_id",
                 text_col: str = "text", part_col: str = "lang", filters=text_filters):
        self.spark, self.filters = spark, filters
        self.id_col, self.text_col, self.part_col = id_col, text_col, part_col
        self.scratch = Scratch(spark, "audit")
        if folder:
            self.scratch.base = folder.rstrip("/")
        flag = [F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int")).alias(c) for c in ("quality", "toxic")]
        self.labels = labels.where("doc_id IS NOT NULL AND (quality = 1 OR toxic = 1)").groupBy("doc_id").agg(*flag)

    def rows(self, docs: DataFrame) -> DataFrame:
        """id, key (128 bits of the text's SHA-256), part, mask of every row; nothing but work by row."""
        text = F.coalesce(F.col(f"`{self.text_col}`"), F.lit(""))
        docs = docs.select(F.col(f"`{self.id_col}`").alias("id"), text.alias("text"),
                           F.coalesce(F.col(f"`{self.part_col}`").cast("string"), F.lit("")).alias("part"))
        mask = sum((F.when(fails, 1 << k).otherwise(0) for k, (_, fails) in enumerate(self.filters(F.col("text")))), F.lit(0))
        key = F.substring(F.unhex(F.sha2(F.col("text"), 256)), 1, 16)
        return docs.select("id", key.alias("key"), "part", mask.alias("mask"))

    @property
    def letters(self) -> str:
        return "".join(letter for letter, _ in self.filters(F.lit(""))) + COPIES

    @property
    def copy_bit(self) -> int:
        return 1 << (len(self.letters) - 1)

    def run(self, path: str, batches: int = 4) -> None:
        """Reads the files under ``path`` that this folder has not read yet, in about ``batches`` micro-batches."""
        known = self.spark.read.parquet(path)
        files = max(1, -(-len(known.inputFiles()) // batches))
        # a glob of one name: the file source takes a single file only so
        stream = (self.spark.readStream.schema(known.schema).option("maxFilesPerTrigger", files)
                  .option("maxFileAge", "36500d").parquet(f"{path[:-1]}[{path[-1]}]"))
        query = (self.rows(stream).writeStream.foreachBatch(self._merge).trigger(availableNow=True)
                 .option("checkpointLocation", f"{self.scratch.base}/checkpoint").start())
        query.awaitTermination()

    def _write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.scratch.base}/{name}"
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def _earlier(self, name: str, batch: int, like: str) -> DataFrame:
        """The tables ``name`` of the batches before ``batch``, with their number."""
        base = f"{self.scratch.base}/{name}"
        paths = [f"{base}/batch={b}" for b in range(batch)]
        if not paths:
            return self.spark.createDataFrame([], f"{like}, batch int")
        return self.spark.read.schema(f"{like}, batch int").option("basePath", base).parquet(*paths)

    def _merge(self, batch_df: DataFrame, batch: int) -> None:
        rows = self._write(batch_df, "rows")  # from here on the session of the caller, with adaptive execution
        rows = rows.join(self.labels.select(F.col("doc_id").alias("id"), "quality", "toxic"), "id", "left").fillna(
            0, ["quality", "toxic"])
        rows = self._write(rows, "labelled")
        kind = rows.schema["id"].dataType.simpleString()
        # the smallest id of each text in this batch, and how often it stands in each part
        own = (rows.where("id IS NOT NULL").groupBy("key", "id", "part", "mask", "quality", "toxic").agg(F.count("*").alias("n"))
               .groupBy("key", "id").agg(F.first("mask").alias("mask"), F.max("quality").alias("quality"),
                                         F.max("toxic").alias("toxic"), F.collect_list(F.struct("part", "n")).alias("held"))
               .groupBy("key").agg(F.min(F.struct("id", "mask", "quality", "toxic", "held")).alias("new")))
        like = (f"key binary, now struct<id:{kind},mask:int,quality:int,toxic:int,held:array<struct<part:string,n:bigint>>>")
        state = (self._earlier("minima", batch, like).groupBy("key").agg(F.max_by("now", "batch").alias("old")))
        new, old = F.col("new"), F.col("old")
        changed = own.join(state, "key", "left").where(old.isNull() | (new["id"] <= old["id"]))
        again = new["id"] == old["id"]
        held = F.when(again, F.concat(old["held"], new["held"])).otherwise(new["held"])
        merged = F.struct(new["id"].alias("id"), new["mask"].alias("mask"), new["quality"].alias("quality"),
                          new["toxic"].alias("toxic"), self._summed(held).alias("held"))
        minima = self._write(changed.select(
            "key", merged.alias("now"), "new", F.when(~again, old).alias("gone")), f"minima/batch={batch}")
        # all rows count as copies, rows without an id never do; then holders change sides
        bit = F.lit(self.copy_bit)
        everyone = rows.select("part", F.when(F.col("id").isNull(), F.col("mask")).otherwise(F.col("mask").bitwiseOR(bit))
                               .alias("mask"), "quality", "toxic", F.lit(1).cast("long").alias("n"))
        moves = [self._moved(minima, "new", 1), self._moved(minima.where("gone IS NOT NULL"), "gone", -1)]
        counts = everyone.unionByName(moves[0]).unionByName(moves[1])
        self._write(counts.groupBy("part", "mask", "quality", "toxic").agg(F.sum("n").alias("n")).where("n <> 0"),
                    f"counts/batch={batch}")
        self.scratch.drop("rows", "labelled")

    @staticmethod
    def _summed(held: Column) -> Column:
        """(part, n) lists with one entry per part."""
        parts = F.array_distinct(F.transform(held, lambda h: h["part"]))
        return F.transform(parts, lambda p: F.struct(p.alias("part"), F.aggregate(
            F.filter(held, lambda h: h["part"] == p), F.lit(0).cast("long"), lambda s, h: s + h["n"]).alias("n")))

    def _moved(self, minima: DataFrame, name: str, sign: int) -> DataFrame:
        """Count changes of holders that leave (sign 1) or join (-1) the copies of their text."""
        h, bit = F.col(name), F.lit(self.copy_bit)
        one = minima.select(h["mask"].alias("mask"), h["quality"].alias("quality"), h["toxic"].alias("toxic"),
                            F.explode(h["held"]).alias("h"))
        sides = F.array(F.struct(F.col("mask").alias("mask"), F.lit(sign).alias("sign")),
                        F.struct(F.col("mask").bitwiseOR(bit).alias("mask"), F.lit(-sign).alias("sign")))
        return one.select("quality", "toxic", "h", F.explode(sides).alias("s")).select(
            F.col("h.part").alias("part"), F.col("s.mask").alias("mask"), "quality", "toxic",
            (F.col("h.n") * F.col("s.sign")).alias("n"))

    def counts(self) -> DataFrame:
        """part, mask, n, good, toxic: documents by failures, with those of quality 1 and of toxic 1 among them.

        Bit k of the mask stands for letter k; the last for copies.
        """
        base = f"{self.scratch.base}/counts"
        like = "part string, mask int, quality int, toxic int, n bigint, batch int"
        sums = self.spark.read.schema(like).option("basePath", base).parquet(f"{base}/batch=*").groupBy("part", "mask").agg(
            F.sum("n").alias("n"), F.sum(F.col("n") * F.col("quality")).alias("good"),
            F.sum(F.col("n") * F.col("toxic")).alias("toxic"))
        return sums.where("n <> 0")


def interactions(counts: DataFrame, letters: str) -> DataFrame:
    """part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    One row per part, order of ``letters`` and step, zeros included. A mask of m failures meets its filter f first in 1/m
    of all orders, so ``shapley`` (removals over all orders) needs no sum over orders.
    """
    orders = ["".join(p) for p in permutations(letters)]
    steps = F.array(*[F.struct(F.lit(order).alias("filter_order"), F.lit(k + 1).alias("step"),
                               F.lit(1 << letters.index(letter)).alias("bit"),
                               F.lit(sum(1 << letters.index(x) for x in order[:k])).alias("before"))
                      for order in orders for k, letter in enumerate(order)])
    rows = counts.select("*", F.explode(steps).alias("s"))
    mask, bit, before = F.col("mask"), F.col("s.bit"), F.col("s.before")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0
    share = F.expr(f"{factorial(len(letters))} div bit_count(mask)")

    def total(condition: Column, value: Column) -> Column:
        return F.sum(F.when(condition, value).otherwise(0)).cast("long")

    n = F.col("n")
    return rows.groupBy("part", F.col("s.filter_order").alias("filter_order"), F.col("s.step").alias("step")).agg(
        total(~fails & ~gone, n).alias("kept"), total(fails & ~gone, n).alias("removed"),
        total(fails & gone, n).alias("redundant"), total(mask == bit, n).alias("unique_fails"),
        total(fails & ~gone, F.col("good")).alias("good_lost"), total(fails & ~gone, F.col("toxic")).alias("toxic_lost"),
        total(fails, n * share).alias("shapley"))


def audit(spark: SparkSession, path: str, labels: DataFrame, folder: str | None = None, batches: int = 4) -> DataFrame:
    """``interactions`` of all documents in the Parquet files under ``path`` (columns doc_id, text, lang).

    Null texts are empty and a null lang is the part ''. A row without an id is no copy and makes none; rows of one id and
    text are no copies of each other. ``labels`` (doc_id, quality, toxic) may repeat ids: a flag
    of any row counts. Other columns play no part; an empty table gives no rows.
    """
    job = Audit(spark, labels, folder)
    job.run(path, batches)
    return interactions(job.counts(), job.letters)


# DuckDB: every document against the smallest id of its text, every order by joins of the letters
ORACLE = r"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS q, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS x
    FROM labels GROUP BY doc_id),
f AS (SELECT part, coalesce(q, 0) AS q, coalesce(x, 0) AS x,
    CASE WHEN len(words) < 200 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
    FROM w LEFT JOIN l USING (doc_id)),
c AS (SELECT part, mask, count(*) AS n, sum(q) AS q, sum(x) AS x FROM f GROUP BY part, mask),
b AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f, unnest([1, 2, 4, 8, 16]) AS bit),
o AS (SELECT b1.f || b2.f || b3.f || b4.f || b5.f AS filter_order, [b1.bit, b2.bit, b3.bit, b4.bit, b5.bit] AS bits
    FROM b b1 JOIN b b2 ON b1.bit <> b2.bit JOIN b b3 ON b3.bit NOT IN (b1.bit, b2.bit)
    JOIN b b4 ON b4.bit NOT IN (b1.bit, b2.bit, b3.bit) JOIN b b5 ON b5.bit NOT IN (b1.bit, b2.bit, b3.bit, b4.bit)),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0) AS before
    FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
r AS (SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
    sum(CASE WHEN mask & CAST(bit + before AS INTEGER) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) = 0 THEN q ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & CAST(before AS INTEGER) = 0 THEN x ELSE 0 END) AS toxic_lost
    FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM r
"""
