"""Shards through fixed virtual slots and a versioned slot-to-shard map.

Records are hashed into a fixed number of slots; rows and bytes are summed per slot; a map
of slots to shards is made from the sums and stored as one version. Rebalancing or adding
shards edits the map: only the records of the slots that it names move.
"""

from __future__ import annotations

import heapq

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orchard.llm.common import Scratch

N_SLOTS = 4096


def record_size(text: Column) -> Column:
    """UTF-8 bytes of the text, null as none, plus 8 for the id."""
    return (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long")


def number_twins(records: DataFrame) -> DataFrame:
    """``records`` (a written table with hash and part) with ``twin``: numbers from 0 among rows of one hash.

    Rows are numbered within the part of the table that they were read in, after the totals of the
    parts before, so a record that makes up a third of all rows is numbered by many tasks.
    """
    totals = records.groupBy("hash", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("hash").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = totals.select("hash", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    inside = F.row_number().over(Window.partitionBy("hash", "part").orderBy("doc_id")) - 1
    numbered = records.withColumn("inside", inside).join(firsts, ["hash", "part"])
    return numbered.withColumn("twin", (F.col("first") + F.col("inside")).cast("long")).drop("first", "inside")


def slot_totals(records: DataFrame) -> DataFrame:
    """(vslot, rows, bytes) of records with columns vslot and size; partial sums meet per slot."""
    return records.groupBy("vslot").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"))


def balanced_map(totals: list, n_shards: int) -> dict[int, int]:
    """slot -> shard with near equal bytes: slots from the heaviest, each to the lightest shard.

    ``totals``: (vslot, rows, bytes) of at most ``n_slots`` slots; ties by slot and shard number.
    """
    heap = [(0, 0, s) for s in range(n_shards)]
    out = {}
    for vslot, rows, size in sorted(totals, key=lambda t: (-t[2], t[0])):
        load, held, shard = heapq.heappop(heap)
        out[vslot] = shard
        heapq.heappush(heap, (load + size, held + rows, shard))
    return out


def rebalanced_map(current: dict[int, int], totals: list, n_shards: int, slack: float = 0.02) -> dict[int, int]:
    """An edit of ``current`` for ``n_shards``: moves slots only from shards over the mean to lighter ones.

    Slots of shards that no longer exist move too. With more shards than before, slots move
    only into the new ones. Stops when the heaviest shard is within ``slack`` of the mean or no
    move of a slot makes it lighter than the one that takes it.
    """
    size = {v: b for v, _, b in totals}
    out = dict(current)
    load = dict.fromkeys(range(n_shards), 0)
    for v, s in out.items():
        load[s] = load.get(s, 0) + size.get(v, 0)
    old = max(current.values(), default=-1) + 1
    takers = list(range(old, n_shards)) if n_shards > old else list(range(n_shards))
    mean = sum(load.values()) / n_shards
    by_shard: dict[int, list] = {}
    for v, s in out.items():
        by_shard.setdefault(s, []).append((size.get(v, 0), v))
    for slots in by_shard.values():
        slots.sort()

    def move(v: int, to: int) -> None:
        load[out[v]] -= size.get(v, 0)
        load[to] += size.get(v, 0)
        out[v] = to

    for s in [s for s in by_shard if s >= n_shards]:
        for _, v in reversed(by_shard.pop(s)):
            move(v, min(takers, key=lambda t: (load[t], t)))
        load.pop(s)
    while True:
        heavy = max((s for s in load if by_shard.get(s)), key=lambda s: (load[s], -s), default=None)
        light = min(takers, key=lambda t: (load[t], t))
        if heavy is None or load[heavy] <= mean * (1 + slack):
            return out
        gap = load[heavy] - load[light]
        k = next((i for i in range(len(by_shard[heavy]) - 1, -1, -1) if by_shard[heavy][i][0] < gap), None)
        if k is None or heavy in takers and n_shards > old:
            return out
        move(by_shard[heavy].pop(k)[1], light)


def store_map(spark: SparkSession, slots: dict[int, int], path: str, version: int) -> None:
    """Writes one version of a map under ``path``; earlier versions stay."""
    rows = [(v, s) for v, s in sorted(slots.items())]
    spark.createDataFrame(rows, "vslot int, shard int").coalesce(1).write.parquet(f"{path}/version={version}")


def load_map(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(version, vslot, shard) of one version, the latest by default."""
    maps = spark.read.option("basePath", path).parquet(path)
    if version is None:
        version = maps.agg(F.max("version")).first()[0]
    return maps.where(F.col("version") == version).select("version", "vslot", "shard")


def shard(docs: DataFrame, n_shards: int = 24, n_slots: int = N_SLOTS, id_col: str = "doc_id",
          text_col: str = "text", map_path: str | None = None) -> DataFrame:
    """doc_id, size, text_crc32, vslot, shard, slot (place in the shard), map_version per row of ``docs``.

    The virtual slot is the hash of id, text and the row's number among its equals, so ids that
    repeat or are null spread by text and equal rows spread by number; null text counts as no
    bytes and checksum 0. The map is stored under ``map_path`` (default: the shared folder) as
    version 1. An empty table gives no rows; other columns play no part. Places run from 0
    without gaps in every shard, ordered by virtual slot, then id and checksum; they come from
    the slot sums and a row number inside a slot, so no task sees a whole shard.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "shards")
    text = F.col(text_col)
    read = scratch.write(docs.select(
        F.col(id_col).alias("doc_id"), record_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.xxhash64(F.col(id_col), text).alias("hash"), F.spark_partition_id().alias("part")), "read")
    vslot = F.pmod(F.xxhash64("hash", "twin"), F.lit(n_slots).cast("long")).cast("int")
    records = scratch.write(number_twins(read).select("doc_id", "size", "text_crc32", vslot.alias("vslot")), "records")
    scratch.drop("read")
    totals = [tuple(r) for r in slot_totals(records).collect()]  # n_slots rows at most
    path = map_path or f"{scratch.base}/map"
    store_map(spark, balanced_map(totals, n_shards), path, 1)
    sums = spark.createDataFrame(totals, "vslot int, rows long, bytes long")
    before = Window.partitionBy("shard").orderBy("vslot").rowsBetween(Window.unboundedPreceding, -1)
    places = load_map(spark, path).join(sums, "vslot").withColumn(
        "first", F.coalesce(F.sum("rows").over(before), F.lit(0)))  # n_slots rows
    inside = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32")) - 1
    return (records.withColumn("inside", inside).join(F.broadcast(places), "vslot")
            .select("doc_id", "size", "text_crc32", "vslot", "shard",
                    (F.col("first") + F.col("inside")).cast("long").alias("slot"),
                    F.col("version").cast("int").alias("map_version")))


def write_shards(docs: DataFrame, assigned: DataFrame, path: str) -> None:
    """Writes the texts of ``docs`` (unique doc_id) under ``path``/shard=N by the places of ``shard``."""
    places = assigned.select("doc_id", "shard", "slot", "vslot")
    (docs.drop("shard", "slot", "vslot").join(places, "doc_id").repartition("shard", "vslot")
     .sortWithinPartitions("shard", "slot").drop("vslot").write.partitionBy("shard").parquet(path))
