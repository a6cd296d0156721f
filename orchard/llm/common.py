"""Shared folder tables, distributed connected components and small numpy helpers."""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Unset on a local master (tests): a private folder is made. Unset on a cluster: an error,
    because executors do not see a folder of the driver's machine.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    master = spark.sparkContext.master
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = spark.sparkContext.getCheckpointDir() or tempfile.mkdtemp(prefix="orchard-llm-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


class Scratch:
    """Tables of one run of an operator in the shared folder.

    A table written here survives the loss of executors and cuts lineage. ``drop`` removes
    a table that nothing reads any more; what the returned DataFrame reads must stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.base}/{name}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        jvm = self.spark._jvm
        for name in names:
            path = jvm.org.apache.hadoop.fs.Path(f"{self.base}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(text: Column) -> Column:
    """``text`` with A-Z in lower case and every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def forest(i: np.ndarray, j: np.ndarray, n: int) -> np.ndarray:
    """Smallest index of each of ``n`` nodes' components under the links ``i[k] - j[k]``."""
    label = np.arange(n)
    while len(i):
        low = np.minimum(label[i], label[j])
        before = label.copy()
        np.minimum.at(label, i, low)
        np.minimum.at(label, j, low)
        label = label[label]
        if np.array_equal(before, label):
            break
    return label


def components(links: DataFrame, scratch: Scratch, name: str = "links") -> DataFrame:
    """Connected components of the links (a, b), two columns of one type.

    Returns (node, root): the smallest node of the component of every linked node that is
    not itself the smallest. Alternates large-star and small-star rounds; a round replaces links by
    links to smaller nodes, so a long chain halves and a hub's rows only pass through
    partial aggregates and joins whose skewed partitions Spark splits. Each round is a
    written table.
    """
    a, b = F.col("a"), F.col("b")

    def star(df: DataFrame, hub_is_larger: bool) -> DataFrame:
        if hub_is_larger:  # small star: each node with its smaller neighbours
            out = df.select(a.alias("hub"), b.alias("nb"))
        else:  # large star: each node with all its neighbours
            out = df.select(a.alias("hub"), b.alias("nb")).unionAll(df.select(b.alias("hub"), a.alias("nb")))
        low = out.groupBy("hub").agg(F.least(F.min("nb"), F.col("hub")).alias("low"))
        joined = out.join(low, "hub")
        if hub_is_larger:
            pairs = joined.select(F.col("nb").alias("a"), F.col("low").alias("b")).unionAll(
                joined.select(F.col("hub").alias("a"), F.col("low").alias("b")))
        else:
            pairs = joined.where("nb > hub").select(F.col("nb").alias("a"), F.col("low").alias("b"))
        return pairs.where(a != b).distinct()

    def mark(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    stars = scratch.write(links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
                          .distinct(), f"{name}-0")
    last, k = mark(stars), 0
    while last[0]:
        k += 1
        stars = scratch.write(star(star(stars, False), True), f"{name}-{k}")
        scratch.drop(f"{name}-{k - 1}")
        now = mark(stars)
        if now == last:
            break
        last = now
    return stars.select(a.alias("node"), b.alias("root"))
