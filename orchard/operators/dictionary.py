"""Versioned id dictionaries: dense numbers that ids keep from run to run.

A dictionary is a folder of ``version=N`` tables, each with the ids that were new then; all
versions up to N together are version N of the dictionary. Ids may be of any orderable type. A
run numbers the ids that no version has, in their order, after the last number given, so
models and tables made with an older version stay valid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orchard.operators.prefix import dense_rank_sorted


def sorted_index(df: DataFrame, col: str, index_col: str) -> DataFrame:
    """Distinct non-null values of ``col``, of any orderable type, numbered from 0 in ascending order.

    The splits of the ranges are sampled from the values themselves; each range is numbered by its own task.
    """
    ids = df.select(col).where(F.col(col).isNotNull())
    return dense_rank_sorted(ids, [col], index_col=index_col)


def versions(spark: SparkSession, path: str) -> list[int]:
    """The versions stored under ``path``, ascending; none where there is no such folder."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(hadoop)]
    done = [n for n in names if n.startswith("version=") and fs.exists(
        spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}/_SUCCESS"))]
    return sorted(int(n.split("=", 1)[1]) for n in done)


def load_index(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(id, number) of one version, the latest by default."""
    known = [v for v in versions(spark, path) if version is None or v <= version]
    if not known:
        raise ValueError(f"no index version under {path}")
    return spark.read.option("basePath", path).parquet(*[f"{path}/version={v}" for v in known]).drop("version")


def update_index(df: DataFrame, col: str, index_col: str, path: str) -> DataFrame:
    """Adds the ids of ``df`` that the dictionary under ``path`` lacks as its next version; returns the whole dictionary.

    Old numbers stay. New ids get the next numbers in ascending order; without new ids no version is written. A
    version that a lost driver left unfinished is written anew. Null ids have no number. One
    writer at a time.
    """
    spark = df.sparkSession
    known = versions(spark, path)
    ids = df.select(col).where(F.col(col).isNotNull())
    first = 0
    if known:
        stored = load_index(spark, path)
        top = stored.agg(F.max(index_col)).first()[0]
        first = 0 if top is None else top + 1
        ids = ids.distinct().join(stored.select(col), col, "left_anti")
    new = sorted_index(ids, col, index_col).withColumn(index_col, F.col(index_col) + F.lit(first))
    target = f"{path}/version={known[-1] + 1 if known else 1}"
    if not known or not new.isEmpty():
        new.write.mode("overwrite").parquet(target)
    return load_index(spark, path)
