"""Readers and writers: event / customer files, part files, table ingest and export,
processed-artifact tables, sample export, run-metric sinks.

Readers take explicit schemas (no inference pass over the data) except where the job is
"ingest whatever CSV arrives" (``ingest_tables``), where inference is the feature.
"""

from __future__ import annotations

import os
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orchard.operators.dictionary import versions
from orchard.operators.interactions import with_load_weights

EVENT_SCHEMA = T.StructType([
    T.StructField("timestamp", T.LongType()),
    T.StructField("visitorid", T.LongType()),
    T.StructField("event", T.StringType()),
    T.StructField("itemid", T.LongType()),
    T.StructField("transactionid", T.LongType()),
])

CUSTOMER_SCHEMA = T.StructType([
    T.StructField("customerid", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("senior_citizen", T.StringType()),
    T.StructField("contract", T.StringType()),
    T.StructField("internet_service", T.StringType()),
    T.StructField("payment_method", T.StringType()),
    T.StructField("tenure_months", T.IntegerType()),
    T.StructField("monthly_charges", T.DoubleType()),
    T.StructField("total_charges", T.StringType()),
    T.StructField("churn_value", T.IntegerType()),
])


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(p))


def load_events(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Event CSV with header -> rows + type weight (view 1, addtocart 2, transaction 3, else null)."""
    return with_load_weights(spark.read.schema(schema).option("header", True).csv(path))


def load_customers(spark: SparkSession, path: str, fmt: str = "csv",
                   schema: T.StructType | None = CUSTOMER_SCHEMA) -> DataFrame:
    """Processed customer table from CSV (explicit schema) or Parquet."""
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.option("header", True)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def combine_parts(parts: list, spark: SparkSession | None = None, fmt: str = "csv") -> DataFrame:
    """Concatenate part files (paths or DataFrames) by column name; a missing path raises."""
    frames = []
    for p in parts:
        if isinstance(p, DataFrame):
            frames.append(p)
            continue
        if spark is None:
            raise ValueError("spark session needed to read paths")
        if not _exists(spark, p):
            raise FileNotFoundError(f"part file not found: {p}")
        frames.append(spark.read.option("header", True).format(fmt).load(p))
    if not frames:
        raise ValueError("no parts")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# Logical table names of the retail dataset and their file names.
SOURCE_FILES = {
    "events": ["events.csv"],
    "item_properties": ["item_properties_part1.csv", "item_properties_part2.csv"],
    "category_tree": ["category_tree.csv"],
}


def collect_sources(root: str, prefix: str = "") -> dict[str, list[str]]:
    """Logical (optionally prefixed) table name -> list of file paths under ``root``."""
    return {f"{prefix}{name}": [os.path.join(root, f) for f in files] for name, files in SOURCE_FILES.items()}


def ingest_tables(spark: SparkSession, sources: dict[str, list[str]], database: str,
                  prefix: str = "") -> list[str]:
    """Create the database, load each CSV source, append; return table names.

    The types of a source are inferred over all of its part files together."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, paths in sources.items():
        table = f"{database}.{prefix}{name}"
        for p in paths:
            if not _exists(spark, p):
                raise FileNotFoundError(f"part file not found: {p}")
        df = spark.read.option("header", True).option("inferSchema", True).csv(list(paths))
        df.write.mode("append").saveAsTable(table)
        names.append(table)
    return names


def ingest_new_files(spark: SparkSession, files: str, schema: str, path: str, checkpoint: str) -> None:
    """Loads the CSV files under ``files`` that no earlier run has loaded.

    The checkpoint remembers the files; each run's micro-batches are stored under their ids, so
    one that runs again overwrites itself. Types are declared: a line that does not fit them
    is kept apart as rejected, with its text. Without new files a run adds nothing.
    """
    typed = T.StructType.fromDDL(schema).add("rejected_line", "string")
    stream = (spark.readStream.schema(typed).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", "rejected_line").csv(files)
              .withColumn("source_file", F.col("_metadata.file_path")))

    def store(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn("rejected", F.col("rejected_line").isNotNull()).write.mode("overwrite")
         .partitionBy("rejected").parquet(f"{path}/version={batch_id}"))

    (stream.writeStream.foreachBatch(store).option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .start().awaitTermination())


def load_ingested(spark: SparkSession, path: str) -> DataFrame:
    """All stored lines: the declared columns, rejected_line, source_file, rejected and version (the batch)."""
    known = versions(spark, path)
    if not known:
        raise ValueError(f"nothing ingested under {path}")
    return spark.read.option("basePath", path).parquet(*[f"{path}/version={v}" for v in known])


def extract_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def extract_query(spark: SparkSession, sql: str, dest: str, force: bool = False,
                  log_shape: bool = False) -> str:
    """Run SQL and write CSV with header; an existing destination is kept unless ``force``."""
    df = spark.sql(sql)
    df.write.mode("overwrite" if force else "ignore").option("header", True).csv(dest)
    if log_shape:
        out = spark.read.option("header", True).csv(dest)
        print(f"[extract] {dest}: {out.count()} rows x {len(out.columns)} columns")
    return dest


def save_processed(base: str, interactions: DataFrame, user_index: DataFrame, item_index: DataFrame,
                   popularity: DataFrame, mode: str = "overwrite") -> dict[str, str]:
    """Write the preprocessing artifacts as Parquet tables under ``base``."""
    paths = {}
    for name, df in [("interactions", interactions), ("user_index", user_index),
                     ("item_index", item_index), ("popularity", popularity)]:
        p = f"{base.rstrip('/')}/{name}"
        df.write.mode(mode).parquet(p)
        paths[name] = p
    return paths


def load_processed(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    """Read the preprocessing artifacts back (typed by Parquet); a missing one raises."""
    out = {}
    for name in ("interactions", "user_index", "item_index", "popularity"):
        p = f"{base.rstrip('/')}/{name}"
        if not _exists(spark, p):
            raise FileNotFoundError(f"processed table missing: {p}")
        out[name] = spark.read.parquet(p)
    return out


def samples_for_export(samples: DataFrame, user_index: DataFrame | None = None,
                       item_index: DataFrame | None = None) -> DataFrame:
    """(user_id, item_id, label, split): dense indexes decoded back to external ids."""
    df = samples
    if user_index is not None:
        df = df.join(user_index, "user_idx").withColumnRenamed("visitorid", "user_id")
    if item_index is not None:
        df = df.join(item_index, "item_idx").withColumnRenamed("itemid", "item_id")
    cols = [c for c in ("user_id", "item_id", "user_idx", "item_idx", "label", "split") if c in df.columns]
    return df.select(*cols)


def export_samples(samples: DataFrame, dest: str, user_index: DataFrame | None = None,
                   item_index: DataFrame | None = None) -> str:
    """Write ``samples_for_export`` as Parquet partitioned by split."""
    samples_for_export(samples, user_index, item_index).write.mode("overwrite").partitionBy("split").parquet(dest)
    return dest


def save_clean_customers(df: DataFrame, dest: str, fmt: str = "parquet") -> str:
    df.write.mode("overwrite").format(fmt).option("header", True).save(dest)
    return dest


def append_run_metrics(metrics: DataFrame, dest: str) -> str:
    """Append (run, [epoch,] metric, value) rows for later comparison."""
    metrics.withColumn("logged_at", F.current_timestamp()).write.mode("append").parquet(dest)
    return dest


def write_bucketed(df: DataFrame, table: str, keys: list[str], n_buckets: int, mode: str = "overwrite") -> str:
    """Save as a catalog table bucketed and sorted by ``keys``: later joins / aggregations on
    those keys between tables with the same bucket count read co-located data (no shuffle)."""
    df.write.mode(mode).bucketBy(n_buckets, *keys).sortBy(*keys).saveAsTable(table)
    return table
