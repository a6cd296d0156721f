"""SparkSession construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import tempfile
import zipfile
from multiprocessing.pool import ThreadPool
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job relies on: AQE for runtime re-planning (partition coalescing,
# skew-join splitting, broadcast conversion from measured sizes), UTC so that timestamps
# compare equal with the DuckDB oracle, and removal of checkpoint files that nothing reads.
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

# Used where neither the submit arguments nor the caller say otherwise and the master is a
# cluster: start wide and let AQE coalesce to ~256 MB partitions; scans split at 256 MB.
CLUSTER_CONF = {
    "spark.sql.shuffle.partitions": "4000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "orchard", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session configured for the library.

    ``master`` is for local runs and tests; without it the master, the resources and every
    setting given to spark-submit stay as they are.
    """
    builder = SparkSession.builder.appName(app)
    conf = dict(BASE_CONF)
    if master:
        builder = builder.master(master)
        if master.startswith("local"):
            # one JVM: as many shuffle partitions as cores, driver memory is the executor memory
            conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions or os.environ.get("BENCH_CPUS", "8"))
            conf["spark.driver.memory"] = os.environ.get("ORCHARD_DRIVER_MEMORY", "16g")
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    if not is_local(spark):
        given = spark.sparkContext.getConf()
        for k, v in CLUSTER_CONF.items():
            if k not in conf and not given.contains(k):
                spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    if is_local(spark):
        ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def is_local(spark: SparkSession) -> bool:
    """Whether driver and executors are one process (a local-cluster master is not)."""
    return spark.sparkContext.master.split("[")[0] == "local"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Checkpoint directory of the session: the folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a local run (tests) gets a private scratch folder; on a cluster that
    is an error, because executors do not see a folder of the driver's machine.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="orchard-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def cut_lineage(df, eager: bool = True):
    """Reliable checkpoint into the shared checkpoint folder (never a local one).

    With ``cleanCheckpoints`` the files go once the driver no longer refers to the result.
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=eager)


TASK_ROWS = 16384  # rows that are worth a task of their own in a fit


def spread(df, *keys: str):
    """``df`` dealt by hash of ``keys`` over the job's cores, as far as it has rows for them, and written once more.

    For the input of iterative fits: written tables have partitions by their bytes, so a narrow table of many
    rows lies in one or two, and a fit would use that many cores in each of its passes. Smaller tables stay as they are.
    """
    wanted = min(df.sparkSession.sparkContext.defaultParallelism, df.count() // TASK_ROWS)
    return cut_lineage(df.repartition(wanted, *keys)) if wanted > df.rdd.getNumPartitions() else df


def side_by_side(spark: SparkSession, jobs: list) -> list:
    """Results of independent functions of no argument, run at the same time, in their order.

    Fits are long chains of small Spark jobs; one chain alone leaves most cores waiting.
    """
    from pyspark import inheritable_thread_target
    with ThreadPool(max(len(jobs), 1)) as pool:
        return pool.map(lambda job: job(), [inheritable_thread_target(spark)(job) for job in jobs], chunksize=1)


_shipped: set[str] = set()  # application ids


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in workers are found by module name there, whatever folder or
    machine the workers start in.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="orchard-package-")) / "orchard-package.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, str(f.relative_to(root.parent)))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)
