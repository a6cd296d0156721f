"""Session settings, the package on the workers, and the entry without its optional parts."""

import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
SF = "/root/testdata/sf0.001"


def run(code, cwd, **env):
    keep = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", code], cwd=cwd, env={**keep, **env}, capture_output=True, text=True, timeout=240)
    assert done.returncode == 0, done.stderr[-2000:]
    return done.stdout.strip().splitlines()[-1]


def test_submit_settings_stay(tmp_path):
    code = (f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
            "from orchard.session import get_spark\n"
            "s = get_spark()\n"
            "print(s.sparkContext.master, s.conf.get('spark.sql.shuffle.partitions'))")
    args = "--master local[2] --conf spark.sql.shuffle.partitions=7 --conf spark.ui.enabled=false pyspark-shell"
    assert run(code, tmp_path, PYSPARK_SUBMIT_ARGS=args) == "local[2] 7"


@pytest.mark.skipif(not os.path.isdir(SF), reason="fixture tables not present")
def test_workers_find_the_package_from_another_folder(tmp_path):
    code = (f"import sys; sys.path.insert(0, {str(ROOT)!r})\n"
            "from pyspark.sql import SparkSession\n"
            "import __spark_entry__ as E\n"
            "s = SparkSession.builder.master('local[2]').config('spark.ui.enabled', 'false').getOrCreate()\n"
            f"print(E.queries()['top_k_per_user'](s, {SF!r}).count() > 0)")
    assert run(code, tmp_path) == "True"


def test_cluster_without_shared_folder_is_an_error():
    from orchard.session import ensure_checkpoint_dir

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(Session())


def test_entry_without_the_training_operators(tmp_path):
    shutil.copytree(ROOT / "orchard", tmp_path / "orchard", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = ("import __spark_entry__ as E\n"
            "q, o = E.queries(), E.oracle_sql()\n"
            "print(len(q) > 100 and set(o) <= set(q) and not any(k.startswith('op1') or k == 'pipeline' for k in q))")
    assert run(code, tmp_path) == "True"


def test_spread_deals_many_rows_over_the_cores(spark, monkeypatch):
    from orchard import session
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    one = spark.range(400).coalesce(1)
    cores = spark.sparkContext.defaultParallelism
    out = session.spread(one, "id")
    assert out.rdd.getNumPartitions() == max(1, min(4, cores))
    assert sorted(r.id for r in out.collect()) == list(range(400))
    assert session.spread(spark.range(99).coalesce(1), "id").rdd.getNumPartitions() == 1


def test_side_by_side_runs_at_once_and_keeps_the_order(spark):
    import threading

    from orchard.session import side_by_side
    meet = threading.Barrier(3, timeout=30)  # passes only when all three are running

    def job(n):
        meet.wait()
        return spark.range(n).count()

    assert side_by_side(spark, [lambda n=n: job(n) for n in (5, 3, 9)]) == [5, 3, 9]
