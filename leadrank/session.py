"""Session helpers: local session for tests and bench, shared scratch folder."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = 8, app: str = "leadrank") -> SparkSession:
    """A local session. On a cluster the caller brings their own session."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables.

    A cluster names it in ``spark.checkpoint.dir``. Where that is unset, a local
    master gets a temporary folder that goes with the process; on any other
    master the executors could not see it, so that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = spark.conf.get("leadrank.local.scratch", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="leadrank-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("leadrank.local.scratch", folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a reliable checkpoint."""
    spark = df.sparkSession
    # pyspark's SparkContext.getCheckpointDir reports the folder in force.
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


#: A table that the planner takes for larger than this is left as it was read.
SPREAD_BYTES = 1 << 30


def spread(df: DataFrame) -> DataFrame:
    """Deal a small table over all cores before heavy per-row work.

    A few files give a few tasks, however many cores there are. Only tables
    below ``SPREAD_BYTES`` are dealt out, so what this shuffles is bounded; a
    larger one is split by its scan already. The planner's estimate decides;
    no file is listed.
    """
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    if int(size) > SPREAD_BYTES:
        return df
    return df.repartition(df.sparkSession.sparkContext.defaultParallelism)


class Reuse:
    """Tables read more than once by a job.

    ``keep`` marks a table for storage on first use; blocks lost with an
    executor are recomputed from lineage. ``release`` frees them all, which
    long-running callers (streams, loops) should do after each run.
    """

    def __init__(self) -> None:
        self._kept: list[DataFrame] = []

    def keep(self, df: DataFrame) -> DataFrame:
        kept = df.persist(StorageLevel.MEMORY_AND_DISK)
        self._kept.append(kept)
        return kept

    def release(self) -> None:
        while self._kept:
            self._kept.pop().unpersist()

    def __enter__(self) -> "Reuse":
        return self

    def __exit__(self, *exc) -> None:
        self.release()
