"""Session construction and shared scratch space."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins and coalesces/splits
# partitions from runtime sizes, skew-join splits a hot key's partition.
_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_STAGES: list[str] = []
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "reviewlens", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in _CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    The cluster names it in ``spark.checkpoint.dir``.  Only a ``local`` master
    (unit tests on one machine) may leave it unset; anywhere else a
    machine-local folder would scatter stages over the executors' disks, so
    that is an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        conf_dir = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors once per application.

    Python workers import it by name; on a cluster, or when the driver was
    started from another folder, they would not find it otherwise.
    """
    sc = spark.sparkContext
    if getattr(sc, "_reviewlens_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="reviewlens-"), "reviewlens_pkg.zip")
    with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(root):
            for n in names:
                if n.endswith((".py", ".txt")):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(archive)
    sc._reviewlens_shipped = True


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared checkpoint folder for written stages."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    # Checkpoint dirs get a per-context uuid appended; keep our stages beside it.
    path = f"{base}/reviewlens-{name}-{uuid.uuid4().hex[:12]}"
    _STAGES.append(path)
    return path


def _delete(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True))


def drop(*staged) -> None:
    """Delete the tables that ``stage`` wrote for these DataFrames.

    Call it when the last job that reads them has ended: a plan that still scans one would fail.
    """
    for df in staged:
        path = getattr(df, "_stage_path", None)
        if path in _STAGES:
            _STAGES.remove(path)
            _delete(df.sparkSession, path)


def drop_stages(spark: SparkSession) -> int:
    """Delete every stage this process wrote; call when their readers are done.  Returns how many were there."""
    found = 0
    while _STAGES:
        found += _delete(spark, _STAGES.pop())
    return found


@contextmanager
def shuffles_go(spark: SparkSession):
    """Delete a query's shuffle files as soon as it has ended.

    Only for queries that write a table and are not run again: otherwise Spark keeps the files until the driver's next
    garbage collection, and a job of many steps holds the shuffles of all of them at once.
    """
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def stage(df, name: str):
    """Write ``df`` once to the shared checkpoint folder and read it back.

    For an expensive intermediate (cleaned text, token counts) that later
    passes read more than once: it is computed once, later passes scan the
    written table, and lineage is cut (a lost executor re-reads the table
    instead of recomputing the text work).
    """
    path = scratch_dir(df.sparkSession, name)
    with shuffles_go(df.sparkSession):
        df.write.parquet(path)
    out = df.sparkSession.read.parquet(path)
    out._stage_path = path
    return out
