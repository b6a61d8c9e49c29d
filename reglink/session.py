"""Session construction and shared-folder helpers.

Every operator in the package takes and returns DataFrames; the helpers here
only build a session for scripts and tests, and locate the shared folder that
jobs use to cut lineage or stage derived files.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: adaptive execution re-plans joins and
# partition counts from runtime sizes, splits skewed shuffle partitions, and
# coalesces the many small post-aggregation partitions.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "reglink",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the package's scale settings."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SCALE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a folder every executor can
    reach (HDFS, object store); it is read, never replaced, and its absence
    is an error. Local runs and tests have none, so a fresh temporary folder
    is used there.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return sc.getCheckpointDir() or current
    if not sc.master.startswith("local"):
        # A machine-local folder would leave each executor's files on its own
        # disk, out of reach of the others: a cluster must name a shared one.
        raise RuntimeError("spark.checkpoint.dir is unset: set it to a folder every executor can reach")
    local = tempfile.mkdtemp(prefix="reglink-ckpt-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir() or local


def staging_dir(spark: SparkSession, tag: str) -> str:
    """A fresh folder under the shared checkpoint folder for derived files."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/staging/{tag}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain-Python helpers can use the path."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def input_bytes(spark: SparkSession, paths: str | list[str]) -> int:
    """Total size of the files under ``paths``, summed by a distributed job
    that lists files without reading their content (only ``length`` is read)."""
    from pyspark.sql import functions as F

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    return int(files.agg(F.sum("length")).first()[0] or 0)


def scale_conf(
    total_bytes: int,
    partition_bytes: int = 128 * 1024 * 1024,
    min_partitions: int = 200,
) -> dict[str, str]:
    """Partition settings for an input of ``total_bytes``.

    File splits and the adaptive target are ``partition_bytes`` each, so one
    task's slice fits an executor core's share of memory; the initial
    shuffle partition count covers the whole input at that size,
    and adaptive execution coalesces it down after map-side aggregation has
    shrunk the data. A shuffle partition over four targets counts as skewed.
    """
    n = max(min_partitions, -(-total_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


def tune_for_input(spark: SparkSession, paths: str | list[str], **kw) -> dict[str, str]:
    """Measure the input and apply ``scale_conf`` to the running session."""
    conf = scale_conf(input_bytes(spark, paths), **kw)
    for key, value in conf.items():
        spark.conf.set(key, value)
    return conf


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``reglink`` importable on every executor's Python workers.

    Functions run by ``mapInPandas`` are pickled by reference to this
    package, so the workers must import it. On a cluster the package is
    usually passed with ``--py-files``; otherwise this zips the installed
    package once per application and ships it with ``addPyFile`` (Spark's
    own file distribution; the zip is only read by the driver).
    """
    import zipfile

    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    package_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(package_dir)
    target = os.path.join(tempfile.mkdtemp(prefix="reglink-pyfiles-"), "reglink.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(package_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(app)
