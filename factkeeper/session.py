"""Spark session defaults and the shared working folder.

Everything in the library takes a ``SparkSession`` from the caller; this module
only offers a builder with the settings the operators are designed for, and a
way to find the cluster's shared folder (``spark.checkpoint.dir``) for
intermediate tables, exports and streaming state.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every job here relies on: UTC so date/timestamp literals mean the
# same thing on every executor, AQE so shuffle partition counts, skewed join
# partitions and small-side broadcasts are decided from runtime sizes.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "factkeeper",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    On a cluster leave ``master`` unset so spark-submit decides; set
    ``shuffle_partitions`` to roughly (shuffled bytes / 128 MB) — AQE then
    coalesces downwards at run time.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if extra:
        conf.update(extra)
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(shuffle_bytes: int, target_partition_bytes: int = 128 << 20) -> dict:
    """Shuffle sizing for a job that shuffles about ``shuffle_bytes``.

    The initial partition count gives ~``target_partition_bytes`` per reduce
    task (so sorts and hash maps fit executor memory instead of spilling);
    AQE then coalesces small partitions and splits skewed join partitions.
    E.g. 100 TB scanned with ~20 TB shuffled → ~160k initial partitions.
    """
    n = max(200, min(500_000, -(-shuffle_bytes // target_partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(2 * target_partition_bytes),
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A folder set on the context (``setCheckpointDir``, or ``spark.checkpoint.dir``
    at its start) comes first, then the setting. Where neither is there, a local
    master gets a private folder; any other raises, since executors on other
    machines would not see one of ours.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if sc.master != "local" and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="factkeeper-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str, temporary: bool = False) -> str:
    """A fresh, never reused folder below the shared checkpoint root.

    ``temporary`` folders (intermediate tables such as stored per-key
    results) are deleted at the end of the ``scratch_scope`` they were made in."""
    path = f"{checkpoint_root(spark)}/factkeeper/{label}-{uuid.uuid4().hex[:12]}"
    if temporary and (paths := _SCOPE.get()) is not None:
        paths.append(path)
    return path


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the executors' Python this package, as ``--py-files`` would (once per application)."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    _SHIPPED.add(sc.applicationId)
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for source in sorted(package.rglob("*.py")):
            z.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(target))


_SCOPE: ContextVar[list[str] | None] = ContextVar("scratch_scope", default=None)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes the temporary folders made inside it, and only those.

    A frame that reads one must have run before the scope ends; scopes of
    other threads and outer ones keep theirs."""
    paths: list[str] = []
    token = _SCOPE.set(paths)
    try:
        yield
    finally:
        _SCOPE.reset(token)
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for p in paths:
            path = jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(conf).delete(path, True)


__all__ = ["BASE_CONF", "build_session", "scale_conf", "checkpoint_root", "scratch_path", "scratch_scope", "ship_package"]
