"""Session settings and the shared folder used for checkpoints and scratch tables."""

from __future__ import annotations

import tempfile
import uuid
import warnings

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import SparkSession

_SHARED = "spark.checkpoint.dir"
_SCRATCH: dict[str, list[str]] = {}
#: Folders that were tried out, by application and the name they were given.
_PROVEN: dict[tuple[str, str | None], str] = {}
_INITIAL = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def build_session(
    app: str = "hearthline",
    master: str | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Session for applications. On a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **(conf or {}),
    }
    for name, value in settings.items():
        builder = builder.config(name, value)
    return configure(builder.getOrCreate())


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings the operators rely on; safe to call on any session.

    * UTC, so minute and day buckets do not depend on the machine.
    * A skewed join is split even when an aggregation above it reuses the
      join's partitioning (one more exchange, only where skew is measured).
    * ``checkpoint()`` uses the shared folder (see ``shared_dir``).
    * On a cluster shuffles start with several partitions per core, since adaptive
      execution merges small partitions but cannot add any. A value already set stays.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    context = spark.sparkContext
    local = context.master.startswith("local")
    if context.getCheckpointDir() is None:
        named = spark.conf.get(_SHARED, None)
        if named:
            context.setCheckpointDir(named)
        elif local:
            shared_dir(spark)
    if not local and spark.conf.get(_INITIAL, None) is None:
        planned = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(_INITIAL, str(max(planned, 4 * context.defaultParallelism)))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    The name is taken as ``checkpoint()`` takes it: without a scheme it lies in the default
    file system, which may be a share mounted on every machine. On a cluster it is tried out
    once: where executors write to disks of their own, files would be missing from what is read
    back, often without an error. Then the folder the context checkpoints to or the warehouse is
    taken, and ``checkpoint()`` goes there too. Only a local session without that setting gets
    a temporary folder.
    """
    named = spark.conf.get(_SHARED, None)
    context = spark.sparkContext
    local = context.master.startswith("local")
    if not named and context.getCheckpointDir() is None:
        if not local:
            raise RuntimeError(f"set {_SHARED} to a folder shared by all executors")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="hearthline-"))
    current = context.getCheckpointDir()
    if local and not context.master.startswith("local-cluster"):
        return named or current
    tried = (context.applicationId, named)
    if tried not in _PROVEN:
        folders = [named, current, spark.conf.get("spark.sql.warehouse.dir")]
        folders = list(dict.fromkeys(f for f in folders if f))
        found = next((f for f in folders if _is_shared(spark, f)), None)
        if found is None:
            raise RuntimeError(f"set {_SHARED} to a folder shared by all executors, not {folders}")
        if found not in (named, current):
            warnings.warn(f"executors do not share {folders[0]}; {found} is used", stacklevel=2)
            context.setCheckpointDir(found)
        _PROVEN[tried] = found
    return _PROVEN[tried]


def _is_shared(spark: SparkSession, folder: str) -> bool:
    """Whether what a task on every core writes below ``folder`` is read back whole."""
    tasks = max(2, spark.sparkContext.defaultParallelism)
    path = f"{folder.rstrip('/')}/hearthline/probe-{uuid.uuid4().hex}"
    try:
        spark.range(0, tasks, 1, tasks).write.mode("overwrite").parquet(path)
        found = spark.read.schema("id bigint").parquet(path).count()
        _remove(spark, path)
    except (Py4JJavaError, PySparkException):
        return False
    return found == tasks


def _remove(spark: SparkSession, name: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/hearthline/{label}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Remove the scratch tables of this application; frames that read them end with them."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    return sum(_remove(spark, name) for name in paths)
