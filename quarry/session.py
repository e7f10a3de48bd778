"""Session helpers.

Library functions never create a session; they take the caller's. The helpers
here are for tests, ``bench.py`` and the copy job's ``main``: they build a
session with sane defaults and make sure a *shared* checkpoint directory is
known before anything cuts lineage.
"""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

CHECKPOINT_CONF = "spark.checkpoint.dir"

# Defaults for a local / test session. On a cluster the submitter's settings win
# because ``getOrCreate`` keeps an existing session and ``conf`` overrides these.
_LOCAL_DEFAULTS = {
    "spark.ui.enabled": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(
    master: str = "local[8]",
    app_name: str = "quarry",
    shuffle_partitions: int = 8,
    conf: dict | None = None,
) -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = SparkSession.builder.master(master).appName(app_name)
    settings = dict(_LOCAL_DEFAULTS)
    settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's shared checkpoint directory.

    In order: the launch setting ``spark.checkpoint.dir``, a directory the
    caller gave the context, and, only for a ``local`` master (tests), a fresh
    one under the system temp folder. Without any of them on a cluster this
    raises: a machine-local folder would not be visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        # the context adds a directory of its own below the one that was set
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        configured = _local_checkpoint_dir(sc.master)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def _local_checkpoint_dir(master: str) -> str:
    if not master.split("[")[0] == "local":
        raise ValueError(
            f"{CHECKPOINT_CONF} is not set: intermediate data needs a folder that all "
            f"executors of {master!r} share"
        )
    return tempfile.mkdtemp(prefix="quarry-ckpt-")


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh sub-directory of the shared checkpoint directory for job output
    that must be visible to every executor (round trips, landed fixtures)."""
    import uuid

    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a directory made by ``scratch_dir``; a missing one is no error."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def clear_scratch(spark: SparkSession) -> None:
    """Delete everything this application landed in the shared folder. Frames
    that still read from it can no longer be computed."""
    current = spark.sparkContext.getCheckpointDir()
    if current:
        remove_dir(spark, current)


def _parquet_writable(dt: T.DataType) -> bool:
    if isinstance(dt, (T.NullType, T.CalendarIntervalType, T.YearMonthIntervalType, T.DayTimeIntervalType)):
        return False
    if isinstance(dt, T.StructType):
        return all(_parquet_writable(f.dataType) for f in dt.fields)
    if isinstance(dt, T.ArrayType):
        return _parquet_writable(dt.elementType)
    if isinstance(dt, T.MapType):
        return _parquet_writable(dt.keyType) and _parquet_writable(dt.valueType)
    return True


def materialize_frame(df: DataFrame, name: str = "materialized") -> DataFrame:
    """Compute ``df`` once into the shared checkpoint directory and read it
    back: as a Parquet table when every type fits (later passes read only the
    columns they need), else with ``checkpoint()``. Either cuts the lineage, so
    a lost executor does not recompute the upstream plan."""
    spark = df.sparkSession
    if _parquet_writable(df.schema):
        path = scratch_dir(spark, name)
        df.write.mode("overwrite").parquet(path)
        return spark.read.parquet(path)
    ensure_checkpoint_dir(spark)
    return df.checkpoint(eager=True)


def local_dir(path: str) -> str:
    """The local-file-API form of ``path`` for writers that run in Python on
    the executors. Only ``file:`` paths and plain paths qualify; on a cluster
    they must name a shared mount. Other schemes (``hdfs://``, ``s3a://``)
    are rejected rather than silently created as a local folder."""
    if re.match(r"[A-Za-z][A-Za-z0-9+.-]+:", path) and not path.startswith("file:"):
        raise ValueError(
            f"{path!r} is not a local or mounted path; Python-side writers need one "
            "(set spark.checkpoint.dir to a shared mount or pass a directory)"
        )
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def task_file_name(sequence: int, suffix: str) -> str:
    """A file name that is the same on every attempt of the current task
    (partition id + sequence within the partition), so a retried or
    speculative attempt replaces its own files instead of adding copies."""
    from pyspark import TaskContext

    ctx = TaskContext.get()
    pid = ctx.partitionId() if ctx is not None else 0
    return f"part-{pid:05d}-{sequence:07d}{suffix}"


def write_file_atomic(directory: str, name: str, data) -> None:
    """Write via a temporary name and rename, so readers never see a
    partial file and a repeated write replaces the earlier one. ``data``: bytes,
    or an iterable of bytes that are written as they come."""
    import contextlib
    import os
    import uuid

    final = os.path.join(directory, name)
    # a name of its own, as two attempts of a task may write at the same time
    tmp = os.path.join(directory, f".{name}.{uuid.uuid4().hex[:12]}.tmp")
    try:
        with open(tmp, "wb") as fh:
            for part in [data] if isinstance(data, (bytes, bytearray, memoryview)) else data:
                fh.write(part)
        os.replace(tmp, final)
    except BaseException:
        with contextlib.suppress(OSError):
            os.remove(tmp)
        raise


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable by the Python workers of this application.

    Functions that run in ``mapInArrow`` refer to helpers of this package, so
    the workers must be able to import it. When the package is not installed
    on the executors, it is zipped once on the driver and handed to
    ``SparkContext.addPyFile`` (Spark distributes it, as with ``--py-files``).
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import os
    import zipfile

    import quarry

    pkg_dir = os.path.dirname(os.path.abspath(quarry.__file__))
    root = os.path.dirname(pkg_dir)
    target = os.path.join(tempfile.mkdtemp(prefix="quarry-pyfiles-"), "quarry.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as zf:
        for folder, _, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(target)
    _SHIPPED.add(app)
