"""Session helpers: one place for the settings every job here assumes."""

from __future__ import annotations

import atexit
import os
import tempfile

from pyspark.sql import SparkSession


def get_spark(cpus: int | str = "*", shuffle_partitions: int | None = None,
              app: str = "rackpulse") -> SparkSession:
    """Local session for tests and the bench; on a cluster use the given session."""
    parts = shuffle_partitions or (8 if cpus == "*" else max(int(cpus), 1) * 2)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("RACKPULSE_DRIVER_MEM", "16g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    A cluster sets ``spark.checkpoint.dir`` to a shared file system; that value
    is always used. Only when it is unset (a local test session) is a fresh
    scratch folder created.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage")
        configured = tempfile.mkdtemp(prefix="rackpulse-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


_LEAVING: set[str] = set()


def _leave_nothing(spark: SparkSession) -> None:
    """When Python ends, the application's staged tables go."""
    try:
        clear_staged(spark)
    except Exception:  # noqa: BLE001  the session, or its JVM, has ended before
        pass


def _staged_root(spark: SparkSession) -> str:
    """This application's own folder for staged tables under the checkpoint dir."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if spark.sparkContext.applicationId not in _LEAVING:
        _LEAVING.add(spark.sparkContext.applicationId)
        atexit.register(_leave_nothing, spark)
    return f"{base}/staged/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name for one job's files under this application's
    folder in the shared checkpoint dir (removed by ``clear_staged``)."""
    import uuid

    return f"{_staged_root(spark)}/{name}-{uuid.uuid4().hex}"


def clear_staged(spark: SparkSession) -> None:
    """Delete the tables this application wrote with ``stage`` (through the
    Hadoop file system API, so it works on any shared storage)."""
    for key in [k for k in _HELD if k[0] == spark.sparkContext.applicationId]:
        del _HELD[key]
    base = _staged_root(spark)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(path):
        fs.delete(path, True)


_HELD: dict[tuple[str, str], str] = {}


def input_stamp(spark: SparkSession, folder: str) -> str:
    """Names, sizes and times of what lies directly in an input folder; a table
    written anew, or with files added, has another."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    held = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(path)
    return "|".join(sorted(f"{x.getPath().getName()} {x.getLen()} {x.getModificationTime()}" for x in held))


def stage_once(spark: SparkSession, name: str, source: str, build):
    """``build()`` staged once per application and state of ``source`` (the
    input folder), then read by every query that asks."""
    key = (spark.sparkContext.applicationId, f"{name}|{source}|{input_stamp(spark, source)}")
    if key not in _HELD:
        path = scratch_path(spark, name)
        build().write.mode("overwrite").parquet(path)
        _HELD[key] = path
    return spark.read.parquet(_HELD[key])


def spread_over(spark: SparkSession) -> int:
    """The number of parts for rows that cost far more than their bytes say
    (much arithmetic, a file each): adaptive execution would merge them."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def stage(df, name: str, partition_by: tuple[str, ...] = ()):
    """Write ``df`` once as Parquet in the shared checkpoint folder and return
    a DataFrame that reads it back.

    Used for intermediate tables that several branches of one plan read (the
    canonical metric samples, the aligned rows): each branch then scans the
    written table with its own column pruning instead of recomputing, and
    re-shuffling, the whole input. The write is an ordinary distributed job,
    and the files live on the cluster's shared storage, so a lost executor
    costs a task retry, not the table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return spark.read.parquet(path)
