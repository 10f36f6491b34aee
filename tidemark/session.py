"""Session helpers: a local session for tests and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_SCRATCH: dict[str, str] = {}


def local_session(cores: int | str = 8, app_name: str = "tidemark", **conf) -> SparkSession:
    """A single-JVM session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(cores) if str(cores).isdigit() else "8")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` or the context's checkpoint directory.

    Only a local session without either (tests) gets a fresh temporary one; on a
    cluster each executor would see a folder of its own there, so this raises.
    """
    context = spark.sparkContext
    app = context.applicationId
    if app not in _SCRATCH:
        set_on_context = context._jsc.sc().getCheckpointDir()
        base = spark.conf.get("spark.checkpoint.dir", None) or (set_on_context.get() if set_on_context.isDefined() else None)
        if not base:
            if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
                raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
            base = tempfile.mkdtemp(prefix="tidemark-")
        _SCRATCH[app] = f"{base.rstrip('/')}/tidemark-{uuid.uuid4().hex}"
    return _SCRATCH[app]


# The most that a task reads of stored files. What a scan sorts or counts before a shuffle grows with what
# it read, so this bounds a task's memory at any table size; the usual 128 MB are millions of narrow rows.
SCAN_MB = 16


def bound_scans(spark: SparkSession) -> None:
    """Let a task of this session read ``SCAN_MB`` of files at most; a lower setting stays."""
    key = "spark.sql.files.maxPartitionBytes"
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key))
    if now > SCAN_MB << 20:
        spark.conf.set(key, f"{SCAN_MB}m")


# The most that is broadcast on the strength of a guess. Before a join runs, all that Spark knows of a stored side is
# the size of its compressed files; a column of ids takes up to ninety times its share of them (measured) in memory, on
# the driver and on every executor. So these are some 10 MB there, what Spark broadcasts of measured sides.
GUESSED_KB = 128


def bound_broadcasts(spark: SparkSession) -> None:
    """Let this session broadcast ``GUESSED_KB`` of files at most; a lower setting stays.

    The former bound goes on to hold where a side was shuffled and so measured.
    """
    key, measured = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    if spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold() > GUESSED_KB << 10:
        if spark.conf.get(measured, None) is None:
            spark.conf.set(measured, spark.conf.get(key))
        spark.conf.set(key, f"{GUESSED_KB}k")


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder of stored files, wherever Spark keeps them."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def complete_folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders of that pattern that a finished write left, in the order of their names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{pattern}/_SUCCESS")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().getParent().toString() for f in found or [])


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def replace_partitions(rows: DataFrame, path: str, column: str, values: Iterable) -> None:
    """Make ``rows`` all there is of the partitions ``values`` (of ``column``) in a folder; others are not touched.

    ``rows`` are read twice, so they must be stored, and not in the partitions they replace.
    """
    spark = rows.sparkSession
    dealt = rows.hint("rebalance", column)
    dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(column).parquet(path)
    left = {r[0] for r in rows.select(column).distinct().collect()}
    for value in set(values) - left:
        delete_folder(spark, f"{path.rstrip('/')}/{column}={value}")


def materialize(df: DataFrame, label: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and return a frame that scans it.

    Used where several plans need the same intermediate result. The files live
    in shared storage, so they outlive the executors that wrote them; an owner may
    name a ``folder`` that it deletes as a whole.
    """
    spark = df.sparkSession
    path = f"{folder or shared_dir(spark) + '/stage'}/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored._folder = path
    return stored


def discard(*stored: DataFrame) -> None:
    """Delete the files of frames that ``materialize`` returned and nobody reads any more."""
    for df in stored:
        delete_folder(df.sparkSession, df._folder)
