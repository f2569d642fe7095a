"""Session defaults and shared scratch locations."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job in this package assumes. Event time is stored as
# TIMESTAMP_NTZ holding UTC wall-clock time, so results do not depend on the
# session zone; UTC is still pinned so that printing and casts agree.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    # merge session windows inside each partition before the shuffle, so a
    # hot session is combined map-side like any other aggregate
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(master: str | None = None, app: str = "pulseline",
              shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    On a cluster leave ``master`` and ``shuffle_partitions`` unset: the
    launcher decides the master and AQE coalesces the shuffle partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` is read from the session. Only a local session
    without it gets a fresh local folder; on a cluster it must be set, as
    executors could not see such a folder.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="pulseline-ckpt-")
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique folder under the shared checkpoint folder.

    Jobs that stage files (stream inputs, stream outputs, state) write here
    so that every executor and the driver see the same path; a folder is
    never reused or cleared, each run takes a new one.
    """
    return f"{ensure_checkpoint_dir(spark)}/pulseline/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    """The file system of ``path`` (whichever the cluster uses) and the path in it."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, none if it does not exist."""
    fs, where = _fs(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(where)] if fs.exists(where) else []


def count_files(spark: SparkSession, path: str) -> int:
    """Number of files below a folder, 0 if it does not exist."""
    fs, where = _fs(spark, path)
    return fs.getContentSummary(where).getFileCount() if fs.exists(where) else 0


def read_text(spark: SparkSession, path: str) -> str:
    """A small text file."""
    fs, where = _fs(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file under another name and rename it, so that readers see all of it or nothing."""
    fs, where = _fs(spark, path)
    draft = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.{uuid.uuid4().hex}.tmp")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    if not fs.rename(draft, where):
        raise RuntimeError(f"cannot write {path}")


def delete_path(spark: SparkSession, path: str) -> bool:
    """Delete a file or folder of a table that maintenance has replaced."""
    fs, where = _fs(spark, path)
    return bool(fs.delete(where, True))
