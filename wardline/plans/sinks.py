"""Table sinks: versioned Parquet directories behind an atomically switched pointer.

A mart is rewritten while readers may be using it.  Each build writes a
new version directory; only after the write succeeds is a new pointer file
published (the newest pointer wins), so a reader sees either the old or
the new version, never a partial one, and never finds no pointer.  Paths go
through the Hadoop FileSystem API, so they may be local, HDFS or object
storage.
"""

from __future__ import annotations

import time
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

POINTER = "_CURRENT"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath, jvm


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, target, jvm = _fs(spark, path)
    if not fs.exists(target):
        return None
    stream = fs.open(target)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    try:
        return reader.readLine()
    finally:
        reader.close()


def publish_pointer(spark: SparkSession, folder: str, value: str, keep: int | None = 3) -> None:
    """Point ``folder`` at ``value`` without a moment of no pointer.

    Each publication is a new file ``_CURRENT-<number>``, one above the last;
    readers take the highest that is complete.  The file is created only if it does not exist,
    so of two publishers one gets a number and the other the next, whatever
    their clocks say.  Older pointer files are removed only after the new one
    exists (``keep=None``: not at all).
    """
    fs, root, jvm = _fs(spark, folder)
    fs.mkdirs(root)
    for _ in range(100):
        last = _pointers(fs, root)[-1:]
        number = int(last[0].split("-")[1]) + 1 if last else 1
        try:
            out = fs.create(jvm.org.apache.hadoop.fs.Path(root, f"{POINTER}-{number:013d}"), False)
            break
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getName() and "already exists" not in str(e.java_exception):
                raise
    else:
        raise OSError(f"could not publish a pointer in {folder}")
    out.write(bytearray(value.encode("utf-8")))
    out.close()
    for old in _pointers(fs, root)[:-max(1, keep)] if keep is not None else []:
        fs.delete(jvm.org.apache.hadoop.fs.Path(root, old), False)


def _pointers(fs, root) -> list[str]:
    """Names of the pointer files, oldest first."""
    return sorted(st.getPath().getName() for st in fs.listStatus(root) if st.getPath().getName().startswith(f"{POINTER}-"))


def current_pointer(spark: SparkSession, folder: str) -> str | None:
    """The value of the newest pointer in ``folder`` (or of a single ``_CURRENT`` file)."""
    fs, root, jvm = _fs(spark, folder)
    if not fs.exists(root):
        return None
    for name in reversed(_pointers(fs, root)):
        try:
            value = _read_text(spark, f"{folder.rstrip('/')}/{name}")
        except Exception:  # noqa: BLE001 - pruned by a concurrent writer: try the next one
            continue
        if value:
            return value
    return _read_text(spark, f"{folder.rstrip('/')}/{POINTER}")


def write_table(df: DataFrame, root: str, name: str, partition_by: str | None = None,
                max_records_per_file: int | None = None, keep_versions: int = 2,
                rebalance: bool = True) -> str:
    """Write ``df`` as a new version of table ``name`` under ``root``; return its path.

    With ``partition_by`` one shuffle gives few, evenly sized files per value
    (AQE splits a hot value and coalesces small ones).  ``rebalance=False``
    saves it, but every task then writes a file per value it holds: only for
    input of few tasks.  All but the ``keep_versions`` newest versions are
    removed (0 keeps all).
    """
    spark = df.sparkSession
    version = f"v{int(time.time() * 1000)}-{uuid.uuid4().hex[:8]}"
    path = f"{root.rstrip('/')}/{name}/{version}"
    if partition_by and rebalance:
        # one extra shuffle: AQE hashes on the partition column, splits a hot
        # value over several tasks and coalesces small ones (fewer, even files)
        writer_df = df.hint("rebalance", partition_by)
    elif partition_by:
        # no shuffle: each task writes its rows grouped by value, one file open
        # at a time; with ~256 MB input splits the files stay reasonably sized
        writer_df = df.sortWithinPartitions(partition_by)
    else:
        writer_df = df
    w = writer_df.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(partition_by)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)
    publish_pointer(spark, f"{root.rstrip('/')}/{name}", version, keep=None)
    if keep_versions:
        prune_versions(spark, root, name, keep_versions)
    return path


def prune_versions(spark: SparkSession, root: str, name: str, keep: int = 2) -> None:
    """Delete all but the ``keep`` last published versions, with their pointers.

    Keeping the previous version lets readers that resolved the pointer just
    before a switch finish their scan.  A version that no pointer names may still be
    in the hands of another writer, so it is left alone.
    """
    folder = f"{root.rstrip('/')}/{name}"
    fs, table, jvm = _fs(spark, folder)
    published = [(p, _read_text(spark, f"{folder}/{p}")) for p in _pointers(fs, table)]
    kept = {version for _, version in published[-max(1, keep):]}
    for pointer, version in published[:-max(1, keep)]:
        if version and version not in kept:
            fs.delete(jvm.org.apache.hadoop.fs.Path(table, version), True)
        fs.delete(jvm.org.apache.hadoop.fs.Path(table, pointer), False)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """Read the current version of table ``name``."""
    version = current_pointer(spark, f"{root.rstrip('/')}/{name}")
    if not version:
        raise FileNotFoundError(f"table {name} has no published version under {root}")
    return spark.read.parquet(f"{root.rstrip('/')}/{name}/{version}")
