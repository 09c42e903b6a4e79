"""Session defaults and shared-folder helpers."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings the models rely on.  Time zone UTC keeps wall-clock date parts
# stable; ANSI makes bad casts fail loudly; AQE re-plans joins and
# coalesces/splits partitions from runtime statistics.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Broadcast by size: the planning-time threshold (estimates) stays at the
    # 10 MB default; at run time AQE knows exact shuffle sizes and may
    # broadcast a join side of up to 64 MB instead of sort-merging it.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # remove checkpoint files once their DataFrames are garbage collected
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def get_session(master: str | None = None, app: str = "wardline",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting points at shared storage and is only read; where
    it is unset there, this raises, since no machine's own folder would do.
    In local mode (tests) a private folder is created, and removed at exit.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir:
        try:
            conf_dir = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - unset key
            conf_dir = None
    if not conf_dir:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(f"spark.checkpoint.dir is not set; on {sc.master} it must name a folder that the "
                               "driver and all executors share")
        conf_dir = tempfile.mkdtemp(prefix="wardline-ckpt-")
        atexit.register(shutil.rmtree, conf_dir, ignore_errors=True)
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


_SCRATCH: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def scratch_count() -> int:
    return len(_SCRATCH)


def clear_scratch(spark: SparkSession, keep: int = 0) -> None:
    """Remove the scratch folders this process has made, but for the ``keep`` first ones.

    Frames that read them are of no use afterwards.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while len(_SCRATCH) > keep:
        p = jvm.org.apache.hadoop.fs.Path(_SCRATCH.pop())
        p.getFileSystem(conf).delete(p, True)


def scale_conf(input_bytes: int, partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` of input.

    Scan splits and AQE's target shuffle partition size are both about
    ``partition_bytes``; the initial shuffle partition count is large
    enough that no reducer starts above that size, and AQE coalesces the
    small ones at run time.
    """
    initial = max(200, -(-input_bytes // partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(partition_bytes),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.shuffle.partitions": str(initial),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(initial),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * partition_bytes),
    }


@contextmanager
def scaled(spark: SparkSession, input_bytes: int, partition_bytes: int = 16 << 20) -> Iterator[int]:
    """Shuffle partitions by the input, for the work that runs inside; the session's number is put back after it.

    One partition per ``partition_bytes`` of (compressed) input, never fewer than
    the session has, so that the rows which a task sorts do not grow with the
    input and are not spilled; AQE joins the small ones.
    """
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    partitions = max(int(before), -(-input_bytes // partition_bytes))
    spark.conf.set(key, str(partitions))
    try:
        yield partitions
    finally:
        spark.conf.set(key, before)
