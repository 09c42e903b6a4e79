"""Helpers shared by the training-data operators."""

from __future__ import annotations

import gc
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wardline.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows that go to a Python worker at once where whole texts also come back.
BATCH_ROWS = 500


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_ROWS`` rows, so that a task holds a few megabytes of text.

    It is a session setting, as Arrow reads it when a plan runs; a smaller one stays.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    current = int(spark.conf.get(key))
    if current <= 0 or current > BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


@contextmanager
def text_batches(spark: SparkSession, rows: int = BATCH_ROWS):
    """Arrow batches of at most ``rows`` rows for the plans that run inside, which then leave the setting as it was."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    if int(before) <= 0 or int(before) > rows:
        spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


class Scratch:
    """Intermediate tables in the shared checkpoint folder, removed when no longer read.

    ``keep`` writes a frame and returns it read back, which cuts the lineage: a
    lost executor costs only the tasks since the last table.  ``drop`` removes
    tables that nothing reads any more.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = scratch_path(spark, name)
        self.count = 0

    def keep(self, df: DataFrame, name: str, codec: str = "snappy", **measures: Column) -> DataFrame:
        """``df`` written and read back; aggregates named in ``measures`` are taken on the way (``.measured``)."""
        self.count += 1
        path = f"{self.base}/{self.count:03d}-{name}"
        seen = Observation() if measures else None
        out = df.observe(seen, *[c.alias(k) for k, c in measures.items()]) if seen else df
        out.write.parquet(path, compression=codec)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch = path
        back.measured = seen.get if seen else {}
        return back

    def release(self) -> None:
        """Let go of the shuffle files of plans that nothing holds any more, which Spark removes on the driver's collection.

        Called after steps whose shuffles are as large as the input; the files would else stay until the heap fills.
        """
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for df in frames:
            path = jvm.org.apache.hadoop.fs.Path(df._scratch)
            path.getFileSystem(conf).delete(path, True)


def components(scratch: Scratch, edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (a, b): one row (node, component), component = smallest node.

    Minimum labels with hooking and pointer jumping.  Every round each node
    takes the smallest label among its neighbours' labels, tells it to the node
    its old label names, then takes the label of its label, so the longest
    chain about halves; the rounds are logarithmic in it.  Each round is
    written to the shared folder and all join sides are plain shuffles, so AQE
    splits hub nodes.
    """
    both = edges.select("a", "b").union(edges.select("b", "a")).where("a <> b")
    both = scratch.keep(both.groupBy("a", "b").agg(F.lit(1).alias("one")).select("a", "b"), "edges")
    labels = scratch.keep(both.groupBy("a").agg(F.least("a", F.min("b")).alias("l")).select(F.col("a").alias("node"), "l"),
                          "labels")
    while True:
        near = (both.join(labels.select(F.col("node").alias("b"), F.col("l").alias("near")), "b")
                .groupBy("a").agg(F.min("near").alias("near")))
        told = scratch.keep(labels.join(near, labels["node"] == near["a"])
                            .select("node", "l", F.least("l", "near").alias("best")), "told",
                            lower=F.count_if(F.col("best") < F.col("l")))
        if not told.measured["lower"]:
            scratch.drop(both, told)
            out = labels.select("node", F.col("l").alias("component"))
            out._scratch = labels._scratch
            return out
        hooks = told.where("best < l").groupBy(F.col("l").alias("node")).agg(F.min("best").alias("hook"))
        hooked = (told.join(hooks, "node", "left")
                  .select("node", F.least("best", F.coalesce("hook", "best")).alias("best")))
        jump = hooked.select(F.col("node").alias("best"), F.col("best").alias("root"))
        nxt = scratch.keep(hooked.join(jump, "best").select("node", F.col("root").alias("l")), "labels")
        scratch.drop(told, labels)
        labels = nxt


def registered(queries: dict[str, Callable], name: str):
    """Decorator: add a query under ``name``."""
    def put(fn):
        queries[name] = fn
        return fn
    return put
