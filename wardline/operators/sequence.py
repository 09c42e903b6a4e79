"""Per-group sequencing: ``row_number()`` plus ``lead()`` of some columns.

One window over the group key would put every row of a group in one task.
Instead the rows are dealt once, by ranges of (group, order), and

1. each task numbers its sorted rows group by group and takes the leads from
   the next row, in one pass over Arrow batches that holds one row back;
2. a group can cross from one range into the next only at the ends of a
   range, so at most two rows per range - size and first row of its first
   and last group - go through a window that yields the rows of the group in
   the ranges before and its first row in the next one;
3. these few rows (their number is bounded by the number of partitions)
   are broadcast and fix the numbers of the first group and the last lead of each range.

The input is read and its rows are shuffled once: both readers of the sorted
ranges share one exchange.  A group that holds a third of the rows is spread
over a third of the tasks.  The number of ranges is
``spark.sql.shuffle.partitions`` and fixed, so that a range is the same in both readers.
NULL group keys form a group, as they do in a window.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _equal_next(by: pa.ChunkedArray) -> np.ndarray:
    """Of every row but the last: whether the next row has the same key (NULL is NULL)."""
    a, b = by.slice(0, len(by) - 1), by.slice(1)
    same = pc.or_(pc.fill_null(pc.equal(a, b), False), pc.and_(pc.is_null(a), pc.is_null(b)))
    return same.to_numpy().astype(bool)


def _number(by: str, leads: dict[str, str], columns: list[str], names: list[str]):
    """Arrow function: rows sorted by group and order, with number, leads and their place in the range."""
    def put(rows: pa.Table, number: np.ndarray, head: np.ndarray, same: np.ndarray, last: bool) -> list[pa.RecordBatch]:
        """All of ``rows`` but the last one, which only gives the leads; ``last``: there is no further row."""
        size = len(number)
        after = pa.array(np.where(same, np.arange(1, size + 1), -1))
        after = pc.if_else(pc.less(after, 0), pa.scalar(None, pa.int64()), after)
        out = rows.slice(0, size).select(columns).columns
        out += [pa.array(number.astype(np.int64)), *(rows.column(s).take(after) for s in leads.values()),
                rows.slice(0, size).column("_pid"), pa.array(head), pa.array(~same), pa.array(np.full(size, last))]
        return pa.Table.from_arrays(out, names=names).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count, first = None, 0, True  # the last row so far, its number, whether it is of the first group
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([held, rows]).combine_chunks() if held is not None else rows
            same = _equal_next(rows.column(by))
            begins = np.concatenate([[True], ~same])
            start = np.maximum.accumulate(np.where(begins, np.arange(len(begins)), 0))
            number = np.arange(len(begins)) - start + 1
            if held is not None:
                number[start == 0] += count - 1
            head = (start == 0) & first
            if len(same):
                yield from put(rows, number[:-1], head[:-1], same, False)
            held, count, first = rows.slice(len(rows) - 1), int(number[-1]), bool(head[-1])
        if held is not None:
            yield from put(held, np.array([count]), np.array([first]), np.array([False]), True)

    return run


def sequence_within(df: DataFrame, by: str, order: Sequence[Column], rank_col: str,
                    leads: dict[str, str], rank_type: str = "int") -> DataFrame:
    """Add ``rank_col`` = row_number() and ``leads`` {out: src} = lead(src) over ``by``.

    ``order`` must be a total order within a group (end it with a unique
    column) for the result to be deterministic.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordering = [F.col(by).asc_nulls_first(), *order]
    schema = T.StructType([
        *df.schema.fields, T.StructField("_rn", T.LongType()),
        *[T.StructField(f"_lead_{o}", df.schema[s].dataType) for o, s in leads.items()],
        T.StructField("_pid", T.IntegerType()), T.StructField("_head", T.BooleanType()),
        T.StructField("_end", T.BooleanType()), T.StructField("_open", T.BooleanType())])
    local = (df.repartitionByRange(ranges, *ordering).sortWithinPartitions(*ordering)
             .withColumn("_pid", F.spark_partition_id())
             .mapInArrow(_number(by, leads, df.columns, schema.names), schema))
    # the first and the last group of each range: their size there, and the first row of the first group
    sources = sorted(set(leads.values()))
    key = F.struct(F.col(by).alias("g")).alias("_g")
    ends = (local.where((F.col("_head") & ((F.col("_rn") == 1) | F.col("_end"))) | F.col("_open"))
            .groupBy("_pid", key).agg(
                F.max("_rn").alias("_n"),
                F.min_by(F.struct(F.lit(1).alias("_one"), *[F.col(s).alias(s) for s in sources]), "_rn").alias("_first")))
    w = Window.partitionBy("_g").orderBy("_pid")
    carried = ends.select(
        F.col("_pid").alias("_range"), "_g",
        F.coalesce(F.sum("_n").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"),
        F.lead("_first").over(w).alias("_next")).where("_before > 0 or _next is not null")
    rows = local.join(F.broadcast(carried), (F.col("_pid") == F.col("_range"))
                      & (F.struct(F.col(by).alias("g")) == F.col("_g")), "left")
    return rows.select(
        *[F.col(f"`{c}`") for c in df.columns],
        (F.col("_rn") + F.coalesce("_before", F.lit(0))).cast(rank_type).alias(rank_col),
        *[F.when(F.col("_open"), F.col(f"_next.`{s}`")).otherwise(F.col(f"_lead_{o}")).alias(o) for o, s in leads.items()])
