"""Records with quoted line breaks, read in splits.

A line break inside quotes does not end a record, and whether a split begins
inside quotes depends on all quotes before it.  Two passes settle that without reading
a file in one task:

1. every split counts its quotes (their parity) and keeps the lines up to its first line
   with an odd number of quotes: if the split begins inside a record, that is where it ends;
2. an exclusive XOR scan over the few rows (one per split) tells where each split begins;
   every task then puts together the records that begin in its splits, and the
   record that a split leaves open gets the heads of the splits after it.

So each record is given out by the task that owns its first byte, and a file has
as many tasks as one without quotes.  Memory: a split's open record and its head.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardline.operators.joins import bounded_broadcast
from wardline.session import scratch_path


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, split (its first byte), value of every line; lines end with \\n alone, as \\r may stand inside quotes."""
    return (spark.read.option("lineSep", "\n").text(files)
            .select(F.xxhash64("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("split"), "value"))


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple, int, int]]:
    """(file, split), start and end of each run of lines of one split."""
    file, split = (batch.column(c).to_numpy() for c in ("file", "split"))
    cuts = np.flatnonzero((np.diff(file) != 0) | (np.diff(split) != 0)) + 1
    edges = [0, *cuts.tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:]):
        if b > a:
            yield (int(file[a]), int(split[a])), a, b


def _odd(batch: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.count_substring(batch.column("value"), '"'), 0).to_numpy() % 2 == 1


def splits_of(lines: DataFrame) -> DataFrame:
    """file, split, parity, closes (some line has odd quotes) and head (the lines up to the first such line)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parity, closes, head, done = None, 0, False, [], []
        for batch in batches:
            odd = _odd(batch)
            for k, a, b in _runs(batch):
                if k != key:
                    if key:
                        done.append((*key, parity, closes, "\n".join(head)))
                    key, parity, closes, head = k, 0, False, []
                if not closes:
                    first = np.flatnonzero(odd[a:b])
                    closes = len(first) > 0
                    head += batch.column("value").slice(a, int(first[0]) + 1 if closes else b - a).to_pylist()
                parity ^= int(odd[a:b].sum()) & 1
            if done:
                yield rows(done)
                done = []
        if key:
            yield rows([(*key, parity, closes, "\n".join(head))])

    def rows(found: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], t) for i, t in enumerate(kinds)],
                                          names=["file", "split", "parity", "closes", "head"])

    return lines.mapInArrow(run, "file long, split long, parity int, closes boolean, head string")


def written(df: DataFrame, name: str) -> DataFrame:
    """A small result, written to the shared folder and read back, as several steps read it."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def records(spark: SparkSession, files: list[str]) -> DataFrame:
    """file, split, record, header: the records of ``files`` (first lines too, marked), each from the split that it begins in."""
    lines = _lines(spark, files)
    splits = written(splits_of(lines), "quoted-splits")
    w = Window.partitionBy("file").orderBy("split")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    scanned = splits.select(
        "file", "split", "head", (F.coalesce(F.sum("parity").over(before), F.lit(0)) % 2 == 1).alias("inside"),
        F.last(F.when(F.col("closes"), F.col("split")), ignorenulls=True).over(before).alias("owner"))
    # what follows the record that a split leaves open
    rest = (scanned.where("inside").groupBy(F.col("file").alias("rf"), F.col("owner").alias("rs"))
            .agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split", "head"))), lambda h: h["head"]), "\n")
                 .alias("rest")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, skipping, held = None, False, []  # whether the split's first lines are another's; lines of an open record
        for batch in batches:
            if not batch.num_rows:
                continue
            odd, begins = _odd(batch), batch.column("inside").to_numpy(zero_copy_only=False)
            whole, made, heads = np.zeros(batch.num_rows, bool), [], np.zeros(batch.num_rows, bool)
            for k, a, b in _runs(batch):
                if k != key:
                    if held:
                        made.append((*key, "\n".join(held), True))
                    key, skipping, held = k, bool(begins[a]), []
                    heads[a] = k[1] == 0  # a file's first line
                ends = np.flatnonzero(odd[a:b]) + a
                at = a
                if skipping:
                    if not len(ends):
                        continue
                    at, ends, skipping = int(ends[0]) + 1, ends[1:], False
                for end in ends.tolist():
                    if held:  # the record ends here
                        held += batch.column("value").slice(at, end + 1 - at).to_pylist()
                        made.append((*key, "\n".join(held), False))
                        held, at = [], end + 1
                    else:  # whole lines up to here, where one opens
                        whole[at:end] = True
                        held, at = [batch.column("value")[end].as_py()], end + 1
                if held:
                    held += batch.column("value").slice(at, b - at).to_pylist()
                else:
                    whole[at:b] = True
            lines_ = batch.filter(pa.array(whole))
            yield rows(lines_.column("file"), lines_.column("split"), lines_.column("value"),
                       pa.array(np.zeros(lines_.num_rows, bool)), pa.array(heads[whole]))
            if made:
                yield told(made)
        if held:
            yield told([(*key, "\n".join(held), True)])

    def told(made: list) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.bool_())
        return rows(*[pa.array([m[i] for m in made], t) for i, t in enumerate(kinds)], pa.array([False] * len(made)))

    def rows(*columns: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(list(columns), names=["file", "split", "record", "open", "header"])

    # one small row per split (at least ``spark.sql.files.maxPartitionBytes`` of text each); a join that
    # shuffles would lose the order of the lines
    starts = F.broadcast(scanned.select(F.col("file").alias("sf"), F.col("split").alias("ss"), "inside"))
    placed = lines.join(starts, (F.col("file") == F.col("sf")) & (F.col("split") == F.col("ss")))
    given = placed.select("file", "split", "value", "inside").mapInArrow(
        run, "file long, split long, record string, open boolean, header boolean")
    # broadcast if its measured size allows, so that the records themselves are not shuffled
    whole = given.join(bounded_broadcast(written(rest, "quoted-rests")), F.col("open") & (F.col("file") == F.col("rf")) & (F.col("split") == F.col("rs")), "left")
    record = F.when(F.col("rest").isNotNull(), F.concat_ws("\n", "record", "rest")).otherwise(F.col("record"))
    return whole.select("file", "split", F.regexp_replace(record, "\r$", "").alias("record"), "header")
