"""Exact dedup by deterministic block naming.

A text is normalised (white space deleted), cut into blocks of a fixed number
of bytes, and every distinct block gets an integer name by sorting the blocks.
Then adjacent names are paired and each distinct pair gets an integer name the
same way, until a document has one name left.  Names are never hashes: equal
(level, name) means equal text.

One naming step moves its keys through one shuffle: rows are dealt by key and
sorted, and the name of a key is the position where its run starts.  Keys that
hold more than ``1 / HOT_SHARE`` of all rows (a large group of copies, a common
opening) are found beforehand by counting 64-bit hashes; there are fewer than
``HOT_SHARE`` of them, so their distinct keys are named in one small sorted
table that is broadcast, and their rows are not shuffled at all.  A hash
collision only sends a key the other way; it cannot change a name's meaning,
because a hash goes one way as a whole.

Defined cases: null text counts as empty; texts without other than white space
are all equal.  Of equal texts exactly one row stays, also where rows repeat a
doc_id: each of them counts in ``group_size``, and of rows with the same
length and doc_id any one is the row that stays.  A null doc_id is an identifier that
sorts last.  Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import Scratch

BLOCK_BYTES = 8192
HOT_SHARE = 4096
WHITE = " \n\t\x0b\x0c\r"


def normalised(text: Column) -> Column:
    """``text`` without the characters of [\\x20\\x09-\\x0D]; null is empty."""
    out = F.coalesce(text, F.lit(""))
    for c in WHITE:
        out = F.replace(out, F.lit(c), F.lit(""))
    return out


def name_keys(scratch: Scratch, rows: DataFrame, key: list[str], carry: list[str], label: str) -> DataFrame:
    """``carry`` with an integer ``name``: equal exactly where ``key`` is equal (nulls equal nulls).

    ``rows`` is a written table with its count in ``measured`` and a hash ``h`` of the key.
    """
    h = F.col("h")
    total = rows.measured["rows"]
    hot = [r.h for r in rows.groupBy("h").agg(F.count(F.lit(1)).alias("n"))
           .where((F.col("n") > 1) & (F.col("n") * HOT_SHARE > total)).select("h").collect()]
    cold = rows.where(~h.isin(hot)) if hot else rows
    runs = (cold.repartition(*key).sortWithinPartitions(*key)
            .withColumn("at", F.monotonically_increasing_id()))
    named = runs.select(*carry, F.min("at").over(W.partitionBy(*key)).alias("name"))
    if hot:
        frequent = rows.where(h.isin(hot))
        names = (frequent.select(*key).distinct()
                 .select(*[F.col(k).alias(f"k_{k}") for k in key],
                         (-F.row_number().over(W.orderBy(*key))).cast("long").alias("name")))
        same = F.lit(True)
        for k in key:
            same = same & F.col(k).eqNullSafe(F.col(f"k_{k}"))
        named = named.unionByName(frequent.join(F.broadcast(names), same).select(*carry, "name"))
    return scratch.keep(named, f"{label}-names")


def identities(scratch: Scratch, docs: DataFrame) -> DataFrame:
    """One row (doc_id, salt, level, name) per distinct document; equal texts have equal (level, name)."""
    blocks = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("salt"),
        normalised(F.col("text")).cast("binary").alias("bytes"))
    blocks = blocks.select(
        "doc_id", "salt",
        F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.octet_length("bytes") / BLOCK_BYTES) - 1, F.lit(0))),
                    lambda i: F.substring("bytes", (i * BLOCK_BYTES + 1).cast("int"), F.lit(BLOCK_BYTES)))
        .alias("parts"))
    blocks = blocks.select("doc_id", "salt", F.size("parts").alias("left"), F.posexplode("parts").alias("pos", "block"))
    blocks = scratch.keep(blocks.withColumn("h", F.xxhash64("block")), "blocks",
                          rows=F.count(F.lit(1)), longest=F.max("left"))
    doc = ["doc_id", "salt", "left"]
    rows = name_keys(scratch, blocks, ["block"], [*doc, "pos"], "block")
    scratch.drop(blocks)
    level, longest, done = 0, blocks.measured["longest"] or 1, []
    while True:
        single = rows.where("left = 1").groupBy("doc_id", "salt").agg(F.min("name").alias("name"))
        done.append(single.select("doc_id", "salt", F.lit(level).alias("level"), "name"))
        if longest == 1:
            break
        level, longest = level + 1, -(-longest // 2)
        pairs = (rows.where("left > 1")
                 .groupBy("doc_id", "salt", F.ceil(F.col("left") / 2).cast("int").alias("left"),
                          F.floor(F.col("pos") / 2).cast("int").alias("pos"))
                 .agg(F.max(F.when(F.col("pos") % 2 == 0, F.col("name"))).alias("a"),
                      F.max(F.when(F.col("pos") % 2 == 1, F.col("name"))).alias("b")))
        pairs = scratch.keep(pairs.withColumn("h", F.xxhash64("a", "b")), f"pairs{level}", rows=F.count(F.lit(1)))
        rows = name_keys(scratch, pairs, ["a", "b"], [*doc, "pos"], f"pair{level}")
        scratch.drop(pairs)
    out = done[0]
    for d in done[1:]:
        out = out.union(d)
    return out


def exact_dedup(docs: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, text_hash for every row of ``docs`` (doc_id, text).

    ``text_hash`` is xxhash64 of the original text (null: empty), by which rows of one doc_id are told apart.

    Of equal texts the row with the most code points in the original text
    stays, then the one with the smallest doc_id.
    """
    scratch = scratch or Scratch(docs.sparkSession, "exact-dedup")
    ids = identities(scratch, docs).withColumnsRenamed({"doc_id": "i_doc", "salt": "i_salt"})
    rows = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("salt"),
        F.char_length(F.coalesce("text", F.lit(""))).alias("chars"),
        F.unhex(F.sha2(normalised(F.col("text")).cast("binary"), 256)).alias("sha"))
    rows = scratch.keep(
        rows.join(ids, F.col("doc_id").eqNullSafe(F.col("i_doc")) & (F.col("salt") == F.col("i_salt")))
        .select("doc_id", "salt", "chars", "sha", "level", "name", F.monotonically_increasing_id().alias("row")), "rows")
    best = F.min(F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("none"), F.col("doc_id"), F.col("row")))
    groups = scratch.keep(
        rows.groupBy("level", "name").agg(F.count(F.lit(1)).alias("n"), best.alias("best")).where("n > 1")
        .select("level", "name", "n", F.col("best.doc_id").alias("keep_id"), F.col("best.row").alias("stays")), "groups")
    grouped = F.col("stays").isNotNull()
    return rows.join(groups, ["level", "name"], "left").select(
        "doc_id", F.when(grouped, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("n", F.lit(1)).cast("long").alias("group_size"),
        F.coalesce(F.col("row") == F.col("stays"), F.lit(True)).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"), F.col("salt").alias("text_hash"))


ORACLE = r"""
with t as (
  select doc_id, length(coalesce(text, '')) as chars,
         regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
  from documents),
g as (
  select norm, count(*) as n, first(doc_id order by chars desc, doc_id) as keep_id from t group by norm)
select t.doc_id, g.keep_id, g.n as group_size, t.doc_id = g.keep_id as kept, sha256(t.norm) as text_sha256
from t join g on t.norm = g.norm
"""
