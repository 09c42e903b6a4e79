"""CSV sources: scan, schema inference, load by column name, full reload.

Dialect of the raw files: header row, ``,`` separator, optional ``"``
quoting (a quoted field may hold separators, quotes and line breaks), an empty
field is NULL, no trimming, compression from the file extension (a compressed
file without its extension is refused).  Columns are matched to the target
**by name, case-insensitively** (never by position), and a malformed value
aborts the load (FAILFAST).  Sub-folders are read.

Spark's CSV reader binds a user schema by position, so files are grouped by
header; each group is read with a string schema in that file order, selected by
name and cast, and the groups are unioned by name.  There is one read per
distinct header, not per file.

What has to be known of the files before that comes from two aggregations over
their lines (``Extract.of``): per file the header and whether quotes hold line
breaks; per file and column, how many values there are and how many do not
convert to each type.  Such counts add up in any order, and a column has the
first type that all its values convert to.  Neither sorts the lines.
A file in which some line has an odd number of quotes holds a quoted line
break: its records are put together over its splits (``quoted``), so it stays
splittable, and its types are counted from the records in a pass of their own.
"""

from __future__ import annotations

import re
from collections import OrderedDict
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardline.sources.quoted import records, written

# Extensions that the Hadoop codecs open, and how compressed files begin when read as text.
COMPRESSED = (".gz", ".bz2", ".zst", ".deflate", ".snappy", ".lz4")
_MAGIC = {"\x1f\ufffd": "gzip", "BZh": "bzip2", "(\ufffd/\ufffd": "zstd"}

CSV_OPTIONS = {
    "header": "true",
    "sep": ",",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "mode": "FAILFAST",
    "multiLine": "false",
}

# Columns whose text must survive as is (identifiers, codes, zip codes keep leading zeros).
STRING_COLUMN_HINTS = ("id", "patient", "encounter", "organization", "provider", "payer", "code",
                       "reasoncode", "zip", "ssn", "drivers", "passport", "fips")


def _is_string_hint(name: str, hints: Sequence[str]) -> bool:
    n = name.lower()
    return n in hints or n.endswith("_id") or n.endswith("code")


# --- file discovery -------------------------------------------------------------

def _hadoop(spark: SparkSession):
    return spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, size) of the data files at ``path`` (a file, or a directory with its sub-folders)."""
    jvm, conf = _hadoop(spark)
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(conf)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    out, todo = [], [p]
    while todo:
        for st in fs.listStatus(todo.pop()):
            if st.getPath().getName().startswith(("_", ".")):
                continue
            if st.isDirectory():
                todo.append(st.getPath())
            else:
                out.append((st.getPath().toString(), int(st.getLen())))
    return sorted(out)


def _header(line: str | None, path: str) -> list[str]:
    """Column names of a CSV file from its first line."""
    if not line:
        return []
    if not path.lower().endswith(COMPRESSED):
        for start, kind in _MAGIC.items():
            if line.startswith(start):
                raise ValueError(f"{path} is {kind}-compressed but its name does not say so")
    return [c.strip('"') for c in _split_csv_line(line.lstrip("\ufeff").rstrip("\r"))]


def _split_csv_line(line: str) -> list[str]:
    out, cur, quoted = [], [], False
    i = 0
    while i < len(line):
        ch = line[i]
        if quoted:
            if ch == '"' and i + 1 < len(line) and line[i + 1] == '"':
                cur.append('"')
                i += 1
            elif ch == '"':
                quoted = False
            else:
                cur.append(ch)
        elif ch == '"':
            quoted = True
        elif ch == ",":
            out.append("".join(cur))
            cur = []
        else:
            cur.append(ch)
        i += 1
    out.append("".join(cur))
    return out


# --- what the lines tell --------------------------------------------------------

#: Types that a column may get, in the order in which they are preferred, and what a text must look
#: like besides converting, as casts also take blanks, years as dates and the like.
LATTICE = (
    ("int", T.IntegerType(), r"^[+-]?\d+$"), ("long", T.LongType(), r"^[+-]?\d+$"),
    ("double", T.DoubleType(), r"^([+-]?(\d|\.\d)[\d.]*([eE][+-]?\d+)?|NaN|[+-]?Infinity|[+-]?Inf)$"),
    ("date", T.DateType(), r"^\d{4}-\d{2}-\d{2}$"),
    ("stamp", T.TimestampNTZType(), r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}.*)?$"),
    ("boolean", T.BooleanType(), r"(?i)^(true|false)$"))
_SEPARATOR = "\0"  # stands for the commas outside quotes


def _fields(record: Column) -> Column:
    """The texts of a record's fields, without quotes; an empty field is NULL."""
    def text(raw: Column) -> Column:
        inner = F.replace(F.substr(raw, F.lit(2), F.length(raw) - 2), F.lit('""'), F.lit('"'))
        return F.nullif(F.when(raw.startswith('"'), inner).otherwise(raw), F.lit(""))
    # between quotes every other part is outside them; a regular expression would recurse over long fields
    parts = F.transform(F.split(F.rtrim(record, F.lit("\r")), '"', -1),
                        lambda part, i: F.when(i % 2 == 0, F.replace(part, F.lit(","), F.lit(_SEPARATOR))).otherwise(part))
    return F.transform(F.split(F.array_join(parts, '"'), _SEPARATOR, -1), text)


def _misfits(text: Column) -> dict[str, Column]:
    """Per type, whether a text does not convert to it; NULL, no value, converts to all."""
    return {name: text.isNotNull() & ~(text.rlike(looks) & _typed(text, dtype).isNotNull()) for name, dtype, looks in LATTICE}


def _facts(lines: DataFrame) -> DataFrame:
    """Per file (f) of ``lines`` (f, split, value): its first line, whether a line has an odd number of quotes, and its lines."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    rows = lines.where(F.trim("value") != "").select(
        "f", F.when(F.col("split") == 0, F.struct(F.monotonically_increasing_id().alias("at"), "value")).alias("first"),
        (quotes % 2 == 1).alias("odd"))
    # with a collected set the rows are aggregated in place; a minimum over texts alone would sort all lines by file
    return rows.groupBy("f").agg(F.min("first")["value"].alias("first"), F.array_contains(F.collect_set("odd"), True).alias("odd"),
                                 F.count(F.lit(1)).alias("lines"))


def _counted(lines: DataFrame) -> DataFrame:
    """Per file and column (f, pos) of ``lines``: values, and values that do not convert to each type; the header counts like a record.

    All that is summed is a number, so the fields are aggregated in place and not sorted.
    """
    rows = lines.where(F.trim("value") != "").select("f", F.posexplode(_fields(F.col("value"))).alias("pos", "text"))
    return rows.groupBy("f", "pos").agg(
        F.count("text").alias("values"), *[F.count_if(m).alias(n) for n, m in _misfits(F.col("text")).items()])


def _layout_types(facts: DataFrame, counted: DataFrame) -> dict[tuple[str, bool], dict[int, tuple]]:
    """(first line, odd) -> position -> (has values, the types that all values have)."""
    files = facts.select(F.col("f").alias("g"), F.col("first").alias("line"), F.col("odd").alias("broken"))
    names = [n for n, _, _ in LATTICE]
    sums = counted.join(files, F.col("f") == F.col("g")).groupBy("line", "broken", "pos").agg(
        F.count(F.lit(1)).alias("files"), *[F.sum(c).alias(c) for c in ("values", *names)])
    # the header of each file was counted too: take away what its text adds
    own = sums.withColumn("own", F.get(_fields(F.col("line")), F.col("pos")))
    there = F.when(F.col("own").isNotNull(), F.col("files")).otherwise(0)
    less = {n: F.when(m, there).otherwise(0) for n, m in _misfits(F.col("own")).items()}
    found = own.select("line", "broken", "pos", (F.col("values") > there).alias("some"),
                       *[(F.col(n) == less[n]).alias(n) for n in names]).collect()  # a row per column of a layout
    out: dict[tuple[str, bool], dict[int, tuple]] = {}
    for r in found:
        out.setdefault((r.line, r.broken), {})[r.pos] = (r.some, [n for n in names if r[n]])
    return out


@dataclass
class Extract:
    """The files of one table, grouped by (header, holds quoted line breaks); ``filled`` groups have rows.

    ``types`` has what the second pass found of a group's columns; groups with line breaks are not in it.
    """
    groups: "OrderedDict[tuple[tuple[str, ...], bool], list[str]]"
    filled: set
    types: dict

    @classmethod
    def of(cls, spark: SparkSession, path: "str | Extract", types: bool = False) -> "Extract":
        """One pass over the lines of the files; with ``types`` a second counts what the columns convert to."""
        if isinstance(path, Extract):
            return path
        out, files = cls(OrderedDict(), set(), {}), [f for f, _ in list_files(spark, path)]
        if not files:
            return out
        told = written(_facts(_text(spark, files)), "csv-facts")
        facts = {_name(unquote(r.f)): r for r in told.collect()}
        found = _layout_types(told, written(_counted(_text(spark, files)), "csv-types")) if types else {}
        for f in files:
            fact = facts.get(_name(f))
            header = tuple(_header(fact.first if fact else None, f))
            if not header:
                continue
            key = (header, fact.odd)
            out.groups.setdefault(key, []).append(f)
            if fact.lines > 1:
                out.filled.add(key)
            if types and not fact.odd:
                out.types.setdefault(key, {})[fact.first] = found[fact.first, False]
        return out


def _text(spark: SparkSession, files: list[str]) -> DataFrame:
    return spark.read.text(files).select(F.col("_metadata.file_path").alias("f"),
                                         F.col("_metadata.file_block_start").alias("split"), "value")


def _name(path: str) -> str:
    """A path without scheme and leading slashes, which listings spell differently."""
    return re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:", "", path).lstrip("/")


def _reader(spark: SparkSession, options: dict | None = None):
    r = spark.read
    for k, v in {**CSV_OPTIONS, **(options or {})}.items():
        r = r.option(k, v)
    return r


# --- scan / inference / load ---------------------------------------------------

def scan_csv(spark: SparkSession, path: "str | Extract", options: dict | None = None) -> DataFrame:
    """All columns as strings, named by the header in lower case, matched by name.

    Files with different column orders are aligned by name; a column
    missing from some files is NULL there.
    """
    groups = Extract.of(spark, path).groups
    if not groups:
        raise ValueError(f"no CSV data with a header under {path}")
    frames = []
    for (header, multi), files in groups.items():
        # name the string schema after the file's own header (so Spark's header
        # check agrees); positional names only if the header repeats a name
        unique = len({h.lower() for h in header}) == len(header)
        names = list(header) if unique else [f"_c{i}" for i in range(len(header))]
        schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
        if multi:
            df = _broken(spark, files, names, options)
        else:
            df = _reader(spark, options).schema(schema).csv(files)
        frames.append(df.select(*[F.col(f"`{n}`").alias(h.lower()) for n, h in zip(names, header)]))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _broken(spark: SparkSession, files: list[str], names: list[str], options: dict | None) -> DataFrame:
    """The rows of files with quoted line breaks, parsed record by record."""
    schema = ", ".join(f"c{i} string" for i in range(len(names)))
    parsed = F.from_csv("record", schema, {**CSV_OPTIONS, **(options or {}), "header": "false", "multiLine": "true"})
    body = records(spark, files).where((F.trim("record") != "") & ~F.col("header"))
    return body.select(parsed.alias("r")).select(*[F.col(f"r.c{i}").alias(n) for i, n in enumerate(names)])


# Numeric types from narrow to wide, for columns that two layouts type differently.
_WIDER = (T.IntegerType(), T.LongType(), T.DoubleType())


def _common(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    if a in _WIDER and b in _WIDER:
        return max(a, b, key=_WIDER.index)
    if {a, b} == {T.DateType(), T.TimestampNTZType()}:
        return T.TimestampNTZType()
    return T.StringType()


def infer_schema(spark: SparkSession, path: "str | Extract", strings: Sequence[str] = STRING_COLUMN_HINTS,
                 options: dict | None = None) -> T.StructType:
    """Schema inferred from all rows of all files, in file column order, lower-case names.

    Types come from the counts of a pass over the lines; files with
    quoted line breaks are counted record by record.  Layouts are merged by name: numbers
    widen, a column typed otherwise in two layouts becomes string, a column
    without values in one layout takes the other's type.  Identifier-, code- and
    zip-like columns are pinned to string: inference would turn numeric-looking
    ids into numbers and drop zip leading zeros.  Timestamps are TIMESTAMP_NTZ.
    """
    merged: OrderedDict[str, T.DataType | None] = OrderedDict()
    extract = Extract.of(spark, path, types=True)
    kinds = {n: dtype for n, dtype, _ in LATTICE}
    for key, files in extract.groups.items():
        header, multi = key
        layouts = list(extract.types.get(key, {}).values()) or _read_types(spark, files, multi)
        for i, given in enumerate(header):
            name = given.lower()
            of = [found[i] for found in layouts if i in found]
            fits = [n for n in kinds if all(n in f for _, f in of)]
            dtype = T.StringType() if _is_string_hint(name, strings) or not fits else kinds[fits[0]]
            if not any(some for some, _ in of):
                merged.setdefault(name, None)
            else:
                merged[name] = dtype if merged.get(name) is None else _common(merged[name], dtype)
    return T.StructType([T.StructField(n, t or T.StringType(), True) for n, t in merged.items()])


def _read_types(spark: SparkSession, files: list[str], multi: bool) -> list[dict[int, tuple]]:
    """What the columns of ``files`` convert to, where the passes of the extract have not counted it."""
    if multi:
        lines = records(spark, files).select(F.col("file").cast("string").alias("f"), "split", F.col("record").alias("value"))
    else:
        lines = _text(spark, files)
    return list(_layout_types(_facts(lines), written(_counted(lines), "csv-types")).values())


_OFFSET = r"\d{2}:\d{2}.*(Z|[+-]\d{2}(:?\d{2})?)$"


def _typed(src: Column, dtype: T.DataType) -> Column:
    """``src`` as ``dtype``; a timestamp that states an offset is the UTC time of its instant."""
    if not isinstance(dtype, T.TimestampNTZType):
        return src.try_cast(dtype)
    instant = F.convert_timezone(F.current_timezone(), F.lit("UTC"), src.try_cast("timestamp").cast("timestamp_ntz"))
    return F.when(src.rlike(_OFFSET), instant).otherwise(src.try_cast(dtype))


def load_by_name(spark: SparkSession, path: "str | Extract", schema: T.StructType,
                 options: dict | None = None) -> DataFrame:
    """Load CSV files into ``schema`` by column name; a bad value aborts the job.

    Names are matched case-insensitively; target columns absent from a file
    are NULL; file columns absent from the target are ignored.  A value that
    does not convert to its column type raises (``raise_error``) instead of
    silently becoming NULL, independent of the session's ANSI setting.
    """
    text = scan_csv(spark, path, options)
    have = set(text.columns)
    cols = []
    for f in schema.fields:
        name = f.name.lower()
        if name not in have:
            cols.append(F.lit(None).cast(f.dataType).alias(name))
            continue
        src = F.col(f"`{name}`")
        if isinstance(f.dataType, T.StringType):
            cols.append(src.alias(name))
            continue
        # abort on a value that does not convert, whatever the session's ANSI setting
        typed = _typed(src, f.dataType)
        cols.append(F.when(src.isNotNull() & typed.isNull(),
                           F.raise_error(F.concat(F.lit(f"cannot load column {name} as "
                                                        f"{f.dataType.simpleString()}: "), src)))
                    .otherwise(typed).alias(name))
    return text.select(*cols)


def source_path(spark: SparkSession, src_dir: str, table: str) -> tuple[str, int, bool] | None:
    """``{table}.csv``, compressed or not, or a ``{table}/`` folder of parts: (path, bytes, compressed).

    More than one of these for a table raises, since either alone would lose rows.
    """
    jvm, conf = _hadoop(spark)
    root = jvm.org.apache.hadoop.fs.Path(src_dir)
    fs = root.getFileSystem(conf)
    forms = []
    for st in fs.listStatus(root):
        base = st.getPath().getName().lower()
        path = st.getPath().toString()
        if st.isFile() and base in (f"{table}.csv", *(f"{table}.csv{c}" for c in COMPRESSED)):
            forms.append((path, int(st.getLen()), base.endswith(COMPRESSED)))
        if st.isDirectory() and base == table:
            files = list_files(spark, path)
            forms.append((path, sum(s for _, s in files), any(f.endswith(COMPRESSED) for f, _ in files)))
    if len(forms) > 1:
        raise ValueError(f"table {table} is in {src_dir} in several forms: " + ", ".join(p for p, _, _ in sorted(forms)))
    return forms[0] if forms else None


def load_raw_all(spark: SparkSession, src_dir: str, dst_root: str, tables: Iterable[str],
                 target_file_bytes: int = 128 << 20) -> dict[str, DataFrame]:
    """Reload every table of ``tables`` in ``src_dir`` as a Parquet table under ``dst_root``.

    Each table is inferred, loaded by name and published as a new version
    (create-or-replace).  A table that is missing raises before anything is
    loaded; header-only files are skipped.  A compressed file is one
    unsplittable partition, so it is spread over several partitions before
    the Parquet write.  A failure stops the loop at that table.
    """
    from wardline.plans.sinks import read_table, write_table

    found = {t: source_path(spark, src_dir, t) for t in tables}
    missing = [t for t, f in found.items() if f is None]
    if missing:
        raise FileNotFoundError(f"not in {src_dir}: " + ", ".join(f"{t}.csv" for t in missing))
    loaded: dict[str, DataFrame] = {}
    for table, (path, size, compressed) in found.items():
        extract = Extract.of(spark, path, types=True)
        if not extract.filled:
            continue  # header only: nothing to load
        df = load_by_name(spark, extract, infer_schema(spark, extract))
        if compressed:
            df = df.repartition(max(1, (size * 8) // target_file_bytes + 1))
        write_table(df, dst_root, table)
        loaded[table] = read_table(spark, dst_root, table)
    return loaded


def write_csv(df: DataFrame, path: str, files: int | None = None, compression: str | None = None,
              columns: Sequence[str] | None = None, header_case: str = "as_is") -> str:
    """Write ``df`` as headed CSV (optionally reordered / re-cased columns)."""
    out = df.select(*columns) if columns else df
    if header_case == "upper":
        out = out.toDF(*[c.upper() for c in out.columns])
    if files:
        out = out.repartition(files)
    w = out.write.mode("errorifexists").option("header", "true")
    if compression:
        w = w.option("compression", compression)
    w.csv(path)
    return path
