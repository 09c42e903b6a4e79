"""Landing raw extracts as files, for the CSV and streaming entry points.

The clinical source files are not available, so the raw tables derived
from the test tables are written out the way an extract would arrive:
headed CSV, part of it gzip-compressed, column order and header case
varying between files.  Spark writes them in parallel (one file per
task); paths are fresh folders under the shared checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.session import scratch_path
from wardline.sources.csv import write_csv


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def gather_files(spark: SparkSession, src_dirs: list[str], dst: str) -> str:
    """Move the data files of several Spark output folders into one folder."""
    jvm, fs = _fs(spark, dst)
    fs.mkdirs(jvm.org.apache.hadoop.fs.Path(dst))
    i = 0
    for src in src_dirs:
        for st in fs.listStatus(jvm.org.apache.hadoop.fs.Path(src)):
            name = st.getPath().getName()
            if name.startswith(("_", ".")) or not st.isFile():
                continue
            ext = name[name.index("."):] if "." in name else ""
            fs.rename(st.getPath(), jvm.org.apache.hadoop.fs.Path(f"{dst}/part-{i:05d}{ext}"))
            i += 1
    return dst


def land_table_csv(spark: SparkSession, df: DataFrame, key: str, name: str) -> str:
    """Land ``df`` as one folder of CSV files with two layouts; return the folder.

    Rows split by a hash of ``key``: one half plain CSV with the columns in
    reverse order and upper-case headers, the other half gzip-compressed in
    the original order.  Loading the folder by name gives back ``df``.
    """
    root = scratch_path(spark, f"landing-{name}")
    half = F.abs(F.xxhash64(F.col(key))) % 2
    cols = list(df.columns)
    write_csv(df.filter(half == 0), f"{root}/a", columns=list(reversed(cols)), header_case="upper")
    write_csv(df.filter(half == 1), f"{root}/b", compression="gzip")
    return gather_files(spark, [f"{root}/a", f"{root}/b"], f"{root}/files")


def land_extract(spark: SparkSession, frames: dict[str, DataFrame], gz: frozenset = frozenset(),
                 header_only: tuple[str, ...] = ()) -> str:
    """Land raw tables as an extract folder: ``{name}/part-*.csv[.gz]`` per table.

    Tables in ``header_only`` get a single file holding just the header line.
    """
    root = scratch_path(spark, "extract")
    for name, df in frames.items():
        write_csv(df, f"{root}/{name}", compression="gzip" if name in gz else None)
    jvm, fs = _fs(spark, root)
    for name in header_only:
        out = fs.create(jvm.org.apache.hadoop.fs.Path(f"{root}/{name}.csv"), True)
        out.write(bytearray(b"Id,Date,Patient\n"))
        out.close()
    return root
