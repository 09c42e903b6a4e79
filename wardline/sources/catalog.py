"""Named raw relations: the declared raw sources that the staging models read."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame

# The declared raw sources.  The models read the first five; the
# others are there for queries and checks on raw data.
MODELLED_SOURCES = ("patients", "encounters", "conditions", "medications", "organizations")
DECLARED_SOURCES = MODELLED_SOURCES + ("observations", "procedures", "providers", "payers")


class RawTables(Mapping):
    """Lazily built raw DataFrames by name.

    Each value is produced on first access and then reused, so a model
    graph built from one ``RawTables`` shares the same logical sub-plans.
    """

    def __init__(self, builders: Mapping[str, Callable[[], DataFrame]], table_backed: bool = False):
        self._builders = dict(builders)
        self._cache: dict[str, DataFrame] = {}
        # True when every raw relation is a plain columnar table scan (cheap to
        # re-read); False for derived or text-parsed relations.
        self.table_backed = table_backed

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._cache:
            self._cache[name] = self._builders[name]()
        return self._cache[name]

    def __iter__(self):
        return iter(self._builders)

    def __len__(self) -> int:
        return len(self._builders)

    def with_stream(self, name: str, stream_dir: str) -> "RawTables":
        """This catalog with rows appended by ``streaming.ingest`` added to ``name``.

        The streamed folder keeps its own commit log (readers only see
        committed batches); it is unioned by column name with the batch-loaded
        table, so staging reads both as one raw relation.
        """
        builders = dict(self._builders)
        batch = builders[name]

        def both() -> DataFrame:
            b = batch()
            streamed = b.sparkSession.read.parquet(stream_dir)
            return b.unionByName(streamed, allowMissingColumns=True)
        builders[name] = both
        return RawTables(builders, table_backed=self.table_backed)

    @classmethod
    def from_frames(cls, frames: Mapping[str, DataFrame]) -> "RawTables":
        return cls({k: (lambda v=v: v) for k, v in frames.items()})

    @classmethod
    def from_parquet(cls, spark, root: str, names=DECLARED_SOURCES) -> "RawTables":
        return cls({n: (lambda n=n: spark.read.parquet(f"{root.rstrip('/')}/{n}")) for n in names},
                   table_backed=True)

    @classmethod
    def from_csv(cls, spark, folder: str, names=DECLARED_SOURCES) -> "RawTables":
        """Raw tables read in place from ``{name}.csv[.gz]`` files or ``{name}/`` folders, every run.

        Types are inferred from all rows and columns matched by name; no load
        step is needed (the local, file-based way of running the models).
        """
        from wardline.sources.csv import Extract, infer_schema, load_by_name, source_path

        def build(name: str):
            found = source_path(spark, folder, name)
            if found is None:
                raise FileNotFoundError(f"{name}.csv[.gz] not in {folder}")
            extract = Extract.of(spark, found[0])
            return load_by_name(spark, extract, infer_schema(spark, extract))
        return cls({n: (lambda n=n: build(n)) for n in names})

    @classmethod
    def from_tables(cls, spark, root: str, names=DECLARED_SOURCES) -> "RawTables":
        """Raw tables published under ``root`` by ``plans.sinks.write_table`` / ``load_raw_all``."""
        from wardline.plans.sinks import read_table
        return cls({n: (lambda n=n: read_table(spark, root, n)) for n in names}, table_backed=True)
