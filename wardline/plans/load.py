"""Load step: publish raw tables (the warehouse's raw layer) as Parquet tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from wardline.plans.sinks import write_table
from wardline.sources.catalog import MODELLED_SOURCES, RawTables


def publish_raw(raw: RawTables, root: str, names=MODELLED_SOURCES, threads: int = 4) -> RawTables:
    """Write each raw relation once (independent tables as concurrent jobs); return the loaded catalog."""
    frames = {n: raw[n] for n in names}
    spark = next(iter(frames.values())).sparkSession
    with ThreadPoolExecutor(max_workers=max(1, threads)) as pool:
        for f in [pool.submit(write_table, df, root, n) for n, df in frames.items()]:
            f.result()
    return RawTables.from_tables(spark, root, names)
