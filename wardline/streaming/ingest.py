"""Stream ingestion into the raw table that the batch load also fills."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from wardline.streaming.capture import _trigger, file_stream

# Text formats carry timestamps at full (microsecond) precision.
TEXT_TS_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
                   "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def ingest_raw_stream(spark: SparkSession, landing_dir: str, schema: T.StructType, raw_dir: str,
                      checkpoint: str, fmt: str = "json", trigger: str | None = "1 minute",
                      max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Append arriving messages (files here; a broker source swaps in) to ``raw_dir`` as Parquet.

    The file sink commits each batch in its metadata log, so batch readers
    of ``raw_dir`` only see complete batches and a replay adds nothing twice.
    """
    opts = TEXT_TS_OPTIONS if fmt in ("json", "csv") else None
    rows = file_stream(spark, landing_dir, schema, fmt, max_files_per_trigger, opts)
    w = (rows.writeStream.format("parquet").option("path", raw_dir)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, trigger).start()
