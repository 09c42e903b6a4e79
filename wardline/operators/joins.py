"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Largest lookup table broadcast, by its measured size: the setting and its default.
MAX_BROADCAST_CONF = "wardline.broadcast.maxBytes"
MAX_BROADCAST_BYTES = 64 << 20
_ROW_BYTES = 32  # per row and column, besides the text of strings


def bounded_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """Hint ``df`` for broadcast only when it measures at most ``max_bytes``.

    The size is that of the rows themselves: every string's bytes plus a fixed
    share per value.  At most as many rows are read as could fit.  Above the
    bound the frame is returned unhinted and the planner (with AQE runtime
    sizes) picks a shuffle join instead.  A frame whose rows are known literals
    (``_known_bytes``) is not measured again.
    """
    limit = max_bytes or int(df.sparkSession.conf.get(MAX_BROADCAST_CONF, str(MAX_BROADCAST_BYTES)))
    size = getattr(df, "_known_bytes", None)
    if size is None:
        fixed = _ROW_BYTES * max(1, len(df.columns))
        text = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) for c in df.columns), F.lit(0))
        size = (df.limit(limit // fixed + 1).agg(F.coalesce(F.sum(text + fixed), F.lit(0)).alias("b")).first()["b"])
    return F.broadcast(df) if size <= limit else df
