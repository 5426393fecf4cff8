"""The size check in front of every explicit broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A broadcast holds at most this many rows and this much text.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 256 * 1024 * 1024


def text_bytes(df: DataFrame):
    """Aggregate: bytes in the text and binary columns; the others have a fixed width."""
    wide = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    per_row = sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in wide), F.lit(0))
    return F.coalesce(F.sum(per_row.cast("long")), F.lit(0))


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` is small enough to send to every executor; counted, not estimated."""
    rows, size = df.agg(F.count(F.lit(1)), text_bytes(df)).first()
    return rows <= max_rows and size <= max_bytes
