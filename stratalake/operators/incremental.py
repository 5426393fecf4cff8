"""Watermark filter and latest-row-per-key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# Fixed value: the watermark of a target that has no rows yet.
EPOCH = "1900-01-01 00:00:00"


def watermark(target: DataFrame, col: str = "load_ts", default: str = EPOCH) -> Column:
    """``max(col)`` of the target as a literal, or ``default`` when it is empty.

    One scalar comes back to the driver. As a literal the bound reaches the
    parquet reader, which skips row groups by their statistics.
    """
    kind = target.schema[col].dataType
    if isinstance(kind, T.TimestampType):
        # micros, not text: text would be ambiguous in the hour a clock is set back
        micros = target.agg(F.unix_micros(F.max(col))).first()[0]
        return F.lit(default).cast(kind) if micros is None else F.timestamp_micros(F.lit(micros))
    top = target.agg(F.max(col).cast("string")).first()[0]
    return F.lit(default if top is None else top).cast(kind)


def utc_day(ts: Column) -> Column:
    """The day of a timestamp in UTC, whatever the session's zone: writers and readers may differ in that."""
    return F.date_from_unix_date(F.floor(F.unix_micros(ts) / 86_400_000_000.0).cast("int"))


def incremental_filter(src: DataFrame, ts_col: str, bound: Column, date_col: str | None = None) -> DataFrame:
    """Rows stamped after ``bound``.

    ``date_col`` names a partition column holding the :func:`utc_day` of
    ``ts_col``; the same bound on it lets the scan leave out whole directories.
    """
    newer = src.where(F.col(ts_col) > bound)
    return newer if date_col is None else newer.where(F.col(date_col) >= utc_day(bound))


def dedup_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_col: str,
    tie_breakers: Sequence[str] | None = None,
) -> DataFrame:
    """The row with the greatest ``order_col`` for each key.

    Rows of one load share their time, so ties are normal. They are settled by
    ``tie_breakers``, by default every other column in frame order, descending,
    NULLs first: the same rows always give the same winner.

    The rank filter is planned with a group limit on both sides of the shuffle,
    so a key that holds a third of the rows sends one row per input task.
    """
    if tie_breakers is None:
        tie_breakers = [c for c in df.columns if c not in keys and c != order_col]
    order = [F.col(c).desc_nulls_first() for c in (order_col, *tie_breakers)]
    ranked = df.withColumn("__rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col("__rank") == 1).drop("__rank")
