"""Tables bucketed by key: lookups and merges that do not shuffle them.

A table is written once with its rows dealt to buckets by key and sorted within each. Joins on that
key then read both sides bucket by bucket: of two bucketed tables none is shuffled, of a bucketed table and other rows
only the rows. They are tables of Spark's catalog, at a path of one's own; all tables that are to be joined need the same number
of buckets: so many that a bucket fits a task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratalake.operators.upsert import check_source, upsert


def write_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Write ``df`` as the catalog table ``name`` with its files at ``path``; rows of a bucket come together in one file."""
    spread = df.repartition(buckets, *keys)
    return save_bucketed(spread, name, path, keys, buckets)


def save_bucketed(df: DataFrame, name: str, path: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """:func:`write_bucketed` of rows that a join on bucketed tables has left in their buckets: no shuffle."""
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def lookup_bucketed(rows: DataFrame, dim: DataFrame, key: str, dim_key: str, value: str) -> DataFrame:
    """``rows`` with the dimension's ``value``, NULL where it has no such row; both bucketed by the key.

    Rows without a key stay in their bucket.
    """
    pairs = dim.select(F.col(dim_key).alias("__key"), value)
    return rows.join(pairs.hint("merge"), rows[key] == pairs["__key"], "left").select(*rows.columns, value)


def merge_bucketed(
    target: DataFrame, source: DataFrame, keys: Sequence[str], name: str, path: str, buckets: int, unique_rows: int | None = None
) -> DataFrame:
    """Upsert into a bucketed table, written as a new one: the target is neither shuffled to join it nor to write it.

    ``source`` is dealt to the same buckets. Its keys are checked unless ``unique_rows`` is given.
    """
    rows = check_source(source, keys) if unique_rows is None else unique_rows
    dealt = source.repartition(buckets, *keys)
    merged = upsert(target, dealt, keys, unique_rows=rows, broadcast_keys=-1, target_rows=1)
    return save_bucketed(merged, name, path, keys, buckets)
