"""Star-schema loading: dimensions, key resolution, facts, and orphan checks."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.operators.sizing import BROADCAST_ROWS, fits_broadcast
from stratalake.operators.upsert import check_source, keyed_upsert

# A key is hot above 1/share of all rows, so there are fewer than ``share`` hot keys. The share is
# this many times the shuffle partitions: an ordinary key is then a small part of one of them.
HOT_PER_PARTITION = 4
_HOT_PLACES = 1 << 14
_PART = "__dealt"


@dataclass(frozen=True)
class DimRef:
    """A dimension to resolve: its frame, its natural key and its surrogate key.

    With ``rows`` given nothing is counted: ``BROADCAST_ROWS`` with keys of up to 250 bytes (60 characters of any kind) fit.
    """

    dim: DataFrame
    natural_key: str
    key_col: str
    fact_col: str | None = None  # the fact's column, if named otherwise
    rows: int | None = None  # the size, if it is known and the natural keys are short


def load_dimension(
    dim: DataFrame,
    source: DataFrame,
    natural_key: str,
    key_col: str,
    attrs: Sequence[str],
    promote_if: Column | None = None,
    load_ts: Column | None = None,
    trusted: bool = False,
) -> DataFrame:
    """Overwriting dimension load: attributes follow the source, keys stay, no row leaves.

    ``source`` must hold each natural key once; that is checked unless it is
    ``trusted``. The result is the dimension's new content.
    """
    promoted = source if promote_if is None else source.where(promote_if)
    rows = promoted.select(natural_key, *attrs, *([load_ts.alias("load_ts")] if load_ts is not None else []))
    return _merge_keyed(dim, rows, promoted, natural_key, key_col, trusted)


def _merge_keyed(target: DataFrame, rows: DataFrame, source: DataFrame, natural_key: str, key_col: str, trusted: bool) -> DataFrame:
    """The target with ``rows`` merged in and new ones numbered; ``source`` is what they came from, the cheaper one to count.

    Both are dealt by a hash of the key, as many parts as fill the shuffle partitions evenly.
    """
    n = source.count() if trusted else check_source(source, [natural_key])
    top, held = target.agg(F.max(key_col), F.count(F.lit(1))).first()
    parts = HOT_PER_PARTITION * int(target.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    part = F.pmod(F.xxhash64(natural_key), F.lit(parts))
    merged = keyed_upsert(
        target.withColumn(_PART, part), rows.withColumn(_PART, part), natural_key, key_col, _PART, parts, held + n, top or 0
    )
    return merged.rows.select(*target.columns)


def resolve_keys(
    rows: DataFrame,
    dims: Sequence[DimRef],
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int | None = None,
) -> DataFrame:
    """Add each dimension's surrogate key; NULL where the dimension has no such row."""
    given = rows
    for ref in dims:
        fact_col = ref.fact_col or ref.natural_key
        pairs = ref.dim.select(F.col(ref.natural_key).alias(fact_col), ref.key_col)
        if ref.rows <= broadcast_rows if ref.rows is not None else fits_broadcast(pairs, broadcast_rows):
            rows = rows.join(F.broadcast(pairs), fact_col, "left")
        else:
            rows = _lookup_large(rows, pairs, fact_col, ref.key_col, hot_keys(given, fact_col, hot_share))
    return rows


def hot_keys(rows: DataFrame, col: str, share: int | None = None) -> list:
    """Values of ``col`` that more than ``1/share`` of the rows carry: fewer than ``share``.

    Rows are counted by a hash of the value first, which leaves a few numbers per task; values are counted only where a hash is
    that frequent.
    """
    if share is None:
        share = HOT_PER_PARTITION * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.when(F.col(col).isNotNull(), F.pmod(F.xxhash64(col), F.lit(_HOT_PLACES)))
    places = rows.select(place.alias("__place")).groupBy("__place").agg(F.count(F.lit(1)).alias("__n")).collect()
    least = sum(n for _, n in places) / share
    often = [p for p, n in places if p is not None and n > least]
    if not often:
        return []
    counts = rows.select(col).where(place.isin(often)).groupBy(col).agg(F.count(F.lit(1)).alias("__n"))
    return [r[0] for r in counts.where(F.col("__n") > least).select(col).collect()]


def _lookup_large(rows: DataFrame, pairs: DataFrame, col: str, value_col: str, hot_values: list) -> DataFrame:
    """Left join with a large unique lookup that no hot or NULL key can pile up in one task.

    Only ordinary rows are shuffled. Rows without a key match nothing, and rows
    with a hot key (see :func:`hot_keys`, so a short list) take their value from
    a broadcast: both stay where they are.
    """
    hot = F.col(col).isin(hot_values)
    keyless = rows.where(F.col(col).isNull()).withColumn(value_col, F.lit(None).cast(pairs.schema[value_col].dataType))
    ordinary = rows.where(F.col(col).isNotNull() & ~hot).join(pairs, col, "left")
    joined = ordinary.select(*rows.columns, value_col).unionByName(keyless)
    if not hot_values:
        return joined
    settled = rows.where(hot).join(F.broadcast(pairs.where(hot)), col, "left")
    return joined.unionByName(settled.select(*rows.columns, value_col))


def load_fact(
    fact: DataFrame,
    source: DataFrame,
    dims: Sequence[DimRef],
    natural_key: str,
    key_col: str,
    measures: Sequence[str],
    promote_if: Column | None = None,
    load_ts: Column | None = None,
    trusted: bool = False,
) -> DataFrame:
    """Resolve the dimension keys, then upsert on the natural key, keeping surrogate keys."""
    promoted = source if promote_if is None else source.where(promote_if)
    rows = resolve_keys(promoted, dims).select(
        natural_key,
        *[d.key_col for d in dims],
        *measures,
        *([load_ts.alias("load_ts")] if load_ts is not None else []),
    )
    return _merge_keyed(fact, rows, promoted, natural_key, key_col, trusted)


def orphans(
    rows: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows whose key is not in ``dim``, including rows without a key."""
    return _by_presence(rows, dim, key, dim_key, broadcast_rows, present=False)


def with_match(
    rows: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, broadcast_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Rows whose key is in ``dim``; the complement of :func:`orphans`."""
    return _by_presence(rows, dim, key, dim_key, broadcast_rows, present=True)


def _by_presence(rows, dim, key, dim_key, broadcast_rows, present: bool) -> DataFrame:
    known = dim.select(F.col(dim_key or key).alias(key))
    if fits_broadcast(known, broadcast_rows):
        return rows.join(F.broadcast(known), key, "left_semi" if present else "left_anti").select(*rows.columns)
    known = known.where(F.col(key).isNotNull()).distinct().withColumn("__known", F.lit(True))
    marked = _lookup_large(rows, known, key, "__known", hot_keys(rows, key))
    wanted = F.col("__known").isNotNull() if present else F.col("__known").isNull()
    return marked.where(wanted).select(*rows.columns)
