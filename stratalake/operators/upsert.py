"""Key-based upsert and surrogate keys.

``upsert`` returns the new content of the target as a DataFrame; the table
store hands it the part of the table that the source's keys fall into.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from stratalake.operators.sizing import BROADCAST_ROWS, fits_broadcast
from stratalake.sources.staging import PACKED, stage, stage_observed

# A delta is small if the target is this many times larger.
SMALL_FACTOR = 10
# Rows that ``assign_keys`` sorts in one bucket, about, and the most buckets: their offsets are broadcast.
BUCKET_ROWS = 200_000
MOST_BUCKETS = 1 << 20
# The rows of one part are dealt to so many pieces that there are this many for each shuffle partition.
PIECES_PER_PARTITION = 4
PIECE = "__piece"


def check_source(source: DataFrame, keys: Sequence[str]) -> int:
    """Row count of a merge source; raises on a NULL key or a repeated key."""
    per_key = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    any_null = F.lit(False)
    for k in keys:
        any_null = any_null | F.col(k).isNull()
    row = per_key.agg(F.sum("__n"), F.max("__n"), F.count_if(any_null)).first()
    rows, most, nulls = row[0] or 0, row[1] or 0, row[2]
    if nulls:
        raise ValueError(f"merge source has rows with a NULL in {list(keys)}")
    if most > 1:
        raise ValueError(f"merge source has up to {most} rows for one value of {list(keys)}")
    return rows


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
    unique_rows: int | None = None,
    broadcast_keys: int = BROADCAST_ROWS,
    factor: int = SMALL_FACTOR,
    target_rows: int | None = None,
) -> DataFrame:
    """Target rows with matches updated and the other source rows added.

    ``update`` lists the columns a match overwrites, ``insert`` those a new row
    fills (default for both: all the source has). Elsewhere a match keeps the
    target's value and a new row has NULL. No row is deleted. ``unique_rows`` is
    the row count of a source already known to hold each key once; without it
    that is checked here. ``target_rows`` is the target's size where it is known; it is counted otherwise.

    A small delta (at most ``broadcast_keys`` rows and ``1/factor`` of the target) is broadcast as bare keys: the
    target streams through an anti join and is not shuffled. A larger one is
    merged by one full outer join, which shuffles each side once.
    """
    keys = list(keys)
    rest, overwrite, fill = _roles(target, source, keys, update, insert)
    given = [c for c in rest if c in source.columns]
    rows = check_source(source, keys) if unique_rows is None else unique_rows
    target_rows = target.count() if target_rows is None else target_rows
    if target_rows == 0:  # first load: nothing to match
        return source.select(*[_typed(target, c, F.col(c) if c in fill or c in keys else F.lit(None)) for c in target.columns])
    if _is_small(source, keys, rows, target_rows, broadcast_keys, factor):
        return _merge_small(target, source, keys, rest, overwrite, fill)
    return _merge_large(target, source, keys, given, overwrite, fill)


def _is_small(source: DataFrame, keys: Sequence[str], rows: int, target_rows: int, limit: int, factor: int) -> bool:
    """Whether sending the source's keys to every task beats joining the two tables."""
    return rows <= limit and rows * factor <= target_rows and fits_broadcast(source.select(*keys), limit)


def _typed(target: DataFrame, col: str, value: Column) -> Column:
    return value.cast(target.schema[col].dataType).alias(col)


def _merge_small(target, source, keys, rest, overwrite, fill) -> DataFrame:
    bare = F.broadcast(source.select(*keys))
    untouched = target.join(bare, keys, "left_anti").select(*target.columns)
    mixed = [c for c in rest if c not in overwrite or c not in fill]
    if mixed:
        # Only the rows that match come out of the second scan, so at most |source|.
        held = target.join(bare, keys, "left_semi").select(
            *keys, *[F.col(c).alias(f"__t_{c}") for c in mixed], F.lit(True).alias("__hit")
        )
        source = source.join(held, keys, "left")

    def value(c: str) -> Column:
        if c not in mixed:
            return F.col(c)
        matched = F.col(c) if c in overwrite else F.col(f"__t_{c}")
        return F.when(F.col("__hit"), matched).otherwise(F.col(c) if c in fill else F.lit(None))

    return untouched.unionByName(source.select(*[_typed(target, c, value(c)) for c in target.columns]))


def _merge_large(target, source, keys, given, overwrite, fill) -> DataFrame:
    left = target.withColumn("__hit", F.lit(True))
    right = source.select(*keys, *[F.col(c).alias(f"__s_{c}") for c in given], F.lit(True).alias("__new"))
    both = left.join(right, keys, "full")

    def value(c: str) -> Column:
        if c in keys:
            return F.col(c)
        matched = F.col(f"__s_{c}") if c in overwrite else F.col(c)
        inserted = F.col(f"__s_{c}") if c in fill else F.lit(None)
        return F.when(F.col("__hit") & F.col("__new"), matched).when(F.col("__new"), inserted).otherwise(F.col(c))

    return both.select(*[_typed(target, c, value(c)) for c in target.columns])


def assign_keys(
    rows: DataFrame,
    natural_key: str | Sequence[str],
    key_col: str,
    start_after: int = 0,
    buckets: int | None = None,
) -> DataFrame:
    """Number the rows ``start_after + 1 …`` without gaps, in parallel.

    Rows are hashed to ``buckets`` (by default as many as their number asks
    for) by natural key and ranked inside each; a running total over the bucket sizes (``buckets`` rows, the one small table
    that meets in a single task and is broadcast) shifts the ranks. The result
    depends on the natural keys alone, so a lost task recomputes the same
    numbers. Natural keys must be unique, which also keeps buckets even.
    """
    nk = [natural_key] if isinstance(natural_key, str) else list(natural_key)
    if buckets is None:
        buckets = key_buckets(rows.count())
    if buckets == 1:
        number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(*nk))
        return rows.withColumn(key_col, (number + F.lit(start_after)).cast(T.LongType()))
    placed = rows.withColumn("__b", F.pmod(F.xxhash64(*nk), F.lit(buckets)).cast("int"))
    before = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("__b")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select("__b", (F.coalesce(F.sum("__n").over(before), F.lit(0)) + F.lit(start_after)).alias("__off"))
    )
    ranked = placed.withColumn("__i", F.row_number().over(Window.partitionBy("__b").orderBy(*nk)))
    return (
        ranked.join(F.broadcast(offsets), "__b")
        .withColumn(key_col, (F.col("__off") + F.col("__i")).cast(T.LongType()))
        .drop("__b", "__off", "__i")
    )


def key_buckets(rows: int) -> int:
    """How many buckets so many rows are numbered in: one if a task can sort them, else at least 16."""
    return 1 if rows <= BUCKET_ROWS // 2 else min(max(16, rows // BUCKET_ROWS), MOST_BUCKETS)


def max_key(target: DataFrame, key_col: str) -> int | None:
    """Highest surrogate key in use, None for an empty table."""
    return target.agg(F.max(key_col)).first()[0]


def piece(df: DataFrame, keys: Sequence[str], parts: int, rows: int = 0) -> Column:
    """The piece of its part that a row is dealt to, by a hash of the keys: a task holds some pieces, never a whole part.

    There are enough pieces to fill the shuffle partitions, and to have about ``BUCKET_ROWS`` of ``rows`` in one.
    """
    wanted = max(PIECES_PER_PARTITION * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), rows // BUCKET_ROWS)
    return F.pmod(F.xxhash64(F.lit(PIECE), *keys), F.lit(-(-wanted // parts))).cast("int")


def fold(target: DataFrame, source: DataFrame, keys: Sequence[str], part: str, parts: int, rows: int = 0) -> DataFrame:
    """Both sides by key, from one shuffle: ``part``, ``PIECE``, the keys, and the other columns as the structs ``old`` and ``new``.

    ``part``, one of ``parts`` numbers, is a column of both sides that depends on the keys alone. The rows are dealt by it and by
    :func:`piece`, so what is made of them can be written part by part without another shuffle, and no task grows with a part.
    Each side holds a key once; a struct is null where its side has no row.
    """
    keys = list(keys)
    sides = []
    for df, name in ((target, "old"), (source, "new")):
        rest = [c for c in df.columns if c not in keys and c != part]
        sides.append(df.select(part, *keys, F.struct(*rest, F.lit(True).alias("__there")).alias(name)))
    both = sides[0].unionByName(sides[1], allowMissingColumns=True)
    both = both.withColumn(PIECE, piece(both, keys, parts, rows)).repartition(part, PIECE)
    return both.groupBy(part, PIECE, *keys).agg(*[F.first(name, ignorenulls=True).alias(name) for name in ("old", "new")])


def upsert_parts(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    part: str,
    parts: int,
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
) -> DataFrame:
    """:func:`upsert` of rows that are dealt by ``part``, which the result keeps: one shuffle of each side."""
    rest, overwrite, fill = _roles(target, source, [*keys, part], update, insert)
    old, new = (lambda c: F.col(f"old.{c}")), (lambda c: F.col(f"new.{c}") if c in source.columns else F.lit(None))

    def value(c: str) -> Column:
        matched = new(c) if c in overwrite else old(c)
        added = new(c) if c in fill else F.lit(None)
        return _typed(target, c, F.when(F.col("new").isNull(), old(c)).when(F.col("old").isNull(), added).otherwise(matched))

    folded = fold(target, source, keys, part, parts)
    return folded.select(*[value(c) if c in rest else _typed(target, c, F.col(c)) for c in target.columns])


def _roles(target: DataFrame, source: DataFrame, keys: Sequence[str], update, insert) -> tuple[list[str], set[str], set[str]]:
    """The target's columns that are no keys, those a match overwrites, and those a new row fills."""
    rest = [c for c in target.columns if c not in keys]
    given = [c for c in rest if c in source.columns]
    for wanted in (update, insert):
        if wanted is not None and set(wanted) - set(given) - set(keys):
            raise ValueError(f"source lacks {sorted(set(wanted) - set(given) - set(keys))}")
    return rest, set(given if update is None else update), set(given if insert is None else insert)


@dataclass(frozen=True)
class Merged:
    """The rows of a merge, how many of them got a new key, and its ``changes``, if asked for: old and new image per merged row.

    ``beside`` has the natural key of each merged row with the column that was only to be carried along, ``noted`` how often that is set.
    """

    rows: DataFrame
    new: int
    changes: DataFrame | None
    beside: DataFrame | None = None
    noted: int = 0


def keyed_upsert(
    target: DataFrame,
    source: DataFrame,
    natural_key: str,
    key_col: str,
    part: str,
    parts: int,
    rows: int,
    top: int = 0,
    images: bool = False,
    beside: str | None = None,
) -> Merged:
    """Upsert of rows that hold each natural key once, with surrogate keys; ``part`` as in :func:`fold`.

    One shuffle of both sides gives the keys in use, the merged rows and what was there before; that is staged. New rows are counted
    in the order of their natural keys inside each piece, where they are, and a running total over the pieces numbers them from ``top + 1``:
    nothing is shuffled for it. Columns that the source lacks keep their value. ``target`` may be a part of a table as long as it has all
    rows of the source's keys. ``rows`` is about how many both have, an upper bound at best. The ``images`` of the changes have all columns but
    the surrogate key. ``beside`` names a column of the source that is no part of the target.
    """
    plain = [c for c in target.columns if c not in (key_col, part)]
    folded = fold(target, source, [natural_key], part, parts, rows)

    def value(c: str) -> Column:
        if c in (natural_key, part):
            return F.col(c)
        merged = F.when(F.col("new").isNotNull(), F.col(f"new.{c}")).otherwise(F.col(f"old.{c}")) if c in source.columns else F.col(f"old.{c}")
        return merged.cast(target.schema[c].dataType).alias(c)

    # a row without an old one gets a number, or the key of that old row is null
    unkeyed = F.col(f"old.{key_col}").isNull()
    so_far = Window.partitionBy(part, PIECE).orderBy(natural_key).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    more = [PIECE, F.count_if(unkeyed).over(so_far).alias("__i")]
    if images:  # the key stands beside it
        more.append(F.when(F.col("old").isNotNull(), F.struct(*[F.col(f"old.{c}").alias(c) for c in plain if c != natural_key])).alias("__old"))
    if beside:
        more.append(F.col(f"new.{beside}").alias(beside))
    if images or beside:
        more.append(F.col("new").isNotNull().alias("__new"))
    found = {"new": F.count_if(F.col(key_col).isNull()), **({"noted": F.count(beside)} if beside else {})}
    merged, found = stage_observed(folded.select(*map(value, target.columns), *more), f"keys-{key_col}", PACKED, **found)
    rows, changes = merged.select(*target.columns), None
    if images:
        image = F.struct(*[F.col(c) if c == natural_key else F.col(f"__old.{c}").alias(c) for c in plain])
        old = F.when(F.col("__old").isNotNull(), image).alias("old")
        changes = merged.where("__new").select(natural_key, old, F.struct(*plain).alias("new"))
    if found["new"]:
        before = Window.orderBy(part, PIECE).rowsBetween(Window.unboundedPreceding, -1)
        offsets = merged.groupBy(part, PIECE).agg(F.max("__i").alias("__n"))
        offsets = offsets.select(part, PIECE, (F.coalesce(F.sum("__n").over(before), F.lit(0)) + F.lit(top)).alias("__off"))
        number = F.coalesce(F.col(key_col), (F.col("__off") + F.col("__i")).cast(target.schema[key_col].dataType))
        rows = merged.join(F.broadcast(offsets), [part, PIECE]).withColumn(key_col, number).select(*target.columns)
    carried = merged.where("__new").select(natural_key, beside) if beside else None
    return Merged(rows, found["new"], changes, carried, found["noted"] if beside else 0)


def conform_to(rows: DataFrame, target: DataFrame) -> DataFrame:
    """The target's columns and types; those the rows lack are NULL."""
    return rows.select(*[_typed(target, c, F.col(c) if c in rows.columns else F.lit(None)) for c in target.columns])


def with_surrogate_keys(
    source: DataFrame,
    target: DataFrame,
    natural_key: str,
    key_col: str,
    rows: int,
    broadcast_keys: int = BROADCAST_ROWS,
    factor: int = SMALL_FACTOR,
) -> DataFrame:
    """``source`` plus ``key_col``: the target's key where it has one, else a new one.

    ``rows`` is the size of the source. A small one is broadcast as bare keys to
    fetch the keys in use, so the target is not shuffled; a large one is joined
    once and the outcome staged, as three later steps read it.
    """
    top = max_key(target, key_col)
    if top is None:  # first load: every row is new
        return assign_keys(source, natural_key, key_col, buckets=key_buckets(rows))
    held = target.select(natural_key, key_col)
    if _is_small(source, [natural_key], rows, target.count(), broadcast_keys, factor):
        held = held.join(F.broadcast(source.select(natural_key)), natural_key, "left_semi")
        joined = source.join(held, natural_key, "left")
    else:
        joined = stage(source.join(held, natural_key, "left"), f"keys-{key_col}")
    fresh = joined.where(F.col(key_col).isNull()).drop(key_col)
    numbered = assign_keys(fresh, natural_key, key_col, top, key_buckets(rows))
    return joined.where(F.col(key_col).isNotNull()).unionByName(numbered)
