"""What a merge changed, and sums kept up to date from that: changed rows are taken off as they were and added as they are."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def differing(changes: DataFrame, apart: Sequence[str] = ()) -> DataFrame:
    """The rows of ``changes`` (columns ``old`` and ``new``, structs; null where there is no row) whose images differ.

    Columns in ``apart`` do not count.
    """
    fields = [f.name for f in changes.schema["new"].dataType.fields if f.name not in apart]
    unlike = [~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")) for c in fields]
    return changes.where(reduce(or_, unlike, F.col("old").isNull() | F.col("new").isNull()))


def net_changes(changes: DataFrame, by: str, sums: Mapping[str, Column]) -> DataFrame:
    """``by`` and the net change of each sum: new images count, old ones are taken off.

    ``sums`` are expressions over the columns of an image. Summed per group before the shuffle.
    """
    signed = F.array(F.struct(F.lit(-1).alias("sign"), F.col("old").alias("row")), F.struct(F.lit(1).alias("sign"), F.col("new").alias("row")))
    images = changes.select(F.inline(signed)).where("row is not null").select("sign", "row.*")
    return images.groupBy(by).agg(*[F.sum(F.col("sign") * c).alias(name) for name, c in sums.items()])


def adjust(held: DataFrame, net: DataFrame, by: str, sums: Sequence[str], count: str) -> DataFrame:
    """Kept sums plus their net changes; groups of which no row is left go.

    One row per group on both sides, also for a null ``by``.
    """
    both = held.unionByName(net.select(*[F.col(c).cast(held.schema[c].dataType).alias(c) for c in held.columns]))
    added = both.groupBy(by).agg(*[F.sum(s).cast(held.schema[s].dataType).alias(s) for s in sums])
    return added.where(F.col(count) != 0).select(*held.columns)
