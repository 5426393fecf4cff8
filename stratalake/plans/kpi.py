"""Reports over a fact and a dimension, with all column names as parameters.

Each grouped report sums the fact per surrogate key first and joins the
dimension to those sums: what is shuffled is one row per key and task, however
many fact rows a key has, and the join never sees the fact itself. Only then
are keys that share a name added up.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_key(fact: DataFrame, key: str, counted: str, amount: str | None) -> DataFrame:
    """``key`` and its sums: ``visits`` and, with ``amount``, ``revenue`` and ``amounts``."""
    aggs = [F.count(counted).alias("visits")]
    if amount is not None:
        aggs += [F.sum(amount).alias("revenue"), F.count(amount).alias("amounts")]
    return fact.where(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def group_kpi(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    by: str,
    counted: str,
    amount: str | None = None,
    sort: Sequence[str] = (),
) -> DataFrame:
    """``by``, total_visits and, with ``amount``, total_revenue; sorted descending by ``sort``.

    Rows without a match in the dimension are left out. NULL amounts add nothing.
    """
    return group_sums(_per_key(fact, key, counted, amount), dim, key, by, amount is not None, sort)


def group_sums(sums: DataFrame, dim: DataFrame, key: str, by: str, revenue: bool, sort: Sequence[str] = ()) -> DataFrame:
    """:func:`group_kpi` from sums per ``key``: ``visits`` and, if asked for, ``revenue`` (NULL where no row has an amount)."""
    named = sums.join(dim.select(key, by), key)
    aggs = [F.sum("visits").alias("total_visits")]
    if revenue:
        # sums that were kept up to date are zero, not NULL, where the last amount was taken off
        aggs.append(F.sum(F.when(F.col("amounts") > 0, F.col("revenue"))).alias("total_revenue"))
    out = named.groupBy(by).agg(*aggs)
    return out.orderBy(*[F.col(c).desc_nulls_first() for c in sort], F.col(by)) if sort else out


# Fixed value: an average of amounts has six digits more than the amounts.
AVERAGE_DIGITS = 8


def average_kpi(fact: DataFrame, dim: DataFrame, key: str, by: str, amount: str) -> DataFrame:
    """``by`` and avg_revenue_per_visit, the sum over the number of non-NULL amounts, as a decimal rounded half up.

    Joined on the surrogate key: joining the dimension's text id to it, as the
    original report does, cannot match.
    """
    sums = _per_key(fact, key, amount, amount).join(dim.select(key, by), key)
    out = sums.groupBy(by).agg(F.sum("revenue").alias("__s"), F.sum("amounts").alias("__c"))
    exact = F.col("__s").cast("decimal(24,2)") / F.col("__c").cast("decimal(13,0)")
    mean = F.when(F.col("__c") > 0, F.round(exact, AVERAGE_DIGITS).cast(f"decimal(30,{AVERAGE_DIGITS})"))
    return out.select(by, mean.alias("avg_revenue_per_visit"))


def alerts(fact: DataFrame, amount: str, threshold: float, tie_breakers: Sequence[str] = ()) -> DataFrame:
    """Fact rows strictly above the threshold, highest first.

    The tie-breakers also let the range sort split rows of one popular amount.
    """
    hits = fact.where(F.col(amount) > threshold)
    return hits.orderBy(F.col(amount).desc_nulls_first(), *tie_breakers)


def top_n(kpi: DataFrame, measure: str, n: int, tie: str) -> DataFrame:
    """The ``n`` rows with the highest measure; planned as one top-k, not a full sort."""
    return kpi.orderBy(F.col(measure).desc_nulls_first(), F.col(tie)).limit(n)


def trend(fact: DataFrame, date: str) -> DataFrame:
    """Visits per day; rows without a date are one group of their own."""
    return fact.groupBy(date).agg(F.count(F.lit(1)).alias("total_visits"))


def peak(daily: DataFrame, n: int, date: str) -> DataFrame:
    """The ``n`` busiest dated days; earlier days first among equals."""
    return top_n(daily.where(F.col(date).isNotNull()), "total_visits", n, date)


def peak_ties(daily: DataFrame, date: str) -> DataFrame:
    """Every day that reaches the highest count."""
    dated = daily.where(F.col(date).isNotNull())
    return dated.join(dated.agg(F.max("total_visits").alias("total_visits")), "total_visits", "left_semi")
