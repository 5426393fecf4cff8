"""Data-quality operators: required columns, quarantine split, summaries, schema checks."""

from __future__ import annotations

import itertools
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratalake.functions.text import missing, present
from stratalake.functions.values import std_date


@dataclass(frozen=True)
class Rule:
    """A row is bad where ``test`` is true; ``reason`` says why."""

    name: str
    test: Column
    reason: str


# The reasons written beside quarantined rows.
MISSING_ID_REASON = "Missing Patient ID"
BAD_DATE_REASON = "Invalid Visit Date"


def missing_id_rule(id_col: str) -> Rule:
    return Rule("missing_id", missing(id_col), MISSING_ID_REASON)


def invalid_date_rule(date_col: str, parsed: Column | None = None) -> Rule:
    """Optional: also quarantine rows whose date is NULL or unreadable.

    ``parsed`` is the date where it has been read already, which saves reading it again.
    """
    return Rule("invalid_date", (std_date(date_col) if parsed is None else parsed).isNull(), BAD_DATE_REASON)


def first_reason(rules: Sequence[Rule]) -> Column:
    """Reason of the first rule that fires, NULL for a good row."""
    return F.coalesce(*[F.when(r.test, r.reason) for r in rules], F.lit(None).cast("string"))


def split_bad(df: DataFrame, rules: Sequence[Rule], reason_col: str = "error_reason") -> tuple[DataFrame, DataFrame]:
    """(good, bad): every input row is in exactly one; bad rows carry the reason."""
    tagged = df.withColumn(reason_col, first_reason(rules))
    good = tagged.where(F.col(reason_col).isNull()).drop(reason_col)
    return good, tagged.where(F.col(reason_col).isNotNull())


def require(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Keep rows where every named text column is present. Apply before ranking."""
    return df.where(reduce(and_, [present(c) for c in cols]))


def quality_summary(df: DataFrame, status_cols: Sequence[str]) -> DataFrame:
    """Row count per combination of status values."""
    return df.groupBy(*status_cols).agg(F.count(F.lit(1)).alias("row_count"))


def quality_measures(statuses: Mapping[str, Sequence[str]]) -> dict[str, Column]:
    """Aggregates that count the rows of each combination of status words, to be observed while rows are written.

    ``statuses`` gives the words each status column may hold; any other value, or none, counts as its own word ``None``.
    """
    return {f"q{i}": F.count_if(test) for i, (_, test) in enumerate(_combinations(statuses))}


def quality_rows(statuses: Mapping[str, Sequence[str]], measured: Mapping) -> list[list]:
    """The combinations that occurred, each with its number of rows, as :func:`quality_summary` gives them."""
    counted = [[*words, measured[f"q{i}"]] for i, (words, _) in enumerate(_combinations(statuses))]
    return [row for row in counted if row[-1]]


def _combinations(statuses: Mapping[str, Sequence[str]]):
    for words in itertools.product(*[[*words, None] for words in statuses.values()]):
        tests = []
        for (col, known), word in zip(statuses.items(), words):
            other = F.coalesce(~F.col(col).isin(*known), F.lit(True))
            tests.append(other if word is None else F.col(col) == word)
        yield list(words), reduce(and_, tests)


def _constraints(schema: T.StructType) -> list[tuple[str, str, Column]]:
    """(column, rule, test of an offending row) of each declared constraint."""
    checks: list[tuple[str, str, Column]] = []
    for f in schema.fields:
        if not f.nullable:
            checks.append((f.name, "not_null", F.col(f.name).isNull()))
        if "max_length" in f.metadata:
            checks.append((f.name, "max_length", F.length(f.name) > f.metadata["max_length"]))
    return checks


def violation_measures(schema: T.StructType) -> dict[str, Column]:
    """Aggregates that count the offending rows of each constraint, to be observed while rows are written."""
    return {f"v{i}": F.count_if(test) for i, (_, _, test) in enumerate(_constraints(schema))}


def violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """One row per declared constraint with its number of offending rows.

    Constraints come from the schema: ``nullable=False`` and, for text, the
    ``max_length`` entry of the field metadata. All are counted in one pass.
    """
    checks = _constraints(schema)
    if not checks:
        return df.sparkSession.createDataFrame([], "column_name string, rule string, violations long")
    counted = df.agg(*[c.alias(name) for name, c in violation_measures(schema).items()])
    entries = [
        F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.col(f"v{i}").alias("violations"))
        for i, (c, r, _) in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*entries)))


def assert_schema(df: DataFrame, schema: T.StructType, measured: Mapping | None = None) -> DataFrame:
    """``df`` cast and ordered to ``schema``; raises if a constraint is broken.

    ``measured`` is what :func:`violation_measures` counted where that was done on the way.
    """
    if measured is None:
        measured = df.agg(*[c.alias(name) for name, c in violation_measures(schema).items()], F.lit(0).alias("_")).first().asDict()
    broken = [(c, measured[f"v{i}"], r) for i, (c, r, _) in enumerate(_constraints(schema)) if measured[f"v{i}"]]
    if broken:
        raise ValueError("; ".join(f"{c}: {n} rows break {r}" for c, n, r in broken))
    return conform(df, schema)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Order and cast to ``schema``; columns the frame lacks become NULL."""
    have = {c.lower() for c in df.columns}
    return df.select(
        *[
            (F.col(f.name) if f.name.lower() in have else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
