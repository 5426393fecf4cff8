"""Row status rules, and the validation struct that bundles them.

The struct is an ordinary column: add it once with ``withColumn`` and read its
fields, so that each raw text is parsed once and filters on a field stay
visible to the optimizer.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, SparkSession

from stratalake.functions.text import missing_node
from stratalake.functions.tree import Node, call
from stratalake.functions.values import DATE_FORMATS, any_negative_node, std_date_node, total_node

# Status words.
VALID, INVALID, BAD, VALIDATED, LOOKUP_OK = "VALID", "INVALID", "BAD", "VALIDATED", "OK"


def negative_node(cols: Iterable[Column | str]) -> Node:
    return call("if", any_negative_node(cols), INVALID, VALID)


def negative_status(cols: Iterable[Column | str]) -> Column:
    """``INVALID`` if a component is negative, else ``VALID`` (also for NULL)."""
    return negative_node(cols).column()


def lookup_node(checks: Sequence[tuple[Column | str, str]]) -> Node:
    return call("coalesce", *[call("if", missing_node(c), label, None) for c, label in checks], LOOKUP_OK)


def lookup_status(checks: Sequence[tuple[Column | str, str]]) -> Column:
    """The label of the first missing column in the given order, else ``OK``."""
    return lookup_node(checks).column()


def visit_node(id_col: Column | str, amounts: Iterable[Column | str]) -> Node:
    return call("if", missing_node(id_col), BAD, negative_node(amounts))


def visit_status(id_col: Column | str, amounts: Iterable[Column | str]) -> Column:
    """``BAD`` without an id, else the negative-amount status."""
    return visit_node(id_col, amounts).column()


def text_status(c: Column | str) -> Column:
    """``INVALID`` for a missing text, else ``VALID``."""
    return call("if", missing_node(c), INVALID, VALID).column()


@dataclass(frozen=True)
class RowCheck:
    """What to validate in a row. ``lookups`` are (column, label) in test order."""

    id_col: str
    date_col: str
    amounts: Sequence[str]
    lookups: Sequence[tuple[str, str]] = field(default_factory=tuple)
    date_formats: Sequence[str] = DATE_FORMATS

    def columns(self) -> list[str]:
        """Input columns, each once, in parameter order."""
        named = [self.id_col, *[c for c, _ in self.lookups], self.date_col, *self.amounts]
        return list(dict.fromkeys(named))


def validate_node(check: RowCheck) -> Node:
    """The rules of one row, the only place where they are put together."""
    fields = {
        "visit_date": std_date_node(check.date_col, check.date_formats),
        "lookup_status": lookup_node(check.lookups),
        "total_charges": total_node(check.amounts),
        "status": visit_node(check.id_col, check.amounts),
    }
    return call("named_struct", *[x for name, part in fields.items() for x in (name, part)])


def validate_struct(check: RowCheck) -> Column:
    """``struct<visit_date, lookup_status, total_charges, status>`` for one row."""
    return validate_node(check).column()


def register_validation(spark: SparkSession, name: str, check: RowCheck) -> None:
    """Offer the same rules to SQL as ``name(<check.columns()>)``, a SQL-bodied function."""
    params = ", ".join(f"{c} STRING" for c in check.columns())
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}({params})
        RETURNS STRUCT<visit_date: DATE, lookup_status: STRING, total_charges: DECIMAL(12,2), status: STRING>
        RETURN {validate_node(check).sql()}
    """)
