"""Dates and amounts read from untrusted text.

Everything here is safe under ANSI mode: text that does not parse gives NULL.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame

from stratalake.functions.tree import Cast, Infix, Node, Value, call, node

# Accepted date formats, in the order they are tried.
DATE_FORMATS = ("dd-MM-yyyy", "yyyy-MM-dd")


_PARTS = {"yyyy": r"(\d{4})", "MM": r"(0[1-9]|1[0-2])", "dd": r"(0[1-9]|[12]\d|3[01])"}
_PART = re.compile("yyyy|MM|dd")


def iso_rewrite(fmt: str) -> tuple[str, str] | None:
    """(pattern, replacement) that turns a text of this format into ``yyyy-MM-dd`` and any other into ``--``.

    Only for formats made of one four-digit year, one two-digit month and one
    two-digit day; None for the rest.
    """
    order = _PART.findall(fmt)
    if sorted(order) != sorted(_PARTS) or re.search("[A-Za-z']", _PART.sub("", fmt)):
        return None
    literals = iter([re.escape(x) for x in _PART.split(fmt)])
    wanted = next(literals) + "".join(_PARTS[p] + next(literals) for p in order)
    groups = "-".join(f"${order.index(p) + 1}" for p in ("yyyy", "MM", "dd"))
    return rf"(?s)\A(?:{wanted}|.*)\z", groups


def date_node(c: Column | str, fmt: str) -> Node:
    rewrite = iso_rewrite(fmt)
    if rewrite is None:
        return call("try_to_date", node(c), fmt)
    return Cast(call("regexp_replace", node(c), *rewrite), "date", attempt=True)


def parse_date(c: Column | str, fmt: str) -> Column:
    """The date in ``c`` under one format, NULL if it does not fit it exactly.

    Digits-only formats are rewritten to ISO order and cast. The general parser
    raises an exception inside for each text that does not fit, which costs far
    more, and texts of another format are the normal case here.
    """
    return date_node(c, fmt).column()


def std_date_node(c: Column | str, formats: Iterable[str] = DATE_FORMATS) -> Node:
    return call("coalesce", *[date_node(c, f) for f in formats])


def std_date(c: Column | str, formats: Iterable[str] = DATE_FORMATS) -> Column:
    """The date under the first format that fits, else NULL."""
    return std_date_node(c, formats).column()


def amount_node(c: Column | str, precision: int = 10, scale: int = 2) -> Node:
    return Cast(node(c), f"decimal({precision},{scale})", attempt=True)


def amount(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """``decimal(precision, scale)``, rounded half up; NULL if unreadable or too large."""
    return amount_node(c, precision, scale).column()


def parse_amounts(df: DataFrame, cols: Iterable[str], precision: int = 10, scale: int = 2) -> DataFrame:
    """Text amounts replaced by decimals, once; :func:`amount` of such a column costs nothing."""
    return df.withColumns({c: amount(c, precision, scale) for c in cols})


def total_node(cols: Iterable[Column | str], precision: int = 10, scale: int = 2) -> Node:
    zero = Cast(Value(0), f"decimal({precision},{scale})")
    parts = [call("coalesce", amount_node(c, precision, scale), zero) for c in cols]
    return Cast(reduce(lambda a, b: Infix("+", a, b), parts), f"decimal({precision + 2},{scale})")


def total(cols: Iterable[Column | str], precision: int = 10, scale: int = 2) -> Column:
    """Sum of the readable components; a missing or unreadable one counts as zero.

    Two digits wider than the components, so that up to a hundred of them always fit.
    """
    return total_node(cols, precision, scale).column()


def any_negative_node(cols: Iterable[Column | str], precision: int = 10, scale: int = 2) -> Node:
    tests = [call("coalesce", Infix("<", amount_node(c, precision, scale), Value(0)), False) for c in cols]
    return reduce(lambda a, b: Infix("OR", a, b), tests)


def any_negative(cols: Iterable[Column | str], precision: int = 10, scale: int = 2) -> Column:
    """True if a readable component is below zero; unreadable ones do not count."""
    return any_negative_node(cols, precision, scale).column()
