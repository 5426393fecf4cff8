"""Text clean-up and "missing" tests. Trimming strips spaces only, not tabs."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.functions.tree import Infix, Node, Value, call, node

# Text that stands for NULL in the delivered files.
NULL_TOKENS = ("NULL", "null", "")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_node(c: Column | str) -> Node:
    part = node(c)
    return Infix("OR", call("isnull", part), Infix("=", call("trim", part), Value("")))


def missing(c: Column | str) -> Column:
    """True for NULL and for text that is empty after trimming; never NULL itself."""
    return missing_node(c).column()


def present(c: Column | str) -> Column:
    """The exact opposite of :func:`missing`."""
    c = _col(c)
    return c.isNotNull() & (F.trim(c) != "")


def null_tokens(c: Column | str, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Trim, then turn any of the null tokens into a real NULL."""
    text = F.trim(_col(c))
    return F.when(~text.isin(*tokens), text)


def trim_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Trim the named columns in place, in one projection."""
    return df.withColumns({c: F.trim(F.col(c)) for c in cols})
