"""Expressions written once and rendered both as a Column and as SQL text."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


class Node:
    """A part of an expression."""

    def column(self) -> Column:
        raise NotImplementedError

    def sql(self) -> str:
        raise NotImplementedError


@dataclass(frozen=True)
class Name(Node):
    """A column, or a parameter of a SQL function, by name."""

    name: str

    def column(self) -> Column:
        return F.col(self.name)

    def sql(self) -> str:
        return f"`{self.name}`"


@dataclass(frozen=True)
class Given(Node):
    """A column that is no name; it has no SQL text."""

    value: Column

    def column(self) -> Column:
        return self.value

    def sql(self) -> str:
        raise ValueError("a rule offered to SQL takes its columns by name")


@dataclass(frozen=True)
class Value(Node):
    value: str | int | bool | None

    def column(self) -> Column:
        return F.lit(self.value)

    def sql(self) -> str:
        if isinstance(self.value, str):
            escaped = self.value.replace("\\", "\\\\").replace("'", "\\'")
            return f"'{escaped}'"
        return "NULL" if self.value is None else str(self.value).upper()


@dataclass(frozen=True)
class Call(Node):
    """A built-in function."""

    function: str
    arguments: tuple[Node, ...]

    def column(self) -> Column:
        return F.call_function(self.function, *[a.column() for a in self.arguments])

    def sql(self) -> str:
        return f"{self.function}({', '.join(a.sql() for a in self.arguments)})"


_OPERATORS: dict[str, Callable[[Column, Column], Column]] = {
    "=": lambda a, b: a == b,
    "<": lambda a, b: a < b,
    "+": lambda a, b: a + b,
    "OR": lambda a, b: a | b,
}


@dataclass(frozen=True)
class Infix(Node):
    """Two parts with an operator between them."""

    operator: str
    left: Node
    right: Node

    def column(self) -> Column:
        return _OPERATORS[self.operator](self.left.column(), self.right.column())

    def sql(self) -> str:
        return f"({self.left.sql()} {self.operator} {self.right.sql()})"


@dataclass(frozen=True)
class Cast(Node):
    part: Node
    kind: str
    attempt: bool = False  # NULL instead of an error

    def column(self) -> Column:
        part = self.part.column()
        return part.try_cast(self.kind) if self.attempt else part.cast(self.kind)

    def sql(self) -> str:
        return f"{'try_cast' if self.attempt else 'cast'}({self.part.sql()} AS {self.kind})"


def node(c: Column | str | Node) -> Node:
    """A name, a column or a part as a part."""
    if isinstance(c, Node):
        return c
    return Name(c) if isinstance(c, str) else Given(c)


def call(function: str, *arguments: Node | str | int | bool | None) -> Call:
    """A function call; arguments that are no parts are values."""
    return Call(function, tuple(a if isinstance(a, Node) else Value(a) for a in arguments))
