"""Filter trees that render as SQL text for a script or as a Column for Spark.

Build trees with the functions below and combine them with ``&``, ``|`` and ``~``::

    f = (gt("o_totalprice", 1000) | is_null("o_custkey")) & ~starts_with("o_orderpriority", "1")
    f.sql()      # text for the <pushed_filters> tag
    f.column()   # Column for DataFrame.where; Spark pushes it to the scan
"""

from __future__ import annotations

import datetime as dt
import math
import re
from dataclasses import dataclass
from decimal import Decimal
from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F

_COMPARE = {"eq": "=", "gt": ">", "ge": ">=", "lt": "<", "le": "<="}
_LIKE = {"starts_with": ("", "%"), "ends_with": ("%", ""), "contains": ("%", "%")}
_SPARK_MATCH = {"starts_with": "startswith", "ends_with": "endswith", "contains": "contains"}


def spark_string(text: str) -> str:
    """A Spark SQL string literal, safe for quotes and backslashes."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


_NAME_PART = re.compile(r'"(?P<dq>(?:[^"]|"")+)"|`(?P<bq>(?:[^`]|``)+)`|(?P<plain>[^."`][^.]*)')


def name_parts(name: str) -> list[str]:
    """Parts of a possibly dotted name; a part in double quotes or back-ticks may hold dots and is taken as it is."""
    parts, at = [], 0
    while True:
        match = _NAME_PART.match(name, at)
        if not match:
            raise ValueError(f"not a column name: {name!r}")
        if match["dq"] is not None:
            parts.append(match["dq"].replace('""', '"'))
        elif match["bq"] is not None:
            parts.append(match["bq"].replace("``", "`"))
        else:
            parts.append(match["plain"])
        at = match.end()
        if at == len(name):
            return parts
        if name[at] != ".":
            raise ValueError(f"not a column name: {name!r}")
        at += 1


def identifier(name: str, dialect: str = "spark") -> str:
    """Quote a possibly dotted name in the way of the dialect, one part at a time."""
    if dialect == "spark":
        return ".".join("`" + p.replace("`", "``") + "`" for p in name_parts(name))
    return ".".join('"' + p.replace('"', '""') + '"' for p in name_parts(name))


def literal(value: Any, dialect: str = "spark") -> str:
    """Render a Python value as a typed SQL literal."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return "TRUE" if value else "FALSE"
    if isinstance(value, str):
        return spark_string(value) if dialect == "spark" else "'" + value.replace("'", "''") + "'"
    if isinstance(value, dt.datetime):
        if value.tzinfo is not None:
            utc = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
            if dialect == "spark":
                return f"TIMESTAMP_LTZ '{utc.isoformat(sep=' ', timespec='microseconds')} UTC'"
            return f"TIMESTAMPTZ '{utc.isoformat(sep=' ', timespec='microseconds')}+00:00'"
        kind = "TIMESTAMP_NTZ" if dialect == "spark" else "TIMESTAMP"
        return f"{kind} '{value.isoformat(sep=' ', timespec='microseconds')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (bytes, bytearray)):
        return f"X'{bytes(value).hex().upper()}'"
    if isinstance(value, Decimal):
        return format(value, "f")
    if isinstance(value, float):
        if not math.isfinite(value):
            return f"CAST('{value}' AS DOUBLE)"
        return f"CAST('{value!r}' AS DOUBLE)"
    if isinstance(value, int):
        return str(value)
    raise TypeError(f"no SQL literal for {type(value).__name__}")


@dataclass(frozen=True)
class Predicate:
    op: str
    attr: str | None = None
    value: Any = None
    parts: tuple[Predicate, ...] = ()

    def __and__(self, other: Predicate) -> Predicate:
        return Predicate("and", parts=(self, other))

    def __or__(self, other: Predicate) -> Predicate:
        return Predicate("or", parts=(self, other))

    def __invert__(self) -> Predicate:
        return Predicate("not", parts=(self,))

    def attributes(self) -> set[str]:
        """Names of all columns the tree reads."""
        own = {self.attr} if self.attr else set()
        return own.union(*(p.attributes() for p in self.parts))

    def sql(self, dialect: str = "spark") -> str:
        """SQL text; every compound is in parentheses, so it can be put anywhere.

        ``dialect`` is ``"spark"`` or ``"ansi"`` (for an external database).
        """
        if self.op in ("and", "or"):
            return "(" + f" {self.op.upper()} ".join(p.sql(dialect) for p in self.parts) + ")"
        if self.op == "not":
            return f"(NOT {self.parts[0].sql(dialect)})"
        name = identifier(self.attr, dialect)
        if self.op in _COMPARE:
            return f"({name} {_COMPARE[self.op]} {literal(self.value, dialect)})"
        if self.op == "is_null":
            return f"({name} IS NULL)"
        if self.op == "is_not_null":
            return f"({name} IS NOT NULL)"
        if self.op == "in":
            if not self.value:
                return "(1 = 0)"
            return f"({name} IN ({', '.join(literal(v, dialect) for v in self.value)}))"
        if dialect == "spark":
            return f"({_SPARK_MATCH[self.op]}({name}, {literal(self.value)}))"
        before, after = _LIKE[self.op]
        pattern = self.value
        for special in "!%_":
            pattern = pattern.replace(special, "!" + special)
        return f"({name} LIKE {literal(before + pattern + after, dialect)} ESCAPE '!')"

    def column(self) -> Column:
        """The same condition as a Column."""
        if self.op == "and":
            return reduce(lambda a, b: a & b, (p.column() for p in self.parts))
        if self.op == "or":
            return reduce(lambda a, b: a | b, (p.column() for p in self.parts))
        if self.op == "not":
            return ~self.parts[0].column()
        col = F.col(identifier(self.attr))
        if self.op == "is_null":
            return col.isNull()
        if self.op == "is_not_null":
            return col.isNotNull()
        if self.op == "in":
            return col.isin(*self.value) if self.value else F.lit(False)
        if self.op in _SPARK_MATCH:
            return getattr(col, _SPARK_MATCH[self.op])(self.value)
        value = F.expr(literal(self.value))
        return {
            "eq": col == value,
            "gt": col > value,
            "ge": col >= value,
            "lt": col < value,
            "le": col <= value,
        }[self.op]


def eq(attr: str, value: Any) -> Predicate:
    return Predicate("eq", attr, value)


def gt(attr: str, value: Any) -> Predicate:
    return Predicate("gt", attr, value)


def ge(attr: str, value: Any) -> Predicate:
    return Predicate("ge", attr, value)


def lt(attr: str, value: Any) -> Predicate:
    return Predicate("lt", attr, value)


def le(attr: str, value: Any) -> Predicate:
    return Predicate("le", attr, value)


def is_null(attr: str) -> Predicate:
    return Predicate("is_null", attr)


def is_not_null(attr: str) -> Predicate:
    return Predicate("is_not_null", attr)


def is_in(attr: str, *values: Any) -> Predicate:
    return Predicate("in", attr, tuple(values))


def starts_with(attr: str, text: str) -> Predicate:
    return Predicate("starts_with", attr, text)


def ends_with(attr: str, text: str) -> Predicate:
    return Predicate("ends_with", attr, text)


def contains(attr: str, text: str) -> Predicate:
    return Predicate("contains", attr, text)


def filter_sql(filters: Predicate | list[Predicate] | tuple[Predicate, ...] | None,
               dialect: str = "spark") -> str:
    """Text for ``<pushed_filters>``: a conjunction, or ``true`` when there is none."""
    if filters is None:
        return "true"
    if isinstance(filters, Predicate):
        return filters.sql(dialect)
    return " AND ".join(p.sql(dialect) for p in filters) or "true"


def split_filters(filters) -> tuple[list[Predicate], list[Column]]:
    """Separate what can be rendered as text from plain Columns, which Spark evaluates."""
    if filters is None:
        return [], []
    items = filters if isinstance(filters, (list, tuple)) else [filters]
    rendered = [f for f in items if isinstance(f, Predicate)]
    residual = [f for f in items if not isinstance(f, Predicate)]
    return rendered, residual
