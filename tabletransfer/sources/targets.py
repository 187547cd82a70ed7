"""What a source or sink argument means: a table name or a query, and where it lives."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession

DEFAULT_SCHEMA = "default"

_QUERY = re.compile(r"\s*(select|with)\s+\S", re.IGNORECASE)
_PART = r'(?:"[^"]+"|`[^`]+`|\w+)'
_NAME = re.compile(rf"\s*(?:(?P<schema>{_PART})\s*\.\s*)?(?P<table>{_PART})\s*")


def _bare(part: str | None) -> str | None:
    if part and part[0] in '"`':
        return part[1:-1]
    return part


def quote(part: str) -> str:
    """Back-tick one identifier part."""
    return "`" + part.replace("`", "``") + "`"


_FROM = re.compile(rf"\b(?:FROM|JOIN)\s+((?:`[^`]+`|\w+)(?:\.(?:`[^`]+`|\w+))*)(?!\s*\()", re.IGNORECASE)


@dataclass(frozen=True)
class Target:
    """Either a query, or a table with an optional schema."""

    text: str
    is_query: bool
    schema: str | None = None
    table: str | None = None

    @property
    def sql_name(self) -> str:
        if self.is_query:
            raise ValueError(f"not a table name: {self.text}")
        return ".".join(quote(p) for p in (self.schema, self.table) if p)

    def in_schema(self, default: str | None) -> Target:
        """The same table, placed in ``default`` unless it names its own schema."""
        if self.is_query or self.schema or not default:
            return self
        return Target(self.text, False, default, self.table)


def parse_target(text: str) -> Target:
    """Tell ``select …`` (any case) from ``tbl``, ``ns.tbl`` and quoted names."""
    if _QUERY.match(text):
        return Target(text, True)
    m = _NAME.fullmatch(text)
    if not m:
        raise ValueError(f"neither a table name nor a select: {text!r}")
    return Target(text, False, _bare(m["schema"]), _bare(m["table"]))


def search_path(schemas: str | Sequence[str] | None) -> list[str]:
    """Split a comma-separated list; the default schema closes the path."""
    if not schemas:
        return []
    parts = schemas.split(",") if isinstance(schemas, str) else list(schemas)
    path = [_bare(p.strip()) for p in parts if p.strip()]
    if DEFAULT_SCHEMA not in path:
        path.append(DEFAULT_SCHEMA)
    return path


def named_tables(sql: str) -> list[str]:
    """Names that follow FROM or JOIN in a text; some may be no tables."""
    return list(dict.fromkeys(_FROM.findall(sql)))


def refresh_tables(spark: SparkSession, *texts: str | None) -> None:
    """Look up again the files of the tables that SQL texts read.

    Spark remembers them per session and would miss what others wrote since.
    """
    for name in dict.fromkeys(n for text in texts if text for n in named_tables(text)):
        try:
            spark.catalog.refreshTable(name)
        except AnalysisException:  # a name inside the text, a function, a word
            continue


def table_exists(spark: SparkSession, name: str | Target) -> bool:
    target = parse_target(name) if isinstance(name, str) else name
    if target.is_query:
        return False
    if target.schema and not spark.catalog.databaseExists(target.schema):
        return False
    return spark.catalog.tableExists(target.sql_name)


def resolve_table(spark: SparkSession, name: str, schemas: str | Sequence[str] | None = None) -> Target:
    """The table to write: always in a schema, so a temporary view of that name is no match."""
    target = resolve(spark, name, schemas)
    if target.is_query:
        raise ValueError(f"cannot write to a query: {name}")
    return target.in_schema(spark.catalog.currentDatabase())


def resolve(spark: SparkSession, name: str, schemas: str | Sequence[str] | None = None) -> Target:
    """Find ``name`` on the search path; the first hit wins.

    The first schema of the path is created if it is missing, and it is where a
    table that exists nowhere yet will be created.
    """
    target = parse_target(name)
    path = search_path(schemas)
    if target.is_query or target.schema or not path:
        return target
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(path[0])}")
    for schema in path:
        candidate = target.in_schema(schema)
        if table_exists(spark, candidate):
            return candidate
    return target.in_schema(path[0])
