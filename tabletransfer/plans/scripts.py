"""Transfer scripts: SQL text with tags, run by Spark on the way in or out.

A read script inserts into ``<ext_table>`` and what it inserts is the result::

    INSERT INTO <ext_table> (k, total)
    SELECT o_custkey, sum(o_totalprice) FROM orders WHERE <pushed_filters> GROUP BY 1

A write script selects from ``<ext_table>``, which is the incoming DataFrame. Both
may also be a ``BEGIN … END`` block of Spark SQL scripting.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabletransfer.operators.conform import apply_schema
from tabletransfer.plans.filters import filter_sql, split_filters
from tabletransfer.plans.schema import column_ddl, schema_argument, select_list
from tabletransfer.session import delete_path, scratch_path, unique_name
from tabletransfer.sources.targets import quote, refresh_tables

# The tags a script may contain, in any letter case.
TAGS = (
    "ext_table",
    "select_colList",
    "pushed_filters",
    "current_epoch",
    "stream_mode",
    "start_offset_json",
    "end_offset_json",
)

UNSET_OFFSET = "[null]"

_TAG = re.compile("<(" + "|".join(TAGS) + ")>", re.IGNORECASE)
_INSERT = re.compile(
    r"\s*INSERT\s+INTO\s+(?:TABLE\s+)?<ext_table>\s*(?:\((?P<cols>[^()]*)\)\s*)?"
    r"(?P<body>(?:SELECT|WITH|VALUES|FROM|TABLE)\b.*?|\(\s*SELECT\b.*?);?\s*",
    re.IGNORECASE | re.DOTALL,
)


def fill_tags(script: str, **values: str) -> str:
    """Replace all tags in one pass, so that substituted text is never read again."""
    known = {k.lower(): v for k, v in values.items() if v is not None}

    def value_of(match: re.Match) -> str:
        tag = match.group(1).lower()
        if tag not in known:
            raise ValueError(f"the script uses <{match.group(1)}>, which has no value here")
        return str(known[tag])

    return _TAG.sub(value_of, script)


def uses_tag(script: str, tag: str) -> bool:
    return any(m.group(1).lower() == tag.lower() for m in _TAG.finditer(script))


def json_text(value: str | None) -> str:
    """An offset for use between single quotes in a script."""
    text = UNSET_OFFSET if value is None else value
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _insert_statement(script: str) -> tuple[list[str] | None, str] | None:
    """(columns, query) when the script is one ``INSERT INTO <ext_table> query``."""
    match = _INSERT.fullmatch(script)
    if not match:
        return None
    cols = match["cols"]
    names = [c.strip().strip("`\"") for c in cols.split(",")] if cols else None
    return names, match["body"]


def _name_columns(df: DataFrame, names: list[str] | None, schema: T.StructType | None) -> DataFrame:
    """Apply the insert's column list; columns it leaves out become null."""
    if names is None:
        return df if schema is None else apply_schema(df, schema)
    if len(names) != len(df.columns):
        raise ValueError(f"the insert names {len(names)} columns but selects {len(df.columns)}")
    df = df.toDF(*names)
    if schema is None:
        return df
    have = {n.lower() for n in names}
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema if f.name.lower() not in have]
    return apply_schema(df.select("*", *missing), schema)


def read_transfer(
    spark: SparkSession,
    script: str,
    schema: T.StructType | str | None = None,
    filters=None,
    epoch: int | None = None,
    start_offset: str | None = None,
    end_offset: str | None = None,
) -> DataFrame:
    """Run a read script and return what it puts into ``<ext_table>``.

    ``schema`` is a ``StructType``, DDL text, a table name or a query whose columns
    describe the result. ``filters`` are Predicates (rendered into
    ``<pushed_filters>``) or Columns; both are also applied to the result, so a
    script without the tag still gives the filtered rows.

    A script that is one INSERT … SELECT becomes a lazy DataFrame of its SELECT:
    nothing is staged, and Catalyst pushes later filters and projections through it.
    A ``BEGIN … END`` block is run at once and its rows are kept in a table in the
    shared folder, so it needs ``schema``.
    """
    refresh_tables(spark, script)
    out_schema = schema_argument(spark, schema)
    rendered, residual = split_filters(filters)
    values = {
        "pushed_filters": filter_sql(rendered),
        "current_epoch": None if epoch is None else str(epoch),
        "select_colList": None if out_schema is None else select_list(out_schema),
        "start_offset_json": json_text(start_offset),
        "end_offset_json": json_text(end_offset),
    }
    single = _insert_statement(script)
    if single:
        names, body = single
        result = _name_columns(spark.sql(fill_tags(body, **values)), names, out_schema)
    else:
        result = _run_into_table(spark, script, out_schema, values)
    have = {c.lower() for c in result.columns}
    for predicate in rendered:
        if {a.lower() for a in predicate.attributes()} <= have:
            result = result.where(predicate.column())
    for column in residual:
        result = result.where(column)
    return result


def _run_into_table(spark: SparkSession, script: str, schema: T.StructType | None, values: dict) -> DataFrame:
    if schema is None:
        raise ValueError("a procedural script needs schema= for its <ext_table>")
    if not uses_tag(script, "ext_table"):
        raise ValueError("the script puts nothing into <ext_table>")
    name = unique_name("ext")
    path = scratch_path(spark, "ext")
    spark.sql(f"CREATE TABLE {name} ({column_ddl(schema)}) USING parquet LOCATION '{path}'")
    try:
        spark.sql(fill_tags(script, ext_table=name, **values))
        spark.catalog.refreshTable(name)
    except Exception:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        delete_path(spark, path)
        raise
    spark.sql(f"DROP TABLE {name}")  # the catalog entry only; the rows stay at `path`
    return spark.read.schema(schema).parquet(path)


def write_transfer(
    df: DataFrame,
    script: str,
    epoch: int | None = None,
    stream_mode: str | None = None,
    undo=None,
) -> DataFrame:
    """Run a write script with ``df`` as ``<ext_table>``; returns the script's own result.

    The script decides what to store where. One statement is all-or-nothing, because
    Spark commits a job's files at its end; a block of several statements is not one
    transaction, so make it repeatable or give ``undo`` (SQL text or a callable).
    """
    spark = df.sparkSession
    refresh_tables(spark, script)
    view = unique_name("ext")
    df.createOrReplaceTempView(view)
    try:
        return spark.sql(
            fill_tags(
                script,
                ext_table=quote(view),
                select_colList=select_list(df.schema),
                pushed_filters="true",
                current_epoch=None if epoch is None else str(epoch),
                stream_mode=stream_mode,
            )
        )
    except Exception as error:
        run_undo(spark, undo, error)
        raise
    finally:
        spark.catalog.dropTempView(view)


def run_undo(spark: SparkSession, undo, error: Exception) -> None:
    """Best effort to undo side effects: SQL text or a callable without arguments.

    A failure here is added to ``error``, which the caller raises.
    """
    if undo is None:
        return
    try:
        if callable(undo):
            undo()
        else:
            spark.sql(undo)
    except Exception as failure:
        error.add_note(f"undo failed as well: {failure}")
