"""Batch sources: tables, queries and files, read through Spark's own scans."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabletransfer.operators.conform import apply_schema
from tabletransfer.operators.distribution import REPLICATED, parse_distribution, spread, spread_salted
from tabletransfer.plans.filters import Predicate, split_filters
from tabletransfer.plans.schema import schema_argument
from tabletransfer.sinks.catalog import TableInfo, table_info, visible
from tabletransfer.session import path_usage
from tabletransfer.sources.targets import Target, quote, refresh_tables, resolve


#: How often a reader looks again for a table that writers replace again and again.
_ATTEMPTS = 20


def _shape(df: DataFrame, schema, columns, filters) -> DataFrame:
    """Filter, project, cast; Catalyst moves the first two into the scan."""
    rendered, residual = split_filters(filters)
    for column in [p.column() for p in rendered] + residual:
        df = df.where(column)
    if columns:
        df = df.select(*[F.col(quote(c)) for c in columns])
    if schema is not None:
        df = apply_schema(df, schema_argument(df.sparkSession, schema))
    return df


def read_table(
    spark: SparkSession,
    name: str,
    schemas: str | Sequence[str] | None = None,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    filters: Predicate | list | None = None,
    refresh: bool = True,
) -> DataFrame:
    """Read a named table, found on the search path ``schemas``.

    Spark remembers a table's files per session. They are looked up again here, because
    a stream or another session may have written since; ``refresh=False`` skips that.
    A table stored as ``replicated`` is marked for broadcast, but only while its files
    are below Spark's broadcast threshold; a larger one is joined like any other.
    """
    target = resolve(spark, name, schemas)
    for attempt in range(_ATTEMPTS):
        found = visible(spark, target)
        if found is None:
            raise ValueError(f"no table {target.sql_name}")
        try:
            info = _info_or_none(spark, found)
            if info and refresh:
                spark.catalog.refreshTable(found.sql_name)
            df = spark.table(found.sql_name)
            break
        except AnalysisException:
            # A writer may have taken the name since; then the rows are elsewhere now.
            if attempt + 1 == _ATTEMPTS:
                raise
    if info and _fits_broadcast(spark, info):
        df = df.hint("broadcast")
    return _shape(df, schema, columns, filters)


def _byte_size(text: str) -> int:
    """Bytes of a Spark size setting such as ``10485760b`` or ``10MB``."""
    text = text.strip().lower().removesuffix("b")
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}
    if text and text[-1] in units:
        return int(text[:-1]) * units[text[-1]]
    return int(text)


def _info_or_none(spark: SparkSession, target: Target) -> TableInfo | None:
    """Facts about a catalog table; none for a view."""
    try:
        return table_info(spark, target.sql_name)
    except AnalysisException:
        return None


def _fits_broadcast(spark: SparkSession, info: TableInfo) -> bool:
    if info.distribution != REPLICATED or not info.location:
        return False
    limit = _byte_size(spark.conf.get("spark.sql.autoBroadcastJoinThreshold"))
    return limit > 0 and path_usage(spark, info.location)[1] <= limit


def read_query(
    spark: SparkSession,
    query: str,
    schema: T.StructType | str | None = None,
    columns: Sequence[str] | None = None,
    filters: Predicate | list | None = None,
) -> DataFrame:
    """Any SELECT as a source."""
    refresh_tables(spark, query)
    return _shape(spark.sql(query), schema, columns, filters)


def read(spark: SparkSession, source: str, schemas=None, **kwargs) -> DataFrame:
    """A table name or a SELECT, told apart by its text."""
    if resolve(spark, source, schemas).is_query:
        return read_query(spark, source, **kwargs)
    return read_table(spark, source, schemas, **kwargs)


def _node_kinds(node) -> Iterator[str]:
    """Class names of a plan's nodes; names of columns and tables play no part."""
    yield node.getClass().getSimpleName()
    children = node.children()
    for i in range(children.size()):
        yield from _node_kinds(children.apply(i))


def read_parallel(df: DataFrame, n: int, by: Sequence[str] = ()) -> DataFrame:
    """Make sure that at least ``n`` tasks work on ``df``.

    A bare scan that has ``n`` file splits already stays as it is: nothing is shuffled.
    Everything else is spread over ``n`` tasks, evenly or on ``by``, where a hot key is split by the tasks
    it comes from. No job is run to find out.
    """
    if n < 1:
        raise ValueError("n must be at least 1")
    execution = df._jdf.queryExecution()
    shuffles = any(word in kind for kind in _node_kinds(execution.sparkPlan())
                   for word in ("Exchange", "Aggregate", "Join", "Window", "Sort", "Limit"))
    if not shuffles and execution.toRdd().getNumPartitions() >= n:
        return df
    return spread_salted(df, by, n) if by else df.repartition(n)


def read_distributed(
    spark: SparkSession,
    name: str,
    distributed_by: str | None = None,
    n: int | None = None,
    schemas=None,
) -> DataFrame:
    """Read a table in its own distribution, or in the one the caller names.

    Rows that are bucketed on the wanted columns already are not shuffled again.
    Otherwise they are spread so that a hot key is split over several tasks.
    """
    target = resolve(spark, name, schemas)
    df = read_table(spark, name, schemas)
    wanted = parse_distribution(distributed_by)
    if wanted is None or wanted.kind == REPLICATED:
        return df
    if wanted.columns:
        stored = _info_or_none(spark, target)
        if stored and list(wanted.columns) == stored.bucket_columns and n in (None, stored.num_buckets):
            return df
    return spread(df, wanted.columns, n)
