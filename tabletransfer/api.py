"""One entry point per direction, driven by an option map.

``load`` and ``save`` move a table, a query or a script's rows in batch; ``stream``
connects a source and a sink. Without ``url`` both ends are Spark tables; with ``url``
the end is an external database.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabletransfer.operators.conform import apply_schema
from tabletransfer.options import OPTION_NAMES, TransferOptions
from tabletransfer.plans.schema import schema_argument
from tabletransfer.plans.scripts import read_transfer, write_transfer
from tabletransfer.sinks.tables import WriteReport, save_mode, write_table
from tabletransfer.sources.jdbc import read_jdbc, write_jdbc
from tabletransfer.sources.tables import read, read_distributed
from tabletransfer.sources.targets import quote, search_path
from tabletransfer.streaming.ledger import LATEST, script_source, stream_transfer
from tabletransfer.streaming.sink import EpochSink, script_sink, table_sink

Options = TransferOptions | Mapping[str, object]

_PARTITION_CLAUSE = re.compile(r"\s*(?:partition(?:ed)?\s+by\s*\((?P<inner>[^()]*)\)|(?P<plain>[^()]*))\s*", re.IGNORECASE)


def _options(options: Options) -> TransferOptions:
    return options if isinstance(options, TransferOptions) else TransferOptions.from_dict(options)


def partition_columns(clause: str | None) -> list[str]:
    """Column names of ``a, b`` or ``PARTITION BY (a, b)``."""
    if not clause or not clause.strip():
        return []
    match = _PARTITION_CLAUSE.fullmatch(clause)
    if not match:
        raise ValueError(f"not a list of partition columns: {clause!r}")
    return [c.strip().strip('"`') for c in (match["inner"] or match["plain"]).split(",") if c.strip()]


@contextmanager
def _schema_of(spark: SparkSession, options: TransferOptions) -> Iterator[None]:
    """Make the first schema of the search path current while a script is analysed."""
    path = search_path(options.schemas)
    if not path:
        yield
        return
    before = spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(path[0])}")
    spark.catalog.setCurrentDatabase(path[0])
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


def _refuse(options: TransferOptions, place: str, *names: str) -> None:
    """An option that has no effect here is an error, not silence."""
    for name in names:
        if getattr(options, name) not in (None, False):
            option = next(k for k, v in OPTION_NAMES.items() if v == name)
            raise ValueError(f"option {option!r} has no effect on {place}")


def load(spark: SparkSession, options: Options, schema=None, filters=None) -> DataFrame:
    """Read ``dbtable`` (a name or a SELECT) or the rows of ``sqltransfer``.

    With a script, ``dbtable`` or ``schema`` describes its result columns. With ``distributedby`` the rows of
    a table come in that distribution.
    """
    o = _options(options)
    _refuse(o, "a read between Spark tables, whose times have no other zone; the text codec takes tz", "tz")
    _refuse(o, "a read", "truncate", "undo")
    if o.url or o.script:
        _refuse(o, "a read of an external table or of a script", "distributed_by")
    if o.url:
        if o.script:
            raise ValueError("a script runs on Spark tables; read the external table first")
        df = read_jdbc(spark, o)
        return df if filters is None else df.where(filters.column() if hasattr(filters, "column") else filters)
    if o.script:
        with _schema_of(spark, o):
            return read_transfer(spark, o.script, schema or o.table, filters)
    if o.distributed_by:
        spread_rows = read_distributed(spark, o.table, o.distributed_by, schemas=o.schemas)
        if filters is not None:
            spread_rows = spread_rows.where(filters.column() if hasattr(filters, "column") else filters)
        return spread_rows if schema is None else apply_schema(spread_rows, schema_argument(spark, schema))
    return read(spark, o.table, o.schemas, schema=schema, filters=filters)


def save(df: DataFrame, options: Options, mode: str | None = None) -> WriteReport | None:
    """Write to ``dbtable``, or feed ``sqltransfer``. ``mode`` is required for a table."""
    o = _options(options)
    _refuse(o, "a write between Spark tables, whose times have no other zone; the text codec takes tz", "tz")
    if o.url:
        _refuse(o, "a write into an external table", "undo", "distributed_by", "partition_by")
        write_jdbc(df, o, mode)
        return None
    if o.script:
        _refuse(o, "a write by a script, which creates its tables itself", "distributed_by", "partition_by", "truncate", "mode")
        with _schema_of(df.sparkSession, o):
            write_transfer(df, o.script, undo=o.undo)
        return None
    return write_table(
        df, o.table, save_mode(mode or o.mode), truncate=o.truncate, distributed_by=o.distributed_by,
        partition_by=partition_columns(o.partition_by), schemas=o.schemas, undo=o.undo)


def _sink(options: TransferOptions, stream_mode: str) -> EpochSink:
    _refuse(options, "a stream, which appends or, in complete mode, replaces", "truncate", "tz")
    if options.script:
        _refuse(options, "a script, which creates its tables itself", "distributed_by", "partition_by", "mode")
        return script_sink(options.script, stream_mode, options.undo)
    if options.mode not in (None, "append"):
        raise ValueError(f"option 'mode' of a stream can only be append, not {options.mode!r}")
    return table_sink(options.table, stream_mode, options.schemas, options.undo,
                      distributed_by=options.distributed_by, partition_by=partition_columns(options.partition_by))


def stream(
    spark: SparkSession,
    source: Options,
    sink: Options,
    transform: Callable[[DataFrame, int], DataFrame] | None = None,
    checkpoint: str | None = None,
    schema=None,
    starting: str = LATEST,
    stream_mode: str = "append",
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Move micro-batches from a source to a sink, both given as options.

    The source needs ``sqltransfer`` with offset tags and ``offset.select``; its
    ``dbtable`` or ``schema`` describes the rows. ``transform(rows, epoch)`` may change
    each micro-batch on its way.
    """
    src, dst = _options(source), _options(sink)
    folder = checkpoint or dst.checkpoint or src.checkpoint
    if not folder:
        raise ValueError("option 'checkpointLocation' is required for a stream")
    if src.url or dst.url:
        raise ValueError("both ends of a stream are Spark tables; write_jdbc can be called from a sink of your own")
    if not src.script:
        raise ValueError("option 'sqltransfer' is required for a stream source")
    rows = script_source(src.script, schema or src.table)
    store = _sink(dst, stream_mode)

    def changed(session: SparkSession, start: str | None, end: str, epoch: int) -> DataFrame:
        with _schema_of(session, src):
            df = rows(session, start, end, epoch)
        return transform(df, epoch) if transform else df

    return stream_transfer(
        spark, changed, store, folder, src.offset_select, src.offset_update, starting,
        autocommit=src.autocommit, query_name=dst.query_name, available_now=available_now,
        processing_time=processing_time)
