"""Streaming sinks. Every micro-batch can be replayed and leaves the same rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, types as T
from pyspark.sql.streaming import StreamingQuery

from tabletransfer.operators.conform import conform
from tabletransfer.operators.distribution import BY_KEY, Distribution, parse_distribution, spread
from tabletransfer.plans.schema import column_ddl
from tabletransfer.plans.scripts import run_undo, write_transfer
from tabletransfer.session import unique_name
from tabletransfer.sinks.catalog import DISTRIBUTION, OWNED, TableInfo, WriteMetrics, new_location, table_info, write_metrics
from tabletransfer.sinks.tables import OVERWRITE, write_table
from tabletransfer.sources.targets import Target, quote, resolve_table, table_exists
from tabletransfer.streaming.epochs import Update, keeping_log
from tabletransfer.streaming.merge import merge_epoch, merge_table

EPOCH_COLUMN = "batch_id"

#: Stores a micro-batch; what it returns, if it does, goes into the epoch log.
EpochSink = Callable[[DataFrame, int], WriteMetrics | None]

#: Parts of a table of merges, if the caller gives no number; choose it so that a part is some hundred MB.
DEFAULT_BUCKETS = 32

_OUTPUT_MODES = ("append", "update", "complete")


def _create_epoch_table(df: DataFrame, target: Target, dist: Distribution | None,
                        partition_by: Sequence[str]) -> None:
    """An empty table like ``df``, partitioned by the batch number and then by ``partition_by``."""
    spark = df.sparkSession
    path = new_location(spark, target)
    buckets = ""
    if dist and dist.kind == BY_KEY:
        names = ", ".join(quote(c) for c in dist.columns)
        buckets = f"CLUSTERED BY ({names}) INTO {spark.conf.get('spark.sql.shuffle.partitions')} BUCKETS "
    kind = f", '{DISTRIBUTION}' = '{dist.kind}'" if dist else ""
    parts = ", ".join([EPOCH_COLUMN, *[quote(c) for c in partition_by]])
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {target.sql_name} ({column_ddl(df.schema)}, {EPOCH_COLUMN} BIGINT) "
        f"USING parquet PARTITIONED BY ({parts}) {buckets}LOCATION '{path}' "
        f"TBLPROPERTIES ('{OWNED}' = 'true'{kind})")


def epoch_table(df: DataFrame, name: str, schemas=None, dist: Distribution | None = None,
                partition_by: Sequence[str] = ()) -> tuple[Target, T.StructType]:
    """The table for micro-batches like ``df`` and its columns; created if it is missing."""
    spark = df.sparkSession
    target = resolve_table(spark, name, schemas)
    if not table_exists(spark, target):
        _create_epoch_table(df, target, dist, partition_by)
    stored = spark.table(target.sql_name).schema
    if EPOCH_COLUMN not in stored.names:
        raise ValueError(f"{target.sql_name} has no column {EPOCH_COLUMN}, so batches could not be replayed")
    return target, T.StructType([f for f in stored if f.name != EPOCH_COLUMN])


def write_epoch(df: DataFrame, target: Target, columns: T.StructType, epoch: int,
                info: TableInfo | None = None) -> WriteMetrics | None:
    """Store one micro-batch in partition ``batch_id = epoch``, replacing what is there.

    A replayed batch overwrites its own partition only, so rows are never doubled.
    """
    spark = df.sparkSession
    view = unique_name("epoch")
    info = info or table_info(spark, target.sql_name)
    further = [c for c in info.partition_columns if c != EPOCH_COLUMN]
    fitted = conform(df, columns)
    if further or info.bucket_columns:
        fitted = spread(fitted, [*further, *info.bucket_columns])
    fitted.createOrReplaceTempView(view)
    parts = ", ".join([f"{EPOCH_COLUMN} = {int(epoch)}", *[quote(c) for c in further]])
    try:
        return write_metrics(spark.sql(f"INSERT OVERWRITE {target.sql_name} PARTITION ({parts}) SELECT * FROM {view}"))
    finally:
        spark.catalog.dropTempView(view)


def table_sink(name: str, stream_mode: str = "append", schemas=None, undo=None, writers: int | None = None,
               distributed_by: str | None = None, partition_by: Sequence[str] = (), keys: Sequence[str] = (),
               order_by: str | None = None, buckets: int | None = None) -> EpochSink:
    """A sink that keeps a table: appended batches, the whole result in complete mode, or in update mode the newest
    row of each of ``keys`` (of several in a batch the one with the greatest ``order_by``), in ``buckets`` parts.

    ``writers`` limits the tasks that write a batch, and so the number of its files.
    ``distributed_by`` and ``partition_by`` shape a table that the stream creates, as in ``write_table``.
    """
    dist = parse_distribution(distributed_by)
    mode = _check_mode(stream_mode)
    if mode == "update" and not keys:
        raise ValueError("update mode needs keys= to merge by, or a script that says how")
    if mode != "update" and (keys or order_by or buckets):
        raise ValueError("keys, order_by and buckets belong to update mode")
    if mode == "update" and (dist or partition_by):
        raise ValueError("a table of merges is laid out by its keys")
    merged: list[tuple[Target, T.StructType, int]] = []
    found: list[tuple[Target, T.StructType, TableInfo]] = []

    def store(df: DataFrame, epoch: int) -> WriteMetrics | None:
        if mode == "complete":
            report = write_table(df, name, OVERWRITE, writers=writers, schemas=schemas, undo=undo,
                                 distributed_by=distributed_by, partition_by=partition_by)
            return WriteMetrics(report.rows, report.files, report.bytes)
        try:
            if mode == "update":
                if not merged:
                    merged.append(merge_table(df, name, keys, buckets or DEFAULT_BUCKETS, schemas))
                target, columns, parts = merged[0]
                return merge_epoch(df, target, columns, keys, parts, order_by)
            if EPOCH_COLUMN in df.columns:
                df = df.drop(EPOCH_COLUMN)
            if not found:
                target, columns = epoch_table(df, name, schemas, dist, partition_by)
                found.append((target, columns, table_info(df.sparkSession, target.sql_name)))
            target, columns, info = found[0]
            return write_epoch(df.repartition(writers) if writers else df, target, columns, epoch, info)
        except Exception as error:
            run_undo(df.sparkSession, undo, error)
            raise

    return store


def script_sink(script: str, stream_mode: str = "append", undo=None) -> EpochSink:
    """A sink that runs a write script per micro-batch, with its number and the output mode.

    The script must give the same result when it is run twice for one number.
    """
    mode = _check_mode(stream_mode).capitalize()

    def store(df: DataFrame, epoch: int) -> WriteMetrics | None:
        return write_metrics(write_transfer(df, script, epoch=epoch, stream_mode=mode, undo=undo))

    return store


def _check_mode(mode: str) -> str:
    if mode.lower() not in _OUTPUT_MODES:
        raise ValueError(f"output mode must be one of {_OUTPUT_MODES}, not {mode!r}")
    return mode.lower()


def start(df: DataFrame, sink: EpochSink, checkpoint: str, stream_mode: str = "append",
          query_name: str | None = None, available_now: bool = False,
          processing_time: str | None = None) -> StreamingQuery:
    """Start a streaming DataFrame into a sink."""
    writer = (df.writeStream.outputMode(_check_mode(stream_mode)).foreachBatch(sink)
              .option("checkpointLocation", checkpoint))
    if query_name:
        writer = writer.queryName(query_name)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


def write_stream(
    df: DataFrame,
    checkpoint: str,
    name: str | None = None,
    script: str | None = None,
    stream_mode: str = "append",
    schemas=None,
    undo=None,
    writers: int | None = None,
    query_name: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
    offset_update: Update = None,
    autocommit: bool = True,
    keys: Sequence[str] = (),
    order_by: str | None = None,
    buckets: int | None = None,
) -> StreamingQuery:
    """Stream into a table (``name``) or through a script (``script``).

    After an epoch is stored, ``offset_update`` gets its end position as JSON: DML with one ``?`` or a callable
    ``(spark, end)``. If it fails, so does the stream. After a restart only the update is repeated, with
    ``autocommit=False`` the whole batch. It may run twice for one position, after a crash between it and
    Spark's commit. ``epochs.epoch_log`` tells what every epoch did.
    """
    if (name is None) == (script is None):
        raise ValueError("give either name= or script=")
    sink = (table_sink(name, stream_mode, schemas, undo, writers, keys=keys, order_by=order_by, buckets=buckets) if name
            else script_sink(script, stream_mode, undo))
    sink = keeping_log(sink, checkpoint, offset_update, autocommit)
    return start(df, sink, checkpoint, stream_mode, query_name or unique_name("transfer"),
                 available_now, processing_time)
