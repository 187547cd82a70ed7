"""Streams whose position is whatever a SQL query says.

``offset_select`` returns one JSON text, the newest position. A ticking stream gives
the micro-batches; before a batch runs, its range is noted in a ledger next to the
checkpoint. A batch that is run again after a crash finds its range there and reads
the same rows again.
"""

from __future__ import annotations

import datetime as dt
import json
import time
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tabletransfer.plans.scripts import read_transfer
from tabletransfer.session import unique_name
from tabletransfer.sources.targets import refresh_tables
from tabletransfer.streaming.epochs import EpochLog, Ledger, Range, update_position
from tabletransfer.streaming.sink import EpochSink, start

LATEST, EARLIEST = "latest", "earliest"

# Fixed value: how often the position is polled when the caller sets no trigger.
DEFAULT_POLL = "100 milliseconds"

Source = Callable[[SparkSession, str | None, str, int], DataFrame]


def current_offset(spark: SparkSession, offset_select: str | None) -> str | None:
    """The newest position as JSON text; without a query, the current time."""
    if offset_select is None:
        return json.dumps({"timestamp": dt.datetime.now().isoformat(sep=" ")})
    refresh_tables(spark, offset_select)
    row = spark.sql(offset_select).head()
    return None if row is None else row[0]


def same_offset(a: str | None, b: str | None) -> bool:
    """Offsets are equal when their JSON values are."""
    if a is None or b is None:
        return a is b
    return json.loads(a) == json.loads(b)


def script_source(script: str, schema=None, filters=None) -> Source:
    """Rows of a read script that uses ``<start_offset_json>`` and ``<end_offset_json>``."""

    def rows(spark: SparkSession, start: str | None, end: str, epoch: int) -> DataFrame:
        return read_transfer(spark, script, schema, filters, epoch, start, end)

    return rows


def stream_transfer(
    spark: SparkSession,
    source: str | Source,
    sink: EpochSink,
    checkpoint: str,
    offset_select: str | None = None,
    offset_update: str | Callable[[SparkSession, str], None] | None = None,
    starting: str = LATEST,
    schema=None,
    filters=None,
    autocommit: bool = True,
    query_name: str | None = None,
    available_now: bool = False,
    processing_time: str | None = None,
) -> StreamingQuery:
    """Poll ``offset_select`` at each trigger and move the new range from source to sink.

    The source is a read script or a callable ``(spark, start, end, epoch)``. No batch
    runs while the position is unchanged. ``epoch`` counts the batches that ran, from 0,
    also over restarts. ``starting`` is ``latest`` (only what comes later), ``earliest``
    (start is ``[null]``) or a JSON position.

    After a batch is stored, ``offset_update`` gets its end position: DML with one ``?``
    or a callable. If it fails, so does the query. After a restart, with ``autocommit=False`` the
    whole batch is run again, because the update belongs to it; with ``True`` its rows count
    as stored, and only the update is repeated.
    """
    rows_of = script_source(source, schema, filters) if isinstance(source, str) else source
    ledger_path = f"{checkpoint}/ranges"
    state: dict[str, Ledger] = {}

    def first_range(session: SparkSession, tick: int) -> Range:
        if starting == LATEST:
            position = current_offset(session, offset_select)
        else:
            position = None if starting == EARLIEST else starting
        return Range(tick, -1, position, position)

    def run(tick_df: DataFrame, tick: int) -> None:
        session = tick_df.sparkSession
        ledger = state.get("ledger")
        if ledger is None:
            ledger = state["ledger"] = Ledger(session, ledger_path)
        if ledger.last is None:
            ledger.note(first_range(session, tick))
            if starting == LATEST:
                return
        entry = ledger.at(tick)
        if entry is None:
            entry = ledger.last
            end = current_offset(session, offset_select)
            if end is None or same_offset(entry.end, end):
                return
            entry = Range(tick, entry.epoch + 1, entry.end, end)
            ledger.note(entry)
        if not entry.stored:
            began = time.time()
            done = sink(rows_of(session, entry.start, entry.end, entry.epoch), entry.epoch)
            EpochLog(session, checkpoint).note(entry.epoch, began, done, entry.start, entry.end)
        try:
            update_position(session, offset_update, entry.end)
        except Exception as error:
            if not autocommit:
                raise
            ledger.note(replace(entry, stored=True))
            raise RuntimeError(f"rows up to {entry.end} are stored, but offset_update failed") from error

    ticks = spark.readStream.format("rate-micro-batch").option("rowsPerBatch", 1).load()
    return start(ticks, run, checkpoint, "append", query_name or unique_name("transfer"),
                 available_now, processing_time or DEFAULT_POLL)
