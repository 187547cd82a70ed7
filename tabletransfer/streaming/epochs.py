"""What each micro-batch did, in small files next to the checkpoint.

``epoch_log`` has a row for every epoch of a stream, however many there were. The ledger notes the range of a batch before
or after it is stored, so what belongs to a batch is done once and, after a crash, not left out.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabletransfer.session import delete_path, hadoop_path, newest_notes, read_note, write_note
from tabletransfer.sinks.catalog import WriteMetrics

Update = str | Callable[[SparkSession, str], None] | None

# The ledger keeps at least so many ranges, and more where Spark's checkpoint keeps more
# batches; older ones are overwritten in turn.
_LEAST_SLOTS = 128
_RETAINED = "spark.sql.streaming.minBatchesToRetain"

@dataclass(frozen=True)
class Range:
    """One noted batch: rows after ``start`` up to ``end``. ``epoch`` -1 is the start mark.

    ``stored`` says that the rows are in the sink and only ``offset_update`` is left to do.
    """

    tick: int
    epoch: int
    start: str | None
    end: str | None
    stored: bool | None = False


class Ledger:
    """Small files with one range each, in the checkpoint folder; a bounded number of them.

    Ranges are found by their tick, so a checkpoint that is set back by several ticks finds the
    range of each.
    """

    SCHEMA = "tick long, epoch long, start string, end string, stored boolean"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.slots = max(_LEAST_SLOTS, int(spark.conf.get(_RETAINED)) + 1)
        self.entries: dict[int, Range] = {}
        files = list(newest_notes(spark, path).values())
        if files:
            rows = spark.read.schema(self.SCHEMA).json(files).collect()
            self.entries = {entry.epoch: entry for entry in (Range(*row) for row in rows)}

    @property
    def last(self) -> Range | None:
        return self.entries[max(self.entries)] if self.entries else None

    def at(self, tick: int) -> Range | None:
        """The range that was noted for a tick, if it was a batch."""
        return next((e for e in self.entries.values() if e.tick == tick and e.epoch >= 0), None)

    def note(self, entry: Range) -> None:
        write_note(self.spark, f"{self.path}/{entry.epoch % self.slots}.json", json.dumps(asdict(entry)))
        self.entries.pop(entry.epoch - self.slots, None)
        self.entries[entry.epoch] = entry


def update_position(spark: SparkSession, update: Update, end: str) -> None:
    """Tell others how far a stream got: DML with one ``?``, or a callable."""
    if callable(update):
        update(spark, end)
    elif update:
        spark.sql(update, args=[end])


def batch_range(spark: SparkSession, checkpoint: str, epoch: int) -> tuple[str | None, str | None]:
    """(start, end) of a micro-batch as JSON, from the offsets that Spark notes before it runs a batch; an array of one
    entry for each source if there are several."""

    def position(number: int) -> str | None:
        text = read_note(spark, f"{checkpoint.rstrip('/')}/offsets/{number}") if number >= 0 else None
        if text is None:
            return None
        # A version, a line about the batch, and a line for each source.
        sources = text.split("\n")[2:]
        return sources[0] if len(sources) == 1 else "[" + ", ".join("null" if s == "-" else s for s in sources) + "]"

    return position(epoch - 1), position(epoch)


# --- the log ----------------------------------------------------------------------


class EpochLog:
    """One row per epoch; an epoch that runs again replaces its row. Single rows are merged ``MERGE_AT`` at a time."""

    SCHEMA = ("epoch long, started timestamp, rows long, files long, bytes long, start_offset string, end_offset string, ms long")
    MERGE_AT = 200

    def __init__(self, spark: SparkSession, checkpoint: str):
        self.spark, self.path = spark, f"{checkpoint.rstrip('/')}/epochs"

    def note(self, epoch: int, began: float, done: WriteMetrics | None, start: str | None, end: str | None) -> None:
        now = time.time()
        row = {"epoch": epoch, "started": time.strftime("%Y-%m-%dT%H:%M:%S", time.gmtime(began)) + f".{int(began % 1 * 1000):03d}Z",
               "start_offset": start, "end_offset": end, "ms": int((now - began) * 1000)}
        if isinstance(done, WriteMetrics):
            row |= {"rows": done.rows, "files": done.files, "bytes": done.bytes}
        write_note(self.spark, f"{self.path}/epoch-{epoch:09d}.json", json.dumps(row))
        if epoch and epoch % self.MERGE_AT == 0:
            self._merge(epoch)

    def _merge(self, epoch: int) -> None:
        single = {n: p for n, p in newest_notes(self.spark, self.path).items() if n.startswith("epoch-") and n < f"epoch-{epoch:09d}"}
        text = "\n".join(read_note(self.spark, p) for p in single.values())
        write_note(self.spark, f"{self.path}/merged-{epoch:09d}.json", text)
        for path in single.values():
            delete_path(self.spark, path)

    def read(self) -> DataFrame:
        files = list(newest_notes(self.spark, self.path).values())
        if not files:
            return self.spark.createDataFrame([], self.SCHEMA)
        rows = self.spark.read.schema(self.SCHEMA).json(files)
        names = rows.columns
        # A merge that did not end leaves rows twice, and an epoch that ran again may be in an older merge as well.
        newest = rows.groupBy("epoch").agg(F.max_by(F.struct(*names), "started").alias("row"))
        return newest.select(*[F.col(f"row.{n}") for n in names])


def epoch_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``epoch, started, rows, files, bytes, start_offset, end_offset, ms`` of every stored micro-batch of a stream.

    Rows, files and bytes come from the write itself; they are null where a sink does not tell them, as a script of
    several statements.
    """
    return EpochLog(spark, checkpoint).read()


def keeping_log(sink, checkpoint: str, update: Update = None, autocommit: bool = True):
    """A sink that logs each epoch, and then tells its end position to ``update``.

    With ``autocommit`` an epoch whose rows are stored is noted before the update, so after a crash or a failing update
    only that is repeated; otherwise the whole batch is.
    """
    ledgers: list[Ledger] = []

    def store(df: DataFrame, epoch: int) -> None:
        spark = df.sparkSession
        start, end = batch_range(spark, checkpoint, epoch)
        if update is not None and not ledgers:
            ledgers.append(Ledger(spark, f"{checkpoint.rstrip('/')}/updates"))
        entry = ledgers[0].at(epoch) if ledgers else None
        if not (autocommit and entry and entry.stored):
            began = time.time()
            done = sink(df, epoch)
            EpochLog(spark, checkpoint).note(epoch, began, done, start, end)
            if ledgers and autocommit:
                ledgers[0].note(Range(epoch, epoch, start, end, True))
        if update is not None:
            update_position(spark, update, end)

    return store
