"""What a stream did, and telling others how far it got."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tabletransfer.functions.udfs import get_batch_id, row_timestamp


def progress_report(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch with its rows, offsets and times in milliseconds."""
    rows = []
    for p in query.recentProgress:
        source = p["sources"][0]
        spent = p["durationMs"]
        rows.append((
            p["batchId"], p["timestamp"], p["numInputRows"],
            str(source["startOffset"]), str(source["endOffset"]),
            spent.get("addBatch"), spent.get("triggerExecution"),
        ))
    return spark.createDataFrame(
        rows,
        "batch_id long, started string, rows long, start_offset string, end_offset string, "
        "batch_ms long, total_ms long",
    )


def with_delay(df: DataFrame, generated: str = "gen_ts") -> DataFrame:
    """Add ``batch_id``, ``spark_ts`` and ``delay_s``, the seconds since a row was made."""
    stamped = df.withColumn("batch_id", get_batch_id()).withColumn("spark_ts", row_timestamp())
    seconds = (F.unix_micros("spark_ts") - F.unix_micros(F.col(generated).cast("timestamp"))) / F.lit(1e6)
    return stamped.withColumn("delay_s", seconds)


def stop_between_batches(query: StreamingQuery, timeout: float = 60.0) -> bool:
    """Stop a stream when no micro-batch is running; True if such a moment was found.

    After ``timeout`` seconds the running batch is cut off; it is run again on restart.
    """
    deadline = time.monotonic() + timeout
    idle = False
    while query.isActive and time.monotonic() < deadline and not idle:
        idle = not query.status["isTriggerActive"]
        if not idle:
            time.sleep(0.01)
    query.stop()
    return idle


def drain(query: StreamingQuery) -> None:
    """Let a stream with a short trigger take all there is, in as many batches as its limits ask for, and stop it."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


class OffsetUpdate(StreamingQueryListener):
    """Runs DML with one ``?`` for the end offset of each finished micro-batch of a query."""

    def __init__(self, spark: SparkSession, offset_update: str, query_name: str):
        self.spark = spark
        self.offset_update = offset_update
        self.query_name = query_name

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        progress = event.progress
        if progress.name == self.query_name and progress.durationMs.get("addBatch") is not None:
            self.spark.sql(self.offset_update, args=[progress.sources[0].endOffset])

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
