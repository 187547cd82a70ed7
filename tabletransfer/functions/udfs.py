"""Functions for use in SQL and in DataFrame expressions."""

from __future__ import annotations

import time

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, SparkSession, functions as F, types as T

VERSION = "0.1.0"

# Fixed value: the task property in which Spark keeps the micro-batch number.
_BATCH_PROPERTY = "streaming.sql.batchId"


@F.pandas_udf(T.IntegerType())
def _batch_id(partition: pd.Series) -> pd.Series:
    context = TaskContext.get()
    value = context.getLocalProperty(_BATCH_PROPERTY) if context else None
    return pd.Series([int(value) if value else None] * len(partition), dtype="Int32")


@F.pandas_udf(T.TimestampType())
def _row_timestamp(partition: pd.Series) -> pd.Series:
    micros = [time.time_ns() // 1000 for _ in range(len(partition))]
    return pd.to_datetime(pd.Series(micros, dtype="int64"), unit="us", utc=True)


_row_timestamp = _row_timestamp.asNondeterministic()


def get_batch_id() -> Column:
    """Number of the current micro-batch; null outside a stream.

    Inside ``foreachBatch`` use ``F.lit(batch_id)``, which costs nothing.
    """
    return _batch_id(F.spark_partition_id())


def row_timestamp() -> Column:
    """The moment this row passed, per row (``current_timestamp`` is one value per batch)."""
    return _row_timestamp(F.spark_partition_id())


def version() -> str:
    return f"tabletransfer v{VERSION}"


def register_udfs(spark: SparkSession) -> None:
    """Make ``getBatchId()``, ``getRowTimestamp()`` and ``transferVersion()`` available in SQL."""
    spark.udf.register("transfer_batch_id", _batch_id)
    spark.udf.register("transfer_row_timestamp", _row_timestamp)
    for name, result, body in (
        ("getBatchId", "INT", "transfer_batch_id(spark_partition_id())"),
        ("getRowTimestamp", "TIMESTAMP", "transfer_row_timestamp(spark_partition_id())"),
        ("transferVersion", "STRING", f"'{version()}'"),
    ):
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}() RETURNS {result} RETURN {body}")
