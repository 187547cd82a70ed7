"""Batch sinks: write a DataFrame to a catalog table, all or nothing."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F, types as T

from tabletransfer.operators.conform import conform
from tabletransfer.operators.distribution import BY_KEY, Distribution, RANDOMLY, REPLICATED, parse_distribution, spread
from tabletransfer.plans.scripts import run_undo
from tabletransfer.session import path_usage, unique_name
from tabletransfer.sinks.catalog import (
    DISTRIBUTION, OWNED, discard, new_location, publish, set_properties, settle, table_info, write_metrics,
    WriteMetrics,
)
from tabletransfer.sources.targets import Target, quote, resolve_table

_BUCKET = "_transfer_bucket"

APPEND, OVERWRITE, IGNORE, ERROR = "append", "overwrite", "ignore", "errorifexists"
_MODES = {"append": APPEND, "overwrite": OVERWRITE, "ignore": IGNORE, "error": ERROR, "errorifexists": ERROR}


@dataclass(frozen=True)
class WriteReport:
    """What one write did: its rows, and the files and bytes that it added."""

    table: str
    action: str
    rows: int
    files: int | None
    bytes: int | None
    ms: int

    def to_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [astuple(self)], "table string, action string, rows long, files int, bytes long, ms long")


def save_mode(mode: str) -> str:
    if not isinstance(mode, str) or mode.lower() not in _MODES:
        raise ValueError(f"mode must be one of {sorted(_MODES)}, not {mode!r}")
    return _MODES[mode.lower()]


def _arrange(df: DataFrame, dist: Distribution | None, buckets: int | None,
             partition_by: Sequence[str], writers: int | None, cluster: bool) -> DataFrame:
    """Choose the one shuffle before the write, or none.

    A plain table is written from the tasks that computed it. Bucketed or partitioned
    tables are clustered first, otherwise every task would write a file per bucket or
    partition value; hot values are split by Spark at run time.
    """
    if dist and dist.kind == BY_KEY and partition_by:
        # Rows of one partition value and bucket go together, as they will be in one file.
        spread_on = df.withColumn(_BUCKET, F.pmod(F.hash(*[F.col(quote(c)) for c in dist.columns]), F.lit(buckets)))
        return spread(spread_on, [*partition_by, _BUCKET]).drop(_BUCKET)
    if dist and dist.kind == BY_KEY:
        return spread(df, dist.columns, buckets)
    if dist and dist.kind in (RANDOMLY, REPLICATED):
        return spread(df, parts=writers)
    if partition_by and cluster:
        return spread(df, partition_by, writers)
    if writers:
        # A shuffle of its own: what comes before keeps its number of tasks.
        return df.repartition(writers)
    return df


def write_table(
    df: DataFrame,
    name: str,
    mode: str,
    *,
    truncate: bool = False,
    distributed_by: str | None = None,
    buckets: int | None = None,
    partition_by: Sequence[str] = (),
    writers: int | None = None,
    cluster: bool = True,
    schemas: str | Sequence[str] | None = None,
    undo: str | Callable[[], None] | None = None,
    fmt: str = "parquet",
) -> WriteReport:
    """Write ``df`` to a table, creating it if it does not exist.

    ``mode`` is required: ``append`` inserts by column name (columns left out become
    null); ``overwrite`` replaces the table with ``df``'s columns, or with
    ``truncate=True`` keeps the table's structure and replaces its rows; ``ignore``
    leaves an existing table alone; ``errorifexists`` fails on one.

    New rows are written to a folder of their own and published by a change of catalog
    entries at the end, so a failed write leaves the table as it was, and a table may be
    overwritten by a query that reads it. After a failure ``undo`` is run and the error
    is raised again.

    ``distributed_by``: ``a, b`` (buckets, ``buckets`` of them), ``randomly`` (even
    files) or ``replicated`` (small table; read with a broadcast hint). ``partition_by``
    names partition columns; ``cluster=False`` skips the shuffle before a partitioned
    write. ``writers`` limits the number of writing tasks.
    """
    chosen = save_mode(mode)
    spark = df.sparkSession
    target = resolve_table(spark, name, schemas)
    exists = settle(spark, target)
    started = time.monotonic()
    if exists and chosen == IGNORE:
        return WriteReport(target.sql_name, "ignored", 0, None, None, 0)
    if exists and chosen == ERROR:
        raise ValueError(f"table {target.sql_name} exists")
    dist = parse_distribution(distributed_by)
    if isinstance(partition_by, str):
        partition_by = [c.strip() for c in partition_by.split(",")]
    seen = Observation(unique_name("write"))
    files = size = None
    try:
        if exists and chosen == APPEND:
            action = "appended"
            done = _insert(df, target, seen, writers)
            files, size = (done.files, done.bytes) if done else (None, None)
        else:
            action = "replaced" if exists else "created"
            staged = Target("", False, target.schema, unique_name(f"{target.table}_new"))
            path = new_location(spark, target)
            try:
                if exists and truncate:
                    spark.sql(f"CREATE TABLE {staged.sql_name} LIKE {target.sql_name} LOCATION '{path}'")
                    kept = table_info(spark, target.sql_name).distribution
                    _insert(df, staged, seen, writers)
                else:
                    kept = dist.kind if dist else None
                    out = _arrange(df, dist, buckets or _default_buckets(spark), partition_by, writers, cluster)
                    _create(out, staged, path, seen, dist, buckets, partition_by, fmt)
                properties = {OWNED: "true"} | ({DISTRIBUTION: kept} if kept else {})
                set_properties(spark, staged.sql_name, **properties)
                publish(spark, staged, target)
            except Exception:
                discard(spark, staged, target, path)
                raise
            files, size = path_usage(spark, path)
        spark.catalog.refreshTable(target.sql_name)
    except Exception as error:
        run_undo(spark, undo, error)
        raise
    ms = int((time.monotonic() - started) * 1000)
    return WriteReport(target.sql_name, action, seen.get["rows"], files, size, ms)


def _default_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _observed(df: DataFrame, seen: Observation) -> DataFrame:
    """Count rows in the writing job itself, after the last shuffle."""
    return df.observe(seen, F.count(F.lit(1)).alias("rows"))


def _create(df: DataFrame, staged: Target, path: str, seen: Observation, dist: Distribution | None,
            buckets: int | None, partition_by: Sequence[str], fmt: str) -> None:
    writer = _observed(df, seen).write.format(fmt).option("path", path)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if dist and dist.kind == BY_KEY:
        writer = writer.bucketBy(buckets or _default_buckets(df.sparkSession), *dist.columns)
    writer.saveAsTable(staged.sql_name)


def _insert(df: DataFrame, target: Target, seen: Observation, writers: int | None) -> WriteMetrics | None:
    """Insert by name. Spark's commit protocol shows the rows only when all tasks are done."""
    spark = df.sparkSession
    info = table_info(spark, target.sql_name)
    fields = {f.name.lower(): f for f in spark.table(target.sql_name).schema}
    unknown = [c for c in df.columns if c.lower() not in fields]
    if unknown:
        raise ValueError(f"table {target.sql_name} has no column {unknown}")
    wanted = T.StructType([fields[c.lower()] for c in df.columns])
    fitted = conform(df, wanted)
    dist = Distribution(BY_KEY, tuple(info.bucket_columns)) if info.bucket_columns else None
    # Cluster only on columns that are being inserted.
    have = {c.lower() for c in fitted.columns}
    parts = [c for c in info.partition_columns if c.lower() in have]
    if dist and not {c.lower() for c in dist.columns} <= have:
        dist = None
    out = _observed(_arrange(fitted, dist, info.num_buckets, parts, writers, True), seen)
    view = unique_name("rows")
    out.createOrReplaceTempView(view)
    try:
        return write_metrics(spark.sql(f"INSERT INTO {target.sql_name} BY NAME SELECT * FROM {view}"))
    finally:
        spark.catalog.dropTempView(view)


