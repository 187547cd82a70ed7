"""Keyed merges: a table that keeps the newest row of each key, changed by micro-batches.

The table is cut into buckets by a hash of the key, each a partition with a folder of its own. An epoch writes new
folders for the buckets that hold changed keys and then points the partitions to them, one catalog call each. Merging the same
rows again gives the same table, so an epoch may be repeated at any point.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabletransfer.operators.conform import conform
from tabletransfer.operators.distribution import spread
from tabletransfer.plans.schema import column_ddl
from tabletransfer.session import delete_path, hadoop_path, scratch_path, unique_name
from tabletransfer.sinks.catalog import OWNED, WriteMetrics, new_location, table_info
from tabletransfer.sources.targets import Target, quote, resolve_table, table_exists

BUCKET = "merge_bucket"
KEYS, BUCKETS = "transfer.merge.keys", "transfer.merge.buckets"


def merge_table(df: DataFrame, name: str, keys: Sequence[str], buckets: int, schemas=None) -> tuple[Target, T.StructType, int]:
    """The table for merges by ``keys``, its columns and its number of buckets; created if it is missing."""
    spark = df.sparkSession
    target = resolve_table(spark, name, schemas)
    missing = [k for k in keys if k not in df.columns]
    if missing or not keys:
        raise ValueError(f"keys must be columns of the stream; missing: {missing}")
    if not table_exists(spark, target):
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {target.sql_name} ({column_ddl(df.schema)}, {BUCKET} INT) USING parquet "
            f"PARTITIONED BY ({BUCKET}) LOCATION '{new_location(spark, target)}' "
            f"TBLPROPERTIES ('{OWNED}' = 'true', '{KEYS}' = '{','.join(keys)}', '{BUCKETS}' = '{buckets}')")
    stored = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {target.sql_name}").collect()}
    if stored.get(KEYS) != ",".join(keys):
        raise ValueError(f"{target.sql_name} is not a table of merges by {', '.join(keys)}")
    columns = T.StructType([f for f in spark.table(target.sql_name).schema if f.name != BUCKET])
    return target, columns, int(stored[BUCKETS])


def _newest(df: DataFrame, keys: Sequence[str], order_by: str | None) -> DataFrame:
    """One row per key, the one with the greatest ``order_by``; added up in each task first, so a hot key is no burden."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    row = F.struct(*[F.col(quote(c)) for c in rest])
    one = F.max_by(row, F.col(quote(order_by))) if order_by else F.max(row)
    grouped = df.groupBy(*[F.col(quote(k)) for k in keys]).agg(one.alias("_row"))
    return grouped.select(*[F.col(quote(k)) for k in keys], *[F.col(f"_row.{quote(c)}").alias(c) for c in rest]).select(*[F.col(quote(c)) for c in df.columns])


def merge_epoch(df: DataFrame, target: Target, columns: T.StructType, keys: Sequence[str], buckets: int,
                order_by: str | None = None) -> WriteMetrics:
    """Put the rows of a micro-batch in the place of those with the same keys; other keys are added. Null keys are equal."""
    spark = df.sparkSession
    changed = _newest(conform(df, columns), keys, order_by)
    hashed = F.pmod(F.hash(*[F.col(quote(k)) for k in keys]), F.lit(buckets)).cast("int")
    held = scratch_path(spark, "merge")
    # The micro-batch is computed once; what follows reads it several times.
    changed.withColumn(BUCKET, hashed).write.parquet(held)
    try:
        changed = spark.read.schema(T.StructType([*columns.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(held)
        touched = sorted(r[0] for r in changed.select(BUCKET).distinct().collect())  # at most `buckets` numbers
        if not touched:
            return WriteMetrics(0, 0, 0)
        spark.catalog.refreshTable(target.sql_name)
        old = spark.table(target.sql_name).where(F.col(BUCKET).isin(touched)).alias("old")
        new_keys = changed.select(*keys, BUCKET).alias("new")
        same = F.col(f"old.{BUCKET}") == F.col(f"new.{BUCKET}")
        for k in keys:
            same &= F.col(f"old.{quote(k)}").eqNullSafe(F.col(f"new.{quote(k)}"))
        rows = old.join(new_keys, same, "left_anti").unionByName(changed)
        home = table_info(spark, target.sql_name).location
        version = f"{home}/{unique_name('v')}"
        spread(rows, [BUCKET]).write.partitionBy(BUCKET).parquet(version)
        _point_to(spark, target, home, version, touched)
        filesystem, path = hadoop_path(spark, version)
        summary = filesystem.getContentSummary(path)
        return WriteMetrics(changed.count(), summary.getFileCount(), summary.getLength())
    finally:
        delete_path(spark, held)


def _point_to(spark: SparkSession, target: Target, home: str, version: str, touched: list[int]) -> None:
    there = {int(r[0].partition("=")[2]) for r in spark.sql(f"SHOW PARTITIONS {target.sql_name}").collect()}
    for bucket in touched:
        place = f"{version}/{BUCKET}={bucket}"
        if bucket in there:
            spark.sql(f"ALTER TABLE {target.sql_name} PARTITION ({BUCKET} = {bucket}) SET LOCATION '{place}'")
        else:
            spark.sql(f"ALTER TABLE {target.sql_name} ADD IF NOT EXISTS PARTITION ({BUCKET} = {bucket}) LOCATION '{place}'")
    spark.catalog.refreshTable(target.sql_name)
    # Older folders of these buckets are not read by new readers any more.
    filesystem, _ = hadoop_path(spark, home)
    name = version.rpartition("/")[2]
    for status in filesystem.listStatus(hadoop_path(spark, home)[1]):
        if status.isDirectory() and status.getPath().getName() != name:
            for bucket in touched:
                delete_path(spark, f"{status.getPath().toString()}/{BUCKET}={bucket}")
