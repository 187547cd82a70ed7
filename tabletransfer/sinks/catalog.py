"""Facts about catalog tables, and publishing a finished table under its name."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession

from tabletransfer.session import delete_path, note_age, path_exists, read_note, same_path, unique_name, write_new_note
from tabletransfer.sources.targets import Target, table_exists

log = logging.getLogger(__name__)

OWNED = "transfer.owned"
DISTRIBUTION = "transfer.distribution"


@dataclass(frozen=True)
class TableInfo:
    location: str | None
    num_buckets: int | None = None
    bucket_columns: list[str] = field(default_factory=list)
    partition_columns: list[str] = field(default_factory=list)
    owned: bool = False
    distribution: str | None = None
    columns: str = ""
    provider: str | None = None
    sort_columns: list[str] = field(default_factory=list)


def table_info(spark: SparkSession, name: str) -> TableInfo:
    described = json.loads(spark.sql(f"DESCRIBE EXTENDED {name} AS JSON").head()[0])
    properties = described.get("table_properties") or {}
    return TableInfo(
        location=described.get("location"),
        num_buckets=described.get("num_buckets"),
        bucket_columns=described.get("bucket_columns") or [],
        partition_columns=described.get("partition_columns") or [],
        owned=properties.get(OWNED) == "true",
        distribution=properties.get(DISTRIBUTION),
        columns=json.dumps(described.get("columns"), sort_keys=True),
        provider=described.get("provider"),
        sort_columns=described.get("sort_columns") or [],
    )


@dataclass(frozen=True)
class WriteMetrics:
    """What one write command stored; None where it is not known."""

    rows: int | None
    files: int | None
    bytes: int | None


def write_metrics(result: DataFrame) -> WriteMetrics | None:
    """What an INSERT wrote, from the metrics of its command that Spark also shows in its UI; None for other results."""
    done = result._jdf.queryExecution().commandExecuted()
    if done.getClass().getSimpleName() != "CommandResult":
        return None
    plan = done.commandPhysicalPlan()
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        plan = plan.executedPlan()
    found, metrics = {}, plan.metrics().iterator()
    while metrics.hasNext():
        metric = metrics.next()
        found[metric._1()] = metric._2().value()
    names = ("numOutputRows", "numFiles", "numOutputBytes")
    return WriteMetrics(*[found.get(n) for n in names]) if any(n in found for n in names) else None


def new_location(spark: SparkSession, target: Target) -> str:
    """A fresh folder next to the other tables of the target's database."""
    database = target.schema or spark.catalog.currentDatabase()
    base = spark.catalog.getDatabase(database).locationUri.rstrip("/")
    return f"{base}/{unique_name(target.table)}"


def set_properties(spark: SparkSession, name: str, **properties: str) -> None:
    items = ", ".join(f"'{k}' = '{v}'" for k, v in properties.items())
    spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({items})")


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table; files that this package placed go with it."""
    info = table_info(spark, name)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    if info.owned and info.location:
        try:
            delete_path(spark, info.location)
        except Exception:
            log.warning("could not delete %s", info.location, exc_info=True)


def _same_shape(a: TableInfo, b: TableInfo) -> bool:
    """Whether rows stored for one table can be another's just by their folder. Partitions have places of their own."""
    return not a.partition_columns and (a.columns, a.provider, a.num_buckets, a.bucket_columns, a.sort_columns, a.partition_columns) == (
        b.columns, b.provider, b.num_buckets, b.bucket_columns, b.sort_columns, b.partition_columns)


# --- leases -----------------------------------------------------------------------

#: Seconds after which the publishing of a table counts as dead. It takes a few catalog calls; clocks of writers
#: must not differ by more.
LEASE_SECONDS = 120
_POLL = 0.05


@dataclass(frozen=True)
class Lease:
    """Who publishes a table, until when, and what it would leave behind: the note that others go by."""

    owner: str
    until: float
    staged: str
    path: str
    old: str
    old_path: str | None


def _lease_path(spark: SparkSession, target: Target) -> str:
    database = target.schema or spark.catalog.currentDatabase()
    return f"{spark.catalog.getDatabase(database).locationUri.rstrip('/')}/_transfer_publish_{target.table.lower()}.json"


def current_lease(spark: SparkSession, target: Target) -> Lease | None:
    text = read_note(spark, _lease_path(spark, target))
    return Lease(**json.loads(text)) if text else None


def _still_ours(spark: SparkSession, target: Target, lease: Lease) -> None:
    now = current_lease(spark, target)
    if now is None or now.owner != lease.owner:
        raise RuntimeError(f"{target.sql_name} was published by another writer, after more than {LEASE_SECONDS} seconds")


def settle(spark: SparkSession, target: Target) -> bool:
    """Wait for another writer that publishes the table, or clean up after a dead one; True if there is the table now.

    For writers only. A lease that has ended and is still there belongs to a writer that died: the
    old rows get their name back unless the new ones have it, and what is left over is deleted.
    """
    path = _lease_path(spark, target)
    while path_exists(spark, path):
        lease = current_lease(spark, target)
        if lease is None and note_age(spark, path) > LEASE_SECONDS:
            delete_path(spark, path)  # its writer died before it said anything, and so before it did anything
            continue
        if lease is None or lease.until > time.time():
            time.sleep(_POLL)
            continue
        # One of several writers takes the dead one's lease over; the others wait for it.
        taken = f"{path}.{lease.owner}"
        if not write_new_note(spark, taken, unique_name("settle")):
            if note_age(spark, taken) > LEASE_SECONDS:
                delete_path(spark, taken)
            time.sleep(_POLL)
            continue
        if current_lease(spark, target) == lease:
            _roll_back(spark, target, lease)
            delete_path(spark, path)
        delete_path(spark, taken)
    return table_exists(spark, target)


def _roll_back(spark: SparkSession, target: Target, lease: Lease) -> None:
    named = lambda table: Target("", False, target.schema, table)
    staged, old = named(lease.staged), named(lease.old)
    if not table_exists(spark, target) and table_exists(spark, old):
        spark.sql(f"ALTER TABLE {old.sql_name} RENAME TO {target.sql_name}")
        log.warning("%s got its old rows back after a write that did not end", target.sql_name)
    published = table_exists(spark, target) and same_path(table_info(spark, target.sql_name).location, lease.path)
    if table_exists(spark, staged):
        spark.sql(f"DROP TABLE IF EXISTS {staged.sql_name}")
    if not published:
        delete_path(spark, lease.path)
    elif table_exists(spark, old):
        drop_table(spark, old.sql_name)
    elif lease.old_path:
        delete_path(spark, lease.old_path)


def visible(spark: SparkSession, target: Target) -> Target | None:
    """The table that a reader of ``target`` should read: itself, or, while a writer has set the old rows aside, those.

    Readers change nothing, whether the writer lives or not.
    """
    while True:
        if table_exists(spark, target):
            return target
        lease = current_lease(spark, target)
        if lease is None:
            return target if table_exists(spark, target) else None
        old = Target("", False, target.schema, lease.old)
        if table_exists(spark, old):
            return old
        if lease.until < time.time():
            return target if table_exists(spark, target) else None
        time.sleep(_POLL)


def _step(name: str) -> None:
    """Called between the steps of ``publish``; tests look at the table from here."""


def publish(spark: SparkSession, staged: Target, target: Target) -> None:
    """Give a finished staging table its final name. Only catalog entries change; no row is read or moved.

    A table of the same columns, format and buckets, without partitions, is pointed to the new folder by one catalog
    call, so any reader sees the old or the new rows. Otherwise the catalog takes two renames, with a moment
    between them in which the name is free: ``read_table`` then reads the old rows where the writer's lease says
    they are, while other readers find no table. The lease also tells later writers what to clean up if this one dies.
    """
    if not table_exists(spark, target):
        spark.sql(f"ALTER TABLE {staged.sql_name} RENAME TO {target.sql_name}")
        return
    before, after = table_info(spark, target.sql_name), table_info(spark, staged.sql_name)
    lease = Lease(unique_name("writer"), time.time() + LEASE_SECONDS, staged.table, after.location,
                  unique_name(f"{target.table}_old"), before.location if before.owned else None)
    while not write_new_note(spark, _lease_path(spark, target), json.dumps(asdict(lease))):
        if not settle(spark, target):
            spark.sql(f"ALTER TABLE {staged.sql_name} RENAME TO {target.sql_name}")
            return
        before = table_info(spark, target.sql_name)
        lease = replace(lease, until=time.time() + LEASE_SECONDS, old_path=before.location if before.owned else None)
    try:
        _step("leased")
        if before.owned and _same_shape(before, after):
            _move_location(spark, staged, target, before, after)
        else:
            _swap_names(spark, staged, target, lease)
    except Exception:
        _release(spark, target, lease)
        raise
    _release(spark, target, lease)
    _tidy(lambda: spark.catalog.refreshTable(target.sql_name))


def _release(spark: SparkSession, target: Target, lease: Lease) -> None:
    now = current_lease(spark, target)
    if now is not None and now.owner == lease.owner:
        _tidy(lambda: delete_path(spark, _lease_path(spark, target)))


def discard(spark: SparkSession, staged: Target, target: Target, path: str) -> None:
    """Delete what a failed write staged, unless it has become the table's."""
    spark.sql(f"DROP TABLE IF EXISTS {staged.sql_name}")
    if not (table_exists(spark, target) and same_path(table_info(spark, target.sql_name).location, path)):
        delete_path(spark, path)


def _move_location(spark: SparkSession, staged: Target, target: Target, before: TableInfo, after: TableInfo) -> None:
    if before.distribution != after.distribution:
        if after.distribution:
            set_properties(spark, target.sql_name, **{DISTRIBUTION: after.distribution})
        else:
            spark.sql(f"ALTER TABLE {target.sql_name} UNSET TBLPROPERTIES IF EXISTS ('{DISTRIBUTION}')")
    spark.sql(f"ALTER TABLE {target.sql_name} SET LOCATION '{after.location}'")
    _step("moved")
    # From here on the new rows are in place, and nothing may undo the write.
    _tidy(lambda: spark.sql(f"DROP TABLE IF EXISTS {staged.sql_name}"))
    _tidy(lambda: delete_path(spark, before.location))


def _swap_names(spark: SparkSession, staged: Target, target: Target, lease: Lease) -> None:
    old = Target("", False, target.schema, lease.old)
    spark.sql(f"ALTER TABLE {target.sql_name} RENAME TO {old.sql_name}")
    try:
        _step("aside")
        _still_ours(spark, target, lease)
        spark.sql(f"ALTER TABLE {staged.sql_name} RENAME TO {target.sql_name}")
    except Exception:
        if table_exists(spark, old) and not table_exists(spark, target):
            spark.sql(f"ALTER TABLE {old.sql_name} RENAME TO {target.sql_name}")
        raise
    _step("named")
    _tidy(lambda: drop_table(spark, old.sql_name))


def _tidy(action: Callable[[], object]) -> None:
    try:
        action()
    except Exception:
        log.warning("could not clean up after a write", exc_info=True)
