"""A micro-batch source over parquet files, driven by an ordered offset column.

Each micro-batch holds the rows with ``start < offset <= end``. The newest position
comes from parquet footers, and footers are read once per file: those of many files that are
there when the stream is set up by a Spark job, others with the poll that finds
them. A poll costs one listing plus the footers of new files. Row groups outside the range are
never read. A file with rows of the range that is gone fails the batch, and so does one that comes
when batches have passed its rows. With a checkpoint the footers are kept in an index next to it.
"""

from __future__ import annotations

import datetime as dt
import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from urllib.parse import unquote

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tabletransfer.session import hadoop_path, scratch_path
from tabletransfer.sinks.catalog import table_info
from tabletransfer.streaming.fileindex import FOLDER, FileIndex, Plan, RowGroup

SOURCE_NAME = "transfer_offsets"

LATEST, EARLIEST = "latest", "earliest"

_READ_THREADS = 16
_BATCH_ROWS = 65_536
# Footers that a task of the set-up job reads; up to so many the driver reads by itself.
_FOOTERS_PER_TASK = 256
# Row groups whose offsets are kept in memory to cut batches inside them.
_KEPT_OFFSETS = 8

FAIL, REPORT, IGNORE = "fail", "report", "ignore"

# Fixed value: Spark's folder name for a null partition value.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"

_OFFSET_TYPES = (T.IntegralType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _plain(value) -> int:
    """An offset as a whole number: days of a date, microseconds of a time."""
    if isinstance(value, dt.datetime):
        epoch = dt.datetime(1970, 1, 1, tzinfo=value.tzinfo and dt.timezone.utc)
        return (value - epoch) // dt.timedelta(microseconds=1)
    if isinstance(value, dt.date):
        return (value - dt.date(1970, 1, 1)).days
    return value


def _numbers(offsets):
    """Dates as days and timestamps as microseconds."""
    import pyarrow as pa

    if pa.types.is_timestamp(offsets.type):
        return offsets.cast(pa.timestamp("us", offsets.type.tz)).cast(pa.int64())
    return offsets.cast(pa.int32()) if pa.types.is_date(offsets.type) else offsets


@dataclass
class OffsetSlice(InputPartition):
    """Row groups of one file, and the range to keep (start exclusive, end inclusive)."""

    path: str
    groups: list[int]
    start: object
    end: object


def open_filesystem(path: str):
    """(file system, path inside it); both ends of a path in the cluster's shared storage."""
    from pyarrow import fs

    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path


def list_files(path: str) -> list[str]:
    """Data files below ``path``; names that start with ``_`` or ``.`` are not data. A missing folder is an error."""
    from pyarrow import fs

    filesystem, root = open_filesystem(path)
    if filesystem.get_file_info(root).type == fs.FileType.File:
        return [root]
    found = filesystem.get_file_info(fs.FileSelector(root, recursive=True))
    inside = lambda p: p[len(root):].strip("/").split("/")
    return [f.path for f in found
            if f.type == fs.FileType.File and not any(s.startswith(("_", ".")) for s in inside(f.path))]


def partition_values(path: str) -> dict[str, str | None]:
    """Values of partition columns, which are in folder names and not in the file."""
    values = {}
    for folder in path.split("/")[:-1]:
        name, mark, value = folder.partition("=")
        if mark:
            values[unquote(name)] = None if value == _NULL_PARTITION else unquote(value)
    return values


def footer_groups(filesystem, path: str, column: str) -> list[RowGroup]:
    """Offset range and size of each row group of a file, from its footer."""
    import pyarrow.parquet as pq

    meta = pq.read_metadata(path, filesystem=filesystem)
    names = [meta.schema.column(i).path for i in range(meta.num_columns)]
    position = names.index(column)
    groups = []
    for i in range(meta.num_row_groups):
        group = meta.row_group(i)
        stats = group.column(position).statistics
        if stats is not None and stats.has_min_max:
            rows = group.num_rows - (stats.null_count or 0 if stats.has_null_count else 0)
            groups.append(RowGroup(i, _plain(stats.min), _plain(stats.max), group.total_byte_size, rows))
        elif group.num_rows and not (stats is not None and stats.null_count == group.num_rows):
            raise ValueError(
                f"{path} has no statistics for {column}, so its newest offset is unknown; timestamps "
                "have them when written with spark.sql.parquet.outputTimestampType=TIMESTAMP_MICROS")
    return groups


def write_footers(spark: SparkSession, path: str, column: str, files: list[str]) -> str:
    """Read many footers in parallel on the executors; returns the folder that lists them."""

    def ranges(batches):
        filesystem, _ = open_filesystem(path)
        for batch in batches:
            rows = [(f, g.index, g.low, g.high, g.size, g.rows)
                    for f in batch["path"] for g in footer_groups(filesystem, f, column)]
            yield pd.DataFrame(rows, columns=["path", "index", "low", "high", "size", "rows"])

    out = scratch_path(spark, "footers")
    names = spark.createDataFrame(pd.DataFrame({"path": files}, dtype="object"), "path string")
    parts = max(1, -(-len(files) // _FOOTERS_PER_TASK))
    (names.repartition(parts, "path")
     .mapInPandas(ranges, "path string, index int, low long, high long, size long, rows long").write.parquet(out))
    return out


class OffsetStreamReader(DataSourceStreamReader):
    def __init__(self, schema: T.StructType, options: dict[str, str]):
        self.path = options["path"]
        self.column = options["offset_col"]
        self.starting = options.get("starting", LATEST)
        ending = options.get("ending")
        self.ending = None if ending is None else json.loads(ending)
        self.split_bytes = int(options.get("split_bytes", 128 << 20))
        self.fail_on_data_loss = options.get("fail_on_data_loss", "true").lower() == "true"
        self.late = options.get("late", FAIL if self.fail_on_data_loss else IGNORE)
        self.max_rows = int(options["max_rows"]) if "max_rows" in options else None
        self.max_bytes = int(options["max_bytes"]) if "max_bytes" in options else None
        self.footers = options.get("footers")
        self.index_folder = options.get("index")
        self.schema = schema
        self._forget()

    def _forget(self) -> None:
        self.groups: dict[str, list[RowGroup]] = {}  # of files that are known; those that batches have passed are empty
        self.after: dict[str, int | None] = {}  # how far batches were planned when a file came
        self.new: list[str] = []  # files that are not in the index yet
        self.present: set[str] | None = None  # the files of the newest listing
        self.seen: dict[str, int] = {}  # the listing that a file came with
        self.listings = 0
        self.newest: int | None = None
        self.plan: Plan | None = None
        self.index: FileIndex | None = None
        self.cut: dict[tuple[str, int], np.ndarray] = {}

    _DRIVER_ONLY = ("groups", "after", "new", "present", "seen", "plan", "index", "cut")

    def __getstate__(self):
        """Tasks get the options, not the footers."""
        return {k: v for k, v in self.__dict__.items() if k not in self._DRIVER_ONLY}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    # -- driver side -------------------------------------------------------------

    def _set_up(self) -> dict[str, list[RowGroup]]:
        """Take over the index, and what the footer job found, which is deleted; returns the latter."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        if self.index_folder:
            self.index = FileIndex(*open_filesystem(self.index_folder))
            self.plan = self.index.plan()
            self.groups, self.after = self.index.load(self.plan.start if self.plan else None)
            ends = [g.high for groups in self.groups.values() for g in groups]
            self.newest = max([*ends, *([self.plan.end] if self.plan and self.plan.end is not None else [])], default=None)
        found: dict[str, list[RowGroup]] = {}
        if self.footers:
            filesystem, root = open_filesystem(self.footers)
            if filesystem.get_file_info(root).type != fs.FileType.NotFound:
                for part in list_files(self.footers):
                    for row in pq.read_table(part, filesystem=filesystem, partitioning=None).to_pylist():
                        group = RowGroup(row["index"], row["low"], row["high"], row["size"], row["rows"])
                        found.setdefault(row["path"], []).append(group)
                filesystem.delete_dir(root)
            self.footers = None
        return found

    def _refresh(self) -> None:
        """List the files and read the footers of new ones, which are immutable."""
        given = self._set_up() if self.present is None else {}
        self.present = set(list_files(self.path))
        new = [f for f in self.present if f not in self.groups]
        self.listings += 1
        for path in self.present:
            self.seen.setdefault(path, self.listings)
        filesystem, _ = open_filesystem(self.path)
        read = lambda f: given.get(f) or footer_groups(filesystem, f, self.column)
        with ThreadPoolExecutor(_READ_THREADS) as pool:
            for path, groups in zip(new, pool.map(read, new)):
                after = self.plan.end if self.plan else None
                if self.late == FAIL and self._late(path, groups, after) and not self._merged(path, groups, after):
                    raise ValueError(
                        f"{path} came when batches had passed some of its rows, up to {after}; late='report' leaves such rows "
                        "to late_rows, late='ignore' drops them")
                self.groups[path], self.after[path] = groups, after
                self.new.append(path)
                self.newest = max([g.high for g in groups] + ([self.newest] if self.newest is not None else []), default=None)

    def _late(self, path: str, groups: list[RowGroup], after: int | None) -> bool:
        """Whether a new file has rows of the stream that no batch will read."""
        if after is None:
            return False
        first = self.plan.first
        passed = [g for g in groups if g.low <= after and (first is None or g.high > first)]
        if any(g.high <= after and (first is None or g.low > first) for g in passed):
            return True
        for offsets in self._offsets(path, [g.index for g in passed]):
            inside = offsets <= after
            if first is not None:
                inside &= offsets > first
            if inside.any():
                return True
        return False

    def _newest(self) -> int | None:
        """The newest offset that was ever seen, so the position does not go back when files go."""
        self._refresh()
        return self.newest

    def initialOffset(self) -> dict:
        if self.starting == EARLIEST:
            return {"offset": None}
        if self.starting == LATEST:
            self.started = self._newest()
            return {"offset": self.started}
        return {"offset": json.loads(self.starting)["offset"]}

    def latestOffset(self) -> dict:
        newest = self._newest()
        if newest is not None and self.ending is not None:
            newest = min(newest, self.ending)
        if newest is not None and (self.max_rows or self.max_bytes):
            newest = self._bounded(newest)
        if self.index and self.new:
            # Before the batch that reads them is planned, so a batch that runs again knows its files.
            self.index.add({f: self.groups[f] for f in self.new}, self.after)
            self.new = []
        return {"offset": newest}

    def _bounded(self, newest: int) -> int:
        """The last offset of a batch from the planned position on that holds at most ``max_rows`` rows and ``max_bytes``
        bytes; a single offset with more is a batch of its own."""
        start = self._position()
        groups = [(g, path) for path, own in self.groups.items() for g in own
                  if g.low <= newest and (start is None or g.high > start) and path in self.present]
        groups.sort(key=lambda item: item[0].low)
        ends = [newest]
        for limit, weight in ((self.max_rows, lambda g: g.rows), (self.max_bytes, lambda g: g.size)):
            if limit:
                ends.append(self._cut(groups, start, newest, limit, weight))
        return min(ends)

    def _position(self) -> int | None:
        if self.plan:
            return self.plan.end
        if self.starting == LATEST:
            return self.started if hasattr(self, "started") else self.newest
        return None if self.starting == EARLIEST else json.loads(self.starting)["offset"]

    def _cut(self, groups: list[tuple[RowGroup, str]], start: int | None, newest: int, limit: int, weight) -> int:
        total = np.cumsum([weight(g) for g, _ in groups])
        over = int(np.searchsorted(total, limit, side="right"))
        if over == len(groups):
            return newest
        before = groups[over][0].low - 1
        if over and before >= groups[0][0].low and (start is None or before > start):
            return before  # row groups that begin up to here hold no more, so no offset needs to be read
        offsets, shares = np.zeros(0, np.int64), np.zeros(0)
        for at, (group, path) in enumerate(groups):
            own = self._sorted_offsets(path, group.index)
            own = own[own <= newest] if start is None else own[(own > start) & (own <= newest)]
            offsets = np.concatenate((offsets, own))
            shares = np.concatenate((shares, np.full(len(own), weight(group) / max(group.rows, 1))))
            order = np.argsort(offsets, kind="stable")
            offsets, shares = offsets[order], shares[order]
            over = int(np.searchsorted(np.cumsum(shares), limit, side="right"))
            following = groups[at + 1][0].low if at + 1 < len(groups) else None
            if over < len(offsets) and (following is None or following > offsets[over]):
                break
        if over >= len(offsets):
            return newest
        # All rows of one offset go together.
        first = int(np.searchsorted(offsets, offsets[over], side="left"))
        return int(offsets[first - 1] if first else offsets[over])

    def _sorted_offsets(self, path: str, group: int) -> np.ndarray:
        key = (path, group)
        if key not in self.cut:
            while len(self.cut) >= _KEPT_OFFSETS:
                self.cut.pop(next(iter(self.cut)))
            self.cut[key] = np.sort(np.concatenate([np.zeros(0, np.int64), *self._offsets(path, [group])]))
        return self.cut[key]

    def partitions(self, start: dict, end: dict) -> list[OffsetSlice]:
        """Cut by row groups. The file list is fixed here, once for the whole batch."""
        low, high = start["offset"], end["offset"]
        slices: list[OffsetSlice] = []
        if high is None or high == low:
            return slices  # Spark also asks for an empty range before it repeats a batch
        if low is not None and high < low:
            raise ValueError(f"the newest offset went back from {low} to {high}")
        if self.present is None:
            self._refresh()
        for path, own in sorted(self.groups.items()):
            missed = self.after.get(path)
            begin = low if missed is None else missed if low is None else max(low, missed)
            groups = [g for g in own if g.low <= high and (begin is None or g.high > begin)]
            if groups and path not in self.present:
                if self.fail_on_data_loss and not self._replaced(path):
                    raise FileNotFoundError(
                        f"{path} held rows after {low} up to {high} and is gone; with fail_on_data_loss=False "
                        "such rows are left out")
                continue
            wanted: list[int] = []
            size = 0
            for group in groups:
                if wanted and size + group.size > self.split_bytes:
                    slices.append(OffsetSlice(path, wanted, begin, high))
                    wanted, size = [], 0
                wanted.append(group.index)
                size += group.size
            if wanted:
                slices.append(OffsetSlice(path, wanted, begin, high))
        self._planned(low, high)
        return slices

    def _planned(self, low: int | None, high: int) -> None:
        """Note a plan, and let go of row groups that lie before it; Spark repeats the newest batch only."""
        again = self.plan and (self.plan.start, self.plan.end) == (low, high)
        if again or self.plan and self.plan.end is not None and high <= self.plan.end:
            return
        self.plan = Plan(self.plan.first if self.plan else low, low, high)
        if self.index:
            if self.new:
                self.index.add({f: self.groups[f] for f in self.new}, self.after)
                self.new = []
            self.index.note(self.plan)
        if low is not None and self.index:
            for path, own in self.groups.items():
                if own and all(g.high <= low for g in own):
                    self.groups[path] = []

    def _stored_groups(self, files: set[str]) -> dict[str, list[RowGroup]]:
        """Row groups of known files, also of those that batches have passed."""
        if self.index and any(not self.groups[f] for f in files):
            stored, _ = self.index.load(None)
            return {f: stored.get(f) or self.groups[f] for f in files}
        return {f: self.groups[f] for f in files}

    def _replaced(self, path: str) -> bool:
        """Whether files that came later hold the rows of a file that is gone, as after merging files."""
        gone = self._stored_groups({f for f in self.groups if f not in self.present})
        return self._stand_in(gone, {path}) is not None

    def _merged(self, path: str, groups: list[RowGroup], after: int) -> bool:
        """Whether the rows of a new file that batches have passed are those of files that are gone."""
        gone = self._stored_groups({f for f in self.groups if f not in self.present})
        passed = [g for g in groups if g.low <= after]
        lost = {f for f, own in gone.items() if any(g.low <= h.high and g.high >= h.low for g in own for h in passed)}
        ranges = self._stand_in(gone, lost) if lost else None
        if ranges is None:
            return False
        for offsets in self._offsets(path, [g.index for g in passed]):
            offsets = offsets[offsets <= after]
            inside = np.zeros(len(offsets), bool)
            for r in ranges:
                inside |= (offsets >= r.low) & (offsets <= r.high)
            if not inside.all():
                return False
        return True

    def _stand_in(self, gone: dict[str, list[RowGroup]], lost: set[str]) -> list[RowGroup] | None:
        """The ranges of lost files, if files that came later hold their rows.

        All files that are gone and overlap count together, as one later row replaces one of them only. Later
        files must have exactly as many rows inside their ranges, and the ends of each; more rows may be
        new ones in place of lost ones, which is not told apart.
        """
        lost, reached = set(lost), list(lost)
        while reached:
            at = reached.pop()
            more = {f for f in gone if f not in lost and any(
                g.low <= h.high and g.high >= h.low for g in gone[f] for h in gone[at])}
            lost |= more
            reached += more
        ranges = [g for f in lost for g in gone[f]]
        ends = {x for g in ranges for x in (g.low, g.high)}
        came, held = min(self.seen.get(f, 0) for f in lost), 0
        filesystem, _ = open_filesystem(self.path)
        for file in self.present:
            if self.seen[file] > came:
                # A file of this listing may not be known yet.
                own = self._stored_groups({file})[file] if file in self.groups else footer_groups(filesystem, file, self.column)
                wanted = [g.index for g in own if any(g.low <= r.high and g.high >= r.low for r in ranges)]
                for offsets in self._offsets(file, wanted):
                    inside = np.zeros(len(offsets), bool)
                    for r in ranges:
                        inside |= (offsets >= r.low) & (offsets <= r.high)
                    held += int(inside.sum())
                    ends -= set(offsets[inside].tolist())
        return ranges if not ends and held == sum(g.rows for g in ranges) else None

    def _offsets(self, file: str, groups: list[int]):
        """The offsets in some row groups, without nulls."""
        import pyarrow.parquet as pq

        if not groups:
            return
        filesystem, _ = open_filesystem(self.path)
        with filesystem.open_input_file(file) as handle:
            for batch in pq.ParquetFile(handle).iter_batches(_BATCH_ROWS, row_groups=groups, columns=[self.column]):
                yield _numbers(batch.column(0)).drop_null().to_numpy(zero_copy_only=False)

    def commit(self, end: dict) -> None:
        """Nothing to release. See ``offset_update`` for telling others."""

    # -- executor side -----------------------------------------------------------

    def read(self, partition: OffsetSlice):
        import pyarrow as pa
        import pyarrow.compute as pc
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import to_arrow_schema

        filesystem, _ = open_filesystem(self.path)
        wanted = to_arrow_schema(self.schema)
        folders = partition_values(partition.path)
        with filesystem.open_input_file(partition.path) as handle:
            file = pq.ParquetFile(handle)
            stored = set(file.schema_arrow.names)
            columns = [c for c in dict.fromkeys([*wanted.names, self.column]) if c in stored]
            for batch in file.iter_batches(_BATCH_ROWS, row_groups=partition.groups, columns=columns):
                offsets = batch.column(self.column)
                offsets = _numbers(offsets)
                keep = pc.less_equal(offsets, partition.end)
                if partition.start is not None:
                    keep = pc.and_(keep, pc.greater(offsets, partition.start))
                batch = batch.filter(keep)
                if batch.num_rows:
                    arrays = [
                        batch.column(f.name).cast(f.type) if f.name in stored
                        else pa.array([folders.get(f.name)] * batch.num_rows, pa.string()).cast(f.type)
                        for f in wanted
                    ]
                    yield pa.RecordBatch.from_arrays(arrays, schema=wanted)


class OffsetDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return SOURCE_NAME

    def schema(self) -> str:
        raise ValueError("the source needs an explicit schema")

    def streamReader(self, schema: T.StructType) -> OffsetStreamReader:
        return OffsetStreamReader(schema, dict(self.options))


def read_stream_offsets(
    spark: SparkSession,
    source: str,
    offset_col: str,
    columns: list[str] | None = None,
    starting: str = LATEST,
    ending: object = None,
    schema: T.StructType | None = None,
    split_bytes: int = 128 << 20,
    fail_on_data_loss: bool = True,
    late: str | None = None,
    max_rows: int | None = None,
    max_bytes: int | None = None,
    checkpoint: str | None = None,
) -> DataFrame:
    """Stream the rows of a parquet folder, or of an append-only table, by ``offset_col``.

    ``source`` is a path (with a ``/``) or a table name.
    ``starting``: ``latest`` (only rows that arrive later), ``earliest``, or a JSON
    document ``{"offset": value}``. ``ending`` is the last offset to read in this run.
    The offset is a whole number, a date (days) or a timestamp (microseconds). Rows
    whose offset is null belong to no range and are never read. Only ``columns`` are
    read from the files. A file that vanishes before its rows were read fails the stream;
    with ``fail_on_data_loss=False`` its rows are left out instead.

    A file that comes with rows up to the end of a batch that is planned already is late. ``late="fail"`` (the
    default) fails the stream, ``"report"`` leaves such rows to ``late_rows``, ``"ignore"`` (the default with
    ``fail_on_data_loss=False``) drops them; its other rows are read as usual. ``max_rows`` and ``max_bytes``
    (as in the footers) cut a long history into many batches; under ``available_now`` a run is one batch
    then, so use ``processing_time`` and ``drain``.

    ``checkpoint``, the one that ``write_stream`` gets, is where an index of the files is kept. With it a restart reads no
    footer again, late files are found across restarts, and a batch that runs again reads the files of its first run. Without
    it these are known for one run.
    """
    if late not in (None, FAIL, REPORT, IGNORE):
        raise ValueError(f"late must be {FAIL}, {REPORT} or {IGNORE}, not {late!r}")
    if late == REPORT and not checkpoint:
        raise ValueError("late='report' needs checkpoint=")
    if any(limit is not None and limit < 1 for limit in (max_rows, max_bytes)):
        raise ValueError("max_rows and max_bytes must be at least 1")
    if "/" in source:
        path, stored = source, schema or spark.read.parquet(source).schema
    else:
        path, stored = table_info(spark, source).location, spark.table(source).schema
    # The same file for all processes, whatever the default file system is.
    filesystem, jvm_path = hadoop_path(spark, path)
    if not filesystem.exists(jvm_path):
        raise FileNotFoundError(f"no folder {path}")
    path = filesystem.makeQualified(jvm_path).toString()
    schema = schema or stored
    if offset_col in schema.names and not isinstance(schema[offset_col].dataType, _OFFSET_TYPES):
        raise ValueError(f"{offset_col} is no whole number, date or timestamp")
    if columns:
        schema = T.StructType([schema[c] for c in columns])
    spark.dataSource.register(OffsetDataSource)
    reader = (
        spark.readStream.format(SOURCE_NAME).schema(schema)
        .option("path", path).option("offset_col", offset_col)
        .option("starting", starting).option("split_bytes", str(split_bytes))
        .option("fail_on_data_loss", str(fail_on_data_loss).lower())
    )
    known: dict = {}
    if checkpoint:
        folder = hadoop_path(spark, f"{checkpoint.rstrip('/')}/{FOLDER}")
        folder = folder[0].makeQualified(folder[1]).toString()
        reader = reader.option("index", folder)
        _, known = FileIndex(*open_filesystem(folder)).load(None)
    files = [f for f in list_files(path) if f not in known]
    if len(files) > _FOOTERS_PER_TASK:
        reader = reader.option("footers", write_footers(spark, path, offset_col, files))
    for name, value in (("late", late), ("max_rows", max_rows), ("max_bytes", max_bytes)):
        if value is not None:
            reader = reader.option(name, str(value))
    if ending is not None:
        reader = reader.option("ending", json.dumps(_plain(ending)))
    return reader.load()
