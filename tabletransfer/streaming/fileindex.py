"""What a stream knows of its files, kept next to its checkpoint, and the files that came too late.

A file belongs to a stream from the moment a batch is planned after it was listed. The index says for each file how far
batches had been planned by then (``after``): its rows up to there were missed, those beyond are read. So a
batch that is run again reads the files it was planned with, whatever came since.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F

from tabletransfer.session import hadoop_path

FOLDER = "files"
#: So many increments are merged into one.
MERGE_AT = 32

_SCHEMA = pa.schema([("path", pa.string()), ("index", pa.int32()), ("low", pa.int64()), ("high", pa.int64()),
                     ("size", pa.int64()), ("rows", pa.int64()), ("after", pa.int64())])


@dataclass(slots=True)
class RowGroup:
    index: int
    low: int
    high: int
    size: int
    rows: int


@dataclass
class Plan:
    """The newest planned batch, ``start`` < offset <= ``end``, and where the first one started."""

    first: int | None
    start: int | None
    end: int | None


class FileIndex:
    """Small parquet files with the row groups of new files, and a note of the newest plan. One stream writes it."""

    def __init__(self, filesystem, folder: str):
        self.filesystem, self.folder = filesystem, folder.rstrip("/")
        self._parts: list[str] = []

    def _list(self) -> list[str]:
        from pyarrow import fs

        found = self.filesystem.get_file_info(fs.FileSelector(self.folder, allow_not_found=True))
        return sorted(f.path for f in found if f.base_name.startswith("index-") and f.base_name.endswith(".parquet"))

    def _put(self, name: str, write) -> str:
        """A file that appears whole, in place of an older one of that name."""
        self.filesystem.create_dir(self.folder, recursive=True)
        draft, final = f"{self.folder}/_{name}", f"{self.folder}/{name}"
        with self.filesystem.open_output_stream(draft) as out:
            write(out)
        self.filesystem.move(draft, final)
        return final

    def plan(self) -> Plan | None:
        from pyarrow import fs

        path = f"{self.folder}/plan.json"
        if self.filesystem.get_file_info(path).type != fs.FileType.File:
            return None
        with self.filesystem.open_input_stream(path) as source:
            return Plan(**json.loads(source.read()))

    def note(self, plan: Plan) -> None:
        text = json.dumps({"first": plan.first, "start": plan.start, "end": plan.end}).encode()
        self._put("plan.json", lambda out: out.write(text))

    def load(self, start: int | None) -> tuple[dict[str, list[RowGroup]], dict[str, int | None]]:
        """(row groups by file, ``after`` by file) of all files that are known; groups up to ``start`` are left out."""
        self._parts = self._list()
        groups: dict[str, list[RowGroup]] = {}
        after: dict[str, int | None] = {}
        for part in self._parts:
            known = set(after)
            table = pq.read_table(part, filesystem=self.filesystem, partitioning=None)
            for row in table.to_pylist():
                if row["path"] in known:  # a merge that did not end leaves a file twice
                    continue
                after[row["path"]] = row["after"]
                own = groups.setdefault(row["path"], [])
                if row["index"] is not None and (start is None or row["high"] > start):
                    own.append(RowGroup(row["index"], row["low"], row["high"], row["size"], row["rows"]))
        return groups, after

    def add(self, files: dict[str, list[RowGroup]], after: dict[str, int | None]) -> None:
        """Remember new files; one without rows in its groups has a row of its own."""
        rows = [(path, g.index, g.low, g.high, g.size, g.rows, after[path]) for path, groups in files.items() for g in groups]
        rows += [(path, None, None, None, None, None, after[path]) for path, groups in files.items() if not groups]
        number = int(self._parts[-1].rpartition("index-")[2].removesuffix(".parquet")) + 1 if self._parts else 0
        table = pa.Table.from_pylist([dict(zip(_SCHEMA.names, r)) for r in rows], _SCHEMA)
        if len(self._parts) + 1 >= MERGE_AT:
            parts = [pq.read_table(p, filesystem=self.filesystem, partitioning=None) for p in self._parts]
            table = pa.concat_tables([*parts, table]).sort_by([("high", "ascending")])
        part = self._put(f"index-{number:09d}.parquet", lambda out: pq.write_table(table, out))
        if len(self._parts) + 1 >= MERGE_AT:
            for old in self._parts:
                self.filesystem.delete_file(old)
            self._parts = []
        self._parts.append(part)


def _index_rows(spark: SparkSession, checkpoint: str) -> tuple[DataFrame, Plan | None]:
    folder = f"{checkpoint.rstrip('/')}/{FOLDER}"
    filesystem, path = hadoop_path(spark, f"{folder}/index-*.parquet")
    found = [f.getPath().toString() for f in filesystem.globStatus(path) or []]
    schema = "path string, index int, low long, high long, size long, rows long, after long"
    rows = spark.read.schema(schema).parquet(*found) if found else spark.createDataFrame([], schema)
    _, note = hadoop_path(spark, f"{folder}/plan.json")
    text = spark.read.text(note.toString(), wholetext=True).head()[0] if filesystem.exists(note) else None
    return rows.distinct(), Plan(**json.loads(text)) if text else None


def late_files(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``path, after, low, high``: files of a stream with rows that its batches had passed when they came."""
    rows, plan = _index_rows(spark, checkpoint)
    first = plan.first if plan else None
    late = rows.where("low <= after" if first is None else f"low <= after and high > {first}")
    return late.groupBy("path", "after").agg(F.min("low").alias("low"), F.max("high").alias("high"))


def late_rows(spark: SparkSession, checkpoint: str, offset_col: str, schema=None) -> DataFrame:
    """The rows that a stream with ``late="report"`` left out because their files came too late.

    Read from the files themselves by Spark, so together with the stream's target they are all rows. There are
    as many paths in the plan as late files.
    """
    files = late_files(spark, checkpoint)
    paths = [r.path for r in files.select("path").distinct().collect()]
    _, plan = _index_rows(spark, checkpoint)
    if not paths:
        if schema is None:
            raise ValueError("no file came late; give schema= for a table without rows")
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema) if schema is not None else spark.read
    plain = lambda path: F.regexp_replace(path, "^[a-z0-9]+:/+", "/")
    limits = files.select(plain(F.col("path")).alias("_late_path"), "after").withColumnRenamed("after", "_late_after")
    rows = reader.parquet(*paths).withColumn("_late_path", F.url_decode(plain(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))))
    # A row's offset as the stream counts it: days, microseconds or a whole number.
    kind = dict(rows.dtypes)[offset_col]
    offset = F.col(offset_col)
    if kind == "date":
        offset = F.unix_date(offset)
    elif kind.startswith("timestamp"):
        offset = F.unix_micros(offset.cast("timestamp")) if kind == "timestamp" else F.unix_micros(
            F.to_utc_timestamp(offset.cast("timestamp"), F.current_timezone()))
    wanted = rows.join(F.broadcast(limits) if len(paths) < 10_000 else limits, "_late_path").where(offset <= F.col("_late_after"))
    if plan and plan.first is not None:
        wanted = wanted.where(offset > plan.first)
    return wanted.drop("_late_path", "_late_after")
