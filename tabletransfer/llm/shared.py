"""What the operators share: a place for tables between jobs, and byte kernels.

The kernels work on the bytes of many texts at once, in NumPy, inside tasks.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable, Iterator
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one kernel call handles together; a longer text is handled alone.
SLICE_BYTES = 512 << 10

_U = np.uint64

#: Folders of the tables kept since the innermost ``settle`` began.
_INSIDE: ContextVar[list[str] | None] = ContextVar("inside", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Only a session that runs in one process may go without the setting; its warehouse
    then takes the tables.
    """
    folder = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_llm"
    return f"{folder.rstrip('/')}/llm-{spark.sparkContext.applicationId}"


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    This cuts the lineage: a lost executor costs its running tasks only, and a table that
    is used several times is computed once.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    inside = _INSIDE.get()
    if inside is not None:
        inside.append(path)
    return spark.read.schema(df.schema).parquet(path)


def settle(make: Callable[[], DataFrame], name: str) -> DataFrame:
    """``keep`` the rows that ``make`` returns, then delete all tables that were kept while it ran.

    Only the result may be used outside of ``make``: other rows made in it may read tables that are gone.
    """
    inside: list[str] = []
    token = _INSIDE.set(inside)
    try:
        df = keep(make(), name)
    finally:
        _INSIDE.reset(token)
    *gone, path = inside
    for old in gone:
        _delete(df.sparkSession, old)
    outside = _INSIDE.get()
    if outside is not None:
        outside.append(path)
    return df


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def clear(spark: SparkSession) -> None:
    """Delete the tables that the operators of this application wrote."""
    _delete(spark, shared_folder(spark))


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Only these columns; a missing one is an error that names it."""
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}; there are {', '.join(df.columns)}")
    return df.select(*names)


# --- bytes of texts ---------------------------------------------------------------


def text_slices(column: pa.Array, limit: int = SLICE_BYTES, rows: int = 4096) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds) for runs of at most ``rows`` rows and about ``limit`` bytes.

    ``bounds`` has one entry more than rows and starts at 0. Null counts as empty.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    n = len(column)
    if not n:
        return
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)
    offsets = offsets[column.offset:column.offset + n + 1].astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        end = min(max(end, first + 1), first + rows, n)
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit; works in place."""
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    x *= _U(0xD6E8FEB86659FD93)
    x ^= x >> _U(32)
    return x


class Rolling:
    """Polynomial hashes modulo 2**64 of any stretch of some bytes, by differences of prefix sums."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, seed: int = 1):
        base, values = self._base(seed)
        power, self._inverse = self._tables(base, len(data) + 1)
        self._sums = np.zeros(len(data) + 1, _U)
        np.cumsum(values[data] * power[:len(data)], out=self._sums[1:])

    @staticmethod
    @functools.lru_cache(None)
    def _base(seed: int) -> tuple[int, np.ndarray]:
        numbers = np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 64, 257, dtype=np.uint64)
        return int(numbers[256]) | 1, numbers[:256]

    @classmethod
    def _tables(cls, base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        known = cls._powers.get(base)
        if known is None or len(known[0]) < n:
            size = max(n, SLICE_BYTES + 1)
            both = []
            for b in (base, pow(base, -1, 1 << 64)):
                table = np.full(size, b, _U)
                table[0] = 1
                both.append(np.multiply.accumulate(table))
            known = cls._powers[base] = (both[0], both[1])
        return known

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self._sums[end] - self._sums[start]) * self._inverse[start])


#: A-Z as lower case, and which bytes are white space (space, 0x09-0x0D).
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


def words_of(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of each text, and the number of the first word of each text."""
    inside = ~SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate(([False], inside[:-1])) if len(data) else inside
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.concatenate((inside[1:], [False])) if len(data) else inside
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends, np.searchsorted(starts, bounds)
