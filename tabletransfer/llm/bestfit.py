"""Best-fit-decreasing packing of token ids into rows of a fixed length."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tabletransfer.llm.shared import plain
from tabletransfer.llm.tokens import VOCABULARY, encoder, token_ids

LENGTH, END_ID, PAD_ID = 1024, 0, 0
#: Pieces that are packed together within a task, which bounds its memory.
BLOCK_TOKENS = 2 << 20


class CapacityTree:
    """Segment tree over capacities 0..length: which of them some open row still has.

    A node is the number of open rows below it, so the least capacity that is large enough is found by one
    walk up and one down.
    """

    def __init__(self, length: int):
        self.leaves = 1 << length.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(length + 1)]

    def _add(self, capacity: int, by: int) -> None:
        node = capacity + self.leaves
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, capacity: int, row: int) -> None:
        self.rows[capacity].append(row)
        self._add(capacity, 1)

    def take(self, size: int) -> tuple[int, int] | None:
        """Remove and return (capacity, row) of the open row with the least capacity of at least ``size``."""
        node = size + self.leaves
        if not self.count[node]:
            while node > 1 and not (node % 2 == 0 and self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.rows[capacity].pop()


def best_fit_decreasing(sizes: np.ndarray, length: int) -> list[list[int]]:
    """For each row the numbers of the pieces in it, the longest first."""
    rows: list[list[int]] = []
    tree = CapacityTree(length)
    for piece in np.argsort(-sizes, kind="stable").tolist():
        size = int(sizes[piece])
        found = tree.take(size)
        if found is None:
            found = length, len(rows)
            rows.append([])
        capacity, row = found
        rows[row].append(piece)
        if capacity > size:
            tree.put(capacity - size, row)
    return rows


SCHEMA = ("sequence_id long, doc_ids array<long>, starts array<long>, cu_seqlens array<int>, n_tokens int, "
          "ids binary, positions binary")


def pack_matrix(docs: DataFrame, length: int = LENGTH, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row of ``length`` ids per sequence.

    ``ids`` and ``positions`` are ``length`` little-endian numbers of 16 bits (of 32 for a vocabulary beyond 65,536
    ids); padding is id 0 and position 0 after ``n_tokens``. ``cu_seqlens`` are the cumulative lengths of the segments
    from 0 on, ``doc_ids`` and ``starts`` say where each segment comes from, and positions restart at each
    segment. Every document's ids are followed by id 0. A document longer than a row is split into full rows and a
    rest, without loss. A null text is empty and so only id 0; repeated rows are packed each. Further columns are not
    read. Tasks pack their own documents, in blocks; nothing is shuffled.
    """
    width = np.dtype("<u2") if max(encoder(vocabulary).n_vocab, length) <= 1 << 16 else np.dtype("<u4")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base = TaskContext.get().partitionId() << 33
        done = 0
        pieces: list[tuple] = []
        held = 0

        def block() -> Iterator[pa.RecordBatch]:
            nonlocal done
            rows = best_fit_decreasing(np.array([len(p[2]) for p in pieces], np.int64), length)
            for at in range(0, len(rows), 1024):
                some = rows[at:at + 1024]
                ids = np.full((len(some), length), PAD_ID, width)
                positions = np.zeros((len(some), length), width)
                ends = []
                for k, row in enumerate(some):
                    end = [0]
                    for piece in row:
                        own = pieces[piece][2]
                        ids[k, end[-1]:end[-1] + len(own)] = own
                        positions[k, end[-1]:end[-1] + len(own)] = np.arange(len(own))
                        end.append(end[-1] + len(own))
                    ends.append(end)
                yield pa.RecordBatch.from_arrays([
                    pa.array(base + done + np.arange(len(some))),
                    pa.array([[pieces[p][0] for p in row] for row in some], pa.list_(pa.int64())),
                    pa.array([[pieces[p][1] for p in row] for row in some], pa.list_(pa.int64())),
                    pa.array(ends, pa.list_(pa.int32())), pa.array([e[-1] for e in ends], pa.int32()),
                    pa.array([r.tobytes() for r in ids], pa.binary()), pa.array([r.tobytes() for r in positions], pa.binary())],
                    names=["sequence_id", "doc_ids", "starts", "cu_seqlens", "n_tokens", "ids", "positions"])
                done += len(some)

        for batch in batches:
            for doc_id, own in zip(batch.column(0).to_pylist(), token_ids(batch.column(1), vocabulary)):
                own = np.append(own, END_ID).astype(width)
                pieces.extend((doc_id, at, own[at:at + length]) for at in range(0, len(own), length))
                held += len(own)
                if held >= BLOCK_TOKENS:
                    yield from block()
                    pieces, held = [], 0
        if pieces:
            yield from block()

    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(packed, SCHEMA)
