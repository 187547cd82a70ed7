"""Mixture-controlled packing: deficit round-robin over source queues, in closed form.

Every source is a queue of its documents' tokens, served in turns of ``TURN`` tokens. The
k-th turn of a queue is due when its deficit, which grows with its target share of all tokens
that are sent, has reached half of that turn. Serving turns in the order of their due times keeps each
source within about a turn of its target at every point of the stream, and cutting the
stream every ``length`` tokens fills each window. As the order is known from the queues' totals
alone, each task finds the places of its own documents' turns without seeing others': deficits
carry over windows and partitions alike. Where the queues are too many for every task to hold their
totals, the turns are sorted by their due times instead, and a prefix sum gives the same places.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tabletransfer.llm.shared import keep, plain
from tabletransfer.llm.tokens import VOCABULARY, encoder, token_ids

LENGTH, TURN = 1024, 128
#: With more sources than this tasks do not hold the totals of all queues; turns are sorted for their places.
MAX_QUEUES = 1024
#: Turns of a queue that are made together.
TURNS_TOGETHER = 4096
#: Follows each document's ids.
END_ID = 0


def _tokenized(vocabulary: str):
    width = np.dtype("<u2") if encoder(vocabulary).n_vocab <= 1 << 16 else np.dtype("<u4")

    def tokenized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, before = TaskContext.get().partitionId(), defaultdict(int)
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                starts, ids = [], []
                for queue, own in zip(batch.column(1).to_pylist(), token_ids(batch.column(2), vocabulary)):
                    starts.append(before[queue])
                    ids.append(np.append(own, END_ID).astype(width).tobytes())
                    before[queue] += len(own) + 1
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), batch.column(1), pa.array([part] * len(ids), pa.int64()),
                     pa.array(starts, pa.int64()), pa.array([len(i) // width.itemsize for i in ids], pa.int64()),
                     pa.array(ids, pa.binary())],
                    names=["doc_id", "queue", "part", "start", "n", "ids"])

    return tokenized, width


def stream_places(turns: np.ndarray, queue: np.ndarray, rates: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """Where in the stream of all tokens the given turns of the given queues begin.

    That is how many tokens all queues have sent before; equal due times go by queue number. Due
    times are compared as the same floating-point numbers everywhere, so the order is one
    and the same in all tasks.
    """
    due = (turns + 0.5) / rates[queue]
    places = np.zeros(len(turns), np.int64)
    for other, (rate, total) in enumerate(zip(rates, totals)):
        most = -(-total // TURN)
        sent = np.clip(np.floor(due * rate + 0.5), 0, most).astype(np.int64)

        def first(k):
            time = (k + 0.5) / rate
            return (time < due) | ((time == due) & (other < queue))  # noqa: B023

        for _ in range(2):
            sent -= (sent > 0) & ~first(sent - 1)
            sent += (sent < most) & first(sent)
        sent = np.where(queue == other, turns, sent)
        places += np.minimum(sent * TURN, total)
    return places


def _pieces(start: np.ndarray, n: np.ndarray, places, length: int) -> tuple[np.ndarray, ...]:
    """Document number, start in it, length, place in the stream of every piece of these documents.

    ``places`` gives the places of turns, for their numbers and those of their documents, which it gets in order.
    """

    def split(begin, count, size):
        """Stretches cut at multiples of ``size``: number of the stretch, begin and count of its parts."""
        low, parts = begin // size, (begin + count - 1) // size - begin // size + 1
        of = np.repeat(np.arange(len(begin)), parts)
        k = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.maximum(begin[of], k * size)
        return of, first, np.minimum(begin[of] + count[of], (k + 1) * size) - first, k

    doc, first, count, turn = split(start, n, TURN)
    place = places(turn, doc) + first - turn * TURN
    # Neighbouring turns of one document become one stretch before windows are cut.
    joined = np.zeros(len(doc), bool)
    joined[1:] = (doc[1:] == doc[:-1]) & (place[1:] == place[:-1] + count[:-1])
    head = np.flatnonzero(~joined)
    doc, inside, place = doc[head], (first - start[doc])[head], place[head]
    count = np.add.reduceat(count, head) if len(head) else count[:0]
    of, at, size, _ = split(place, count, length)
    return doc[of], inside[of] + at - place[of], size, at


def _sorted_places(totals: DataFrame) -> DataFrame:
    """``queue, turn, place`` of every turn of queues with ``queue, total, rate``, what ``stream_places`` finds.

    Turns are sorted over all tasks by due time, queue and number; each sorted part adds up its own sizes, and the
    sums of the parts, one row a part, give where each begins.
    """
    most = F.ceil(F.col("total") / TURN).cast("long")
    blocks = totals.select("queue", "total", "rate", most.alias("most"), F.explode(F.sequence(
        F.lit(0).cast("long"), F.floor((most - 1) / TURNS_TOGETHER).cast("long"))).alias("block")).repartition("queue", "block")
    first = F.col("block") * TURNS_TOGETHER
    turns = blocks.select("queue", "total", "rate", F.explode(F.sequence(
        first, F.least(first + TURNS_TOGETHER, "most") - 1)).alias("turn"))
    ordered = turns.select(((F.col("turn") + 0.5) / F.col("rate")).alias("due"), "queue", "turn", F.least(
        F.lit(TURN).cast("long"), F.col("total") - F.col("turn") * TURN).alias("size")).orderBy("due", "queue", "turn")

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, before = TaskContext.get().partitionId(), 0
        for batch in batches:
            size = batch.column(3).to_numpy()
            sums = before + np.cumsum(size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(1), batch.column(2), pa.array(size), pa.array(sums - size), pa.array(np.full(len(size), run))],
                names=["queue", "turn", "size", "before", "run"])
            before = sums[-1] if len(sums) else before

    rows = keep(ordered.mapInArrow(summed, "queue string, turn long, size long, before long, run long"), "turns")
    earlier = Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("run").agg(F.sum("size").alias("size")).select(
        "run", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("base"))
    return rows.join(F.broadcast(runs), "run").select("queue", "turn", (F.col("base") + F.col("before")).alias("place"))


def _with_places(ready: DataFrame, totals: DataFrame) -> DataFrame:
    """The documents with ``places``, those of their turns in order."""
    turn = F.explode(F.sequence(F.floor(F.col("start") / TURN).cast("long"),
                                F.floor((F.col("start") + F.col("n") - 1) / TURN).cast("long"))).alias("turn")
    # Where a document starts in its queue tells it apart, as each has one id at least.
    of_doc = (ready.select("queue", "start", turn).join(_sorted_places(totals), ["queue", "turn"])
              .groupBy("queue", "start").agg(F.sort_array(F.collect_list(F.struct("turn", "place"))).alias("turns"))
              .select("queue", "start", F.col("turns.place").alias("places")))
    return ready.join(of_doc, ["queue", "start"])


def pack(docs: DataFrame, length: int = LENGTH, weights: dict[str, float] | None = None,
         vocabulary: str = VOCABULARY, with_ids: bool = False) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, queue`` of every piece.

    Each document's ids are followed by id 0; every id lies in exactly one piece, and every sequence
    but the last is full. ``weights`` gives the sources' shares of the tokens; without it, and for
    sources not in it (which then weigh 1 token each per token they have), a source's share is that
    of its tokens, so all queues end together. When a queue is empty the others go on in their proportions.
    Every source is a queue, however many there are; the column ``queue`` names it. ``with_ids`` adds the ids of each piece as ``ids array<int>``. Null texts are empty, a
    null source is a queue of its own, repeated rows are packed each. Further columns are not read.
    """
    source = F.col("source").cast("string")
    docs = plain(docs, "doc_id", "source", "text").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("queue"),
        "text")
    tokenized, width = _tokenized(vocabulary)
    tokens = keep(docs.mapInArrow(
        tokenized, "doc_id long, queue string, part long, start long, n long, ids binary"), "tokens")
    per_part = keep(tokens.groupBy("queue", "part").agg(F.sum("n").alias("n")), "queues")
    sums = keep(per_part.groupBy("queue").agg(F.sum("n").alias("total")), "totals")
    many = sums.limit(MAX_QUEUES + 1).count() > MAX_QUEUES
    total = {} if many else {r["queue"]: r["total"] for r in sums.collect()}
    names = sorted(total)
    totals = np.array([total[q] for q in names], np.int64)
    rates = np.array([(weights or {}).get(q[1:], total[q]) for q in names], np.float64) / TURN
    sent = docs.sparkSession.sparkContext.broadcast(({q: k for k, q in enumerate(names)}, rates, totals))
    earlier = Window.partitionBy("queue").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = per_part.select("queue", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rates, totals = sent.value
        for whole in batches:
            for at in range(0, whole.num_rows, 512):
                batch = whole.slice(at, 512)
                doc_id, queue, start, n, ids = batch.columns[:5]
                if many:
                    flat = batch.column(5).flatten().to_numpy()
                    places = lambda turn, doc: flat  # noqa: B023, E731
                else:
                    own = np.array([number[q] for q in queue.to_pylist()], np.int64)
                    places = lambda turn, doc: stream_places(turn, own[doc], rates, totals)  # noqa: B023, E731
                doc, inside, size, place = _pieces(start.to_numpy(), n.to_numpy(), places, length)
                wide = [np.frombuffer(i.as_buffer(), width).astype("<u4") for i in ids]
                cut = [wide[d][a:a + s] for d, a, s in zip(doc.tolist(), inside.tolist(), size.tolist())]
                columns = [
                    doc_id.take(pa.array(doc)), pa.array(inside), pa.array(size),
                    pa.array([zlib.crc32(c) for c in cut], pa.int64()), n.take(pa.array(doc)),
                    pa.array(place // length), pa.array(place % length), queue.take(pa.array(doc))]
                names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "queue"]
                if with_ids:
                    columns.append(pa.array(cut, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    ready = tokens.join(bases, ["queue", "part"]).select("doc_id", "queue", (F.col("start") + F.col("base")).alias("start"), "n", "ids")
    columns = ["doc_id", "queue", "start", "n", "ids"]
    if many:
        rate = F.col("total").cast("double")
        if weights:
            names = docs.sparkSession.createDataFrame(
                [(f"={s}", float(w)) for s, w in weights.items()] + [("", float(w)) for s, w in weights.items() if s == ""],
                "queue string, weight double")
            sums = sums.join(names, "queue", "left")
            rate = F.coalesce("weight", rate)
        ready = _with_places(ready, sums.select("queue", "total", (rate / TURN).alias("rate")))
        columns.append("places")
    ready = ready.select(*columns)
    schema = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
              "queue string" + ", ids array<int>" * with_ids)
    return ready.mapInArrow(placed, schema)
