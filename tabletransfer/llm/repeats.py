"""Repeated passages of 200 bytes, found with run-length Burrows-Wheeler indexes.

A corpus is too large for one index, so it is dealt into many. Every 200-byte string has a
*minimizer*: the least hash among its 32-byte parts, the same wherever the string occurs. A
segment is a stretch of a text whose windows share their minimizer; equal strings lie in segments of
equal minimizers, so segments can be indexed group by group without losing a match.

* A minimizer that occurs once, in one segment, holds no repeated string.
* Segments equal to the byte are one text with a multiplicity, so copies are indexed once.
* Groups with different segments go into indexes of about a megabyte. Each is a run-compressed
  transform with the text positions of run starts and ends, and matching statistics are
  streamed from those samples.
* A group too large for one index is dealt into smaller pieces that are indexed in their turn: windows whose
  hash occurs once are cut off and equal stretches of the others merge, which leaves few as a rule; where
  many different stretches are left, each window is a piece and its hash the group.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tabletransfer.llm.shared import Rolling, keep, mix, plain, settle, text_slices

LENGTH, GRAM = 200, 32
#: Longest segment in windows; longer stretches of one minimizer are several segments.
MOST_WINDOWS = 512
#: Bytes of an index on average, and the most different segments of one group that go into one.
INDEX_BYTES, GROUP_SEGMENTS = 1 << 20, 4096
_SEPARATOR = 255  # no byte of UTF-8 text


# --- segments -----------------------------------------------------------------------


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 32 bytes from each position on."""
    values = Rolling._base(3)[1][data]
    factor = 0xC2B2AE3D27D4EB4F
    width = 1
    while width < GRAM:
        values = values[:-width] * np.uint64(factor) + values[width:]
        factor = factor * factor % (1 << 64)
        width *= 2
    return mix(values)


def _sliding(values: np.ndarray, need: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``need`` values in a row."""
    width = 1
    while 2 * width <= need:
        values = pick(values[:-width], values[width:])
        width *= 2
    return pick(values[:len(values) - (need - width)], values[need - width:])


def segments(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """First window, number of windows, minimizer and whether that occurs again inside, of each
    segment of one run of bytes."""
    grams = _gram_hashes(data)
    need = LENGTH - GRAM + 1
    least = _sliding(grams, need, np.minimum)
    change = np.concatenate(([0], np.flatnonzero(least[1:] != least[:-1]) + 1))
    size = np.diff(np.append(change, len(least)))
    parts = -(-size // MOST_WINDOWS)
    of = np.repeat(np.arange(len(change)), parts)
    k = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    first, key = change[of] + k * MOST_WINDOWS, least[change][of]
    count = np.minimum(size[of] - k * MOST_WINDOWS, MOST_WINDOWS)
    # Where a minimizer stands: the gram is the least of some window around it.
    none = np.zeros(need - 1, np.uint64)
    chosen = np.flatnonzero(grams == _sliding(np.concatenate((none, least, none)), need, np.maximum))
    kinds, kind = np.unique(grams[chosen], return_inverse=True)
    place = np.sort(kind * (len(data) + 1) + chosen)
    own = np.searchsorted(kinds, key) * (len(data) + 1) + first
    again = np.searchsorted(place, own + count + need - 1) - np.searchsorted(place, own) > 1
    return first, count, key, again


def _segmented(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc_id, tag, place, minimizer, content`` of every segment. ``place`` packs 32 bits for the first
    window, one for a minimizer that occurs again inside and 10 for the number of windows."""
    for batch in batches:
        for row, end, data, bounds in text_slices(batch.column(1)):
            docs, places, keys, contents = [], [], [], []
            if len(data) >= LENGTH:
                first, count, least, again = segments(data)
                # Windows that reach into the next text are cut off.
                owner = np.searchsorted(bounds, first, side="right") - 1
                last = np.searchsorted(bounds, first + count - 1, side="right") - 1
                parts = last - owner + 1
                of = np.repeat(np.arange(len(first)), parts)
                text = owner[of] + np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
                begin = np.maximum(first[of], bounds[text])
                stop = np.minimum(first[of] + count[of], bounds[text + 1] - LENGTH + 1)
                good = stop > begin
                text, begin, count, least, again = (
                    text[good], begin[good], (stop - begin)[good], least[of][good], again[of][good])
                content = Rolling(data).of(begin, begin + count + LENGTH - 1)
                place = ((begin - bounds[text]) << 11) | (again.astype(np.int64) << 10) | (count - 1)
                docs, places, keys, contents = row + text, place, least.view(np.int64), content.view(np.int64)
            of_row = pa.array(docs, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(of_row), batch.column(2).take(of_row), pa.array(places, pa.int64()),
                 pa.array(keys, pa.int64()), pa.array(contents, pa.int64())],
                names=["doc_id", "tag", "place", "minimizer", "content"])


# --- the index -----------------------------------------------------------------------


class RunIndex:
    """Run-length Burrows-Wheeler transform of some bytes with sampled run ends.

    ``heads`` are the transform's characters per run, ``lengths`` the runs' lengths;
    ``starts`` and ``ends`` are the text positions sampled at each run's first and last row,
    and ``above`` and ``below`` the common prefixes of those rows with the row before and after.
    """

    def __init__(self, text: np.ndarray):
        n = len(text)
        padded = np.concatenate((text.astype(np.uint64), np.zeros(8, np.uint64)))
        key = np.zeros(n, np.uint64)
        for k in range(8):
            key = (key << np.uint64(8)) | padded[k:k + n]
        self._key, self._levels = key, []
        order = np.argsort(key)  # equal ones have one rank, so any order of theirs will do
        rank = np.empty(n, np.int64)
        tied = self._ranked(rank, order, key[order], np.arange(n))
        width = 8
        self._levels.append((width, rank.copy()))
        while len(tied):  # places of the order that are shared; what has a place of its own keeps it
            these = order[tied]
            after = np.where(these + width < n, rank[np.minimum(these + width, n - 1)] + 1, 0)
            both = rank[these] * (n + 1) + after
            again = np.argsort(both)
            order[tied] = these[again]
            tied = self._ranked(rank, order[tied], both[again], tied)
            width *= 2
            self._levels.append((width, rank.copy()))
        bwt = text[order - 1]  # the row of the whole text has the last character
        turn = bwt[1:] != bwt[:-1]
        origin = int(np.flatnonzero(order == 0)[0])
        if origin:
            turn[origin - 1] = True
        if origin < n - 1:
            turn[origin] = True
        first = np.concatenate(([0], np.flatnonzero(turn) + 1))
        last = np.append(first[1:] - 1, n - 1)
        self.size, self.heads, self.lengths = n, bwt[first], last - first + 1
        self.starts, self.ends = order[first], order[last]
        self.above = self._common(self.starts, order[np.maximum(first - 1, 0)], first > 0)
        self.below = self._common(self.ends, order[np.minimum(last + 1, n - 1)], last < n - 1)
        del self._key, self._levels

    @staticmethod
    def _ranked(rank: np.ndarray, these: np.ndarray, ordered: np.ndarray, places: np.ndarray) -> np.ndarray:
        """Rank these positions, which stand in the order of ``ordered`` at ``places``, by how many have a smaller
        key. Returns the places of equal ones."""
        new = np.concatenate(([True], ordered[1:] != ordered[:-1]))
        rank[these] = places[np.maximum.accumulate(np.where(new, np.arange(len(these)), 0))]
        return places[~(new & np.append(new[1:], True))]

    def _common(self, a: np.ndarray, b: np.ndarray, there: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at a and b, by the ranks of ever shorter prefixes."""
        n = self.size
        a, b, length = a.copy(), b.copy(), np.zeros(len(a), np.int64)
        for width, rank in reversed(self._levels):
            fits = (a + width <= n) & (b + width <= n)
            same = fits & (rank[np.minimum(a, n - 1)] == rank[np.minimum(b, n - 1)])
            step = np.where(same, width, 0)
            a, b, length = a + step, b + step, length + step
        left = np.minimum(n - np.maximum(a, b), 8)
        inside = left > 0
        differ = self._key[np.minimum(a, n - 1)] ^ self._key[np.minimum(b, n - 1)]
        equal = np.zeros(len(a), np.int64)
        for k in range(8):
            equal += (differ >> np.uint64(8 * (7 - k))) == 0
        return np.where(there, length + np.where(inside, np.minimum(equal, left), 0), 0)

    def matching_statistics(self) -> np.ndarray:
        """For each position the longest match with any other position, streamed in text order.

        A row inside a run has the character of its neighbour before it, so both move on
        together and the match shortens by one: values at samples give all others.
        """
        longest = np.zeros(self.size, np.int64)
        at = np.arange(self.size)
        for sampled, value in ((self.starts, self.above), (self.ends, self.below)):
            known = np.zeros(self.size, np.int64)
            known[sampled] = value + sampled
            is_sample = np.zeros(self.size, bool)
            is_sample[sampled] = True
            source = np.maximum.accumulate(np.where(is_sample, at, 0))
            np.maximum(longest, known[source] - at, out=longest)
        return longest


def _ranges(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    edge = np.diff(np.concatenate(([0], marked.astype(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def repeated_windows(texts: list[bytes], copies: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the text, from, to) of its windows that occur elsewhere in these texts."""
    joined = np.frombuffer(bytes([_SEPARATOR]).join(texts) + bytes([_SEPARATOR]), np.uint8)
    longest = RunIndex(joined).matching_statistics()
    end = np.cumsum([len(t) + 1 for t in texts]) - 1
    for k, text in enumerate(texts):
        begin = end[k] - len(text)
        windows = len(text) - LENGTH + 1
        marked = (longest[begin:begin + windows] >= LENGTH) | (copies[k] > 1)
        yield k, *_ranges(marked)


_MARKS = "minimizer long, content long, low int, high int"


def _indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of their minimizer and content; whole groups are indexed together, and what
    a repeated row of the table brings again is left out."""
    rows: list[tuple] = []
    size = 0

    def done() -> pa.RecordBatch:
        found = [(rows[k][0], rows[k][1], lo, hi)
                 for k, low, high in repeated_windows([r[3] for r in rows], np.array([r[2] for r in rows]))
                 for lo, hi in zip(low.tolist(), high.tolist())]
        columns = list(zip(*found)) or [[]] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int32(), pa.int32()))],
            names=["minimizer", "content", "low", "high"])

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if rows and row[:2] == rows[-1][:2]:
                continue
            if size >= INDEX_BYTES and row[0] != rows[-1][0]:
                yield done()
                rows, size = [], 0
            rows.append(row)
            size += len(row[3]) + 1
    if rows:
        yield done()


def _hashed_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per window of each segment, with the hash of its 200 bytes."""
    for batch in batches:
        for minimizer, content, n, data in zip(*(c.to_pylist() for c in batch.columns)):
            at = np.arange(len(data) - LENGTH + 1)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x] * len(at), pa.int64()) for x in (minimizer, content, n)]
                + [pa.array(at, pa.int32()),
                   pa.array(Rolling(np.frombuffer(data, np.uint8), 2).of(at, at + LENGTH).view(np.int64))],
                names=["minimizer", "content", "n", "low", "hash"])


_PIECES = "of_minimizer long, of_content long, shift int, minimizer long, content long, n long, bytes binary"


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The stretches of the listed windows of each segment, or each window where none are listed; those have their
    hash for a group, stretches the minimizer."""
    for batch in batches:
        for minimizer, content, n, data, lows in zip(*(c.to_pylist() for c in batch.columns)):
            raw = np.frombuffer(data, np.uint8)
            if lows is None:
                first = np.arange(len(data) - LENGTH + 1)
                last = first + LENGTH
                group = Rolling(raw, 2).of(first, last).view(np.int64)
            else:
                listed = np.zeros(len(data), bool)
                listed[lows] = True
                first, stop = _ranges(listed)
                last = stop + LENGTH - 1
                group = np.full(len(first), minimizer, np.int64)
            own = Rolling(raw).of(first, last).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([minimizer] * len(first), pa.int64()), pa.array([content] * len(first), pa.int64()),
                 pa.array(first, pa.int32()), pa.array(group), pa.array(own), pa.array([n] * len(first), pa.int64()),
                 pa.array([data[lo:hi] for lo, hi in zip(first.tolist(), last.tolist())], pa.binary())],
                names=["of_minimizer", "of_content", "shift", "minimizer", "content", "n", "bytes"])


# --- spans and what is left -------------------------------------------------------------


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``minimizer, content, n, bytes`` of the wanted segments of each text."""
    for batch in batches:
        out: list[tuple] = []
        for text, wanted in zip(batch.column(0), batch.column(1)):
            data = text.as_buffer().to_pybytes()
            for w in wanted.as_py():
                begin = (w["place"] >> 11) & 0xFFFFFFFF
                out.append((w["minimizer"], w["content"], w["n"],
                            data[begin:begin + (w["place"] & 1023) + LENGTH]))
            if sum(len(o[3]) for o in out) > 8 << 20 or len(out) > 20_000:
                yield _bytes_batch(out)
                out = []
        yield _bytes_batch(out)


def _bytes_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))],
        names=["minimizer", "content", "n", "bytes"])


def _tag_of(text) -> Column:
    """Tells texts of one id apart, by all 64 bits."""
    return F.xxhash64(text)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, tag, spans``: per document that has any, the ranges of its repeated windows.

    A range is ``low, high`` in bytes: windows start from ``low`` up to before ``high``.
    """
    docs = plain(docs, "doc_id", "text").withColumn("tag", _tag_of("text"))
    shared = settle(lambda: _shared(docs), "shared")
    mixed = shared.where("mixed")
    marks = settle(lambda: _mixed_marks(docs, mixed), "marks")

    begin = F.shiftrightunsigned("place", 11).bitwiseAND(F.lit(0xFFFFFFFF)).cast("int")
    whole = shared.where("not mixed").select(
        "doc_id", "tag", begin.alias("low"), (begin + F.col("place").bitwiseAND(F.lit(1023)).cast("int") + 1).alias("high"))
    partly = mixed.join(marks, ["minimizer", "content"]).select(
        "doc_id", "tag", (begin + F.col("low")).alias("low"), (begin + F.col("high")).alias("high"))
    # A row that is repeated finds each span as often; the set drops them in each task already.
    return whole.union(partly).groupBy("doc_id", "tag").agg(F.collect_set(F.struct("low", "high")).alias("spans"))


def _shared(docs: DataFrame) -> DataFrame:
    """The segments whose minimizer occurs twice; ``mixed`` are those of groups that need an index."""
    found = keep(docs.where(F.octet_length("text") >= LENGTH).mapInArrow(
        _segmented, "doc_id long, tag long, place long, minimizer long, content long"), "segments")
    groups = found.groupBy("minimizer").agg(
        F.count("*").alias("times"), F.min("content").alias("one"), F.max("content").alias("other"),
        F.max(F.col("place").bitwiseAND(F.lit(1024))).alias("again"))
    groups = groups.where("times > 1 or again > 0").select("minimizer", F.expr("one != other or times = 1").alias("mixed"))
    return found.join(groups, "minimizer")


def _mixed_marks(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """``minimizer, content, low, high``: the repeated windows of the mixed segments, cut out of the texts."""
    wanted = keep(mixed.groupBy("minimizer", "content").agg(
        F.first("doc_id").alias("doc_id"), F.first("tag").alias("tag"), F.first("place").alias("place"), F.count("*").alias("n")), "wanted")
    per_text = wanted.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("place", "minimizer", "content", "n")).alias("wanted"))
    same = F.col("a.doc_id").eqNullSafe(F.col("b.doc_id")) & (F.col("a.tag") == F.col("b.tag"))
    cut = (docs.alias("a").join(per_text.alias("b"), same).select("a.text", "b.wanted")
           .mapInArrow(_cut_out, "minimizer long, content long, n long, bytes binary"))
    return _marks(cut, wanted)


def _marks(cut: DataFrame, counted: DataFrame, level: int = 0) -> DataFrame:
    """``minimizer, content, low, high``: the repeated windows of the segments ``cut``, all found by indexes.

    ``counted`` has one row per different segment. Groups within the bound go into indexes as they are. Of the others
    the pieces do: stretches of windows whose hash occurs twice (``level`` 0), then single windows (1), of
    which those with equal bytes are one row, so that the last groups need no bound.
    """
    large = keep(counted.groupBy("minimizer").count().where(F.col("count") > GROUP_SEGMENTS).select("minimizer"), "large")
    if level == 2 or large.isEmpty():
        return _by_index(cut)
    if level == 0:
        cut = keep(cut, "cut")  # it is read twice, and takes a shuffle of all texts
    hot = keep(cut.join(large, "minimizer", "left_semi").dropDuplicates(["minimizer", "content"]), "hot")
    if level == 0:
        windows = keep(hot.mapInArrow(_hashed_windows, "minimizer long, content long, n long, low int, hash long"), "windows")
        often = windows.groupBy("minimizer", "hash").agg(F.sum("n").alias("n")).where("n > 1").drop("n")
        lows = windows.join(often, ["minimizer", "hash"]).groupBy("minimizer", "content").agg(F.collect_list("low").alias("lows"))
        hot = hot.join(lows, ["minimizer", "content"])
    else:
        hot = hot.withColumn("lows", F.lit(None).cast("array<int>"))
    pieces = keep(hot.select("minimizer", "content", "n", "bytes", "lows").mapInArrow(_pieces, _PIECES), "pieces")
    different = keep(
        pieces.groupBy("minimizer", "content").agg(F.sum("n").alias("n"), F.first("bytes").alias("bytes")), "different")
    found = _marks(different, different, level + 1)
    back = pieces.drop("n", "bytes").join(found, ["minimizer", "content"]).select(
        F.col("of_minimizer").alias("minimizer"), F.col("of_content").alias("content"),
        (F.col("shift") + F.col("low")).alias("low"), (F.col("shift") + F.col("high")).alias("high"))
    return _by_index(cut.join(large, "minimizer", "left_anti")).union(back)


def _by_index(cut: DataFrame) -> DataFrame:
    return (cut.select("minimizer", "content", "n", "bytes").repartition("minimizer")
            .sortWithinPartitions("minimizer", "content").mapInArrow(_indexed, _MARKS))


def _kept_parts(data: np.ndarray, spans) -> tuple[np.ndarray, int]:
    """Which bytes stay, and how many runs are removed."""
    edge = np.zeros(len(data) + 1, np.int64)
    if spans.is_valid:
        low = spans.values.field(0).to_numpy()
        high = spans.values.field(1).to_numpy()
        np.add.at(edge, low, 1)
        np.add.at(edge, high + LENGTH - 1, -1)
    gone = np.cumsum(edge)[:-1] > 0
    return ~gone, len(_ranges(gone)[0])


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows: list[tuple] = []
        for text, spans in zip(batch.column(1), batch.column(2)):
            data = np.frombuffer(text.as_buffer(), np.uint8) if text.is_valid else np.zeros(0, np.uint8)
            stay, runs = _kept_parts(data, spans)
            rows.append((len(data), int(len(data) - stay.sum()), runs, sha256(data[stay].tobytes()).hexdigest()))
        columns = list(zip(*rows)) or [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [batch.column(0)] + [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _with_spans(docs: DataFrame) -> DataFrame:
    spans = repeated_spans(docs).select(F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag"), F.col("spans").alias("_spans"))
    same = docs["doc_id"].eqNullSafe(F.col("_doc")) & (_tag_of(docs["text"]) == F.col("_tag"))
    return docs.join(spans, same, "left")


def repeats(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` of every document.

    A byte is removed if a 200-byte string that covers it also starts anywhere else, in the same text or
    another; all is judged on the input. Null counts as empty; texts below 200 bytes keep all.
    Repeated rows are copies of each other. Further columns are not read.
    """
    docs = plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    return _with_spans(docs).select("doc_id", "text", "_spans").mapInArrow(
        _digested, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _shortened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)):
            if text.is_valid and spans.is_valid:
                data = np.frombuffer(text.as_buffer(), np.uint8)
                texts.append(data[_kept_parts(data, spans)[0]].tobytes().decode(errors="ignore"))
            else:
                texts.append(text.as_py())
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-2], pa.array(texts, pa.string())], names=[*batch.schema.names[:-2], "text"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """The documents, all columns, with repeated passages cut out of ``text``.

    A character that a cut goes through is dropped whole.
    """
    names = docs.columns
    rest = [c for c in names if c != "text"]
    schema = docs.select(*rest, "text").schema
    return _with_spans(docs).select(*rest, "text", "_spans").mapInArrow(_shortened, schema).select(*names)
