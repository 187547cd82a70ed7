"""Byte-level BPE by prefixes: for each prefix of a piece the one last token that its encoding can end with.

A text is cut into pieces by the vocabulary's pattern, and each piece is encoded by itself. A piece's encoding is the chain
of last tokens from its end: the prefix before the last token ends with its own last token, and so on. A token t is the
last one of a prefix exactly where t alone is the prefix and stays one token, or where t and the last token u of the prefix
before it stay apart, that is where the bytes of u and t together are encoded as [u, t]. Merges only join
neighbours, so whether tokens stay apart is decided by each pair alone.

Last tokens depend on what lies before them only. So bytes may be appended without a change to what is known, and after an
edit the last tokens are the old ones again as soon as those of the longest token's length are.
"""

from __future__ import annotations

import base64
import functools
import re
import struct
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from tabletransfer.llm.shared import plain

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Pieces up to so many bytes are remembered by a task, and so many of them; pairs of tokens likewise.
SHORT, REMEMBERED = 64, 1 << 19
#: Bytes of texts in a batch of rows that a task hands on.
OUT_BYTES = 4 << 20
#: A pattern's match depends on no more characters beyond its end than this.
LOOKAHEAD = 2


class Vocabulary:
    """Tokens by rank. ``last_tokens`` and ``ids_of`` are the encoder, ``decode`` the way back."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self._pattern = ranks, regex.compile(pattern)
        self._stand_ins = stand_ins()
        self._odd = re.compile("[" + _ranges(self._stand_ins) + "]" if self._stand_ins else "(?!)")
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a vocabulary needs every single byte")
        self.longest = max(map(len, ranks))
        self.lengths = np.array([len(t) for t in self.tokens], np.int64)
        self._sizes = self.lengths.tolist()
        self._bytes = np.frombuffer(b"".join(self.tokens), np.uint8)
        self._starts = np.cumsum(self.lengths) - self.lengths
        # Latin-1 gives each byte a character of its own.
        self._suffixes = ahocorasick.Automaton()
        for token, rank in ranks.items():
            self._suffixes.add_word(token.decode("latin-1"), rank)
        self._suffixes.make_automaton()
        self._apart: dict[int, bool] = {}
        self._known: dict[str, bytes] = {}

    def _merged(self, data: bytes) -> list[bytes]:
        """The definition: join the neighbours of the lowest rank, the leftmost first, until none can be joined.
        Used for the bytes of one or two tokens only."""
        parts, rank, none = [data[i:i + 1] for i in range(len(data))], self.ranks.get, len(self.tokens)
        pairs = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while pairs and (least := min(pairs)) < none:
            at = pairs.index(least)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del pairs[at]
            if at:
                pairs[at - 1] = rank(parts[at - 1] + parts[at], none)
            if at < len(pairs):
                pairs[at] = rank(parts[at] + parts[at + 1], none)
        return parts

    def stay_apart(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: nothing) in an encoding."""
        key = (before << 32) + token
        known = self._apart.get(key)
        if known is None:
            if len(self._apart) >= REMEMBERED:
                self._apart.clear()
            parts = [self.tokens[before], self.tokens[token]] if before >= 0 else [self.tokens[token]]
            known = self._apart[key] = self._merged(b"".join(parts)) == parts
        return known

    def following(self, data: bytes, last: list[int], start: int) -> Iterator[int]:
        """The last tokens of the prefixes longer than ``start``; ``last`` has those of the shorter ones."""
        first = max(0, start - self.longest)
        known, apart, lengths = last[first:start], self._apart, self._sizes
        # At each byte the tokens that end there come longest first; the first one that fits is the only one.
        for at, token in self._suffixes.iter(data[first:].decode("latin-1")):
            if len(known) > at:
                continue
            before = at - lengths[token]
            if before < -1 or before == -1 and first:
                continue
            left = known[before] if before >= 0 else -1
            fits = apart.get((left << 32) + token)
            if self.stay_apart(left, token) if fits is None else fits:
                known.append(token)
                yield token

    def last_tokens(self, data: bytes) -> list[int]:
        """The last token of each prefix of ``data`` (of 1, 2, … bytes); ``following`` from the start, in one loop."""
        known, apart, lengths = [], self._apart.get, self._sizes
        for at, token in self._suffixes.iter(data.decode("latin-1")):
            if len(known) == at:
                before = at - lengths[token]
                left = known[before] if before >= 0 else -1
                fits = apart((left << 32) + token)
                if fits or fits is None and self.stay_apart(left, token):
                    known.append(token)
        return known

    def chain(self, data: bytes, last: list[int]) -> list[int]:
        """The encoding that last tokens stand for. A piece that is a token as a whole is that token."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        ids, at = [], len(data)
        while at:
            ids.append(last[at - 1])
            at -= self._sizes[ids[-1]]
        return ids[::-1]

    def spans(self, text: str, start: int = 0) -> Iterator[tuple[int, int]]:
        """Where the pieces from a piece's start on begin and end."""
        if not text.isascii() and self._odd.search(text):
            text = text.translate(self._stand_ins)
        return (m.span() for m in self._pattern.finditer(text, start))

    def split(self, text: str) -> list[str]:
        if text.isascii() or not self._odd.search(text):
            return self._pattern.findall(text)
        return [text[a:b] for a, b in self.spans(text)]

    def piece_ids(self, piece: str) -> bytes:
        data = piece.encode()
        return _four_bytes(self.chain(data, self.last_tokens(data) if data not in self.ranks else []))

    def ids_of(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit numbers."""
        known, out = self._known, []
        for piece in self.split(text):
            ids = known.get(piece)
            if ids is None:
                ids = self.piece_ids(piece)
                if len(piece) <= SHORT:
                    if len(known) >= REMEMBERED:
                        known.clear()
                    known[piece] = ids
            out.append(ids)
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        """The bytes of little-endian ids."""
        numbers = np.frombuffer(ids, "<u4").astype(np.int64)
        if len(numbers) and (numbers.max() >= len(self.tokens) or not self.lengths[numbers].all()):
            raise ValueError("an id that the vocabulary does not have")
        sizes = self.lengths[numbers]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1] if len(ends) else 0)
        return self._bytes[places + np.repeat(self._starts[numbers] - (ends - sizes), sizes)].tobytes()


def _four_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _ranges(codes: Iterable[int]) -> str:
    """Code points as ranges for a character class."""
    codes = np.array(sorted(codes))
    firsts = np.flatnonzero(np.diff(codes, prepend=-2) != 1)
    lasts = np.append(firsts[1:], len(codes)) - 1
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in zip(codes[firsts], codes[lasts]))


@functools.lru_cache(1)
def stand_ins() -> dict[int, str]:
    """Characters that tiktoken's patterns sort otherwise than ``regex`` does, as their Unicode versions differ, with one of
    the kind that tiktoken takes them for: letter, number, white space or other."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    letters, odd = {bytes([b]): b for b in range(256)}, {}
    kinds = {}
    # Bytes alone are the tokens, and what a pattern does not match is left out.
    for kind in (r"\p{L}", r"\p{N}", r"\s"):
        encoding = tiktoken.Encoding(kind, pat_str=f"{kind}+", mergeable_ranks=letters, special_tokens={})
        kinds[kind] = set(bytes(encoding.encode_ordinary(every)).decode()), set(regex.findall(kind, every))
    for c in set().union(*(theirs ^ ours for theirs, ours in kinds.values())):
        mine = [stand_in for (theirs, _), stand_in in zip(kinds.values(), "\u03a9\u0663\u2003") if c in theirs]
        odd[ord(c)] = mine[0] if mine else "\u00a7"
    return odd


@functools.lru_cache(2)
def vocabulary(name: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> Vocabulary:
    with open(public_tokenizers.path(name), "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines)}
    return Vocabulary(ranks, pattern)


@dataclass
class Encoded:
    """A text with its pieces and their last tokens, which appends and edits go on from."""

    words: Vocabulary
    text: str = ""
    starts: list[int] = field(default_factory=list)  # of pieces, in characters
    last: list[list[int]] = field(default_factory=list)  # of each piece
    #: Pieces and bytes that the newest change encoded anew.
    changed: tuple[int, int] = (0, 0)

    @classmethod
    def of(cls, words: Vocabulary, text: str) -> Encoded:
        new = cls(words)
        new.append(text)
        return new

    @classmethod
    def restore(cls, words: Vocabulary, text: str, starts: bytes, last: bytes) -> Encoded:
        """From what ``encode`` stored of a text."""
        bounds = np.frombuffer(starts, "<u4").tolist()
        flat, lists, at = np.frombuffer(last, "<u4").tolist(), [], 0
        for a, b in zip(bounds, [*bounds[1:], len(text)]):
            n = len(text[a:b].encode())
            lists.append(flat[at:at + n])
            at += n
        return cls(words, text, bounds, lists)

    def stored(self) -> tuple[bytes, bytes]:
        flat = [t for tokens in self.last for t in tokens]
        return _four_bytes(self.starts), _four_bytes(flat)

    def pieces(self) -> Iterator[str]:
        for a, b in zip(self.starts, [*self.starts[1:], len(self.text)]):
            yield self.text[a:b]

    def ids(self) -> list[int]:
        return [i for piece, last in zip(self.pieces(), self.last) for i in self.words.chain(piece.encode(), last)]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in the place of characters ``start`` to ``end``. Only pieces near the edit are cut anew, and of a piece
        whose bytes before or after the edit are as they were only the prefixes that it can change are worked out again."""
        if not 0 <= start <= end <= len(self.text):
            raise ValueError("no such characters")
        old, text = self.text, self.text[:start] + new + self.text[end:]
        shift = len(text) - len(old)
        ends = [*self.starts[1:], len(old)]
        # Pieces that end well before the edit were matched without a look at it.
        kept = int(np.searchsorted(ends, start - LOOKAHEAD, side="right")) if ends else 0
        at = ends[kept - 1] if kept else 0
        place = {s: k for k, s in enumerate(self.starts) if s >= max(end, at)}
        starts, last = self.starts[:kept], self.last[:kept]
        pieces = size = 0
        rest = len(self.starts)
        for s, e in self.words.spans(text, at):
            if s >= start + len(new) and s - shift in place:  # from here on all pieces are the old ones
                rest = place[s - shift]
                break
            tokens, worked = self._encoded(old, text, s, e, kept, start, end, len(new))
            starts.append(s)
            last.append(tokens)
            pieces, size = pieces + 1, size + worked
        starts += [s + shift for s in self.starts[rest:]]
        last += self.last[rest:]
        self.text, self.starts, self.last, self.changed = text, starts, last, (pieces, size)

    def _encoded(self, old: str, text: str, s: int, e: int, kept: int, start: int, end: int, added: int) -> tuple[list[int], int]:
        """(last tokens of the piece s to e of the new text, bytes that were worked on)."""
        data = text[s:e].encode()
        k = int(np.searchsorted(self.starts, s, side="right")) - 1
        if k < kept or s > start or self.starts[k] != s:
            return self.words.last_tokens(data), len(data)
        # The piece begins as an old one did: its prefixes before the edit are known.
        stop = self.starts[k + 1] if k + 1 < len(self.starts) else len(old)
        same = len(text[s:min(start, e, stop)].encode())
        tokens = self.last[k][:same]
        # What the old piece has after the edit, if the new piece has it too.
        old_after = len(old[end:stop].encode()) if stop >= end else 0
        new_after = len(text[start + added:e].encode()) if e >= start + added else 0
        shared, equal = min(old_after, new_after), 0
        old_at, new_at = len(self.last[k]) - old_after, len(data) - new_after
        worked = 0
        while len(tokens) < len(data):
            for token in self.words.following(data, tokens, len(tokens)):
                tokens.append(token)
                worked += 1
                inside = len(tokens) - new_at  # bytes after the edit that are done
                if 0 < inside < shared:
                    equal = equal + 1 if token == self.last[k][old_at + inside - 1] else 0
                    if equal >= self.words.longest:
                        tokens += self.last[k][old_at + inside:old_at + shared]
                        break
        return tokens, worked


# --- tables -----------------------------------------------------------------------


def _runs(column: list[bytes | str | None]) -> Iterator[slice]:
    """Rows that go into one batch, by the size of their texts."""
    first = size = 0
    for i, value in enumerate(column):
        size += len(value or "")
        if size >= OUT_BYTES or i + 1 == len(column):
            yield slice(first, i + 1)
            first, size = i + 1, 0


def encode(docs: DataFrame, name: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, ids``: the ids of every text as little-endian unsigned 32-bit numbers; empty for an empty or null text.

    One row per row of ``docs``; texts are encoded whole; special tokens' strings are ordinary text. Further columns
    are not read.
    """

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name, pattern)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            for run in _runs(texts):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[run], pa.array([words.ids_of(t or "") for t in texts[run]], pa.binary())], names=["doc_id", "ids"])

    rows = plain(docs, "doc_id", "text").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(encoded, "doc_id long, ids binary")


def decode(rows: DataFrame, name: str = RANKS) -> DataFrame:
    """``doc_id, ids, decoded``: the bytes that the ids stand for; null ids stay null, unknown ids are an error."""

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            for run in _runs(ids):
                texts = [None if i is None else words.decode(i) for i in ids[run]]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[run], batch.column(1)[run], pa.array(texts, pa.binary())], names=["doc_id", "ids", "decoded"])

    return plain(rows, "doc_id", "ids").mapInArrow(decoded, "doc_id long, ids binary, decoded binary")


STATE = "doc_id long, text string, starts binary, last binary, ids binary"


def prefixes(docs: DataFrame, name: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """``doc_id, text, starts, last, ids``: what ``revise`` goes on from: where pieces start and the last token of each
    prefix of each piece. A null text counts as empty."""
    empty = F.lit(b"")
    rows = plain(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"), F.lit("").alias("text"), empty.alias("starts"), empty.alias("last"),
        F.array(F.struct(F.lit(0).alias("start"), F.lit(0).alias("end"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("new"))).alias("edits"))
    return revise(rows, name, pattern)


def revise(rows: DataFrame, name: str = RANKS, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Rows of ``prefixes`` after their ``edits``, an array of (start, end, new) in characters, one after the other.

    The result is that of ``prefixes`` over the changed texts, but only what an edit can change is encoded again. ``end``
    null stands for the end of the text, ``start`` null for ``end``: an edit with both null appends. A null ``new``
    deletes; no edits leave a row as it is.
    """

    def revised(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(name, pattern)
        for batch in batches:
            for run in _runs(batch.column(1).to_pylist()):
                out = []
                for row in batch[run].to_pylist():
                    one = Encoded.restore(words, row["text"] or "", row["starts"] or b"", row["last"] or b"")
                    for edit in row["edits"] or []:
                        end = len(one.text) if edit["end"] is None else edit["end"]
                        one.replace(end if edit["start"] is None else edit["start"], end, edit["new"] or "")
                    out.append((row["doc_id"], one.text, *one.stored(), _four_bytes(one.ids())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.binary()))],
                    names=["doc_id", "text", "starts", "last", "ids"])

    rows = plain(rows, "doc_id", "text", "starts", "last", "edits")
    return rows.withColumn("edits", F.col("edits").cast("array<struct<start:int,end:int,new:string>>")).mapInArrow(revised, STATE)


def round_trip_digests(docs: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` of every text, from its ids and from what they decode to."""
    return decode(encode(docs)).select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
