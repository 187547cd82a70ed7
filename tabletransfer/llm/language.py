"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabletransfer.llm.shared import plain

#: n-grams of one to three characters share this many counters.
BUCKETS, ORDERS = 1 << 15, (1, 2, 3)
SMOOTHING = 0.5
#: Characters that are counted or scored together; a longer text is handled alone.
SLICE_CHARS = 400_000
UNKNOWN = "und"


@functools.lru_cache(1)
def letters() -> np.ndarray:
    """For each code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def text_grams(texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, list[tuple[np.ndarray, np.ndarray]]]]:
    """(texts, which have letters, [(bucket, text) of each order]) for runs of texts.

    Texts are made lower case, and whatever is not a letter counts as a space.
    """
    at = 0
    while at < len(texts):
        run, size = [], 0
        while at < len(texts) and (not run or size + len(texts[at] or "") <= SLICE_CHARS):
            run.append((texts[at] or "").lower())
            size += len(run[-1])
            at += 1
        codes = np.frombuffer("".join(run).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(len(run)), [len(t) for t in run])
        known = letters()[codes]
        lettered = np.bincount(owner[known], minlength=len(run)) > 0
        codes = np.where(known, codes, 32).astype(np.uint64)
        grams = []
        for order in ORDERS:
            n = max(len(codes) - order + 1, 0)
            mixed = np.full(n, order, np.uint64)
            for k in range(order):
                mixed = (mixed + codes[k:k + n]) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            inside = owner[:n] == owner[order - 1:order - 1 + n]
            grams.append(((mixed >> np.uint64(20))[inside] & np.uint64(BUCKETS - 1), owner[:n][inside]))
        yield len(run), lettered, grams


@dataclass
class Model:
    """Languages, their log prior and the matrix of log probabilities (bucket by language)."""

    languages: list[str]
    prior: np.ndarray
    matrix: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for n, lettered, grams in text_grams(texts):
            total = np.tile(self.prior, (n, 1))
            for bucket, owner in grams:
                if len(owner) and self.languages:
                    firsts = np.flatnonzero(np.diff(owner, prepend=-1))
                    total[owner[firsts]] += np.add.reduceat(self.matrix[bucket], firsts, axis=0, dtype=np.float64)
            for known, row in zip(lettered, total):
                if not known or not self.languages:
                    names.append(UNKNOWN)
                    scores.append(0.0)
                else:
                    best = int(row.argmax())
                    names.append(self.languages[best])
                    scores.append(float(1 / np.exp(row - row[best]).sum()))
        return names, scores


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of a task: (language, bucket, count), and the number of texts under bucket -1."""
    counts: dict[str, np.ndarray] = {}
    texts: dict[str, int] = {}
    for batch in batches:
        column, languages = batch.column(1).to_pylist(), np.array(batch.column(0).to_pylist(), object)
        for name in set(languages):
            own = [column[i] for i in np.flatnonzero(languages == name)]
            table = counts.setdefault(name, np.zeros(BUCKETS, np.int64))
            for n, lettered, grams in text_grams(own):
                texts[name] = texts.get(name, 0) + n
                for bucket, _ in grams:
                    table += np.bincount(bucket.astype(np.int64), minlength=BUCKETS)
    for name, table in counts.items():
        used = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array([name] * (len(used) + 1)), pa.array(np.append(used, -1), pa.int32()),
             pa.array(np.append(table[used], texts[name]), pa.int64())], names=["lang", "bucket", "n"])


def learn(docs: DataFrame) -> Model:
    """Fit on all rows ``text, lang`` whose language is known. The model's size is that of
    the languages times ``BUCKETS``, however many rows there are."""
    rows = plain(docs, "lang", "text").where("lang is not null").mapInArrow(
        _counted, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toArrow()
    names = rows["lang"].to_numpy(zero_copy_only=False)
    languages = sorted(set(names))
    bucket, n = rows["bucket"].to_numpy(), rows["n"].to_numpy()
    counts = np.zeros((BUCKETS, len(languages)))
    texts = np.zeros(len(languages))
    for k, name in enumerate(languages):
        own = names == name
        texts[k] = n[own & (bucket < 0)].sum()
        counts[bucket[own & (bucket >= 0)], k] = n[own & (bucket >= 0)]
    matrix = np.log(counts + SMOOTHING) - np.log(counts.sum(axis=0) + SMOOTHING * BUCKETS)
    return Model(languages, np.log(texts / max(texts.sum(), 1)), matrix.astype(np.float32))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row; only the text is read for the prediction."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = sent.value.predict(batch.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "lang_pred", "score"])

    return plain(docs, "doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(
        predicted, "doc_id long, lang_pred string, score double")


def languages(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every document.

    Learned from the documents whose crc32 of the id modulo 4 is not 2; a null id is in
    neither group. ``lang_pred`` is one of the learned values, of equal ones the first by
    name; ``und`` with score 0 for a text that is null or has no letter, and for all if nothing
    could be learned. ``score`` is the posterior probability. Further columns are not read.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    model = learn(docs.where("doc_id is not null").where(~held_out))
    return predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
