"""Quality by nearest-neighbour voting in a latent-semantic space."""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabletransfer.llm.shared import Rolling, plain, text_slices, words_of

#: Terms: single bytes, hashed pairs and triples of bytes, and how words repeat.
PAIRS, TRIPLES, REPEATS = 1024, 2048, 4
TERMS = 256 + PAIRS + TRIPLES + REPEATS
WEIGHTS = (1, 1, 1, 3)
#: Most labelled rows of each label that a model is fitted on. They are those of the
#: smallest hash of the id, so every part of the table is as likely.
SAMPLE_PER_LABEL = 1500
DIMENSIONS, NEIGHBOURS = 48, 15
THRESHOLD = 0.3


def term_rows(column: pa.Array) -> Iterator[np.ndarray]:
    """Blocks of rows of term weights, one row per text: square roots of relative frequencies."""
    for first, end, data, bounds in text_slices(column, rows=512):
        n = end - first
        length = np.diff(bounds)
        text = np.repeat(np.arange(n), length)
        code = data.astype(np.uint32)

        def counted(terms: np.ndarray, span: int, size: int) -> np.ndarray:
            inside = np.ones(len(data), bool)
            for back in range(1, span):
                inside[np.maximum(bounds[1:] - back, bounds[:-1])[length >= 1]] = False
            inside = inside[:len(terms)]
            counts = np.bincount(text[:len(terms)][inside] * size + terms[inside], minlength=n * size)
            return counts.reshape(n, size)

        pairs = code[:-1] * np.uint32(256) + code[1:]
        triples = pairs[:-1] * np.uint32(256) + code[2:]
        starts, ends, of_text = words_of(data, bounds)
        words = Rolling(data).of(starts, ends)
        owner = np.repeat(np.arange(n), np.diff(of_text))
        _, seen = np.unique(words ^ (owner.astype(np.uint64) << np.uint64(54)), return_index=True)
        new = np.bincount(owner[seen], minlength=n)
        same = [np.bincount(owner[k:][(words[k:] == words[:-k]) & (owner[k:] == owner[:-k])], minlength=n) for k in (1, 2)]
        repeats = np.stack([new, np.diff(of_text) - new, *same], axis=1)
        parts = [counted(data, 1, 256),
                 counted((pairs * np.uint32(2654435761)) >> np.uint32(22), 2, PAIRS),
                 counted((triples * np.uint32(2654435761)) >> np.uint32(21), 3, TRIPLES), repeats]
        yield np.concatenate(
            [weight * np.sqrt(p / np.maximum(p.sum(axis=1, keepdims=True), 1)) for weight, p in zip(WEIGHTS, parts)],
            axis=1).astype(np.float32)


def _unit(rows: np.ndarray) -> np.ndarray:
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-12)


@dataclass
class Model:
    """Projection to the latent space, the labelled vectors in it, the share of label 1, and for how many
    labelled rows each vector stands (without it one)."""

    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float
    stands_for: np.ndarray | float = 1.0

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """Share of label 1 among the nearest labelled vectors, weighted by cosine and by what they stand for.

        Vectors as near as the last neighbour all vote, so ties do not depend on order.
        A text without terms, or with no similar vector, gets the share among all labels.
        """
        if not len(self.labels):
            return np.full(len(rows), self.prior)
        near = _unit(rows @ self.projection) @ self.vectors.T
        k = min(NEIGHBOURS, near.shape[1])
        last = np.partition(near, near.shape[1] - k, axis=1)[:, -k]
        weight = np.where(near >= last[:, None], np.maximum(near, 0), 0).astype(np.float64) * self.stands_for
        total = weight.sum(axis=1)
        share = (weight @ self.labels) / np.maximum(total, 1e-12)
        return np.clip(np.where(total > 1e-6, share, self.prior), 0, 1)


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [zlib.compress(r.tobytes(), 1) for block in term_rows(batch.column(1)) for r in block]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())], names=["label", "terms"])


def fit(docs: DataFrame, marks: DataFrame) -> Model:
    """Fit on the texts of ``docs`` (``doc_id, text``) that ``marks`` (``doc_id, label``) label 0 or 1.

    At most ``SAMPLE_PER_LABEL`` ids of each label are used, chosen by hash of the id; an id that is repeated
    counts once, with its smallest text. A row stands for (rows of its label) / (sampled rows of its label), so
    scores keep to the table's balance of labels whether or not the sample is all. Only ids are shuffled, and cached while
    they are counted and chosen: the chosen ones, whose number is bounded, are broadcast to fetch their texts in one pass.
    The model does not depend on how rows are dealt. Without any row every score is 0.5.
    """
    there = docs.select("doc_id").distinct()
    known = marks.where("label in (0, 1)").distinct().join(there, "doc_id", "left_semi").persist()
    try:
        counts = {r["label"]: r["count"] for r in known.groupBy("label").count().collect()}
        if not counts:
            return Model(np.zeros((TERMS, 1), np.float32), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
        chosen = functools.reduce(DataFrame.unionAll, [
            known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL)
            for label in sorted(counts)])
        texts = docs.join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
        rows = texts.select("label", "text").mapInArrow(_packed, "label int, terms binary").collect()
    finally:
        known.unpersist()
    rows = sorted((r["label"], bytes(r["terms"])) for r in rows)
    labels = [label for label, _ in rows]
    terms = [np.frombuffer(zlib.decompress(packed), np.float32) for _, packed in rows]
    terms, labels = np.stack(terms), np.array(labels)
    stands_for = np.ones(len(labels))
    for label in counts:
        stands_for[labels == label] = counts[label] / max((labels == label).sum(), 1)
    rarity = np.log((1 + stands_for.sum()) / (1 + stands_for @ (terms > 0))) + 1
    weighted = terms * rarity.astype(np.float32) * np.sqrt(stands_for)[:, None].astype(np.float32)
    random = np.random.Generator(np.random.PCG64(8))
    basis = random.standard_normal((len(terms), min(DIMENSIONS + 16, len(terms)))).astype(np.float32)
    for _ in range(4):
        right, _ = np.linalg.qr(weighted.T @ basis)
        basis, _ = np.linalg.qr(weighted @ right)
    _, _, axes = np.linalg.svd(basis.T @ weighted, full_matrices=False)
    projection = (axes[:DIMENSIONS].T * rarity[:, None]).astype(np.float32)
    return Model(projection, _unit(terms @ projection).astype(np.float32), labels.astype(np.float64),
                 counts.get(1, 0) / max(sum(counts.values()), 1), stands_for)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score, predicted`` of every row; only the text is read for the score."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blocks = [sent.value.scores(block) for block in term_rows(batch.column(1))]
            values = np.concatenate(blocks) if blocks else np.zeros(0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(values), pa.array((values >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return plain(docs, id_col, text_col).toDF("doc_id", "text").withColumn(
        "doc_id", F.col("doc_id").cast("long")).mapInArrow(scored, "doc_id long, score double, predicted int")


def passing(docs: DataFrame, model: Model) -> DataFrame:
    """The rows, all columns, whose own text is predicted 1."""
    sent, at = docs.sparkSession.sparkContext.broadcast(model), docs.columns.index("text")

    def passed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row = 0
            for block in term_rows(batch.column(at)):
                yield batch.slice(row, len(block)).filter(pa.array(sent.value.scores(block) >= THRESHOLD))
                row += len(block)

    return docs.mapInArrow(passed, docs.schema)


def held_out(id_col: str = "doc_id", parts: int = 5, part: int = 0):
    """Whether the row is kept from learning; a null id is in neither group."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on the documents outside the held-out part that have a label in ``quality``."""
    known = plain(labels, "doc_id", "quality").where("doc_id is not null and quality is not null").where(~held_out())
    return fit(plain(docs, "doc_id", "text").where("doc_id is not null"),
               known.select("doc_id", F.col("quality").cast("int").alias("label")))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every document.

    ``predicted`` is 1 from a score of 0.3. Null and empty texts get the share of label 1.
    A document with two labels counts with both. Further columns are not read.
    """
    return score(docs, learn(docs, labels)).select("doc_id", held_out().alias("held_out"), "score", "predicted")
