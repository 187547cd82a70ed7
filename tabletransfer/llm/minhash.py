"""MinHash near-duplicates by circulant signatures.

Two permutations make every signature: the first scatters the shingles over a ring, the
second is read at ``K`` neighbouring places of the ring, which is the same as shifting it
circularly ``K`` times. A document's signature is the least value at each shift.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tabletransfer.llm.graph import components
from tabletransfer.llm.shared import LOWER, Rolling, keep, mix, plain, text_slices, words_of

#: Coordinates of a signature, in bands of this many. At similarity 0.75 a pair misses
#: every band with probability (1 - 0.75**4)**32, about 5 in a million.
COORDINATES, BAND = 128, 4
#: Places of the ring. Long texts of 20,000 words fill 2 % of it.
RING = 1 << 20
WORDS = 5
#: Most shingles and texts of a block on average; a task holds two blocks.
BLOCK_SHINGLES, BLOCK_TEXTS = 250_000, 512


@functools.lru_cache(1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and all windows of the second one."""
    random = np.random.Generator(np.random.PCG64(2024))
    scatter = random.permutation(RING).astype(np.uint32)
    values = random.permutation(RING).astype(np.uint32)
    ring = np.concatenate((values, values[:COORDINATES - 1]))
    return scatter, np.lib.stride_tricks.sliding_window_view(ring, COORDINATES)


def signature(shingles: np.ndarray) -> np.ndarray:
    scatter, windows = permutations()
    least = None
    for i in range(0, len(shingles), 4096):
        part = windows[scatter[shingles[i:i + 4096] & np.uint64(RING - 1)]].min(axis=0)
        least = part if least is None else np.minimum(least, part)
    return least


def shingle_sets(column: pa.Array) -> Iterator[np.ndarray]:
    """The set of each text as sorted distinct 64-bit hashes of its five-word shingles."""
    for first, end, data, bounds in text_slices(column):
        low = LOWER[data]
        starts, ends, of_text = words_of(low, bounds)
        words = Rolling(low).of(starts, ends)
        five = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
        for j in range(WORDS):
            five *= np.uint64(0x9E3779B97F4A7C15)
            five += words[j:j + len(five)]
        five = mix(five)
        for a, b in zip(of_text[:-1], of_text[1:]):
            if b - a >= WORDS:
                yield np.unique(five[a:b - WORDS + 1])
            elif b > a:
                whole = np.uint64(b - a)
                for w in words[a:b]:
                    whole = np.uint64((int(whole) * 0x9E3779B97F4A7C15 + int(w)) % (1 << 64))
                yield mix(np.array([whole]))
            else:
                yield np.zeros(0, np.uint64)


def alike(common: int | np.ndarray, n: int, m: int | np.ndarray) -> bool | np.ndarray:
    """Whether sets of n and m with so many common ones reach 75 of 100."""
    return 100 * common >= 75 * (n + m - common)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, prints, bands = [], [], []
        for shingles in shingle_sets(batch.column(1)):
            sizes.append(len(shingles))
            prints.append(np.frombuffer(blake2b(shingles.tobytes(), digest_size=16).digest(), np.int64))
            if len(shingles):
                bands.append(band_keys(signature(shingles)))
            else:
                bands.append(np.zeros(0, np.int64))
        prints = np.array(prints, np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(sizes, pa.int64()), pa.array(prints[:, 0]), pa.array(prints[:, 1]),
             pa.ListArray.from_arrays(
                 pa.array(np.cumsum([0] + [len(b) for b in bands]), pa.int32()),
                 pa.array(np.concatenate(bands) if bands else np.zeros(0, np.int64)))],
            names=["doc_id", "n_shingles", "print_a", "print_b", "bands"])


def band_keys(values: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of a signature; a key holds its band's number."""
    rows = values.reshape(-1, BAND).astype(np.uint64)
    keys = np.arange(1, len(rows) + 1, dtype=np.uint64)
    for j in range(BAND):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
    return keys.view(np.int64)


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of pairs with both texts, those that are alike."""
    for batch in batches:
        right = [alike(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y))
                 for x, y in zip(shingle_sets(batch.column(2)), shingle_sets(batch.column(3)))]
        yield batch.select([0, 1]).filter(pa.array(right, pa.bool_()))


def _block_links(table: pa.Table) -> pa.Table:
    """Links between different components among the texts of one pair of blocks.

    Common shingles are counted over lists of the texts that hold each shingle, so no pair is
    formed that has none in common.
    """
    sets = list(shingle_sets(table["text"]))
    ids, labels = table["doc_id"].to_numpy(), table["label"].to_numpy()
    sizes = np.array([len(s) for s in sets])
    every = np.concatenate(sets)
    holder = np.repeat(np.arange(len(sets)), sizes)
    order = np.argsort(every, kind="stable")
    every, holder = every[order], holder[order]
    kinds, counts = np.unique(labels, return_counts=True)
    common_label = kinds[counts.argmax()]
    found: dict[tuple[int, int], tuple[int, int]] = {}
    for i in np.flatnonzero(labels != common_label):
        lo, hi = np.searchsorted(every, sets[i], "left"), np.searchsorted(every, sets[i], "right")
        n = hi - lo
        at = np.repeat(lo - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
        common = np.bincount(holder[at], minlength=len(sets))
        for j in np.flatnonzero(alike(common, sizes[i], sizes) & (labels != labels[i])):
            found.setdefault((labels[i], labels[j]), (ids[i], ids[j]))
    pairs = np.array(list(found), np.int64).reshape(-1, 2)
    return pa.table({"a": pairs[:, 0], "b": pairs[:, 1]})


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Words are runs without ASCII white space, A-Z in lower case. A text's set is that of its
    five-word shingles; a shorter text is one shingle, a null or empty one has none and
    is linked with nothing. Two texts are linked when their sets reach a similarity of
    0.75, counted on the full sets. ``component_id`` is the smallest id reachable by links, and
    ``kept`` marks the row that has it. Rows that repeat an id are one document. A null id
    takes the class of its text; where no other row has that text it is kept, with a null
    component. Further columns are not read.

    1. One pass makes sets, signatures and band keys. Equal sets become one class.
    2. In each bucket (band and key) every class is checked with the smallest one.
    3. Buckets that then still hold several components are checked in blocks of a bounded number of
       shingles, block against block, in full. A large group of near copies has mostly
       become one component before, so this concerns few texts.
    """
    docs = plain(docs, id_col, text_col).toDF("doc_id", "text").withColumn("doc_id", F.col("doc_id").cast("long"))
    signed = keep(docs.mapInArrow(
        _signed, "doc_id long, n_shingles long, print_a long, print_b long, bands array<long>"), "signed")
    classes = keep(
        signed.where("n_shingles > 0").groupBy("print_a", "print_b").agg(F.min("doc_id").alias("class_id")), "classes")
    members = keep(
        signed.join(classes.select(F.col("class_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
        .select("doc_id", "n_shingles", F.explode("bands").alias("bucket")).distinct(), "members")
    buckets = members.groupBy("bucket").agg(
        F.min("doc_id").alias("centre"), F.count("*").alias("n"), F.sum("n_shingles").alias("weight")).where("n > 1")
    shared = keep(members.join(buckets, "bucket"), "shared")

    needed = shared.select("doc_id").distinct()
    texts = keep(docs.join(needed, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"]), "texts")
    pairs = shared.where("doc_id != centre").select("doc_id", "centre").distinct()
    links = (
        pairs.join(texts, "doc_id")
        .join(texts.select(F.col("doc_id").alias("centre"), F.col("text").alias("other")), "centre")
        .select("doc_id", "centre", "text", "other")
        .mapInArrow(_checked, "doc_id long, centre long"))
    first = components(links.toDF("a", "b"))

    labelled = (
        shared.join(first.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("bucket", "doc_id", F.coalesce("component", "doc_id").alias("label"), "n", "weight"))
    mixed = (
        labelled.where("n > 2").groupBy("bucket")
        .agg(F.min("label").alias("low"), F.max("label").alias("high")).where("low != high").select("bucket"))
    blocks = F.greatest(F.ceil(F.col("weight") / BLOCK_SHINGLES), F.ceil(F.col("n") / BLOCK_TEXTS))
    rows = (
        labelled.where("n > 2").join(mixed, "bucket", "left_semi")
        .withColumn("blocks", blocks.cast("long"))
        .withColumn("own", F.pmod(F.xxhash64("doc_id"), F.col("blocks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .select("doc_id", "label", "bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")))
    more = (
        rows.join(texts, "doc_id").groupBy("bucket", "i", "j").applyInArrow(_block_links, "a long, b long"))
    second = components(more)

    final = (
        classes.join(first.select(F.col("id").alias("class_id"), "component"), "class_id", "left")
        .withColumn("component", F.coalesce("component", "class_id"))
        .join(second.select(F.col("id").alias("component"), F.col("component").alias("joined")), "component", "left")
        .select("print_a", "print_b", F.coalesce("joined", "component").alias("component")))
    return (
        signed.select("doc_id", "n_shingles", "print_a", "print_b").join(final, ["print_a", "print_b"], "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull())))
