import hashlib
import random
from collections import Counter
from pathlib import Path

import numpy as np
import pytest

from tabletransfer.llm import repeats as module
from tabletransfer.llm.repeats import LENGTH, RunIndex, remove_repeats, repeats

from .conftest import SCHEMA, words


def brute(rows):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k:k + LENGTH] for _, b in data for k in range(len(b) - LENGTH + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - LENGTH + 1):
            if count[b[k:k + LENGTH]] > 1:
                gone[k:k + LENGTH] = True
        runs = int((np.diff(np.concatenate(([False], gone)).astype(int)) == 1).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), runs, hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def mixed_rows():
    r = random.Random(11)
    passages = [" ".join(words(k, 60)) for k in range(6)]
    rows = []
    for k in range(40):
        parts = [" ".join(words(1000 + k, r.randint(1, 80)))]
        for _ in range(r.randint(0, 3)):
            p = r.choice(passages)
            cut = r.randint(0, 200)
            parts.append(p[cut:cut + r.randint(150, 420)])
            parts.append(" ".join(words(5000 + 10 * k + len(parts), r.randint(0, 30))))
        rows.append((k, "".join(parts)))
    rows += [(100, rows[0][1]), (101, "x" * 199), (102, "y" * 200), (103, "ab" * 400), (104, "q" * 201), (105, rows[3][1] + "z")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)


def test_like_brute_force(spark):
    rows = mixed_rows()
    assert sorted((tuple(r) for r in repeats(frame(spark, rows)).collect()), key=repr) == brute(rows)


@pytest.mark.parametrize("most", [1, 3])
def test_large_groups_are_dealt_into_pieces(spark, monkeypatch, most):
    """With 1 the pieces are stretches and then single windows, with 3 some groups end as stretches."""
    monkeypatch.setattr(module, "GROUP_SEGMENTS", most)
    rows = mixed_rows() + [mixed_rows()[0]] * 2
    assert sorted((tuple(r) for r in repeats(frame(spark, rows)).collect()), key=repr) == brute(rows)


def test_texts_are_cut_once(spark, monkeypatch):
    """Large groups and the others come from one pass over the texts."""
    monkeypatch.setattr(module, "GROUP_SEGMENTS", 1)
    texts, cut_out = spark.sparkContext.accumulator(0), module._cut_out

    def counted(batches):
        for batch in batches:
            texts.add(batch.num_rows)
            yield from cut_out(iter([batch]))

    monkeypatch.setattr(module, "_cut_out", counted)
    rows = mixed_rows()
    assert sorted((tuple(r) for r in repeats(frame(spark, rows)).collect()), key=repr) == brute(rows)
    assert 0 < texts.value <= len(rows)


@pytest.mark.parametrize("most", [1, 4096])
def test_tables_on_the_way_are_deleted(spark, monkeypatch, most):
    from tabletransfer.llm.shared import shared_folder

    def kept():
        return {p.name for p in Path(shared_folder(spark)).glob("*")}

    monkeypatch.setattr(module, "GROUP_SEGMENTS", most)
    before = kept()
    out = repeats(frame(spark, mixed_rows()))
    assert sorted(name.split("-")[0] for name in kept() - before) == ["marks", "shared"]
    assert sorted((tuple(r) for r in out.collect()), key=repr) == brute(mixed_rows())


def test_marks_of_large_groups_come_from_the_index(spark, monkeypatch):
    """Hashes only choose windows; a window whose hash is another's by accident stays."""
    monkeypatch.setattr(module, "GROUP_SEGMENTS", 1)
    texts = [" ".join(words(k, 60))[:LENGTH + 20].encode() for k in range(3)]
    rows = [(7, k, 1, t) for k, t in enumerate(texts)] + [(7, 9, 1, texts[0][5:] + b"?")]
    cut = spark.createDataFrame([(a, b, c, bytearray(d)) for a, b, c, d in rows],
                                "minimizer long, content long, n long, bytes binary")

    def same_hash(batches):
        import pyarrow as pa
        for batch in batches:
            for minimizer, content, n, data in zip(*(c.to_pylist() for c in batch.columns)):
                size = len(data) - 199
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x] * size, pa.int64()) for x in (minimizer, content, n)]
                    + [pa.array(range(size), pa.int32()), pa.array([1] * size, pa.int64())],
                    names=["minimizer", "content", "n", "low", "hash"])

    monkeypatch.setattr(module, "_hashed_windows", same_hash)
    marked = {(r.content, k) for r in module._marks(cut, cut).collect() for k in range(r.low, r.high)}
    assert marked == {(0, k) for k in range(5, 21)} | {(9, k) for k in range(16)}


def test_hot_group_with_repeated_rows(spark):
    """More segments of one minimizer than an index takes: one passage in 4500 documents, each with its own ends."""
    passage = " ".join(words(77, 80))
    rows = [(k, f"{k:05d} " * 6 + passage + f" {k * 7:06d}" * 6) for k in range(4500)] + [(1, "00001 " * 6 + passage)] * 30
    assert sorted((tuple(r) for r in repeats(frame(spark, rows)).collect()), key=repr) == brute(rows)


def test_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert sorted((tuple(r) for r in repeats(odd_docs).collect()), key=repr) == brute(rows)
    assert repeats(no_docs).collect() == []


def test_removal_keeps_columns_and_whole_characters(spark, odd_docs):
    out = remove_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    passage = "é" * 150
    rows = {r.doc_id: r.text for r in remove_repeats(frame(spark, [(1, "a" + passage), (2, passage + "b"), (3, None)])).collect()}
    assert rows == {1: "a", 2: "b", 3: None}


@pytest.mark.parametrize("seed", range(12))
def test_matching_statistics(seed):
    r = np.random.default_rng(seed)
    n = int(r.integers(1, 300))
    text = r.integers(0, 1 + seed % 4, n) if seed % 2 else np.tile(r.integers(0, 5, 23), 14)[:n]
    text = (text + 97).astype(np.uint8)
    index = RunIndex(text)
    assert np.repeat(index.heads, index.lengths).shape == (n,)
    data = text.tobytes()
    rows = sorted(range(n), key=lambda i: data[i:])
    want = np.zeros(n, int)
    for a, b in zip(rows, rows[1:]):
        k = 0
        while a + k < n and b + k < n and data[a + k] == data[b + k]:
            k += 1
        want[a], want[b] = max(want[a], k), max(want[b], k)
    assert index.matching_statistics().tolist() == want.tolist()
    assert np.repeat(index.heads, index.lengths).tolist() == [data[i - 1] for i in rows]


def test_many_texts_without_id(spark):
    """Among 5000 different texts some agree in 21 bits of their hash."""
    from pyspark.sql import functions as F
    r = random.Random(21)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(r.randint(200, 600))) for _ in range(6000)]
    hashed = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("bits", F.xxhash64("text").bitwiseAND(F.lit(0x1FFFFF)))
    pairs = [x.texts for x in hashed.groupBy("bits").agg(F.collect_list("text").alias("texts")).where("size(texts) > 1").collect()]
    assert pairs
    rows = [(None, t) for pair in pairs for t in pair]
    rows += [(k, "#" + max(pair, key=len)[-210:] + "%") for k, pair in enumerate(pairs)]
    assert sorted((tuple(r) for r in repeats(frame(spark, rows)).collect()), key=repr) == brute(rows)
