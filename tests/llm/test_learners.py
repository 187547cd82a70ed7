import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tabletransfer.llm import hamming, quality
from tabletransfer.llm.hamming import search
from tabletransfer.llm.language import languages
from tabletransfer.llm.quality import quality_scores
from tabletransfer.llm.shared import shared_folder

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


def test_languages_of_held_out_documents(docs):
    rows = languages(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang == r.lang_pred for r in held) > 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_of_odd_rows(odd_docs, no_docs, spark):
    rows = languages(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows}
    assert [by_id[i].lang_pred for i in range(3)] == ["und"] * 3
    assert {r.lang_pred for r in rows} <= {"en", "fr", "und"} and not by_id[None].held_out
    assert languages(no_docs).collect() == []
    unknown = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [tuple(r)[2:] for r in languages(unknown).collect()] == [("und", 0.0)]


def test_quality_of_held_out_documents(spark, docs):
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    rows = quality_scores(docs, labels).join(labels, "doc_id").collect()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.predicted == r.quality for r in held) > 0.95 * len(held)
    assert all(r.predicted == (r.score >= 0.3) for r in rows)


def test_quality_of_odd_rows(odd_docs, no_docs, spark):
    labels = spark.createDataFrame([(5, 1, 0), (6, 1, 0), (8, 0, 1), (9, 0, 0), (9, 1, 0), (10, None, 0), (None, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    rows = quality_scores(odd_docs, labels).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (5, 6)}) == 1
    assert {r.score for r in quality_scores(odd_docs, labels.limit(0)).collect()} == {0.5}
    assert quality_scores(no_docs, labels).collect() == []


def test_votes_like_brute_force():
    r = np.random.default_rng(1)
    model = quality.Model(np.eye(quality.TERMS, 6, dtype=np.float32), r.normal(size=(60, 6)).astype(np.float32),
                          (np.arange(60) % 3 > 0).astype(float), 0.7)
    model.vectors /= np.linalg.norm(model.vectors, axis=1, keepdims=True)
    model.vectors[40:] = model.vectors[:20]
    rows = np.zeros((5, quality.TERMS), np.float32)
    rows[:4, :6] = r.normal(size=(4, 6))
    for row, score in zip(rows, model.scores(rows)):
        v = row[:6] / max(np.linalg.norm(row[:6]), 1e-12)
        near = sorted(((float(v @ x), y) for x, y in zip(model.vectors, model.labels)), key=lambda p: -p[0])
        least = near[quality.NEIGHBOURS - 1][0]
        votes = [(max(s, 0), y) for s, y in near if s >= least - 1e-7]
        total = sum(s for s, _ in votes)
        want = sum(s * y for s, y in votes) / total if total > 1e-6 else 0.7
        assert score == pytest.approx(want, abs=1e-5)


def exact(rows, k=10):
    out = {}
    for q, v in rows:
        if q % 100 == 0:
            near = sorted((float(np.sqrt(((np.array(w) - np.array(v)) ** 2).sum())), i) for i, w in rows if i != q)
            out[q] = [i for _, i in near[:k]]
    return out


def test_search_recall(spark):
    df = spark.read.parquet(f"{DATA}/embeddings.parquet")
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in df.collect()]
    want, got = exact(rows), {}
    found = search(df, F.col("vec_id") % 100 == 0).collect()
    vectors = dict(rows)
    for r in found:
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id))
        assert r.score == pytest.approx(np.linalg.norm(np.array(vectors[r.vec_id]) - vectors[r.query_id]), rel=1e-12)
    hits = sum(len(set(want[q]) & {v for _, v in got[q]}) for q in want)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert all([n for n, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in got.values())


def test_search_of_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(hamming, "BLOCK_ROWS", 16)
    r = np.random.default_rng(3)
    rows = [(i, r.normal(size=12).tolist()) for i in range(0, 150)]
    rows += [(i, rows[100][1]) for i in range(150, 190)]
    bad = [(200, None), (300, [0.0] * 12), (301, [1.0, None] + [0.0] * 10), (302, [float("nan")] + [1.0] * 11),
           (303, [float("inf")] + [1.0] * 11), (304, [1.0, 2.0]), (None, [1.0] * 12)]
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>").selectExpr("*", "1 as code", "2 as shard", "3 as rank")
    found = search(df, F.col("vec_id") % 100 == 0).collect()
    assert {x.query_id for x in found} == {0, 100}
    assert [x.vec_id for x in sorted(found, key=lambda x: x["rank"]) if x.query_id == 100] == list(range(150, 160))
    assert {x.score for x in found if x.query_id == 100} == {0.0}
    few = search(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") % 100 == 0).collect()
    assert sorted(x.vec_id for x in few) == [1, 2]
    assert search(df.limit(0), F.col("vec_id") % 100 == 0).collect() == []


def test_query_rows_that_share_an_id(spark):
    """Each is searched by itself, and is a candidate of the other one."""
    r = np.random.default_rng(9)
    rows = [(i, r.normal(size=16).tolist()) for i in range(1, 40)]
    twins = [(100, rows[4][1]), (100, rows[20][1]), (200, rows[7][1]), (200, rows[7][1])]
    df = spark.createDataFrame(rows + twins, "vec_id long, embedding array<double>")
    found = search(df, F.col("vec_id") % 100 == 0).collect()
    every = rows + twins
    want = []
    for n, (q, vector) in enumerate(twins, len(rows)):
        near = sorted((float(np.linalg.norm(np.array(v) - vector)), i) for m, (i, v) in enumerate(every) if m != n)[:10]
        want += [(q, rank, i, round(d, 9)) for rank, (d, i) in enumerate(near, 1)]
    assert sorted((x.query_id, x["rank"], x.vec_id, round(x.score, 9)) for x in found) == sorted(want)


def test_every_code_within_the_radius_is_retrieved(spark):
    """With a radius of all bits the search is exact."""
    r = np.random.default_rng(5)
    rows = [(i, r.normal(size=20).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    before, hamming._radius = hamming._radius, lambda *_: 20
    try:
        found = search(df, F.col("vec_id") % 100 == 0).collect()
    finally:
        hamming._radius = before
    got = {}
    for x in sorted(found, key=lambda x: x["rank"]):
        got.setdefault(x.query_id, []).append(x.vec_id)
    assert got == exact(rows)


def test_terms_of_a_text_do_not_depend_on_its_neighbours():
    texts = ["ab ab cd", "", "xyz", "ab ab cd"]
    together = np.concatenate(list(quality.term_rows(pa.array(texts))))
    for k, text in enumerate(texts):
        assert np.allclose(together[k], next(quality.term_rows(pa.array([text])))[0])


def test_search_of_clusters_and_an_outlier(spark):
    """Most queries have their neighbours at few bits; an outlier gets its own all the same."""
    r = np.random.default_rng(7)
    centres = 4 * r.normal(size=(25, 32))
    rows = [(i, (centres[i % 25] + 0.02 * r.normal(size=32)).tolist()) for i in range(1, 2500) if i % 100]
    rows += [(i, (centres[(i // 100) % 25] + 0.02 * r.normal(size=32)).tolist()) for i in range(100, 6000, 100)]
    rows += [(6000, (6 * r.normal(size=32)).tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want, got = exact(rows), {}
    for x in search(df, F.col("vec_id") % 100 == 0).collect():
        got.setdefault(x.query_id, []).append(x.vec_id)
    assert {q: len(v) for q, v in got.items()} == dict.fromkeys(want, 10)
    assert sum(len(set(want[q]) & set(got[q])) for q in want) >= 0.9 * sum(map(len, want.values()))


def test_quality_scores_do_not_depend_on_the_sample(spark, monkeypatch):
    """The same 1000 documents by all labelled rows (some 2700 to 450) and by 150 of each label."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    some = docs.where("doc_id % 10 = 0")
    monkeypatch.setattr(quality, "SAMPLE_PER_LABEL", 10_000)
    whole = {r.doc_id: r for r in quality.score(some, quality.learn(docs, labels)).collect()}
    monkeypatch.setattr(quality, "SAMPLE_PER_LABEL", 150)
    part = {r.doc_id: r for r in quality.score(some, quality.learn(docs, labels)).collect()}
    assert sum(abs(r.score - part[i].score) for i, r in whole.items()) <= 0.01 * len(whole)
    assert sum(r.predicted != part[i].predicted for i, r in whole.items()) <= 0.005 * len(whole)


def test_votes_stand_for_the_labelled_rows():
    vectors = np.eye(2, dtype=np.float32)[[0] * 5 + [0] * 5]
    model = quality.Model(np.eye(quality.TERMS, 2, dtype=np.float32), vectors, np.repeat([1.0, 0.0], 5), 0.85,
                          np.repeat([17.0, 3.0], 5))
    assert model.scores(np.eye(1, quality.TERMS, dtype=np.float32)) == pytest.approx([0.85])


def test_learning_leaves_no_files_and_does_not_depend_on_partitions(spark):
    """Labelled ids are few a task: a table of them is a file a task, and the executors start a chmod for each file."""
    docs, labels = (spark.read.parquet(f"{DATA}/{name}.parquet") for name in ("documents", "labels"))
    before, models = set(Path(shared_folder(spark)).glob("*")), []
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for n in ("3", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            models.append(quality.learn(docs.repartition(int(n)), labels))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert set(Path(shared_folder(spark)).glob("*")) == before
    few, many = models
    assert np.array_equal(few.labels, many.labels) and np.array_equal(few.stands_for, many.stands_for)
    assert np.array_equal(few.projection, many.projection) and np.array_equal(few.vectors, many.vectors)
    assert len(few.labels) == docs.join(labels, "doc_id").where(~quality.held_out()).count()
