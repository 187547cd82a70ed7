import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tabletransfer.llm.bestfit import CapacityTree, best_fit_decreasing, pack_matrix
from tabletransfer.llm.mixture import TURN, pack
from tabletransfer.llm.rollups import Rollup, counted, deletes, inserts, maintained, revisions
from tabletransfer.llm.shared import new_path
from tabletransfer.llm.tokens import VOCABULARY, token_ids

from .conftest import SCHEMA, words

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def slow():
    return Tokenizer.from_file(public_tokenizers.path(VOCABULARY))


def ids_of(slow, text):
    return slow.encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_are_those_of_the_tokenizers_library(slow, odd_texts):
    texts = odd_texts + ["a<|endoftext|>b", "tabs\t\tand  spaces \n\n x", "it's 12３４ ½", "\x00\x7f 　."]
    assert [i.tolist() + [0] for i in token_ids(pa.array(texts))] == [ids_of(slow, t) for t in texts]


def check_cover(slow, docs, pieces):
    """All pieces together hold every document's ids once, and sequences have no gap."""
    texts = Counter((d.doc_id, tuple(ids_of(slow, d.text))) for d in docs)
    by_doc = defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
    want = Counter()
    for (doc, ids), n in texts.items():
        for p in {(p.start, p.length) for p in by_doc[doc] if p.doc_tokens == len(ids)}:
            part = np.array(ids[p[0]:p[0] + p[1]], "<u4")
            want[doc, p[0], p[1], zlib.crc32(part.tobytes())] += 0
    assert all(p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes()) and len(p.ids) == p.length for p in pieces)
    assert {(p.doc_id, p.start, p.length, p.ids_crc32) for p in pieces} <= set(want)
    assert Counter(d for d, ids in texts.elements() for _ in ids) == Counter(p.doc_id for p in pieces for _ in range(p.length))
    rows = sorted((p.sequence_id, p.offset, p.length) for p in pieces)
    at = 0
    for sequence, offset, length in rows:
        assert (sequence, offset) == divmod(at, 1024) and offset + length <= 1024
        at += length


def test_mixture_packs_everything_in_proportion(spark, slow):
    docs = spark.read.parquet(f"{DATA}/documents.parquet").repartition(7)
    pieces = pack(docs, with_ids=True).collect()
    check_cover(slow, docs.collect(), pieces)
    total = Counter()
    for p in pieces:
        total[p.queue] += p.length
    share = {q: n / sum(total.values()) for q, n in total.items()}
    last = max(p.sequence_id for p in pieces)
    for part in (10, last // 3, last // 2):
        sent = Counter()
        for p in pieces:
            if p.sequence_id < part:
                sent[p.queue] += p.length
        assert all(abs(sent[q] - share[q] * part * 1024) <= 2 * TURN for q in share)


def test_mixture_by_weights(spark, slow):
    rows = [(i, " ".join(words(i, 300)), "en", "ab"[i % 2], 0) for i in range(40)]
    docs = spark.createDataFrame(rows, SCHEMA)
    pieces = pack(docs, weights={"a": 3.0, "b": 1.0}, with_ids=True).collect()
    check_cover(slow, docs.collect(), pieces)
    early = Counter()
    for p in pieces:
        if p.sequence_id < 8:
            early[p.queue] += p.length
    assert abs(early["=a"] - 3 * early["=b"]) <= 4 * TURN


def test_mixture_with_more_sources_than_queues(spark, slow, monkeypatch):
    from tabletransfer.llm import mixture
    monkeypatch.setattr(mixture, "MAX_QUEUES", 3)
    docs = spark.createDataFrame([(i, " ".join(words(i, 50)), "en", f"s{i}", 0) for i in range(9)], SCHEMA)
    pieces = pack(docs, with_ids=True).collect()
    check_cover(slow, docs.collect(), pieces)
    assert {p.queue for p in pieces} == {f"=s{i}" for i in range(9)}


@pytest.mark.parametrize("weights", [None, {"s1": 4000.0, "s5": 90.5, "": 7.0}])
def test_many_sources_are_packed_like_few(spark, slow, monkeypatch, weights):
    """One queue per source at every size: places do not depend on how they are found."""
    from tabletransfer.llm import mixture
    monkeypatch.setattr(mixture, "TURNS_TOGETHER", 2)
    rows = [(i, " ".join(words(i, 20 + 37 * i % 400)), "en", (f"s{i % 12}", None, "")[i % 40 // 38 + i % 40 // 39], 0) for i in range(120)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5, "doc_id")
    few = sorted(map(tuple, pack(docs, weights=weights).drop("queue").collect()))
    monkeypatch.setattr(mixture, "MAX_QUEUES", 3)
    pieces = pack(docs, weights=weights, with_ids=True).collect()
    check_cover(slow, docs.collect(), pieces)
    assert sorted(tuple(p)[:7] for p in pieces) == few


def test_mixture_of_odd_rows(odd_docs, no_docs, slow):
    pieces = pack(odd_docs, with_ids=True).collect()
    check_cover(slow, odd_docs.collect(), pieces)
    assert pack(no_docs).collect() == []


def test_capacity_tree_like_search():
    r = np.random.default_rng(2)
    tree, open_rows = CapacityTree(50), []
    for row in range(400):
        if r.random() < 0.5:
            capacity = int(r.integers(1, 51))
            tree.put(capacity, row)
            open_rows.append(capacity)
        else:
            size = int(r.integers(1, 51))
            want = min((c for c in open_rows if c >= size), default=None)
            found = tree.take(size)
            assert (found and found[0]) == want
            if want is not None:
                open_rows.remove(want)


def test_best_fit_decreasing():
    assert [sorted(r) for r in best_fit_decreasing(np.array([6, 5, 5, 4, 10]), 10)] == [[4], [0, 3], [1, 2]]
    assert best_fit_decreasing(np.zeros(0, int), 10) == []


def test_matrix_round_trip(spark, slow, odd_docs, no_docs):
    rows = pack_matrix(odd_docs).collect()
    pieces = defaultdict(list)
    for r in rows:
        ids, positions = np.frombuffer(r.ids, "<u2"), np.frombuffer(r.positions, "<u2")
        assert len(ids) == len(positions) == 1024 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens
        assert not ids[r.n_tokens:].any() and not positions[r.n_tokens:].any()
        for k, (doc, start) in enumerate(zip(r.doc_ids, r.starts)):
            a, b = r.cu_seqlens[k], r.cu_seqlens[k + 1]
            assert positions[a:b].tolist() == list(range(b - a))
            pieces[doc].append((start, ids[a:b].tolist()))
    assert len({r.sequence_id for r in rows}) == len(rows)
    want = defaultdict(list)
    for d in odd_docs.collect():
        ids = ids_of(slow, d.text)
        want[d.doc_id] += [(a, ids[a:a + 1024]) for a in range(0, len(ids), 1024)]
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in want.items()}
    assert pack_matrix(no_docs).collect() == []


def test_matrix_has_little_padding(spark):
    rows = pack_matrix(spark.read.parquet(f"{DATA}/documents.parquet")).select("n_tokens").collect()
    assert sum(r.n_tokens for r in rows) > 0.98 * 1024 * len(rows)


def totals(rollup):
    return {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in rollup.totals().collect()}


def test_rollup_batches_count_once(spark):
    docs = spark.createDataFrame([(1, "a b c", "en", "x", 0), (2, "d", None, "x", 0), (3, None, "en", None, 0)], SCHEMA)
    rollup = Rollup(spark, new_path(spark, "rollup"))
    assert totals(rollup) == {}
    rows = counted(docs).where("tokenizer = 'words-1'")
    assert rollup.commit(1, inserts(rows)) and rollup.commit(1, inserts(rows))
    first = {("x", "en", "words-1"): (1, 3), ("x", None, "words-1"): (1, 1), (None, "en", "words-1"): (1, 0)}
    assert totals(rollup) == first
    rollup.compact()
    assert totals(rollup) == first and not rollup.commit(1, inserts(rows))
    new = counted(spark.createDataFrame([(1, "a b", "fr", "x", 0)], SCHEMA)).where("tokenizer = 'words-1'")
    rollup.commit(2, revisions(rows.where("doc_id = 1"), new))
    rollup.commit(3, deletes(rows.where("doc_id = 3")))
    want = {("x", "fr", "words-1"): (1, 2), ("x", None, "words-1"): (1, 1)}
    assert totals(rollup) == want
    rollup.compact()
    rollup.compact()
    assert totals(rollup) == want
    assert sorted(r.batch_id for r in rollup._folded(rollup._base()[0]).collect()) == [1, 2, 3]


def one_batch(spark, tokens, source="x"):
    return inserts(spark.createDataFrame([(1, source, "en", "words-1", tokens)], "doc_id long, source string, lang string, tokenizer string, tokens long"))


def test_rollup_commit_while_compacting(spark, monkeypatch):
    """A batch that comes between the sums and the ids of a compaction is counted once, later."""
    rollup, other = Rollup(spark, new_path(spark, "rollup")), None
    other = Rollup(spark, rollup.path)
    rollup.commit(1, one_batch(spark, 5))
    add = Rollup._sum
    calls = []

    def summed(self, base, batches):
        result = add(self, base, batches)
        if not calls:
            calls.append(other.commit(2, one_batch(spark, 7)))
        return result

    monkeypatch.setattr(Rollup, "_sum", summed)
    rollup.compact()
    assert calls == [True] and totals(rollup) == {("x", "en", "words-1"): (2, 12)}
    rollup.compact()
    rollup.commit(3, one_batch(spark, 1))
    rollup.compact()
    assert totals(rollup) == {("x", "en", "words-1"): (3, 13)}
    # Folders of batches that were folded before the newest base are gone.
    assert [p.split("/")[-2] for p in rollup._complete("deltas/batch_id=*/*")] == ["batch_id=3"]
    assert not rollup.commit(1, one_batch(spark, 5))


def test_rollup_commit_that_dies_again(spark):
    """A repeated commit that fails half way leaves the batch as it was."""
    rollup = Rollup(spark, new_path(spark, "rollup"))
    rollup.commit(1, one_batch(spark, 5))
    broken = one_batch(spark, 5).withColumn("tokens", F.raise_error(F.lit("died")).cast("long"))
    with pytest.raises(Exception, match="died"):
        rollup.commit(1, broken)
    assert totals(rollup) == {("x", "en", "words-1"): (1, 5)}
    assert rollup.commit(1, one_batch(spark, 6)) and totals(rollup) == {("x", "en", "words-1"): (1, 6)}


def test_rollup_query_like_brute_force(spark, slow):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in maintained(docs, labels, new_path(spark, "r")).collect()}
    marks = {r.doc_id: r for r in labels.collect()}
    want = defaultdict(lambda: [0, 0])
    for d in docs.collect():
        mark = marks.get(d.doc_id)
        if mark and mark.toxic == 1:
            continue
        text = " ".join(d.text.split()) if mark and mark.quality == 0 else d.text
        for kind, n in (("words-1", len(text.split())), (VOCABULARY, len(ids_of(slow, text)) - 1)):
            want[d.source, d.lang, kind][0] += 1
            want[d.source, d.lang, kind][1] += n
    assert got == {k: tuple(v) for k, v in want.items()}


def test_rollup_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(5, 0, 1), (7, 0, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    rows = maintained(odd_docs, labels, new_path(spark, "r")).collect()
    assert sum(r.documents for r in rows) == 2 * (odd_docs.count() - 2)
    assert maintained(no_docs, labels, new_path(spark, "r")).collect() == []
