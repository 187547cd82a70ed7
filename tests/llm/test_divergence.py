import random
import re
from collections import Counter

import numpy as np
import pytest

from tabletransfer.llm import divergence as module
from tabletransfer.llm.divergence import FANOUT, Tree, audit, divergence, joint_gaps

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def by_hand(rows):
    """The contract in plain Python, from (text, lang, source)."""
    rows = [tuple(v or "" for v in r) for r in rows]
    out = []
    for lang in {r[1] for r in rows}:
        counts, documents = {}, Counter()
        for text, own, source in rows:
            if own == lang:
                terms = TERM.findall(text.translate(LOWER))
                counts.setdefault(source, Counter()).update(terms)
                documents.update(set(terms))
        kept = [t for t, d in documents.items() if d >= 10]

        def prices(count):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: prices(c) for s, c in counts.items()}
        q = prices(sum(counts.values(), Counter()))
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in counts:
            pairs = [(o, sum(f(p[s][t], p[o][t]) for t in kept)) for o in counts if o != s]
            terms = [(t, f(p[s][t], q[t])) for t in kept if counts[s][t] and p[s][t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, 10)):
                items.sort(key=lambda i: (-i[1], i[0].encode()))
                out += [(lang, s, part, item, value, k + 1) for k, (item, value) in enumerate(items[:most])]
    return sorted(out)


def corpus(seed, n, sources, langs=("en", "de")):
    r = random.Random(seed)
    vocabulary = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(150)] + ["Été", "ÉTÉ", "日本", "x" * 300, "😀z"]
    rows = []
    for _ in range(n):
        source = r.choice(sources)
        bias = hash(source) % 40 if source else 0
        text = r.choice((" ", "\n", "1", "--", "\x00")).join(
            vocabulary[min(int(r.expovariate(0.02)) + bias, len(vocabulary) - 1)].upper() if r.random() < 0.2
            else r.choice(vocabulary) for _ in range(r.randint(0, 60)))
        rows.append((text, r.choice(langs), source))
    return rows


def frame(spark, rows):
    return spark.createDataFrame(rows, "text string, lang string, source string").selectExpr(
        "1L as doc_id", "*", "2 as n", "'t' as term", "3 as p", "'v' as value", "4 as rank", "5 as block", "6 as number")


@pytest.mark.parametrize("slice_bytes, held", [(1 << 20, 1 << 19), (16, 50)])
def test_like_by_hand(spark, monkeypatch, slice_bytes, held):
    monkeypatch.setattr(module, "SLICE", slice_bytes)
    monkeypatch.setattr(module, "HELD", held)
    rows = corpus(1, 300, ["a", "b", "c", None, "", "only here"])
    rows += [("few words", "fr", "a"), (None, "fr", "b"), ("", "fr", "empty"), (None, None, None), ("wa wb", None, "a")]
    rows += [("waa wab " * 3000, "en", "long")] + [("copy of waa", "en", "copies")] * 40
    assert sorted(map(tuple, divergence(frame(spark, rows)).collect())) == by_hand(rows)


def test_more_groups_than_a_block_and_terms_than_a_stripe(spark, monkeypatch):
    monkeypatch.setattr(module, "ROWS", 4)
    monkeypatch.setattr(module, "COLUMNS", 16)
    monkeypatch.setattr(module, "STEP", 8)
    rows = corpus(2, 400, [f"s{k}" for k in range(11)], ("en", None))
    assert sorted(map(tuple, divergence(frame(spark, rows)).collect())) == by_hand(rows)


def test_no_documents_and_a_single_group(spark):
    assert divergence(frame(spark, [])).collect() == []
    assert divergence(frame(spark, [("one two", "en", "a")])).collect() == []
    assert [tuple(r) for r in divergence(frame(spark, [("one", "en", "a"), ("two", "en", "b")])).collect()] == [
        ("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]
    with pytest.raises(ValueError, match="missing columns"):
        divergence(spark.createDataFrame([("a",)], "text string"))


def test_audit_keeps_all_terms(spark):
    rows = corpus(3, 200, ["a", "b"], ("en",))
    found = audit(frame(spark, rows))
    assert found.groups.count() == 2 and found.terms.count() > 20
    best = {(r[1], r[3]): r[4] for r in by_hand(rows) if r[2] == "term"}
    every = {(r.source, r.term): r.value for r in found.terms.collect()}
    assert best.items() <= every.items()


def test_joint_walk_like_a_dense_comparison():
    r = np.random.default_rng(4)
    for n, m, width, density in ((5, 7, 30, 0.1), (16, 16, 64, 0.02), (3, 1, 1, 1.0), (4, 4, 0, 0), (9, 9, 200, 0.5), (6, 6, 50, 0.0)):
        dense = [r.integers(1, 1_000_000_001, (k, width)) * (r.random((k, width)) < density) for k in (n, m)]
        zero = [r.integers(1, 1000, k) for k in (n, m)]
        depth = 1
        while FANOUT ** depth < max(n, m, width):
            depth += 1
        trees = []
        for d in dense:
            at = np.nonzero(d)
            trees.append(Tree(*(a.astype(np.int64) for a in at), d[at], depth))
        p = np.where(dense[0] > 0, dense[0], zero[0][:, None])[:, None, :]
        q = np.where(dense[1] > 0, dense[1], zero[1][:, None])[None, :, :]
        want = ((p - q) ** 2 // (p + q)).sum(axis=2)
        assert (joint_gaps(*trees, *zero, width, False) == want).all()
        if n == m:
            upper = np.triu(np.ones((n, n), bool), 1)
            assert (joint_gaps(*trees, *zero, width, True)[upper] == want[upper]).all()
