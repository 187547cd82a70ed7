import hashlib
import re
from collections import defaultdict

import pytest

from tabletransfer.llm.decontaminate import contamination, remove_documents, remove_spans

from .conftest import SCHEMA, words

PATTERN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def brute(rows, items):
    grams = defaultdict(set)
    for item, text in items:
        w = PATTERN.findall((text or "").translate(LOWER))
        n = min(10, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            grams[tuple(w[i:i + n])].add(item)
    out = []
    for doc, text in rows:
        w = PATTERN.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(g) for g in grams}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found |= grams[tuple(w[i:i + n])]
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


@pytest.fixture
def items(spark):
    passage = words(9, 25)
    rows = [(1, " ".join(passage)), (2, "Short item."), (3, None), (4, "..."), (10, "x " + " ".join(passage[5:18]).upper()),
            (11, "ÉTÉ à la plage"), (None, "one two three")]
    return spark.createDataFrame(rows, "item_id long, text string").selectExpr("*", "0 as size", "1 as hash")


def test_like_brute_force(spark, items):
    p = words(9, 25)
    texts = ["before, " + ", ".join(p[3:14]) + "! after", " ".join(p[:9]), "(" + "\n".join(p).upper() + ")",
             "a short item; and a SHORT-ITEM", "ÉTÉ à la plage", "été À la plage", "l’ÉTÉ à la plage", None, "", " . ",
             " ".join(p + p), "one two three"]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in contamination(df, items).collect()), key=repr)
    assert got == brute(rows, [tuple(r)[:2] for r in items.where("item_id is not null").collect()])
    assert sum(r[5] for r in got) >= 5


def test_odd_rows_and_empty_tables(odd_docs, no_docs, items):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    known = [tuple(r)[:2] for r in items.where("item_id is not null").collect()]
    assert sorted((tuple(r) for r in contamination(odd_docs, items).collect()), key=repr) == brute(rows, known)
    assert contamination(no_docs, items).collect() == []
    assert not any(r.contaminated for r in contamination(odd_docs, items.limit(0)).collect())
    assert remove_documents(odd_docs, items).columns == odd_docs.columns


def test_removal(spark, items):
    p = words(9, 25)
    rows = [(1, "Keep this. " + " ".join(p[:12]) + " and this."), (2, "clean"), (3, None), (None, "a short item")]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    assert sorted(r.doc_id for r in remove_documents(df, items).collect()) == [2, 3]
    left = {r.doc_id: r.text for r in remove_spans(df, items).collect()}
    assert left == {1: "Keep this. and this.", 2: "clean", 3: None, None: "a "}


def test_windows_meet_in_a_join_where_they_are_too_many(spark, items, monkeypatch):
    from tabletransfer.llm import decontaminate
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", 0)
    rows = [(1, " ".join(words(9, 25))), (2, "clean")]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    known = [tuple(r)[:2] for r in items.where("item_id is not null").collect()]
    assert sorted((tuple(r) for r in contamination(df, items).collect()), key=repr) == brute(rows, known)
