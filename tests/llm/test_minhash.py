import random
from collections import defaultdict

import numpy as np
import pyarrow as pa

from tabletransfer.llm.graph import components
from tabletransfer.llm.minhash import COORDINATES, RING, near_duplicates, permutations, shingle_sets, signature

from .conftest import SCHEMA, words


def brute(rows):
    """Components by comparing all pairs; rows are (id, text)."""
    def shingles(text):
        found, word = [], []
        for c in (text or "") + " ":
            if c in " \t\n\x0b\x0c\r":
                if word:
                    found.append("".join(word))
                word = []
            else:
                word.append(c.lower() if "A" <= c <= "Z" else c)
        return {tuple(found[i:i + 5]) for i in range(max(len(found) - 4, 1))} if found else set()

    sets = [(i, shingles(t)) for i, t in rows]
    parent = list(range(len(sets)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(sets)):
        for b in range(a):
            x, y = sets[a][1], sets[b][1]
            if sets[a][0] == sets[b][0] or (x and y and 100 * len(x & y) >= 75 * len(x | y)):
                parent[root(a)] = root(b)
    least = defaultdict(list)
    for k, (i, _) in enumerate(sets):
        least[root(k)].append(i)
    return sorted((i, len(s), min(least[root(k)])) for k, (i, s) in enumerate(sets))


def got(df):
    return sorted((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def test_like_all_pairs(spark):
    r = random.Random(4)
    rows = []
    for group in range(25):
        base = words(group, r.choice([3, 5, 9, 60, 200]))
        for _ in range(r.randint(1, 6)):
            text = list(base)
            for _ in range(r.randint(0, 5)):
                text[r.randrange(len(text))] = r.choice(["other", "Word", base[0].upper()])
            rows.append((len(rows), " ".join(text)))
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    assert got(near_duplicates(df)) == brute(rows)


def test_a_chain_of_near_copies_is_one_component(spark):
    base = words(7, 100)
    rows = [(50 - k, " ".join(["new"] * 2 * k + base[2 * k:])) for k in range(20)]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    assert got(near_duplicates(df)) == brute(rows)


def test_blocks_find_links_beside_the_centre(spark, monkeypatch):
    from tabletransfer.llm import minhash
    monkeypatch.setattr(minhash, "BLOCK_TEXTS", 4)
    shared = words(1, 60)
    rows = [(k, " ".join(shared + words(100 + k // 2, 30) + ([] if k % 2 else ["tail"]))) for k in range(40)]
    df = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    assert got(near_duplicates(df)) == brute(rows)


def test_odd_rows(odd_docs):
    rows = near_duplicates(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by_id = {r.doc_id: r for r in rows if r.doc_id is not None}
    assert [by_id[i].n_shingles for i in range(4)] == [0, 0, 0, 1]
    assert by_id[0].kept and by_id[1].kept and by_id[0].component_id == 0
    assert by_id[5].component_id == by_id[6].component_id == 5 and not by_id[6].kept
    assert by_id[8].component_id == 7
    null = sorted(((r.component_id, r.kept) for r in rows if r.doc_id is None), key=repr)
    assert null == [(5, False), (None, True)]


def test_empty_table(no_docs):
    assert near_duplicates(no_docs).collect() == []


def test_signature_is_the_second_permutation_shifted():
    scatter, windows = permutations()
    values = windows[:, 0]
    shingles = next(iter(shingle_sets(pa.array([" ".join(words(3, 50))]))))
    at = scatter[shingles & np.uint64(RING - 1)].astype(int)
    assert signature(shingles).tolist() == [int(values[(at + k) % RING].min()) for k in range(COORDINATES)]


def test_components_of_long_paths(spark):
    edges = [(k, k + 1) for k in range(200)] + [(500, 501), (501, 500), (7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    found = {r.id: r.component for r in components(df).collect()}
    assert found == {**{k: 0 for k in range(201)}, 500: 500, 501: 500}
