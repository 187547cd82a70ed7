import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tabletransfer.llm import bpe
from tabletransfer.llm.bpe import Encoded, Vocabulary, decode, encode, prefixes, revise, round_trip_digests, vocabulary
from .conftest import collected, words

NASTY = ["a", " ", "\n", "\t", "1", "'s", "'", "re", "é", "日本", "😀", "ab", "\x00", "\x85", " ", "!", "--", "\U00010ee7", "꟒"]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=vocabulary().ranks, special_tokens={})


def numbers(ids):
    return np.frombuffer(ids, "<u4").tolist()


def any_text(r):
    kind = r.random()
    if kind < 0.3:
        return "".join(r.choice(NASTY) * r.choice((1, 1, 2, 9)) for _ in range(r.randint(0, 25)))
    if kind < 0.6:
        tokens = vocabulary().tokens
        return b"".join(tokens[r.randrange(len(tokens))] for _ in range(r.randint(0, 15))).decode("utf-8", "ignore")
    return " ".join(words(r.randrange(10**6), r.randint(0, 20)))


def test_ids_like_the_library(library, odd_texts):
    r = random.Random(1)
    texts = [t or "" for t in odd_texts] + [any_text(r) for _ in range(1500)]
    texts += ["a" * 3000, " " * 2000, "ab" * 2000 + "b", "\n" * 999 + "x", "日本語" * 400, "<|endoftext|> is text", "''" * 99]
    for text in texts:
        assert numbers(vocabulary().ids_of(text)) == library.encode_ordinary(text)
        assert vocabulary().decode(vocabulary().ids_of(text)) == text.encode()


def test_characters_like_the_library(library):
    """Among them those that the pattern libraries sort differently."""
    codes = [*range(0, 0x3100), *bpe.stand_ins(), *range(0x10000, 0x1FFFF, 97)]
    for c in (c for c in codes if not 0xD800 <= c < 0xE000):
        text = f"a{chr(c)}a 1{chr(c)}1 {chr(c)}!{chr(c)}"
        assert numbers(vocabulary().ids_of(text)) == library.encode_ordinary(text)


def test_one_last_token_fits_each_prefix():
    words_, data = vocabulary(), "unbelievably 'tis naïve 日本語日本".encode()
    last = words_.last_tokens(data)
    for end in range(1, len(data) + 1):
        fits = [t for t in range(max(0, end - words_.longest), end) for rank in [words_.ranks.get(data[t:end])]
                if rank is not None and words_.stay_apart(last[t - 1] if t else -1, rank)]
        assert [data[t:end] for t in fits] == [words_.tokens[last[end - 1]]]


def test_small_vocabularies(library):
    """Merges of every shape, tokens that no merge makes among them, against the library."""
    r = random.Random(5)
    for _ in range(25):
        ranks = {bytes([b]): b for b in range(256)}
        known = [b"a", b"b", b"c"]
        for _ in range(r.randint(1, 20)):
            token = r.choice(known) + r.choice(known)
            if r.random() < 0.1:
                token = bytes(r.choice(b"abc") for _ in range(r.randint(3, 5)))
            if token not in ranks:
                ranks[token] = len(ranks)
                known.append(token)
        own = Vocabulary(ranks, r"[abc]+|[^abc]+")
        theirs = tiktoken.Encoding("small", pat_str=r"[abc]+|[^abc]+", mergeable_ranks=ranks, special_tokens={})
        for _ in range(60):
            text = "".join(r.choice("abc") for _ in range(r.randint(1, 30)))
            assert numbers(own.ids_of(text)) == theirs.encode_ordinary(text)


def test_edits_equal_encoding_anew():
    r = random.Random(2)
    words_ = vocabulary()
    for n in range(700):
        text = any_text(r) if n % 7 else "a" * r.randint(1, 200) + any_text(r)
        one = Encoded.of(words_, text)
        for _ in range(4):
            a = r.randint(0, len(text))
            b = min(len(text), a + r.choice((0, 0, 1, 3, 40)))
            new = r.choice(("", any_text(r), r.choice(NASTY), r.choice(NASTY)))
            one.replace(a, b, new)
            text = text[:a] + new + text[b:]
            fresh = Encoded.of(words_, text)
            assert (one.text, one.starts, one.last) == (text, fresh.starts, fresh.last)
        assert one.ids() == numbers(words_.ids_of(text))
        again = Encoded.restore(words_, text, *one.stored())
        assert (again.starts, again.last) == (one.starts, one.last)


def test_appends_and_edits_touch_little():
    words_ = vocabulary()
    text = " ".join(words(3, 4000))
    one = Encoded.of(words_, text)
    one.append(" more")
    assert one.changed[0] <= 3 and one.changed[1] < 60
    one.replace(500, 502, "x y")
    assert one.changed[0] <= 6 and one.changed[1] < 100
    long = Encoded.of(words_, "ab" * 5000)
    long.replace(4000, 4001, "zz")
    assert long.changed == (1, pytest.approx(2 + words_.longest, abs=40))
    long.append("ab")
    assert long.changed[1] == 2
    with pytest.raises(ValueError, match="no such characters"):
        one.replace(5, 4, "")


def test_digests(odd_docs, no_docs, library):
    rows = collected(round_trip_digests(odd_docs))
    want = []
    for r in odd_docs.select("doc_id", "text").collect():
        ids = library.encode_ordinary(r.text or "")
        want.append((r.doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256((r.text or "").encode()).hexdigest()))
    assert rows == sorted(want, key=repr)
    assert round_trip_digests(no_docs).collect() == []


def test_tables_are_handed_on_in_small_batches(odd_docs, monkeypatch):
    whole = collected(encode(odd_docs))
    monkeypatch.setattr(bpe, "OUT_BYTES", 50)
    assert collected(encode(odd_docs)) == whole
    assert len(collected(decode(encode(odd_docs)))) == len(whole)


def test_revise(spark, odd_docs, library):
    state = prefixes(odd_docs)
    assert collected(state.select("doc_id", "ids")) == collected(encode(odd_docs))
    edits = "array<struct<start:int,end:int,new:string>>"
    changed = state.selectExpr("*", f"""CASE WHEN doc_id IS NULL THEN cast(null AS {edits})
        ELSE cast(array(struct(null, null, ' and more'), struct(0, 0, 'First '), struct(2, 4, null)) AS {edits}) END AS edits""")
    new = {r.doc_id: r for r in revise(changed).collect()}
    old = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    for i, r in new.items():
        if i is not None:
            text = "First " + old[i] + " and more"
            assert r.text == text[:2] + text[4:] and numbers(r.ids) == library.encode_ordinary(r.text)


def test_wrong_input(spark):
    with pytest.raises(ValueError, match="missing columns"):
        encode(spark.createDataFrame([(1,)], "doc_id long"))
    with pytest.raises(ValueError, match="that the vocabulary does not have"):
        vocabulary().decode(np.array([50256], "<u4").tobytes())
    with pytest.raises(ValueError, match="every single byte"):
        Vocabulary({b"a": 0}, "a")
    assert decode(spark.createDataFrame([(1, None)], "doc_id long, ids binary")).collect()[0].decoded is None
