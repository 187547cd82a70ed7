from pathlib import Path

import pyarrow as pa
import pytest

import corpus_pipeline
from tabletransfer.llm.shared import shared_folder
from tabletransfer.llm.tokens import VOCABULARY, token_ids

from .conftest import SCHEMA, words


def text_of(seed, n=90):
    return " ".join(words(seed, n))


def junk(seed):
    return " ".join(f"{seed * 7919 % 1000} $$ !! {seed}{seed}" for _ in range(20))


ROWS = [(i, text_of(i), "en", "a", 0) for i in range(30)] + [(100 + i, junk(i), "en", "b", 0) for i in range(30)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Two kinds of documents; repeated rows, copies without id, near copies and junk without id."""
    out = tmp_path_factory.mktemp("corpus")
    rows = ROWS + [
        ROWS[1],  # a repeated row
        (None, ROWS[2][1], "en", "a", 0),  # a copy without id
        (None, text_of(500), "en", "a", 0), (None, text_of(500), "en", "a", 0),  # copies without any id
        (7, ROWS[5][1] + " end", "en", "a", 0),  # a near copy that has another text's id
        (None, junk(900), "en", "b", 0)]  # of low quality, without id
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{out}/documents.parquet")
    spark.createDataFrame([(r[0], int(r[0] < 100), 0) for r in ROWS], "doc_id long, quality int, toxic int").write.parquet(
        f"{out}/labels.parquet")
    spark.createDataFrame([(1, text_of(800, 20))], "item_id long, text string").write.parquet(f"{out}/benchmark.parquet")
    return str(out)


def test_one_row_of_each_copy_reaches_the_end(spark, folder):
    want = {r[0]: r[1] for r in ROWS if r[0] < 100} | {None: text_of(500)}
    got = {r.doc_id: r.n for r in corpus_pipeline.run(spark, folder).groupBy("doc_id").agg({"length": "sum"}).toDF("doc_id", "n").collect()}
    assert got == {i: len(ids) + 1 for i, ids in zip(want, token_ids(pa.array(list(want.values())), VOCABULARY))}


def test_tables_on_the_way_are_deleted(spark, folder):
    def kept():
        return {p.name for p in Path(shared_folder(spark)).glob("*")}

    before = kept()
    out = corpus_pipeline.run(spark, folder)
    assert [name.split("-")[0] for name in kept() - before] == ["packing"]
    assert out.count() > 0
    before = kept()
    left = corpus_pipeline.near_dedup(spark, spark.read.parquet(f"{folder}/documents.parquet"), folder)
    assert sorted(name.split("-")[0] for name in kept() - before) == ["marks", "numbered"]
    assert left.count() == len({r[1] for r in ROWS}) + 2


def test_rows_without_words_are_not_copies(spark):
    rows = [(1, ""), (1, ""), (1, " "), (2, None), (2, None), (None, ""), (None, ""), (3, "one")]
    docs = spark.createDataFrame([(i, t, None, None, 0) for i, t in rows], SCHEMA)
    left = corpus_pipeline.near_dedup(spark, docs, "").select("doc_id", "text").collect()
    assert sorted(map(tuple, left), key=repr) == sorted([(1, ""), (1, " "), (2, None), (None, ""), (None, ""), (3, "one")], key=repr)
