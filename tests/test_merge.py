import random

import pytest
from pyspark.sql import functions as F

from tabletransfer.session import hadoop_path
from tabletransfer.streaming import merge
from tabletransfer.streaming.merge import BUCKET, merge_epoch, merge_table
from tabletransfer.streaming.sink import table_sink

SCHEMA = "k int, part string, v string, at int"


def rows_of(spark, name):
    spark.catalog.refreshTable(name)
    return sorted((tuple(r) for r in spark.table(name).drop(BUCKET).collect()), key=repr)


def test_like_a_dictionary(spark, db):
    r, want, sink = random.Random(1), {}, table_sink(f"{db}.t", "update", keys=["k", "part"], order_by="at", buckets=5)
    for epoch in range(4):
        batch = [(r.choice([None, *range(30)]), r.choice(["a", "b", None]), f"{epoch}-{n}", epoch * 1000 + n) for n in range(40)]
        if epoch == 2:
            batch = []
        for row in batch:
            want[row[:2]] = row
        df = spark.createDataFrame(batch, SCHEMA)
        for _ in range(2):  # as a replayed epoch
            sink(df, epoch)
        assert rows_of(spark, f"{db}.t") == sorted(want.values(), key=repr)
    filesystem, home = hadoop_path(spark, merge.table_info(spark, f"{db}.t").location)
    kept = [p.getPath().getName() for v in filesystem.listStatus(home) for p in filesystem.listStatus(v.getPath()) if p.isDirectory()]
    assert sorted(kept) == [f"{BUCKET}={b}" for b in range(5)]  # one folder each


def test_only_buckets_with_changed_keys_are_written(spark, db):
    sink = table_sink(f"{db}.t", "update", keys=["k"], buckets=64)
    sink(spark.range(1000).selectExpr("cast(id as int) k", "'old' v"), 0)
    before = {r.f for r in spark.table(f"{db}.t").select(F.input_file_name().alias("f")).distinct().collect()}
    done = sink(spark.createDataFrame([(5, "new"), (5, "newer")], "k int, v string"), 1)
    spark.catalog.refreshTable(f"{db}.t")
    after = {r.f for r in spark.table(f"{db}.t").select(F.input_file_name().alias("f")).distinct().collect()}
    assert len(before - after) == 1 and done.rows == 1 and spark.table(f"{db}.t").count() == 1000
    assert [r.v for r in spark.table(f"{db}.t").where("k = 5").collect()] == ["newer"]


def test_an_epoch_that_dies_is_completed_by_its_replay(spark, db, monkeypatch):
    sink = table_sink(f"{db}.t", "update", keys=["k"], buckets=4)
    sink(spark.range(20).selectExpr("cast(id as int) k", "'old' v"), 0)
    new = spark.range(5, 30).selectExpr("cast(id as int) k", "'new' v")
    point = merge._point_to

    class Killed(BaseException):
        pass

    def half(spark_, target, home, version, touched):
        point(spark_, target, home, version, touched[:2])
        raise Killed

    with monkeypatch.context() as m:
        m.setattr(merge, "_point_to", half)
        with pytest.raises(Killed):
            sink(new, 1)
    assert len(rows_of(spark, f"{db}.t")) >= 20  # no key is lost meanwhile
    sink(new, 1)
    assert rows_of(spark, f"{db}.t") == sorted([(k, "old") for k in range(5)] + [(k, "new") for k in range(5, 30)], key=repr)


def test_what_does_not_fit_is_refused(spark, db):
    df = spark.createDataFrame([(1, "x")], "k int, v string")
    for wrong in ({}, {"keys": ["k"], "distributed_by": "k"}):
        with pytest.raises(ValueError):
            table_sink(f"{db}.t", "update", **wrong)
    with pytest.raises(ValueError, match="belong to update"):
        table_sink(f"{db}.t", "append", keys=["k"])
    with pytest.raises(ValueError, match="columns of the stream"):
        table_sink(f"{db}.t", "update", keys=["other"])(df, 0)
    merge_table(df, f"{db}.t", ["k"], 4)
    with pytest.raises(ValueError, match="not a table of merges by v"):
        merge_table(df, f"{db}.t", ["v"], 4)
