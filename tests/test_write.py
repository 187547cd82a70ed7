import os

import pytest
from pyspark.sql import functions as F

from tabletransfer.operators.distribution import parse_distribution
from tabletransfer.sinks.catalog import table_info
from tabletransfer.sinks.tables import write_table
from tabletransfer.sources.tables import read_distributed, read_parallel, read_table


def same(a, b):
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def failing(orders):
    return orders.withColumn("o_custkey", F.when(F.col("o_orderkey") >= 0, F.raise_error(F.lit("boom")).cast("long")))


def folders(spark, db):
    root = spark.catalog.getDatabase(db).locationUri.removeprefix("file:")
    return [f for f in os.listdir(root) if not f.startswith(".")] if os.path.exists(root) else []


def test_append_creates_then_adds(spark, db, orders):
    first = write_table(orders, f"{db}.t", "append")
    second = write_table(orders.limit(10), f"{db}.t", "append")
    assert (first.action, first.rows, first.files > 0, first.bytes > 0) == ("created", orders.count(), True, True)
    assert (second.action, second.rows, second.files) == ("appended", 10, None)
    assert spark.table(f"{db}.t").count() == orders.count() + 10
    assert first.to_df(spark).head().rows == orders.count()


def test_append_by_name_with_a_subset(spark, db, orders):
    write_table(orders, f"{db}.t", "append")
    write_table(orders.limit(3).select("o_custkey", F.col("o_orderkey").cast("int")), f"{db}.t", "append")
    added = spark.table(f"{db}.t").where("o_orderstatus IS NULL")
    assert added.count() == 3 and added.where("o_orderkey IS NULL").count() == 0
    with pytest.raises(ValueError, match="no column"):
        write_table(orders.withColumn("other", F.lit(1)), f"{db}.t", "append")


def test_overwrite_takes_the_new_schema(spark, db, orders):
    write_table(orders, f"{db}.t", "append")
    write_table(orders.select(F.col("o_orderkey").cast("string").alias("k")), f"{db}.t", "overwrite")
    assert spark.table(f"{db}.t").dtypes == [("k", "string")]
    assert len(folders(spark, db)) == 1


def test_truncate_keeps_structure(spark, db, orders):
    write_table(orders, f"{db}.t", "append", distributed_by="o_custkey", buckets=4, partition_by="o_orderstatus")
    write_table(orders.limit(20).drop("o_totalprice"), f"{db}.t", "overwrite", truncate=True)
    info = table_info(spark, f"{db}.t")
    assert (info.num_buckets, info.bucket_columns, info.partition_columns) == (4, ["o_custkey"], ["o_orderstatus"])
    assert spark.table(f"{db}.t").where("o_totalprice IS NULL").count() == 20
    assert len(folders(spark, db)) == 1


def test_modes(spark, db, orders):
    with pytest.raises(TypeError):
        write_table(orders, f"{db}.t")
    with pytest.raises(ValueError, match="mode"):
        write_table(orders, f"{db}.t", "replace")
    assert write_table(orders, f"{db}.t", "ERROR").action == "created"
    assert write_table(orders.limit(1), f"{db}.t", "ignore").action == "ignored"
    with pytest.raises(ValueError, match="exists"):
        write_table(orders, f"{db}.t", "errorifexists")
    assert spark.table(f"{db}.t").count() == orders.count()


@pytest.mark.parametrize("kwargs", [
    {"mode": "append"}, {"mode": "overwrite"}, {"mode": "overwrite", "truncate": True}])
def test_failure_leaves_the_table_and_runs_undo(spark, db, orders, kwargs):
    write_table(orders, f"{db}.t", "append")
    undone = []
    with pytest.raises(Exception, match="boom"):
        write_table(failing(orders), f"{db}.t", undo=lambda: undone.append(1), **kwargs)
    assert undone == [1]
    assert same(spark.table(f"{db}.t"), orders)
    assert len(folders(spark, db)) == 1
    assert len(spark.catalog.listTables(db)) == 1 + sum(t.isTemporary for t in spark.catalog.listTables(db))


def test_failed_create_leaves_nothing(spark, db, orders):
    with pytest.raises(Exception, match="boom"):
        write_table(failing(orders), f"{db}.t", "append")
    assert not spark.catalog.tableExists(f"{db}.t")
    assert folders(spark, db) == []


def test_failed_publish_restores_the_old_table(spark, db, orders, monkeypatch):
    from tabletransfer.sinks import catalog

    write_table(orders, f"{db}.t", "append")
    spoiled = catalog.Target("", False, db, "no_such_staging_table")
    with pytest.raises(Exception):
        catalog.publish(spark, spoiled, catalog.Target("", False, db, "t"))
    assert same(spark.table(f"{db}.t"), orders)


def test_overwrite_of_the_table_being_read(spark, db, orders):
    write_table(orders, f"{db}.t", "append")
    for truncate in (False, True):
        write_table(spark.table(f"{db}.t").where("o_custkey > 50"), f"{db}.t", "overwrite", truncate=truncate)
    assert same(spark.table(f"{db}.t"), orders.where("o_custkey > 50"))


def test_overwrite_of_a_managed_table(spark, db, orders):
    orders.write.saveAsTable(f"{db}.t")
    write_table(orders.limit(5), f"{db}.t", "overwrite")
    assert spark.table(f"{db}.t").count() == 5


def test_empty_frame_keeps_its_schema(spark, db, orders):
    assert write_table(orders.where("o_orderkey < 0"), f"{db}.t", "overwrite").rows == 0
    assert spark.table(f"{db}.t").schema == orders.schema
    assert spark.table(f"{db}.t").count() == 0


@pytest.mark.parametrize("text, kind, columns", [
    ("replicated", "replicated", ()), (" DISTRIBUTED  Replicated ", "replicated", ()),
    ("randomly", "randomly", ()), ("distributed randomly", "randomly", ()),
    ("a, b", "by_key", ("a", "b")), ("Distributed By (a desc, \"B c\")", "by_key", ("a", "B c")),
    ("`x y`", "by_key", ("x y",))])
def test_distribution_clauses(text, kind, columns):
    dist = parse_distribution(text)
    assert (dist.kind, dist.columns) == (kind, columns)


def test_no_distribution():
    assert parse_distribution(None) is None and parse_distribution("  ") is None
    with pytest.raises(ValueError):
        parse_distribution("by (a")


def test_bucketed_tables_join_without_a_shuffle(spark, db, orders, plan):
    write_table(orders, f"{db}.a", "append", distributed_by="o_custkey", buckets=4)
    write_table(orders.limit(100), f"{db}.b", "append", distributed_by="o_custkey", buckets=4)
    a, b = (read_table(spark, f"{db}.{n}", columns=["o_custkey", "o_orderkey"]) for n in "ab")
    joined = a.hint("merge").join(b, "o_custkey")
    text = plan(joined)
    assert "SortMergeJoin" in text and "Exchange" not in text
    assert joined.count() == orders.join(orders.limit(100), "o_custkey").count()
    assert "Exchange" not in plan(read_distributed(spark, f"{db}.a", "o_custkey"))
    assert "REBALANCE" in plan(read_distributed(spark, f"{db}.a", "o_orderkey", 4))


def test_hot_key_is_split_over_tasks(spark, db):
    """One key with a third of all rows must not be written by one task."""
    rows = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        write_table(rows, f"{db}.hot", "append", distributed_by="k", buckets=8)
        write_table(rows.withColumn("p", F.col("k") == -7), f"{db}.part", "append", partition_by=["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    for name in ("hot", "part"):
        stored = spark.table(f"{db}.{name}")
        assert stored.count() == 300_000 and stored.where("k = -7").count() == 100_000
        files = stored.where("k = -7").select(F.input_file_name().alias("f")).distinct().count()
        assert files > 2
    assert spark.table(f"{db}.hot").groupBy("k").count().where("k = -7").head()["count"] == 100_000


def test_hot_key_is_salted_without_adaptive_execution(spark, db):
    rows = spark.range(0, 30_000, 1, 8).select(F.when(F.col("id") % 3 == 0, -7).otherwise(F.col("id")).alias("k"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        write_table(rows, f"{db}.hot", "append", distributed_by="k", buckets=8)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    stored = spark.table(f"{db}.hot")
    assert stored.columns == ["k"] and stored.count() == 30_000
    assert stored.where("k = -7").select(F.input_file_name()).distinct().count() > 2


def test_plain_write_does_not_shuffle(spark, db, orders):
    spread_out = orders.repartition(6)
    write_table(spread_out, f"{db}.t", "append", writers=2)
    assert spark.table(f"{db}.t").select(F.input_file_name()).distinct().count() == 2


def test_replicated_is_broadcast_only_while_small(spark, db, orders, plan):
    write_table(orders.limit(50), f"{db}.r", "append", distributed_by="replicated")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
        assert "BroadcastHashJoin" in plan(orders.join(read_table(spark, f"{db}.r"), "o_orderkey"))
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100")
        assert "BroadcastHashJoin" not in plan(orders.join(read_table(spark, f"{db}.r"), "o_orderkey"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_partition_pruning(spark, db, orders, plan):
    write_table(orders, f"{db}.p", "append", partition_by=["o_orderstatus"])
    text = plan(read_table(spark, f"{db}.p", columns=["o_orderkey"]).where("o_orderstatus = 'F'"))
    assert "PartitionFilters: [isnotnull(o_orderstatus" in text


def test_parallel_read(spark, db, orders, plan):
    write_table(orders.repartition(6), f"{db}.t", "append")
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", str(128 << 20))
    try:
        stored = read_table(spark, f"{db}.t")
        assert "Exchange" not in plan(read_parallel(stored, 6))
        wide = read_parallel(stored, 40, ["o_orderkey"])
        assert wide.rdd.getNumPartitions() == 40 and wide.count() == orders.count()
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    with pytest.raises(ValueError):
        read_parallel(orders, 0)


def test_count_reads_no_columns(spark, orders, plan):
    assert "ReadSchema: struct<>" in plan(orders.groupBy().count())


def test_writes_of_another_session_are_seen(spark, db, orders):
    write_table(orders, f"{db}.t", "append")
    assert read_table(spark, f"{db}.t").count() == orders.count()
    other = spark.newSession()
    mine = other.createDataFrame([(1, 2)], "o_orderkey bigint, o_custkey bigint")
    write_table(mine, f"{db}.t", "append")
    assert read_table(spark, f"{db}.t").count() == orders.count() + 1
    write_table(mine, f"{db}.t", "overwrite")
    assert read_table(spark, f"{db}.t").collect() == mine.collect()


def test_a_view_of_the_same_name_is_left_alone(spark, orders):
    assert write_table(orders.limit(3), "orders", "overwrite").table == "`default`.`orders`"
    assert write_table(orders.limit(2), "orders", "append").action == "appended"
    assert spark.table("orders").count() == orders.count()
    assert spark.table("default.orders").count() == 5
    with pytest.raises(ValueError, match="query"):
        write_table(orders, "select 1", "append")
    spark.sql("DROP TABLE default.orders")


def test_missing_table(spark):
    with pytest.raises(ValueError, match="no table"):
        read_table(spark, "no_such_table")


class Killed(BaseException):
    """Ends a write like the end of its process: nothing that catches errors runs."""


def _shapes(kind):
    """Old and new rows, and how they are written, for one catalog call and for two renames."""
    old, new = ("id", "id + 100 AS id") if kind == "same" else ("id", "id + 100 AS id, 'x' AS more")
    return old, new, {"partition_by": ["p"]} if kind == "partitioned" else {}


@pytest.mark.parametrize("kind", ["same", "other columns", "partitioned"])
def test_readers_at_every_step_see_old_or_new_rows(spark, db, monkeypatch, kind):
    from tabletransfer.sinks import catalog

    old, new, how = _shapes(kind)
    extra = ", id % 2 AS p" if kind == "partitioned" else ""
    rows = lambda text: spark.range(4).selectExpr(*(text + extra).split(", "))
    write_table(rows(old), f"{db}.t", "overwrite", **how)
    seen = []

    def look(step):
        # A reader of another session, which also must not disturb the writer.
        seen.append((step, sorted(r.id for r in read_table(spark.newSession(), f"{db}.t").collect())))

    monkeypatch.setattr(catalog, "_step", look)
    write_table(rows(new), f"{db}.t", "overwrite", **how)
    before, after = [0, 1, 2, 3], [100, 101, 102, 103]
    want = [("leased", before), ("moved", after)] if kind == "same" else [("leased", before), ("aside", before), ("named", after)]
    assert seen == want
    assert sorted(r.id for r in read_table(spark, f"{db}.t").collect()) == after
    assert [r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").where("not isTemporary").collect()] == ["t"]
    if kind == "same":
        assert spark.table(f"{db}.t").count() == 4  # any reader, without this library


@pytest.mark.parametrize("kind", ["same", "other columns", "partitioned"])
@pytest.mark.parametrize("died", ["leased", "moved", "aside", "named"])
def test_a_dead_writer_is_cleaned_up_after_its_lease(spark, db, monkeypatch, kind, died):
    from tabletransfer.session import hadoop_path
    from tabletransfer.sinks import catalog

    if (died == "moved") != (kind == "same") and died != "leased":
        pytest.skip("no such step")
    old, new, how = _shapes(kind)
    extra = ", id % 2 AS p" if kind == "partitioned" else ""
    rows = lambda text: spark.range(4).selectExpr(*(text + extra).split(", "))
    write_table(rows(old), f"{db}.t", "overwrite", **how)

    def die(step):
        if step == died:
            raise Killed

    with monkeypatch.context() as m:
        m.setattr(catalog, "_step", die)
        m.setattr(catalog, "LEASE_SECONDS", -1)
        with pytest.raises(Killed):
            write_table(rows(new), f"{db}.t", "overwrite", **how)
    published = died in ("moved", "named")
    start = 100 if published else 0
    want = list(range(start, start + 4))
    tables = lambda: {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").where("not isTemporary").collect()}
    left = tables()
    for _ in range(2):  # readers see a whole table and change nothing
        assert sorted(r.id for r in read_table(spark, f"{db}.t").collect()) == want
    assert tables() == left
    report = write_table(spark.range(7, 8).selectExpr("id", *(["id % 2 AS p"] if extra else [])), f"{db}.t", "append")
    assert report.action == "appended"
    assert sorted(r.id for r in read_table(spark, f"{db}.t").collect()) == sorted([*want, 7])
    assert tables() == {"t"}
    root = spark.catalog.getDatabase(db).locationUri
    filesystem, path = hadoop_path(spark, root)
    assert len(filesystem.listStatus(path)) == 1  # no lease, no rows of the other write


def test_a_writer_waits_for_another_one(spark, db, monkeypatch):
    import threading

    from tabletransfer.sinks import catalog

    write_table(spark.range(3), f"{db}.t", "overwrite")
    held, go = threading.Event(), threading.Event()

    def stop(step):
        if step == "leased" and not held.is_set():
            held.set()
            go.wait(60)

    monkeypatch.setattr(catalog, "_step", stop)
    first = threading.Thread(target=lambda: write_table(spark.range(10, 12), f"{db}.t", "overwrite"))
    first.start()
    held.wait(60)
    second = threading.Thread(target=lambda: write_table(spark.range(20, 24), f"{db}.t", "append"))
    second.start()
    second.join(1)
    assert second.is_alive() and read_table(spark, f"{db}.t").count() == 3
    go.set()
    first.join(60)
    second.join(60)
    assert sorted(r.id for r in read_table(spark, f"{db}.t").collect()) == [10, 11, 20, 21, 22, 23]


def test_a_lease_without_a_word_ends(spark, db, monkeypatch):
    from tabletransfer.session import hadoop_path
    from tabletransfer.sinks import catalog

    write_table(spark.range(3), f"{db}.t", "overwrite")
    target = catalog.Target("", False, db, "t")
    filesystem, path = hadoop_path(spark, catalog._lease_path(spark, target))
    filesystem.create(path, False).close()
    monkeypatch.setattr(catalog, "LEASE_SECONDS", -1)
    assert write_table(spark.range(2), f"{db}.t", "append").rows == 2
    assert read_table(spark, f"{db}.t").count() == 5 and not filesystem.exists(path)


def test_partitioned_buckets_have_one_file_each(spark, db):
    rows = spark.range(4000).selectExpr("id", "id % 3 AS p", "id % 101 AS k")
    report = write_table(rows.repartition(8), f"{db}.t", "overwrite", distributed_by="k", buckets=4, partition_by=["p"])
    assert report.files <= 3 * 4 * 2
    from tabletransfer.sources.tables import read_table
    assert read_table(spark, f"{db}.t").count() == 4000
