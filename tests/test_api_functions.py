import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tabletransfer.api import load, partition_columns, save, stream
from tabletransfer.functions.points import ewkb_to_text, point_to_ewkb
from tabletransfer.functions.udfs import get_batch_id, register_udfs, row_timestamp, version
from tabletransfer.functions.values import bit_text, is_ewkb_hex, is_json, is_time, is_uuid
from tabletransfer.options import TransferOptions
from tabletransfer.plans.filters import eq, gt
from tabletransfer.sources.generator import generate, uuid_rows
from tabletransfer.sources.jdbc import jdbc_options, modulo_predicates, write_options
from tabletransfer.sources.tables import read_parallel


def test_options_in_any_case():
    o = TransferOptions.from_dict({"dbTable": "t", "TRUNCATE": "True", "Offset.Select": "s", "sqlTransfer": "x",
                                   "server.port": 1, "mode": "Overwrite", "ApplicationName": "me"})
    assert (o.table, o.truncate, o.offset_select, o.script, o.mode, o.application_name) == (
        "t", True, "s", "x", "overwrite", "me")
    assert TransferOptions.from_dict({"dbtable": "t"}).autocommit is True
    assert "secret" not in repr(TransferOptions.from_dict({"dbtable": "t", "password": "secret"}))


@pytest.mark.parametrize("options, message", [
    ({}, "required"), ({"dbtable": "t", "colour": "red"}, "unknown option"),
    ({"dbtable": "t", "truncate": "maybe"}, "true or false"), ({"dbtable": "t", "mode": "merge"}, "mode")])
def test_bad_options(options, message):
    with pytest.raises(ValueError, match=message):
        TransferOptions.from_dict(options)


def test_load_and_save_by_options(spark, db, orders):
    save(orders, {"dbschema": f"{db}, other", "dbtable": "t", "distributedby": "o_custkey",
                  "partitionclause": "PARTITION BY (o_orderstatus)", "mode": "overwrite"})
    back = load(spark, {"dbschema": db, "dbtable": "t"}, filters=gt("o_custkey", 10))
    assert back.count() == orders.where("o_custkey > 10").count()
    save(orders, {"dbschema": db, "sqltransfer": "CREATE TABLE made USING parquet AS SELECT * FROM <ext_table>"})
    script = "INSERT INTO <ext_table> SELECT o_orderkey, o_custkey FROM made WHERE <pushed_filters>"
    got = load(spark, {"dbschema": db, "sqltransfer": script, "dbtable": "SELECT 1L o_orderkey, '' o_custkey"}, filters=gt("o_orderkey", 3))
    assert got.dtypes == [("o_orderkey", "bigint"), ("o_custkey", "string")]
    assert got.count() == orders.where("o_orderkey > 3").count()
    assert spark.catalog.currentDatabase() == "default"


def test_residual_filters_of_a_script(spark, db, orders):
    script = "INSERT INTO <ext_table> SELECT o_orderkey AS a FROM orders"
    assert load(spark, {"sqltransfer": script}, filters=eq("a", 3)).count() == orders.where("o_orderkey = 3").count()


def test_partition_clause():
    assert partition_columns('a, "b"') == ["a", "b"] == partition_columns("partitioned by (a, b)")
    assert partition_columns(None) == []
    with pytest.raises(ValueError):
        partition_columns("partition by range (a) (start (1))")


# -- external database: what can be checked without one ------------------------------


def test_modulo_predicates_cover_every_row_once(spark):
    keys = spark.createDataFrame([(k,) for k in [None, -7, -1, 0, 1, 2, 3, 10**12]], "k long")
    parts = [keys.where(p.replace('"', "`")).collect() for p in modulo_predicates("k", 3)]
    assert sorted(str(r.k) for part in parts for r in part) == sorted(str(r.k) for r in keys.collect())


def test_connection_options(spark):
    o = TransferOptions.from_dict({"url": "jdbc:postgresql://h/db", "user": "u", "dbtable": "t", "dbschema": "a, b"})
    got = jdbc_options(spark, o)
    assert got["currentSchema"] == "a,b,public" and got["ApplicationName"] == spark.sparkContext.applicationId
    with pytest.raises(ValueError, match="url"):
        jdbc_options(spark, TransferOptions.from_dict({"dbtable": "t"}))
    with pytest.raises(ValueError, match="script"):
        load(spark, {"url": "jdbc:x", "sqltransfer": "select 1"})


def test_sink_clauses():
    o = TransferOptions.from_dict({"url": "jdbc:x", "dbtable": "s.t", "distributedby": "a, b", "truncate": "true",
                                   "partitionclause": "PARTITION BY RANGE (d) (START (1))"})
    assert write_options(o, {"a": "varchar(10)", "b": "uuid", "c": "decimal(5,2)"}, 500) == {
        "dbtable": "s.t", "batchsize": "500", "truncate": "true",
        "createTableOptions": 'DISTRIBUTED BY ("a", "b") PARTITION BY RANGE (d) (START (1))',
        "createTableColumnTypes": "a varchar(10), c decimal(5,2)"}
    plain = write_options(TransferOptions.from_dict({"url": "jdbc:x", "dbtable": "t", "distributedby": "randomly"}))
    assert plain["createTableOptions"] == "DISTRIBUTED RANDOMLY" and "createTableColumnTypes" not in plain


# -- functions -----------------------------------------------------------------------


def test_points(spark):
    df = spark.createDataFrame([(1.0, 2.0), (0.5, -3.25), (None, 1.0)], "x double, y double")
    rows = df.select(point_to_ewkb("x", "y").alias("p")).select("p", ewkb_to_text("p").alias("t")).collect()
    assert [r.p for r in rows] == [
        "0020000001000010E63FF00000000000004000000000000000",
        "0020000001000010E63FE0000000000000C00A000000000000", None]
    assert [r.t for r in rows] == ["POINT(1 2)", "POINT(0.5 -3.25)", None]
    other = [("0101000000000000000000F03F0000000000000040",), ("00",), ("zz",), ("0102000000" + "00" * 16,)]
    texts = spark.createDataFrame(other, "p string").select(ewkb_to_text("p")).collect()
    assert [r[0] for r in texts] == ["POINT(1 2)", None, None, None]


def test_udfs_in_sql(spark):
    register_udfs(spark)
    df = spark.range(0, 2000, 1, 2).selectExpr("id", "getBatchId() AS b", "getRowTimestamp() AS t", "transferVersion() AS v")
    row = df.agg(F.max("b").alias("b"), F.countDistinct("t").alias("n"), F.max("v").alias("v"), F.max("t").alias("t")).head()
    assert row.b is None and row.n > 2 and row.v == version()
    assert abs(row.t.timestamp() - dt.datetime.now().timestamp()) < 3600
    assert spark.range(3).select(get_batch_id(), row_timestamp()).count() == 3


def test_value_checks(spark):
    row = spark.sql("SELECT '{\"a\":1}' AS j, 'x' AS n, '10:20' AS t, '10:20+03:00' AS z, true AS b, 6 AS i").select(
        is_json(F.col("j")), is_json(F.col("n")), is_time(F.col("t")), is_time(F.col("z")),
        is_time(F.col("z"), zone=True), is_uuid(F.uuid()), is_ewkb_hex(F.col("j")),
        bit_text(F.col("b"), T.BooleanType()),
        F.bin("i")).head()
    assert tuple(row) == (True, False, True, False, True, True, False, "1", "110")


def test_generator(spark):
    rows = generate(spark, 10, 15, 12, 3).orderBy("seq_n").collect()
    assert [r.seq_n for r in rows] == list(range(1, 13)) and {r.payload for r in rows} == {"000"}
    assert [r.offset_id for r in rows] == [11, 11, 11, 12, 12, 13, 13, 13, 14, 14, 15, 15]
    assert len({r.id for r in rows}) == 12
    assert generate(spark, 5, 5, 12, 3).count() == 0
    few = [r.offset_id for r in generate(spark, 0, 100, 12, 1).collect()]
    assert len(set(few)) == 12 and min(few) == 1 and max(few) <= 100


def test_uuid_rows(spark):
    df = uuid_rows(spark.range(0, 100, 1, 2), "id", points=True)
    assert df.columns == ["id", "seq_no", "created_d", "mv", "gps_point"]
    assert df.where(is_uuid(F.col("id")) & is_ewkb_hex(F.col("gps_point"))).count() == 100
    assert df.rdd.getNumPartitions() == 2
    assert df.where("mv").count() == 50


def test_every_option_works_or_is_refused(spark, db):
    spark.range(5).selectExpr("id", "id % 2 k").write.saveAsTable(f"{db}.src")
    table = {"dbtable": f"{db}.src"}
    for option, value in (("dbtimezone", "UTC"), ("truncate", "true"), ("undo.side.effects.sql", "SELECT 1")):
        with pytest.raises(ValueError, match="no effect"):
            load(spark, table | {option: value})
    script = {"sqltransfer": "INSERT INTO <ext_table> SELECT 1 a"}
    with pytest.raises(ValueError, match="no effect"):
        load(spark, script | {"distributedby": "a"})
    for option, value in (("distributedby", "id"), ("partitionclause", "k"), ("truncate", "true"), ("mode", "append")):
        with pytest.raises(ValueError, match="no effect"):
            save(spark.range(1), script | {option: value})
    with pytest.raises(ValueError, match="no effect"):
        save(spark.range(1), {"dbtable": f"{db}.t", "dbtimezone": "UTC"}, "append")
    source = script | {"offset.select": "SELECT '1'"}
    for option, value in (("truncate", "true"), ("mode", "overwrite"), ("dbtimezone", "UTC")):
        with pytest.raises(ValueError):
            stream(spark, source, {"dbtable": f"{db}.t", option: value, "checkpointLocation": "x"})
    spread_rows = load(spark, table | {"distributedby": "k"}, schema="id long, k long", filters=gt("id", 1))
    assert sorted(r.id for r in spread_rows.collect()) == [2, 3, 4]


def test_read_parallel_runs_no_job(spark):
    tracker = spark.sparkContext.statusTracker()
    joined = spark.range(50).join(spark.range(50).withColumnRenamed("id", "x"), F.col("id") == F.col("x")).groupBy("id").count()
    spark.sparkContext.setJobGroup("plan only", "")
    parallel = read_parallel(joined, 6)
    assert not tracker.getJobIdsForGroup("plan only")
    spark.sparkContext.setJobGroup("after", "")
    assert parallel.count() == 50 and parallel.rdd.getNumPartitions() >= 6
    assert read_parallel(spark.range(0, 10, 1, 8), 6).rdd.getNumPartitions() == 8


def test_keys_of_all_sizes_go_into_one_part(spark):
    keys = spark.sql("SELECT explode(array(-9223372036854775808L, -5L, -1L, 0L, 3L, 9223372036854775807L, NULL)) AS k")
    parts = [F.expr(p.replace('"', "`")) for p in modulo_predicates("k", 4)]
    assert sum(keys.where(p).count() for p in parts) == 7


def test_read_parallel_goes_by_nodes_not_names(spark):
    """A column whose name is that of a node does not make a bare scan shuffle."""
    bare = spark.range(0, 10, 1, 8).selectExpr("id AS Sort_key", "id AS LimitJoin")
    assert read_parallel(bare, 6).rdd.getNumPartitions() == 8
    assert bare._jdf.queryExecution().sparkPlan().toString() == read_parallel(bare, 6)._jdf.queryExecution().sparkPlan().toString()
    assert read_parallel(bare.orderBy("LimitJoin"), 3).rdd.getNumPartitions() == 3
