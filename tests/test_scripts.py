import pytest
from pyspark.sql import functions as F

from tabletransfer.plans.filters import gt
from tabletransfer.plans.scripts import fill_tags, json_text, read_transfer, write_transfer
from tabletransfer.sinks.tables import write_table


def test_tags_in_any_case_and_once():
    text = fill_tags("<EXT_Table> <pushed_FILTERS> <current_epoch>",
                     ext_table="<pushed_filters>", pushed_filters="a = '$1\\x'", current_epoch="4")
    assert text == "<pushed_filters> a = '$1\\x' 4"


def test_tag_without_value():
    with pytest.raises(ValueError, match="current_epoch"):
        fill_tags("select <current_epoch>", ext_table="t")


def test_types_in_angle_brackets_are_not_tags(spark):
    script = "INSERT INTO <ext_table> SELECT CAST(array(1) AS ARRAY<BIGINT>) AS a WHERE 1 <> 2"
    assert read_transfer(spark, script).head().a == [1]


def test_offsets_are_quoted_for_sql(spark):
    value = '{"k":"it\'s $1 \\\\ x"}'
    script = "INSERT INTO <ext_table> SELECT '<start_offset_json>' AS s, '<end_offset_json>' AS e"
    row = read_transfer(spark, script, start_offset=None, end_offset=value).head()
    assert (row.s, row.e) == ("[null]", value)
    assert json_text(None) == "[null]"


def test_read_is_lazy_and_pushes_filters(spark, orders, plan):
    df = read_transfer(spark, "INSERT INTO <ext_table> SELECT <select_colList> FROM orders WHERE <pushed_filters>",
                       schema="SELECT o_orderkey, o_custkey FROM orders", filters=gt("o_custkey", 10))
    text = plan(df.select("o_orderkey"))
    assert "GreaterThan(o_custkey,10)" in text
    assert "o_totalprice" not in text
    assert df.count() == orders.where("o_custkey > 10").count()


def test_script_without_the_tag_is_filtered_all_the_same(spark, orders):
    df = read_transfer(spark, "INSERT INTO <ext_table> SELECT o_orderkey, o_custkey FROM orders",
                       filters=[gt("o_custkey", 10), F.col("o_orderkey") > 5])
    assert df.count() == orders.where("o_custkey > 10 AND o_orderkey > 5").count()


def test_insert_columns(spark, orders):
    df = read_transfer(spark, "INSERT INTO <ext_table> (b, a) SELECT o_custkey, o_orderkey FROM orders",
                       schema="a bigint, b string, c date")
    assert df.dtypes == [("a", "bigint"), ("b", "string"), ("c", "date")]
    assert df.where("c IS NOT NULL OR a IS NULL").count() == 0
    with pytest.raises(ValueError):
        read_transfer(spark, "INSERT INTO <ext_table> (a) SELECT 1, 2")


def test_procedural_script(spark, orders):
    script = """BEGIN
      DECLARE n BIGINT DEFAULT 0;
      SET n = (SELECT count(*) FROM orders WHERE <pushed_filters>);
      IF n > 0 THEN
        FOR r AS (SELECT o_orderstatus AS s, count(*) AS c FROM orders WHERE <pushed_filters> GROUP BY 1) DO
          INSERT INTO <ext_table> VALUES (r.s, r.c);
        END FOR;
      END IF;
      INSERT INTO <ext_table> SELECT 'all', n;
    END"""
    got = {r.s: r.n for r in read_transfer(spark, script, schema="s string, n bigint").collect()}
    want = {r.o_orderstatus: r["count"] for r in orders.groupBy("o_orderstatus").count().collect()}
    assert got == want | {"all": orders.count()}
    tables = [t.name for t in spark.catalog.listTables() if t.name.startswith("ext_")]
    assert tables == []


def test_procedural_script_needs_schema_and_target(spark):
    with pytest.raises(ValueError, match="schema"):
        read_transfer(spark, "BEGIN INSERT INTO <ext_table> SELECT 1; END")
    with pytest.raises(ValueError, match="ext_table"):
        read_transfer(spark, "BEGIN SELECT 1; END", schema="a int")


def test_failed_procedural_script_leaves_nothing(spark):
    with pytest.raises(Exception):
        read_transfer(spark, "BEGIN INSERT INTO <ext_table> SELECT raise_error('no'); END", schema="a string")
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith("ext_")] == []


def test_write_script_joins_and_drops_its_view(spark, db, orders):
    write_transfer(orders, f"CREATE TABLE {db}.out USING parquet AS SELECT e.o_orderkey, <current_epoch> AS ep, "
                           f"'<stream_mode>' AS m FROM <ext_table> e", epoch=7, stream_mode="Append")
    row = spark.table(f"{db}.out").agg(F.count("*").alias("n"), F.max("ep").alias("ep"), F.max("m").alias("m")).head()
    assert (row.n, row.ep, row.m) == (orders.count(), 7, "Append")
    assert not [t for t in spark.catalog.listTables() if t.isTemporary and t.name.startswith("ext_")]


def test_failed_write_script_runs_undo(spark, db, orders):
    write_table(orders.limit(1).select("o_orderkey"), f"{db}.audit", "append")
    script = f"CREATE TABLE {db}.x USING parquet AS SELECT raise_error('refused') a FROM <ext_table>"
    with pytest.raises(Exception, match="refused"):
        write_transfer(orders, script, undo=f"INSERT INTO {db}.audit VALUES (-1)")
    assert spark.table(f"{db}.audit").where("o_orderkey = -1").count() == 1
    with pytest.raises(Exception, match="refused") as failed:
        write_transfer(orders, script, undo="SELECT * FROM no_such_table")
    assert "no_such_table" in failed.value.__notes__[0]
    assert not spark.catalog.tableExists(f"{db}.x")
