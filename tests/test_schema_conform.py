import datetime as dt

import pytest
from pyspark.sql import functions as F, types as T

from tabletransfer.functions.values import json_part, json_text
from tabletransfer.operators.conform import apply_schema, conform, conform_losses
from tabletransfer.plans.schema import (
    column_ddl, column_meta, external_name, external_type, infer_schema, schema_argument, select_list,
)


def test_infer(spark, orders):
    assert infer_schema(spark, "orders") == orders.schema
    assert infer_schema(spark, "no_such_table") == T.StructType()
    schema = infer_schema(spark, "SELECT 1 AS a, 'x' AS b", nullable=True)
    assert [(f.name, f.nullable) for f in schema] == [("a", True), ("b", True)]


def test_inference_runs_no_job(spark, orders):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("infer", "infer")
    infer_schema(spark, "SELECT o_custkey, count(*) FROM orders GROUP BY 1")
    assert list(tracker.getJobIdsForGroup("infer")) == []
    spark.sparkContext.setJobGroup("", "")


def test_column_meta(spark, db):
    spark.sql(f"CREATE TABLE {db}.m (a VARCHAR(5), b DECIMAL(10,2), c DATE) USING parquet")
    rows = [tuple(r) for r in column_meta(spark, f"{db}.m").orderBy("ordinal").collect()]
    assert rows == [(1, "a", "varchar(5)", True, 5, None), (2, "b", "decimal(10,2)", True, 10, 2),
                    (3, "c", "date", True, None, None)]


def test_select_list_round_trip(spark):
    df = spark.createDataFrame([(1, bytes(range(256)) * 3), (2, None)], "id int, b binary")
    coded = df.selectExpr("*").createOrReplaceTempView("raw_bytes")
    assert coded is None
    text = spark.sql(f"SELECT {select_list(df.schema, 'encode')} FROM raw_bytes")
    assert text.dtypes[1] == ("b", "string")
    assert "\n" not in text.where("id = 1").head().b
    text.createOrReplaceTempView("coded_bytes")
    back = spark.sql(f"SELECT {select_list(df.schema, 'decode')} FROM coded_bytes")
    assert sorted(back.collect()) == sorted(df.collect())


def test_ddl(spark):
    schema = T.StructType.fromDDL(
        "s string, i int, l bigint, d double, f float, h smallint, y tinyint, o boolean, b binary, t timestamp, "
        "a date, m decimal(10,2)")
    assert column_ddl(schema, dialect="external") == (
        '"s" TEXT, "i" INTEGER, "l" BIGINT, "d" DOUBLE PRECISION, "f" REAL, "h" INTEGER, "y" INTEGER, '
        '"o" BOOLEAN, "b" BYTEA, "t" TIMESTAMP, "a" DATE, "m" DECIMAL(10,2)')
    over = column_ddl(schema, {"S": "uuid", "i": "bigint", "o": "bit(1)"}, dialect="external")
    assert '"s" UUID, "i" INTEGER' in over and '"o" BIT(1)' in over
    assert T.StructType.fromDDL(column_ddl(schema)) == schema
    with pytest.raises(ValueError, match="Unsupported type"):
        external_name(T.ArrayType(T.IntegerType()))


@pytest.mark.parametrize("text, simple, kind, size", [
    ("VARCHAR(20)", "string", "varchar", 20),
    ("numeric(12, 3)", "decimal(12,3)", None, None),
    ("decimal", "decimal(38,18)", None, None),
    ("Timestamp(6) with time zone", "timestamp", None, None),
    ("timestamp without time zone", "timestamp_ntz", None, None),
    ("bit varying(8)", "string", "varbit", 8),
    ("time with time zone", "string", "timetz", None),
    ("jsonb", "string", "json", None),
    ("double precision", "double", None, None),
])
def test_external_types(spark, text, simple, kind, size):
    ext = external_type(text)
    assert (ext.spark_type.simpleString(), ext.kind, ext.size) == (simple, kind, size)


def test_unknown_type():
    with pytest.raises(ValueError):
        external_type("money")


def test_schema_argument(spark, orders):
    assert schema_argument(spark, "a int, b string").names == ["a", "b"]
    assert schema_argument(spark, "orders") == orders.schema
    assert schema_argument(spark, "select 1 as one").names == ["one"]


def test_apply_schema_by_name_then_position(spark):
    df = spark.sql("SELECT '1' AS a, 2 AS b")
    assert apply_schema(df, T.StructType.fromDDL("b string, a int")).head() == ("2", 1)
    assert apply_schema(df, T.StructType.fromDDL("x int, y int")).head() == (1, 2)
    with pytest.raises(ValueError):
        apply_schema(df, T.StructType.fromDDL("x int, y int, z int"))


GOOD = {
    "uuid": ("0f8fad5b-d9cb-469f-a165-70867728950e", "not-a-uuid"),
    "varchar(3)": ("abc", "abcd"),
    "bit(3)": ("101", "10"),
    "varbit": ("10", "12"),
    "json": ('{"a": [1]}', "{a"),
    "geometry": ("0020000001000010E63FF00000000000004000000000000000", "POINT(1 2)"),
    "time": ("23:59:59.5", "24:00"),
    "timetz": ("10:00:00+03", "10:00:00"),
    "integer": ("12", "1.5"),
    "decimal(4,1)": ("12.25", "99999"),
    "timestamp": ("2024-01-02 03:04:05", "yesterday"),
    "date": ("2024-02-29", "2023-02-29"),
    "boolean": ("yes", "maybe"),
}


@pytest.mark.parametrize("type_name", GOOD)
def test_conform_strings(spark, type_name):
    good, bad = GOOD[type_name]
    df = spark.createDataFrame([(good,), (bad,), (None,)], "c string")
    kept = [r.c for r in conform(df, {"c": type_name}, on_loss="null").collect()]
    assert kept[0] is not None and kept[1:] == [None, None]
    assert conform_losses(df, {"c": type_name}).head().c == 1
    assert conform(df.where("c = '" + good.replace("'", "''") + "' OR c IS NULL"), {"c": type_name}).count() == 2
    with pytest.raises(Exception, match="does not fit"):
        conform(df, {"c": type_name}).collect()


def test_conform_booleans_to_bits(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    assert [r.c for r in conform(df, {"c": "bit(3)"}).collect()] == ["100", "000", None]


def test_conform_columns(spark):
    df = spark.sql("SELECT 1 AS a, TIMESTAMP'2024-01-01 00:00:00' AS t")
    out = conform(df, {"T": "date", "A": "bigint", "missing": "text"})
    assert out.head() == (dt.date(2024, 1, 1), 1, None)
    with pytest.raises(ValueError, match="no column"):
        conform(df, {"a": "bigint"})


def test_conform_long_overflow(spark):
    df = spark.sql("SELECT 5000000000L AS a")
    with pytest.raises(Exception, match="does not fit"):
        conform(df, {"a": "integer"}).collect()
    assert conform(df, {"a": "integer"}, on_loss="null").head().a is None


def test_same_types_cost_nothing(spark, orders, plan):
    assert plan(conform(orders, orders.schema)) == plan(orders) or "CASE" not in plan(conform(orders, orders.schema))


def test_conform_variants(spark):
    texts = ['{"b": [1, {"c": "x\\ty"}], "a": null}', "[]", "7", "null", '"é"', None, "{", '{"a": 1, "a": 2}', ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, c string")
    parsed = conform(df, {"id": "integer", "c": "variant"}, on_loss="null")
    assert parsed.schema["c"].dataType == T.VariantType()
    again = {r.id: r.c for r in conform(parsed, {"id": "integer", "c": "text"}).collect()}
    assert again == {0: '{"a":null,"b":[1,{"c":"x\\ty"}]}', 1: "[]", 2: "7", 3: "null", 4: '"é"', 5: None, 6: None, 7: None, 8: None}
    assert {r.id: r.c for r in conform(parsed, {"id": "integer", "c": "integer"}, on_loss="null").collect() if r.c is not None} == {2: 7}
    assert tuple(conform_losses(df, {"id": "integer", "c": "variant"}).head()) == (0, 3)
    with pytest.raises(Exception, match="column c: value does not fit"):
        conform(df, {"id": "integer", "c": "variant"}).collect()
    parts = parsed.select("id", json_part(F.col("c"), "$.b[1].c", "string").alias("p"), json_part(F.col("c"), "$.b[0]", "date").alias("q"))
    assert [tuple(r) for r in parts.where("p IS NOT NULL OR q IS NOT NULL").collect()] == [(0, "x\ty", None)]
    made = conform(spark.sql("SELECT named_struct('k', 1, 'l', array(true)) AS c"), {"c": "variant"})
    assert made.select(json_text(F.col("c"))).head()[0] == '{"k":1,"l":[true]}'
    assert external_name(T.VariantType()) == "JSONB"
