import pytest

from tabletransfer.sinks.tables import write_table
from tabletransfer.sources.targets import named_tables, parse_target, resolve, search_path, table_exists


@pytest.mark.parametrize("text", ["select 1", "  SELECT\n* from t", "with a as (select 1) select * from a"])
def test_queries(text):
    assert parse_target(text).is_query


@pytest.mark.parametrize("text, schema, table", [
    ("tbl", None, "tbl"),
    ("ns.tbl", "ns", "tbl"),
    ('"My Schema"."My Table"', "My Schema", "My Table"),
    ("`a b`", None, "a b"),
    ("selected", None, "selected"),
])
def test_names(text, schema, table):
    target = parse_target(text)
    assert (target.is_query, target.schema, target.table) == (False, schema, table)


@pytest.mark.parametrize("text", ["a b", "a.b.c", "drop table x", ""])
def test_neither(text):
    with pytest.raises(ValueError):
        parse_target(text)


def test_search_path_is_split():
    assert search_path("one, two") == ["one", "two", "default"]
    assert search_path(["default", "x"]) == ["default", "x"]
    assert search_path(None) == []


def test_first_hit_wins_and_first_schema_is_created(spark, orders):
    write_table(orders, "t1", "append", schemas="s_two")
    assert resolve(spark, "t1", "s_one, s_two").schema == "s_two"
    assert spark.catalog.databaseExists("s_one")
    write_table(orders, "t1", "append", schemas="s_one")
    assert resolve(spark, "t1", "s_one, s_two").schema == "s_one"
    assert resolve(spark, "nowhere", "s_one, s_two").schema == "s_one"
    assert resolve(spark, "s_two.t1", "s_one").schema == "s_two"
    assert not table_exists(spark, "no_such_schema.t")
    assert not table_exists(spark, "select 1")


def test_quoted_name_round_trip(spark, db, orders):
    write_table(orders.select("o_orderkey"), f'{db}."select_1"', "append")
    assert spark.table(f"{db}.`select_1`").count() == orders.count()


def test_tables_named_in_sql():
    text = "SELECT * FROM a.b x JOIN `c` ON 1 = 1 WHERE k IN (SELECT k FROM\n d) -- from the end"
    assert named_tables(text) == ["a.b", "`c`", "d", "the"]
