import datetime as dt
from decimal import Decimal

import pytest

from tabletransfer.plans.filters import (
    contains, ends_with, eq, filter_sql, ge, gt, identifier, is_in, is_not_null, is_null, le, literal, lt, starts_with,
)


@pytest.fixture
def rows(spark):
    return spark.createDataFrame(
        [(1, "50% off", None), (2, "50 off", "x"), (3, "a_b", "it's"), (4, "axb", "back\\slash"), (5, None, "x")],
        "id int, s string, t string")


def ids(df):
    return sorted(r.id for r in df.collect())


@pytest.mark.parametrize("tree, expected", [
    (contains("s", "50%"), [1]),
    (contains("s", "a_b"), [3]),
    (starts_with("s", "50%"), [1]),
    (ends_with("s", "_b"), [3]),
    (eq("t", "it's"), [3]),
    (eq("t", "back\\slash"), [4]),
    (is_null("s") | is_null("t"), [1, 5]),
    (~(eq("id", 1) | eq("id", 2)), [3, 4, 5]),
    ((eq("id", 1) | eq("id", 2)) & is_not_null("t"), [2]),
    (is_in("id", 1, 5) & ~is_null("t"), [5]),
    (is_in("id"), []),
    (gt("id", 1) & le("id", 3) & ge("id", 2) & lt("id", 9), [2, 3]),
    (eq("id", None), []),
])
def test_text_and_column_agree(rows, tree, expected):
    assert ids(rows.where(tree.sql())) == expected
    assert ids(rows.where(tree.column())) == expected


def test_or_keeps_its_parentheses(rows):
    text = filter_sql([eq("id", 1) | eq("id", 3), is_not_null("t")])
    assert ids(rows.where(text)) == [3]


def test_no_filter_is_true():
    assert filter_sql(None) == "true"
    assert filter_sql([]) == "true"


def test_ansi_text():
    assert contains("a.b", "5%_!").sql("ansi") == "(\"a\".\"b\" LIKE '%5!%!_!!%' ESCAPE '!')"
    assert eq("q", "it's").sql("ansi") == "(\"q\" = 'it''s')"
    assert identifier('"a.b".c') == "`a.b`.`c`" and identifier("`x`", "ansi") == '"x"'
    assert identifier('"say ""hi"""', "ansi") == '"say ""hi"""'
    with pytest.raises(ValueError, match="not a column name"):
        identifier('a."b')


def test_quoted_name_is_a_column(spark):
    df = spark.createDataFrame([(1, "x"), (2, "Name")], "k int, Name string")
    assert [r.k for r in df.where(eq('"Name"', "x").column()).collect()] == [1]
    assert [r.k for r in df.where(eq('"Name"', "x").sql()).collect()] == [1]


@pytest.mark.parametrize("value, sql_type", [
    (dt.datetime(2024, 1, 2, 3, 4, 5, 678), "timestamp_ntz"),
    (dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc), "timestamp"),
    (dt.date(2024, 1, 2), "date"),
    (Decimal("12.50"), "decimal(4,2)"),
    (1.5e300, "double"),
    (True, "boolean"),
    (7, "int"),
    (b"\x00\xff", "binary"),
])
def test_literals_are_typed(spark, value, sql_type):
    df = spark.sql(f"SELECT {literal(value)} AS v")
    assert df.dtypes == [("v", sql_type)]
    got = df.head().v
    if isinstance(value, dt.datetime) and value.tzinfo:
        got = spark.sql(f"SELECT unix_micros({literal(value)}) AS v").head().v
        value = int(value.timestamp() * 1_000_000)
    assert got == value


def test_filters_reach_the_scan(spark, orders, plan):
    keep = (gt("o_totalprice", 10.0) & starts_with("o_orderpriority", "1")) | is_in("o_custkey", 1, 2)
    text = plan(orders.where(keep.column()).select("o_orderkey"))
    pushed = text[text.index("PushedFilters"):]
    assert "StringStartsWith(o_orderpriority,1)" in pushed
    assert "GreaterThan(o_totalprice,10.0)" in pushed
    assert "o_orderdate" not in text


def test_unknown_literal():
    with pytest.raises(TypeError):
        literal(object())
