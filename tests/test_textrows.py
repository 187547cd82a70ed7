import datetime as dt
import decimal
import re

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tabletransfer.operators.textrows import (
    LOSSLESS_NULL, decode_rows, encode_rows, escape_text, read_text_rows, unescape_text, write_text_rows,
)

from conftest import DATA

UTC = dt.timezone.utc
DDL = (
    "s string, i int, l bigint, d double, f float, h smallint, y tinyint, o boolean, b binary, "
    "t timestamp, n timestamp_ntz, a date, m decimal(20,4)")
ROWS = [
    ("tab\tnl\ncr\rbs\\two\\\\n\\t|q\"'/é😀\x01\x08\x0c", 1, 2, 1.5, 2.5, 3, 4, True, b"\x00\xff" * 50,
     dt.datetime(2024, 11, 3, 5, 30, 0, 123456, UTC), dt.datetime(1905, 1, 1, 2, 3, 4, 5), dt.date(2061, 5, 6),
     decimal.Decimal("12.3400")),
    ("", None, None, float("inf"), float("-inf"), None, None, False, b"",
     dt.datetime(2061, 6, 30, 6, 30, 0, 10, UTC), None, dt.date(1905, 1, 1), None),
    (None,) * 13,
    ("\\u0041 \\", -1, -2, -1e300, 1e-9, -1, -1, None, None, dt.datetime(1905, 11, 3, 6, 30, tzinfo=UTC),
     dt.datetime(2024, 3, 10, 2, 30), dt.date(2040, 1, 1), decimal.Decimal("-0.0001")),
    ("NULL", 0, 0, 0.0, -0.0, 0, 0, True, b"x", dt.datetime(1970, 1, 1, tzinfo=UTC), dt.datetime(1970, 1, 1),
     dt.date(1970, 1, 1), decimal.Decimal("0.0000")),
    ("null \\N", 0, 0, 0.0, 0.0, 0, 0, True, b"x", dt.datetime(1970, 1, 1, tzinfo=UTC), dt.datetime(1970, 1, 1),
     dt.date(1970, 1, 1), decimal.Decimal("0.0000")),
]


@pytest.mark.parametrize("delimiter", ["\t", "|", ",", ";", "\x01"])
@pytest.mark.parametrize("tz", [None, "Asia/Irkutsk", "America/New_York"])
@pytest.mark.parametrize("ascii_only", [False, True])
def test_every_type_comes_back(spark, delimiter, tz, ascii_only):
    if tz == "America/New_York":
        rows = [r[:9] + (dt.datetime(2024, 7, 1, 5, 30, 0, 1, UTC),) + r[10:] for r in ROWS]  # not a repeated hour
    else:
        rows = ROWS
    df = spark.createDataFrame(rows, DDL)
    lines = encode_rows(df, delimiter, tz, LOSSLESS_NULL, ascii_only)
    back = decode_rows(lines, df.schema, delimiter, tz, LOSSLESS_NULL)
    assert [str(r) for r in back.collect()] == [str(r) for r in df.collect()]
    if ascii_only:
        assert lines.where(F.col("line").rlike("[^\\x01-\\x7e]")).count() == 0


def test_exact_text(spark):
    df = spark.createDataFrame(ROWS[:1], DDL)
    assert encode_rows(df.drop("b")).head().line == (
        "tab\\tnl\\ncr\\rbs\\\\two\\\\\\\\n\\\\t|q\"'/é😀\x01\x08\x0c\t1\t2\t1.5\t2.5\t3\t4\t1\t"
        "2024-11-03 05:30:00.123456\t1905-01-01 02:03:04.000005\t2061-05-06\t12.3400")
    assert encode_rows(df.select("s"), ascii_only=True).head().line.endswith("/\\u00E9\\uD83D\\uDE00\\u0001\\u0008\\u000C")


def test_null_token_keeps_the_compatible_default(spark):
    df = spark.createDataFrame([("NULL", None, "")], "a string, b string, c string")
    lines = encode_rows(df)
    assert lines.head().line == "NULL\tNULL\t"
    assert decode_rows(lines, df.schema).head() == (None, None, "")


def test_zone_is_independent_of_the_session(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 7, 0, 0, 123456, UTC),)], "t timestamp")
    want = "2024-03-10 15:00:00.123456"
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            assert encode_rows(df, tz="Asia/Irkutsk").head().line == want
            lines = spark.createDataFrame([(want,)], "line string")
            back = decode_rows(lines, "t timestamp", tz="Asia/Irkutsk").select(F.unix_micros("t")).head()[0]
            assert back == 1710054000123456
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("text, micros", [
    ("2024-01-02 03:04:05", 0), ("2024-01-02 03:04:05.1", 100000), ("2024-01-02 03:04:05.12", 120000),
    ("2024-01-02 03:04:05.123", 123000), ("2024-01-02 03:04:05.123456", 123456)])
def test_fraction_digits(spark, text, micros):
    lines = spark.createDataFrame([(text,)], "line string")
    assert decode_rows(lines, "n timestamp_ntz").head().n == dt.datetime(2024, 1, 2, 3, 4, 5, micros)
    assert decode_rows(lines, "t timestamp").select(F.unix_micros("t") % 1000000).head()[0] == micros


def test_boolean_tokens(spark):
    lines = spark.createDataFrame([(t,) for t in ("true", "T", "1", "y", "YES", "false", "0", "on", "")], "line string")
    assert [r.b for r in decode_rows(lines, "b boolean").collect()] == [True] * 5 + [False] * 4


BAD = ["1\tx", "a\ty", "1", "1\tx\tz", "NULL\tNULL", "1.5\tx"]


def test_bad_lines_are_flagged(spark):
    lines = spark.createDataFrame([(b,) for b in BAD], "line string")
    rows = decode_rows(lines, "i int, s string", on_error="flag").collect()
    assert [r._bad for r in rows] == [
        None, "cannot read i", "expected 2 fields, found 1", "expected 2 fields, found 3", None, "cannot read i"]
    assert [r.i for r in rows] == [1, None, 1, 1, None, None]


@pytest.mark.parametrize("bad, message", [
    ("a\ty", "not a int"), ("1", "expected 2 fields"), ("1\tx\tz", "expected 2 fields"), ("1\ta\nb", "line feed")])
def test_bad_lines_fail(spark, bad, message):
    lines = spark.createDataFrame([(bad,)], "line string")
    with pytest.raises(Exception, match=message):
        decode_rows(lines, "i int, s string").collect()
    with pytest.raises(Exception):
        decode_rows(lines, "i int, s string").select("i").collect()


def test_trailing_empty_fields_count(spark):
    lines = spark.createDataFrame([("1\t\t",)], "line string")
    assert decode_rows(lines, "i int, a string, b string").head() == (1, "", "")


def test_unknown_escapes_are_errors(spark):
    lines = spark.createDataFrame([("a\\qb",), ("\\101",), ("\\u12g4",), ("ok\\\\q\\u0041\\n\\\\u0041\\\"",), ("tail\\",)], "line string")
    rows = decode_rows(lines, "x string", on_error="flag").collect()
    assert [r.x for r in rows] == [None, None, None, 'ok\\qA\n\\u0041"', None]
    assert [bool(r._bad) for r in rows] == [True, True, True, False, True]
    with pytest.raises(Exception, match="column x"):
        decode_rows(lines, "x string").collect()


def test_unicode_escapes_are_read(spark):
    lines = spark.createDataFrame([("caf\\u00e9 \\ud83d\\ude00 \\u005cn \\u0001\\u000a|\\\\",)], "line string")
    assert decode_rows(lines, "x string").head().x == "café 😀 \\n \x01\n|\\"


@pytest.mark.parametrize("delimiter", ["", "ab", "n", "\\", "\n", "1", "."])
def test_refused_delimiters(spark, delimiter):
    with pytest.raises(ValueError):
        encode_rows(spark.range(1), delimiter)


def test_unsupported_types(spark):
    with pytest.raises(ValueError, match="Unsupported type"):
        encode_rows(spark.sql("SELECT array(1) AS a"))
    with pytest.raises(ValueError, match="Unsupported type"):
        decode_rows(spark.sql("SELECT '' AS line"), "a map<string,int>")


def test_files(spark, tmp_path):
    df = spark.read.parquet(f"{DATA}/documents.parquet")
    path = str(tmp_path / "rows")
    write_text_rows(df, path, "errorifexists", null_token=LOSSLESS_NULL)
    assert spark.read.option("lineSep", "\n").text(path).count() == df.count()
    back = read_text_rows(spark, path, df.schema, null_token=LOSSLESS_NULL)
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0
    with pytest.raises(Exception):
        write_text_rows(df, path, "errorifexists")


def test_overwritten_files(spark, tmp_path):
    path = str(tmp_path / "rows")
    df = spark.range(10)
    write_text_rows(df, path, "overwrite")
    with pytest.raises(Exception, match="boom"):
        write_text_rows(df.select(F.raise_error(F.lit("boom")).cast("long").alias("id")), path, "overwrite")
    assert read_text_rows(spark, path, "id long").count() == 10
    write_text_rows(read_text_rows(spark, path, "id long").where("id < 4"), path, "overwrite")
    assert read_text_rows(spark, path, "id long").count() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["rows"]


def test_binary_longer_than_a_base64_line_survives_a_file(spark, tmp_path):
    df = spark.createDataFrame([(bytes(range(256)) * 4,)], "b binary")
    path = str(tmp_path / "rows")
    write_text_rows(df, path, "append")
    assert read_text_rows(spark, path, df.schema).head().b == bytes(range(256)) * 4


def test_stays_in_generated_code(spark, plan):
    df = spark.read.parquet(f"{DATA}/lineitem.parquet")
    for frame in (encode_rows(df), decode_rows(encode_rows(df), df.schema)):
        text = plan(frame)
        assert "Python" not in text and "Exchange" not in text
    # The fields are cut once, however many columns take one.
    columns = decode_rows(spark.read.text(DATA), df.schema, line_col="value", null_token=LOSSLESS_NULL)
    assert plan(columns).count("split(") == plan(columns.select("l_tax")).count("split(")


def test_generated_code_of_a_table_stays_compilable(spark, capsys):
    """The JVM compiles no method above 8000 bytes."""
    df = spark.read.parquet(f"{DATA}/lineitem.parquet")
    for frame in (encode_rows(df), decode_rows(spark.read.text(DATA), df.schema, line_col="value")):
        capsys.readouterr()
        frame.explain("codegen")
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
        assert sizes and max(sizes) < 8000


ALPHABET = st.text(st.sampled_from(list("ab\\ntrNu0041|,\t\n\r\x01é😀\"'/")), max_size=12)


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(ALPHABET | st.none(), ALPHABET | st.none()), min_size=1, max_size=40),
       st.sampled_from(["\t", "|"]), st.booleans())
def test_any_strings_round_trip(spark, rows, delimiter, ascii_only):
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    lines = encode_rows(df, delimiter, null_token=LOSSLESS_NULL, ascii_only=ascii_only)
    back = decode_rows(lines, df.schema, delimiter, null_token=LOSSLESS_NULL)
    assert [tuple(r) for r in back.collect()] == rows


def test_escape_is_the_reverse_of_unescape(spark):
    df = spark.createDataFrame([("\\" * n + "n" + "\\" * m,) for n in range(5) for m in range(5)], "x string")
    assert df.where(unescape_text(escape_text(F.col("x"))) != F.col("x")).count() == 0


@pytest.mark.parametrize("delimiter", ["\t", "|"])
def test_variants_as_text(spark, delimiter):
    rows = spark.sql("""SELECT id, try_parse_json(t) AS v FROM VALUES (1, '{"k": "a\\tb|c\\\\d"}'), (2, 'null'), (3, NULL), (4, '"NULL"') AS r(id, t)""")
    want = [tuple(r) for r in rows.selectExpr("id", "to_json(v)").orderBy("id").collect()]
    back = decode_rows(encode_rows(rows, delimiter), "id int, v variant", delimiter)
    assert [tuple(r) for r in back.selectExpr("id", "to_json(v)").orderBy("id").collect()] == want
    assert want[1:] == [(2, "null"), (3, None), (4, '"NULL"')]
    bad = spark.createDataFrame([(f"1{delimiter}{{",)], "line string")
    assert decode_rows(bad, "id int, v variant", delimiter, on_error="flag").head()._bad == "cannot read v"
