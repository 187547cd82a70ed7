"""Rows to and from delimited text, as native column expressions.

One row is one line: fields separated by a delimiter (TAB), a token for null, and
backslash escapes for the characters that would break the line apart. Everything here is
column expressions; no Python runs per row. Only writing with ``ascii_only`` leaves
generated code.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabletransfer.functions.values import base64_text, bool_from_text, bool_to_text, json_text
from tabletransfer.session import delete_path, replace_folder, unique_name
from tabletransfer.sources.targets import quote

NULL_TOKEN = "NULL"        # default, as other readers of the format expect it
LOSSLESS_NULL = "\\N"      # cannot be the text of any string, because backslashes are doubled

# Characters and their escapes, backslash first.
_ESCAPES = (("\\", "\\\\"), ("\t", "\\t"), ("\n", "\\n"), ("\r", "\\r"))
_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def check_delimiter(delimiter: str) -> None:
    if len(delimiter) != 1 or delimiter.isalnum() or delimiter in "\\\r\n\"'+-.:_=":
        raise ValueError(f"not usable as a delimiter: {delimiter!r}")


def escape_text(col: Column, delimiter: str = "\t", ascii_only: bool = False) -> Column:
    """Backslash-escape a string. ``ascii_only`` writes other characters as ``\\uXXXX``."""
    col = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), _ESCAPES, col)
    if ascii_only:
        # Cut into printable-ASCII runs and other runs; the latter become UTF-16 hex groups.
        runs = F.regexp_extract_all(col, F.lit("([\\x20-\\x7E]+|[^\\x20-\\x7E]+)"), F.lit(1))
        codes = lambda r: F.regexp_replace(F.hex(F.encode(r, "UTF-16BE")), "(.{4})", "\\\\u$1")
        ascii_runs = F.transform(runs, lambda r: F.when(r.rlike("^[\\x20-\\x7E]"), r).otherwise(codes(r)))
        col = F.when(col.rlike("[^\\x20-\\x7E]"), F.array_join(ascii_runs, "")).otherwise(col)
    if delimiter != "\t":
        col = F.replace(col, F.lit(delimiter), F.lit("\\" + delimiter))
    return col


def unescape_text(col: Column, delimiter: str = "\t") -> Column:
    """Reverse of ``escape_text``, ``\\uXXXX`` included; null where an escape has no meaning.

    Strings without a backslash pass untouched. The escapes of others are those of a JSON string, so
    Spark's JSON reader takes them back, in generated code. What differs is put right before: quotes
    and delimiters. Escaped backslashes are marked by line feeds meanwhile, which end a line and so
    cannot be inside. That reader takes strings of up to 20 million characters; a longer one with
    escapes counts as not readable.
    """
    return F.when(~col.contains("\\"), col).otherwise(_unescaped(col, delimiter))


def _unescaped(col: Column, delimiter: str) -> Column:
    steps = [("\\\\", "\n"), ("\\'", "'"), ('\\"', '"'), ('"', '\\"'), ("\n", "\\\\")]
    if delimiter != "\t":
        steps.insert(1, ("\\" + delimiter, delimiter))
    inner = reduce(lambda c, e: F.replace(c, F.lit(e[0]), F.lit(e[1])), steps, col)
    return F.get_json_object(F.concat(F.lit('{"a":"'), inner, F.lit('"}')), "$.a")


def pad_fraction(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss[.f…]`` with the fraction padded to six digits."""
    fraction = F.when(F.instr(text, ".") > 0, F.substring_index(text, ".", -1)).otherwise("")
    return F.concat(F.substring_index(text, ".", 1), F.lit("."), F.rpad(fraction, 6, "0"))


def local_time(instant: Column, tz: str) -> Column:
    """Wall-clock time in ``tz`` of an instant, exact also where clocks are set back."""
    utc = F.timestamp_add("MICROSECOND", F.unix_micros(instant), F.expr(_EPOCH))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def _plain_time(field: T.StructField, tz: str) -> Column:
    """Timestamps as Spark's own text, which does not depend on the session zone.

    This is a projection of its own, so that each value is formatted once although
    the padding looks at it several times.
    """
    col = F.col(quote(field.name))
    if isinstance(field.dataType, T.TimestampType):
        return local_time(col, tz).cast("string").alias(field.name)
    if isinstance(field.dataType, T.TimestampNTZType):
        return col.cast("string").alias(field.name)
    return col


def _field_text(field: T.StructField, delimiter: str, ascii_only: bool) -> Column:
    col = F.col(quote(field.name))
    kind = field.dataType
    if isinstance(kind, T.StringType):
        return escape_text(col, delimiter, ascii_only)
    if isinstance(kind, T.VariantType):
        return escape_text(json_text(col), delimiter, ascii_only)
    if isinstance(kind, T.BooleanType):
        return bool_to_text(col)
    if isinstance(kind, T.BinaryType):
        return base64_text(col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return pad_fraction(col)
    if isinstance(kind, (T.NumericType, T.DateType)):
        return col.cast("string")
    raise ValueError(f"Unsupported type {kind.simpleString()} of column {field.name}")


def _zone(df: DataFrame, tz: str | None) -> str:
    return tz or df.sparkSession.conf.get("spark.sql.session.timeZone")


def encode_rows(
    df: DataFrame,
    delimiter: str = "\t",
    tz: str | None = None,
    null_token: str = NULL_TOKEN,
    ascii_only: bool = False,
) -> DataFrame:
    """One string column ``line`` per row.

    ``tz`` is the zone for timestamps (default: the session zone). With the default
    null token a string ``NULL`` reads back as null; ``LOSSLESS_NULL`` avoids that.
    """
    check_delimiter(delimiter)
    zone = _zone(df, tz)
    fields = [
        F.coalesce(_field_text(f, delimiter, ascii_only), F.lit(null_token)) for f in df.schema
    ]
    plain = df.select(*[_plain_time(f, zone) for f in df.schema])
    return plain.select(F.concat_ws(delimiter, *fields).alias("line"))


def _field_value(text: Column, kind: T.DataType, tz: str) -> Column:
    """The typed value of a field's text, or null where the text is not one."""
    if isinstance(kind, T.StringType):
        return text
    if isinstance(kind, T.BooleanType):
        return bool_from_text(text)
    if isinstance(kind, T.BinaryType):
        return F.try_to_binary(text, F.lit("base64"))
    if isinstance(kind, T.VariantType):
        return F.try_parse_json(text)
    if isinstance(kind, T.TimestampType):
        return F.when(F.length(text) >= 19, F.concat(text, F.lit(" " + tz)).try_cast(kind))
    if isinstance(kind, T.TimestampNTZType):
        return F.when(F.length(text) >= 19, text.try_cast(kind))
    if isinstance(kind, T.DateType):
        return F.when(F.length(text) >= 10, text.try_cast(kind))
    if isinstance(kind, T.NumericType):
        return text.try_cast(kind)
    raise ValueError(f"Unsupported type {kind.simpleString()}")


def _fields(line: Column, delimiter: str) -> Column:
    """Array of a line's raw fields: cut at delimiters that no escape belongs to."""
    if delimiter == "\t":
        return F.split(line, delimiter, -1)
    # Escaped backslashes are marked by line feeds meanwhile; then a backslash before a delimiter escapes it.
    marked = F.replace(line, F.lit("\\\\"), F.lit("\n"))
    return F.split(marked, r"(?<!\\)" + re.escape(delimiter), -1)


def decode_rows(
    df: DataFrame,
    schema: T.StructType | str,
    delimiter: str = "\t",
    tz: str | None = None,
    null_token: str = NULL_TOKEN,
    on_error: str = "error",
    line_col: str = "line",
) -> DataFrame:
    """Parse lines into the columns of ``schema``.

    A line with a wrong field count, or a field that is not of its type or has an escape
    without a meaning, fails the job (``on_error="error"``). With ``on_error="flag"`` the row is
    kept, such fields are null, and column ``_bad`` says what is wrong (null for good rows).
    """
    if on_error not in ("error", "flag"):
        raise ValueError(f"unknown on_error {on_error!r}")
    check_delimiter(delimiter)
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    zone = _zone(df, tz)
    line = F.col(quote(line_col))
    parts = df.select(_fields(line, delimiter).alias("_f"), line.contains("\n").alias("_lf"))
    n = len(schema)
    wrong_count = F.concat(F.lit(f"expected {n} fields, found "), F.size("_f").cast("string"))
    shape = F.when(F.col("_lf"), F.lit("raw line feed inside a line")).when(F.size("_f") != n, wrong_count)
    if on_error == "error":
        # Every column is taken from the checked array, so a bad line cannot slip through.
        checked = F.coalesce(F.when(shape.isNull(), F.col("_f")), F.raise_error(shape).cast("array<string>"))
        parts = parts.select(checked.alias("_f"))
    values, wrong = [], []
    for i, field in enumerate(schema):
        raw = F.get(F.col("_f"), F.lit(i))
        if delimiter != "\t":
            raw = F.replace(raw, F.lit("\n"), F.lit("\\\\"))
        # The check stands where a value is read, so that nothing is evaluated twice.
        complaint = F.raise_error(F.concat(
            F.lit(f"column {field.name}: not a {field.dataType.simpleString()}: "), raw)).cast(field.dataType)
        checked = (lambda v: F.coalesce(v, complaint)) if on_error == "error" else (lambda v: v)
        if isinstance(field.dataType, T.StringType):
            value = F.when(raw.contains("\\"), checked(_unescaped(raw, delimiter))).otherwise(raw)
        elif isinstance(field.dataType, T.BooleanType):
            value = _field_value(raw, field.dataType, zone)
        elif isinstance(field.dataType, (T.BinaryType, T.VariantType)):
            value = checked(_field_value(unescape_text(raw, delimiter), field.dataType, zone))
        else:
            value = checked(_field_value(raw, field.dataType, zone))
        value = F.when(raw != null_token, value)
        if on_error == "flag" and not isinstance(field.dataType, T.BooleanType):
            wrong.append(F.when((raw != null_token) & value.isNull(), F.lit(field.name)))
        values.append(value.alias(field.name))
    if on_error == "error":
        return parts.select(*values)
    names = F.concat_ws(", ", *wrong) if wrong else F.lit("")
    bad_fields = F.when(names != "", F.concat(F.lit("cannot read "), names))
    return parts.select(*values, F.coalesce(shape, bad_fields).alias("_bad"))


def write_text_rows(df: DataFrame, path: str, mode: str, delimiter: str = "\t", tz: str | None = None,
                    null_token: str = NULL_TOKEN, ascii_only: bool = False) -> None:
    """Write rows as text files, one line each, UTF-8, ``\\n`` at the end.

    ``overwrite`` writes a new folder first and then swaps the names, so that a failure
    leaves the old files, and rows read from ``path`` itself may be written back.
    """
    spark = df.sparkSession
    writer = encode_rows(df, delimiter, tz, null_token, ascii_only).write.option("lineSep", "\n")
    if mode != "overwrite":
        writer.mode(mode).text(path)
        return
    staged = f"{path.rstrip('/')}_{unique_name('new')}"
    try:
        writer.text(staged)
    except Exception:
        delete_path(spark, staged)
        raise
    replace_folder(spark, staged, path)


def read_text_rows(spark, path: str, schema: T.StructType | str, delimiter: str = "\t", tz: str | None = None,
                   null_token: str = NULL_TOKEN, on_error: str = "error") -> DataFrame:
    """Read files written by ``write_text_rows``. Files are split, so this scales with bytes."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return decode_rows(lines, schema, delimiter, tz, null_token, on_error, "value")
