"""Scalar conversions for column types that travel as text. Native expressions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

# The tokens that read as true, in any letter case.
TRUE_TOKENS = ("true", "t", "1", "y", "yes")

_UUID = "^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"
_TIME = r"^([01]\d|2[0-3]):[0-5]\d(:[0-5]\d(\.\d{1,6})?)?"
_ZONE = r"( ?[+-]\d{2}(:?\d{2})?|Z)"


def bool_from_text(col: Column) -> Column:
    """True for the tokens above, false for any other text, null for null."""
    return F.lower(col).isin(*TRUE_TOKENS)


def bool_to_text(col: Column) -> Column:
    return F.when(col, "1").when(~col, "0")


def base64_text(col: Column) -> Column:
    """Base64 on one line (Spark's own breaks lines after 76 characters)."""
    return F.translate(F.base64(col), "\r\n", "")


def bit_text(col: Column, source: T.DataType) -> Column:
    """Bit string of a boolean (1/0), of a whole number (binary digits) or of text (as is)."""
    if isinstance(source, T.BooleanType):
        return bool_to_text(col)
    if isinstance(source, T.IntegralType):
        return F.bin(col)
    return col.cast("string")


def is_bits(col: Column) -> Column:
    return col.rlike("^[01]*$")


def is_uuid(col: Column) -> Column:
    return col.rlike(_UUID)


def is_json(col: Column) -> Column:
    return F.when(col.isNotNull(), F.try_parse_json(col).isNotNull())


def json_value(col: Column, source: T.DataType) -> Column:
    """VARIANT of a JSON text, or of any other value as it is; null for text that is not JSON or repeats a key."""
    if isinstance(source, T.StringType):
        return F.try_parse_json(col)
    if isinstance(source, (T.StructType, T.ArrayType, T.MapType)):
        return F.to_variant_object(col)
    return col.try_cast(T.VariantType())


def json_text(col: Column) -> Column:
    """JSON text of a VARIANT: no white space, keys in the order of their bytes."""
    return F.to_json(col)


def json_part(col: Column, path: str, kind: T.DataType | str) -> Column:
    """The part of a VARIANT at a path such as ``$.a[0].b``; null where there is none or it is not of that type."""
    return F.try_variant_get(col, path, kind if isinstance(kind, str) else kind.simpleString())


def is_time(col: Column, zone: bool = False) -> Column:
    return col.rlike(_TIME + (_ZONE if zone else "") + "$")


def is_ewkb_hex(col: Column) -> Column:
    """Whole bytes of hex that start with a byte-order mark and a type word."""
    return col.rlike("^0[01]([0-9a-fA-F]{2}){4,}$")
