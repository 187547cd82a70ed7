"""Fit a DataFrame to a schema: a caller's schema, or the columns of an existing target."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tabletransfer.functions.values import bit_text, is_bits, is_ewkb_hex, is_time, is_uuid, json_part, json_text, json_value
from tabletransfer.plans.schema import ExternalType, external_type
from tabletransfer.sources.targets import quote


def apply_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast to the caller's schema.

    Columns are matched by name; when the names differ but the count is the same,
    they are matched by position, as an INSERT does.
    """
    have = {c.lower(): c for c in df.columns}
    if all(f.name.lower() in have for f in schema):
        source = [have[f.name.lower()] for f in schema]
    elif len(schema) == len(df.columns):
        df = df.toDF(*[f.name for f in schema])
        source = [f.name for f in schema]
    else:
        missing = [f.name for f in schema if f.name.lower() not in have]
        raise ValueError(f"schema has {len(schema)} columns, source has {len(df.columns)}; missing {missing}")
    return df.select(*[F.col(quote(c)).cast(f.dataType).alias(f.name) for c, f in zip(source, schema)])


def _fields(target) -> list[tuple[str, ExternalType]]:
    if isinstance(target, T.StructType):
        fields = []
        for f in target:
            declared = f.metadata.get("__CHAR_VARCHAR_TYPE_STRING")
            fields.append((f.name, external_type(declared) if declared else ExternalType(f.dataType)))
        return fields
    items = target.items() if isinstance(target, Mapping) else target
    return [(n, external_type(t) if isinstance(t, str) else ExternalType(t)) for n, t in items]


def _kept(col: Column, value: Column, source: T.DataType, target: T.DataType) -> Column | None:
    """Whether casting back gives the value again, where a cast may cut or round; else None.

    Of binary floating-point numbers fifteen digits count.
    """
    if isinstance(source, (T.TimestampType, T.TimestampNTZType)) and isinstance(target, T.DateType):
        return value.cast(source) == col
    if isinstance(target, (T.IntegralType, T.DecimalType)) and isinstance(source, (T.FloatType, T.DoubleType)):
        digits = 1e-6 if isinstance(source, T.FloatType) else 1e-15
        return F.abs(value.cast("double") - col.cast("double")) <= F.abs(col.cast("double")) * digits
    if isinstance(source, T.DecimalType) and isinstance(target, T.IntegralType):
        return value.cast(source) == col
    if isinstance(source, T.DecimalType) and isinstance(target, T.DecimalType) and target.scale < source.scale:
        return value == col
    return None


def _convert(col: Column, source: T.DataType, target: ExternalType) -> Column:
    """The value in the target's type, or null where it does not fit."""
    if target.kind in ("bit", "varbit"):
        bits = bit_text(col, source)
        if target.kind == "bit" and isinstance(source, T.BooleanType):
            bits = F.rpad(bits, target.size or 1, "0")
        fits = is_bits(bits)
        if target.size and target.kind == "bit":
            fits = fits & (F.length(bits) == target.size)
        elif target.size:
            fits = fits & (F.length(bits) <= target.size)
        return F.when(fits, bits)
    if target.kind is None:
        if isinstance(source, T.StringType) and isinstance(target.spark_type, T.BinaryType):
            return F.try_to_binary(col, F.lit("base64"))
        if isinstance(target.spark_type, T.VariantType):
            return json_value(col, source)
        if isinstance(source, T.VariantType):
            return json_text(col) if isinstance(target.spark_type, T.StringType) else json_part(col, "$", target.spark_type)
        value = col.try_cast(target.spark_type)
        kept = _kept(col, value, source, target.spark_type)
        return value if kept is None else F.when(kept, value)
    text = json_text(col) if isinstance(source, T.VariantType) else col.cast("string")
    if target.kind == "uuid":
        return F.when(is_uuid(text), text)
    if target.kind == "varchar":
        return text if target.size is None else F.when(F.length(text) <= target.size, text)
    if target.kind == "json":
        return F.when(F.try_parse_json(text).isNotNull(), text)
    if target.kind == "geometry":
        return F.when(is_ewkb_hex(text), text)
    return F.when(is_time(text, zone=target.kind == "timetz"), text)


def _pairs(df: DataFrame, target) -> list[tuple[str, str | None, Column]]:
    """(target column, source column, converted value) for each target field.

    There is no source column where nothing can be lost: the column is new, or its type
    is the target's already.
    """
    types = {f.name.lower(): f for f in df.schema}
    fields = _fields(target)
    extra = set(types) - {n.lower() for n, _ in fields}
    if extra:
        raise ValueError(f"the target has no column {sorted(extra)}")
    result = []
    for name, ext in fields:
        field = types.get(name.lower())
        if field is None:
            result.append((name, None, F.lit(None).cast(ext.spark_type)))
        elif ext.kind is None and ext.spark_type == field.dataType:
            result.append((name, None, F.col(quote(field.name))))
        else:
            result.append((name, field.name, _convert(F.col(quote(field.name)), field.dataType, ext)))
    return result


def conform(df: DataFrame, target, on_loss: str = "error") -> DataFrame:
    """Cast by name to an existing target's columns.

    ``target`` is a ``StructType`` or a mapping of column → type name of the external
    database (``uuid``, ``varchar(10)``, ``bit(4)``, ``json``, ``timestamptz`` …). ``json`` is text
    that is checked and kept as it stands; ``variant`` is parsed and stored as Spark's VARIANT.
    Target columns that ``df`` lacks become null. Nothing is rounded or cut: a number whose
    fraction the target cannot hold and a time of day that becomes a date do not fit; round
    before, where that is wanted. A value that does not fit fails the
    job (``on_loss="error"``) or becomes null (``"null"``, see ``conform_losses``).
    """
    if on_loss not in ("error", "null"):
        raise ValueError(f"unknown on_loss {on_loss!r}")
    out = []
    for name, source, value in _pairs(df, target):
        if source is not None and on_loss == "error":
            raw = F.col(quote(source))
            shown = json_text(raw) if isinstance(df.schema[source].dataType, T.VariantType) else raw.cast("string")
            message = F.concat(F.lit(f"column {name}: value does not fit the target: "), shown)
            value = F.coalesce(value, F.when(raw.isNotNull(), F.raise_error(message)))
        out.append(value.alias(name))
    return df.select(*out)


def conform_losses(df: DataFrame, target) -> DataFrame:
    """One row: per target column, how many values ``conform`` would lose. One pass."""
    return df.agg(*[
        (F.lit(0).cast("long") if source is None
         else F.count_if(F.col(quote(source)).isNotNull() & value.isNull())).alias(name)
        for name, source, value in _pairs(df, target)
    ])
