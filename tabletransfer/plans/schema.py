"""Schemas, column metadata, type names and select lists."""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabletransfer.plans.filters import identifier
from tabletransfer.sources.targets import parse_target, quote, resolve, table_exists

# Type names of the external database for each Spark type.
EXTERNAL_TYPE_NAMES = {
    "string": "TEXT",
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE PRECISION",
    "float": "REAL",
    "smallint": "INTEGER",
    "tinyint": "INTEGER",
    "boolean": "BOOLEAN",
    "binary": "BYTEA",
    "variant": "JSONB",
    "timestamp": "TIMESTAMP",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}

# External names that map to one Spark type, without a size.
_SIMPLE_TYPES = {
    "text": T.StringType(),
    "smallint": T.ShortType(),
    "integer": T.IntegerType(),
    "int": T.IntegerType(),
    "int4": T.IntegerType(),
    "bigint": T.LongType(),
    "int8": T.LongType(),
    "double precision": T.DoubleType(),
    "float8": T.DoubleType(),
    "double": T.DoubleType(),
    "real": T.FloatType(),
    "float4": T.FloatType(),
    "boolean": T.BooleanType(),
    "bool": T.BooleanType(),
    "bytea": T.BinaryType(),
    "variant": T.VariantType(),
    "date": T.DateType(),
    "timestamp": T.TimestampNTZType(),
    "timestamp without time zone": T.TimestampNTZType(),
    "timestamptz": T.TimestampType(),
    "timestamp with time zone": T.TimestampType(),
}

# External names kept as text, with the check their values must pass.
_TEXT_KINDS = {
    "uuid": "uuid",
    "varchar": "varchar",
    "character varying": "varchar",
    "char": "varchar",
    "character": "varchar",
    "bit": "bit",
    "bit varying": "varbit",
    "varbit": "varbit",
    "json": "json",
    "jsonb": "json",
    "geometry": "geometry",
    "time": "time",
    "time without time zone": "time",
    "time with time zone": "timetz",
    "timetz": "timetz",
}

_TYPE_TEXT = re.compile(r"\s*([a-z_0-9 ]*?[a-z_0-9])\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?\s*((?:with|without) time zone)?\s*")


@dataclass(frozen=True)
class ExternalType:
    """A type name of the external database: its Spark type and, for text, its check."""

    spark_type: T.DataType
    kind: str | None = None
    size: int | None = None


def external_type(name: str) -> ExternalType:
    """Read a type name such as ``varchar(20)``, ``decimal(10,2)`` or ``timestamp with time zone``."""
    m = _TYPE_TEXT.fullmatch(name.lower())
    if not m:
        raise ValueError(f"unknown type name {name!r}")
    base = " ".join((m[1] + " " + (m[4] or "")).split())
    size = int(m[2]) if m[2] else None
    if base in ("decimal", "numeric"):
        if size is None:
            return ExternalType(T.DecimalType(38, 18))
        return ExternalType(T.DecimalType(size, int(m[3] or 0)))
    if base in _SIMPLE_TYPES:
        return ExternalType(_SIMPLE_TYPES[base])
    if base in _TEXT_KINDS:
        return ExternalType(T.StringType(), _TEXT_KINDS[base], size)
    raise ValueError(f"unknown type name {name!r}")


def external_name(data_type: T.DataType) -> str:
    """Type name to create a column of ``data_type`` with in the external database."""
    if isinstance(data_type, T.DecimalType):
        return f"DECIMAL({data_type.precision},{data_type.scale})"
    try:
        return EXTERNAL_TYPE_NAMES[data_type.simpleString()]
    except KeyError:
        raise ValueError(f"Unsupported type {data_type.simpleString()}") from None


def infer_schema(spark: SparkSession, source: str, schemas=None, nullable: bool = False) -> T.StructType:
    """Schema of a table or query without running anything.

    An absent table gives an empty struct. ``nullable=True`` marks every column nullable.
    """
    target = resolve(spark, source, schemas)
    if target.is_query:
        schema = spark.sql(source).schema
    elif table_exists(spark, target):
        schema = spark.table(target.sql_name).schema
    else:
        schema = T.StructType()
    if nullable:
        schema = T.StructType([T.StructField(f.name, f.dataType, True, f.metadata) for f in schema])
    return schema


def _size_and_digits(field: T.StructField) -> tuple[str, int | None, int | None]:
    if isinstance(field.dataType, T.DecimalType):
        return field.dataType.simpleString(), field.dataType.precision, field.dataType.scale
    declared = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING")
    if declared:
        return declared, int(declared[declared.index("(") + 1:-1]), None
    return field.dataType.simpleString(), None, None


def column_meta(spark: SparkSession, source: str, schemas=None) -> DataFrame:
    """One row per column: ``ordinal, name, type, nullable, size, digits``."""
    rows = []
    for i, field in enumerate(infer_schema(spark, source, schemas), start=1):
        type_name, size, digits = _size_and_digits(field)
        rows.append((i, field.name, type_name, field.nullable, size, digits))
    return spark.createDataFrame(
        rows, "ordinal int, name string, type string, nullable boolean, size int, digits int")


def column_counts(df: DataFrame) -> DataFrame:
    """One row per column with the number of its non-null values, in a single pass.

    The pass aggregates to one row (with partial counts per task) before it is
    turned into rows.
    """
    counts = df.agg(*[F.count(F.col(quote(c))).alias(f"c{i}") for i, c in enumerate(df.columns)])
    cells = [
        F.struct(F.lit(i + 1).alias("ordinal"), F.lit(c).alias("name"),
                 F.lit(t).alias("type"), F.col(f"c{i}").alias("n_values"))
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return counts.select(F.inline(F.array(*cells)))


def select_list(schema: T.StructType, mode: str = "plain") -> str:
    """Select list text for ``<select_colList>``.

    ``mode``: ``plain`` leaves columns as they are, ``encode`` turns binary into
    base64 text, ``decode`` turns base64 text back into binary.
    """
    if mode not in ("plain", "encode", "decode"):
        raise ValueError(f"unknown mode {mode!r}")
    items = []
    for field in schema:
        name = quote(field.name)
        value = name
        if isinstance(field.dataType, T.BinaryType) and mode == "encode":
            value = f"translate(base64({name}), '\\r\\n', '')"
        elif isinstance(field.dataType, T.BinaryType) and mode == "decode":
            value = f"unbase64({name})"
        items.append(f"{value} AS {name}")
    return ", ".join(items)


def column_ddl(schema: T.StructType, target: Mapping[str, str] | None = None, dialect: str = "spark") -> str:
    """Column definitions for ``CREATE TABLE``.

    ``dialect="spark"`` gives Spark DDL. ``dialect="external"`` gives the external
    database's names; there, string, boolean and binary columns take the type that
    an existing ``target`` (name → type name) has for them.
    """
    if dialect == "spark":
        return ", ".join(f"{quote(f.name)} {_size_and_digits(f)[0]}" for f in schema)
    known = {k.lower(): v for k, v in (target or {}).items()}
    items = []
    for field in schema:
        type_name = external_name(field.dataType)
        if isinstance(field.dataType, (T.StringType, T.BooleanType, T.BinaryType)):
            type_name = known.get(field.name.lower(), type_name).upper()
        items.append(f"{identifier(field.name, 'ansi')} {type_name}")
    return ", ".join(items)


def schema_argument(spark: SparkSession, schema) -> T.StructType | None:
    """A caller's schema: a ``StructType``, DDL text, a table name or a query."""
    if schema is None or isinstance(schema, T.StructType):
        return schema
    try:
        target = parse_target(schema)
    except ValueError:
        return T.StructType.fromDDL(schema)
    if not target.is_query and not table_exists(spark, target):
        return T.StructType.fromDDL(schema)
    return infer_schema(spark, schema)
