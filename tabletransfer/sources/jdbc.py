"""An external database as source or sink, through Spark's own JDBC data source."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from tabletransfer.operators.conform import conform
from tabletransfer.operators.distribution import parse_distribution
from tabletransfer.options import TransferOptions
from tabletransfer.plans.filters import identifier
from tabletransfer.sinks.tables import save_mode
from tabletransfer.sources.targets import parse_target, search_path


def jdbc_options(spark: SparkSession, options: TransferOptions) -> dict[str, str]:
    """Connection options of Spark's JDBC source."""
    if not options.url:
        raise ValueError("option 'url' is required for an external database")
    result = {"url": options.url}
    for key in ("user", "password", "driver"):
        if getattr(options, key):
            result[key] = getattr(options, key)
    if options.url.startswith("jdbc:postgresql:"):
        result["ApplicationName"] = options.application_name or spark.sparkContext.applicationId
        if options.schemas:
            path = [s for s in search_path(options.schemas) if s != "default"]
            if "public" not in path:
                path.append("public")
            result["currentSchema"] = ",".join(path)
    return result


def modulo_predicates(column: str, n: int) -> list[str]:
    """``n`` conditions that put every row into exactly one part, null and negative keys too."""
    name = identifier(column, "ansi")
    parts = [f"MOD(MOD({name}, {n}) + {n}, {n}) = {i}" for i in range(n)]
    parts[0] = f"({parts[0]} OR {name} IS NULL)"
    return parts


def read_jdbc(
    spark: SparkSession,
    options: TransferOptions | Mapping[str, object],
    n: int | None = None,
    by: str | None = None,
    bounds: tuple[object, object] | None = None,
    predicates: Sequence[str] | None = None,
) -> DataFrame:
    """Read a table or SELECT of the database; filters and columns are pushed down by Spark.

    In parallel: ``by`` with ``bounds`` cuts value ranges (best on an indexed column),
    ``by`` alone cuts by key modulo ``n``, ``predicates`` gives the parts directly.
    """
    if not isinstance(options, TransferOptions):
        options = TransferOptions.from_dict(options)
    if not options.table:
        raise ValueError("option 'dbtable' is required to read from an external database")
    conf = jdbc_options(spark, options)
    target = parse_target(options.table)
    table = f"({options.table}) t" if target.is_query else options.table
    if predicates is None and by and n and bounds is None:
        predicates = modulo_predicates(by, n)
    if predicates is not None:
        url = conf.pop("url")
        return spark.read.jdbc(url, table, predicates=list(predicates), properties=conf)
    reader = spark.read.format("jdbc").options(**conf).option("dbtable", table)
    if by and n:
        reader = (reader.option("partitionColumn", by).option("numPartitions", n)
                  .option("lowerBound", str(bounds[0])).option("upperBound", str(bounds[1])))
    return reader.load()


def write_jdbc(
    df: DataFrame,
    options: TransferOptions | Mapping[str, object],
    mode: str | None = None,
    writers: int | None = None,
    target_types: Mapping[str, str] | None = None,
    batch_size: int = 10_000,
) -> None:
    """Write to a table of the database; ``truncate`` keeps its structure on overwrite.

    ``target_types`` (column → type name) checks and converts text columns first.
    Spark commits per task here, so an all-or-nothing load needs a staging table in the
    database and one INSERT … SELECT there. ``writers`` limits open connections.
    """
    if not isinstance(options, TransferOptions):
        options = TransferOptions.from_dict(options)
    chosen = save_mode(mode or options.mode)
    if target_types:
        df = conform(df, target_types)
    if writers:
        df = df.coalesce(writers)
    more = write_options(options, target_types, batch_size)
    df.write.format("jdbc").options(**jdbc_options(df.sparkSession, options), **more).mode(chosen).save()


def write_options(
    options: TransferOptions, target_types: Mapping[str, str] | None = None, batch_size: int = 10_000,
) -> dict[str, str]:
    """Options of Spark's JDBC sink: the target, its clauses and its sized column types."""
    result = {"dbtable": options.table, "batchsize": str(batch_size), "truncate": str(options.truncate).lower()}
    dist = parse_distribution(options.distributed_by)
    clauses = []
    if dist and dist.columns:
        clauses.append(f"DISTRIBUTED BY ({', '.join(identifier(c, 'ansi') for c in dist.columns)})")
    elif dist:
        clauses.append(f"DISTRIBUTED {dist.kind.upper()}")
    if options.partition_by:
        clauses.append(options.partition_by)
    if clauses:
        result["createTableOptions"] = " ".join(clauses)
    sized = [f"{c} {t}" for c, t in (target_types or {}).items()
             if t.lower().startswith(("varchar", "char(", "decimal"))]
    if sized:
        result["createTableColumnTypes"] = ", ".join(sized)
    return result
