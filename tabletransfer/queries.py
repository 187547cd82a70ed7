"""Registered queries: each runs one capability of the package over whole tables.

``QUERIES`` maps a name to ``(spark, folder) -> DataFrame``; ``ORACLES`` has the SQL
that gives the same rows.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tabletransfer.api import load, save, stream
from tabletransfer.functions.points import ewkb_to_text, point_to_ewkb
from tabletransfer.functions.udfs import get_batch_id, register_udfs
from tabletransfer.functions.values import (
    base64_text, bit_text, bool_from_text, is_ewkb_hex, is_json, is_uuid, json_part, json_text,
)
from tabletransfer.operators.conform import conform, conform_losses
from tabletransfer.operators.textrows import (
    LOSSLESS_NULL, decode_rows, encode_rows, local_time, pad_fraction, read_text_rows, write_text_rows,
)
from tabletransfer.plans.filters import (
    contains, ends_with, eq, ge, gt, is_in, is_not_null, is_null, le, lt, starts_with,
)
from tabletransfer.plans.schema import column_counts, column_meta, infer_schema, select_list
from tabletransfer.plans.scripts import read_transfer, write_transfer
from tabletransfer.session import delete_path, scratch_database, scratch_path
from tabletransfer.sinks.catalog import table_info
from tabletransfer.sinks.tables import write_table
from tabletransfer.sinks.transactions import write_transaction
from tabletransfer.sources.generator import generate, uuid_rows
from tabletransfer.sources.jdbc import modulo_predicates
from tabletransfer.sources.tables import read_distributed, read_parallel, read_query, read_table
from tabletransfer.streaming.epochs import epoch_log
from tabletransfer.streaming.fileindex import late_rows
from tabletransfer.streaming.ledger import stream_transfer
from tabletransfer.streaming.progress import drain, progress_report, with_delay
from tabletransfer.streaming.sink import table_sink, write_stream
from tabletransfer.streaming.source import read_stream_offsets

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function's name, with the SQL it must agree with."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLES[function.__name__] = sql
        return function

    return register


def views(spark: SparkSession, folder: str, *names: str) -> list[DataFrame]:
    """Register tables of the folder as temporary views and return them."""
    frames = []
    for name in names:
        df = spark.read.parquet(f"{folder}/{name}.parquet")
        df.createOrReplaceTempView(name)
        frames.append(df)
    return frames


# -- reading -----------------------------------------------------------------------


@query("SELECT c_custkey, c_name, c_nationkey FROM customer")
def read_table_columns(spark, folder):
    views(spark, folder, "customer")
    return read_table(spark, "customer", columns=["c_custkey", "c_name", "c_nationkey"])


_JOINED = """
SELECT o_orderkey, c_name, n_name, o_totalprice
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
WHERE o_orderpriority LIKE '1%' AND o_totalprice > 100000
"""


@query(_JOINED)
def read_query_join(spark, folder):
    views(spark, folder, "orders", "customer", "nation")
    return read_query(spark, _JOINED)


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 10")
def read_query_limit(spark, folder):
    views(spark, folder, "orders")
    return read_query(spark, "SELECT o_orderkey, o_custkey FROM orders ORDER BY 1 LIMIT 10")


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
       CAST(o_orderdate AS DATE) AS day FROM orders
""")
def read_with_schema(spark, folder):
    views(spark, folder, "orders")
    return read_query(spark, "SELECT o_orderkey, o_totalprice, o_orderdate FROM orders",
                      schema="order_id string, price decimal(18,2), day date")


@query("""
SELECT 1 AS ordinal, 'o_orderstatus' AS name, 'string' AS type, count(o_orderstatus) AS n_values FROM orders
UNION ALL SELECT 2, 'k2', 'bigint', count(o_custkey) FROM orders
UNION ALL SELECT 3, 'o_totalprice', 'double', count(o_totalprice) FROM orders
""")
def infer_schema_query(spark, folder):
    views(spark, folder, "orders")
    text = "SELECT o_orderstatus, o_custkey * 2 AS k2, o_totalprice FROM orders"
    schema = infer_schema(spark, text)
    return column_counts(read_query(spark, text, schema=schema))


@query("""
SELECT 1 AS ordinal, 'p_partkey' AS name, 'bigint' AS type, CAST(NULL AS INTEGER) AS size,
       CAST(NULL AS INTEGER) AS digits, count(p_partkey) AS n_values FROM part
UNION ALL SELECT 2, 'p_brand', 'varchar(40)', 40, NULL, count(p_brand) FROM part
UNION ALL SELECT 3, 'p_retailprice', 'decimal(18,2)', 18, 2, count(p_retailprice) FROM part
""")
def column_metadata(spark, folder):
    (part,) = views(spark, folder, "part")
    db = scratch_database(spark)
    spark.sql(f"CREATE TABLE {db}.typed (p_partkey BIGINT, p_brand VARCHAR(40), p_retailprice DECIMAL(18,2)) "
              "USING parquet")
    write_table(part.select("p_partkey", "p_brand", "p_retailprice"), f"{db}.typed", "append")
    meta = column_meta(spark, f"{db}.typed").drop("nullable")
    counts = column_counts(read_table(spark, f"{db}.typed")).select("name", "n_values")
    return meta.join(counts, "name").select("ordinal", "name", "type", "size", "digits", "n_values")


@query("SELECT count(*) AS n FROM lineitem")
def count_no_columns(spark, folder):
    views(spark, folder, "lineitem")
    return read_table(spark, "lineitem").select().agg(F.count(F.lit(1)).alias("n"))


_COUNTS = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, count(*) AS n_rows FROM {name}" for name in ("customer", "events", "lineitem", "orders"))


@query(_COUNTS)
def union_counts(spark, folder):
    views(spark, folder, "orders", "customer", "lineitem", "events")
    return read_query(spark, _COUNTS)


@query("SELECT o_orderkey, o_custkey FROM orders")
def parallel_read(spark, folder):
    (orders,) = views(spark, folder, "orders")
    return read_parallel(orders.select("o_orderkey", "o_custkey"), 8, ["o_orderkey"])


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def distributed_read(spark, folder):
    (lineitem,) = views(spark, folder, "lineitem")
    db = scratch_database(spark)
    write_table(lineitem.select("l_orderkey", "l_linenumber", "l_quantity"), f"{db}.t", "append",
                distributed_by="l_orderkey", buckets=8)
    return read_distributed(spark, f"{db}.t", "distributed by (l_linenumber)", 8)


@query("SELECT o_orderkey, o_orderstatus FROM orders")
def search_path_read(spark, folder):
    (orders,) = views(spark, folder, "orders")
    first, second = scratch_database(spark), scratch_database(spark)
    write_table(orders.select("o_orderkey", "o_orderstatus"), "found_here", "append", schemas=second)
    return read_table(spark, "found_here", schemas=f"{first}, {second}")


@query("SELECT o_orderkey, o_custkey, ((o_custkey % 4) + 4) % 4 AS part, 1 AS times FROM orders")
def key_parts_read(spark, folder):
    """The partition conditions of a parallel read from a database, all in one scan of a Spark table."""
    (orders,) = views(spark, folder, "orders")
    of = [F.expr(p.replace('"', "`")) for p in modulo_predicates("o_custkey", 4)]
    part = F.coalesce(*[F.when(condition, i) for i, condition in enumerate(of)])
    times = reduce(lambda a, b: a + b, [F.coalesce(condition, F.lit(False)).cast("int") for condition in of])
    return read_table(spark, "orders").select("o_orderkey", "o_custkey", part.alias("part"), times.alias("times"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE o_totalprice > 5000")
def load_and_save(spark, folder):
    views(spark, folder, "orders")
    db = scratch_database(spark)
    table = {"dbschema": db, "dbtable": "kept", "distributedBy": "o_custkey", "partitionClause": "o_orderstatus"}
    source = {"dbtable": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders"}
    save(load(spark, source, filters=gt("o_totalprice", 5000)).drop("o_totalprice"), table, "overwrite")
    return load(spark, table).select("o_orderkey", "o_custkey", "o_orderstatus")


# -- filters -----------------------------------------------------------------------


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders
WHERE ((o_totalprice > 50000 AND o_orderpriority LIKE '1%') OR o_orderstatus IN ('P', 'F'))
  AND NOT (o_custkey <= 20 OR o_orderpriority LIKE '%LOW' OR o_orderpriority LIKE '%SPEC%')
  AND o_custkey IS NOT NULL AND NOT (o_totalprice IS NULL) AND NOT (o_orderkey = 7)
  AND (o_totalprice >= 1000 OR o_totalprice < 900)
""")
def filter_tree(spark, folder):
    views(spark, folder, "orders")
    keep = (
        ((gt("o_totalprice", 50000) & starts_with("o_orderpriority", "1")) | is_in("o_orderstatus", "P", "F"))
        & ~(le("o_custkey", 20) | ends_with("o_orderpriority", "LOW") | contains("o_orderpriority", "SPEC"))
        & is_not_null("o_custkey") & ~is_null("o_totalprice") & ~eq("o_orderkey", 7)
        & (ge("o_totalprice", 1000) | lt("o_totalprice", 900))
    )
    return read_table(spark, "orders", filters=keep).drop("o_orderdate")


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'O' AND o_custkey > 20")
def filter_quoted_names(spark, folder):
    """Names in double quotes, with dots, in a script and in a scan."""
    (orders,) = views(spark, folder, "orders")
    orders.selectExpr("o_orderstatus AS `Order.Status`", "o_custkey AS `Key`").createOrReplaceTempView("quoted_orders")
    keep = eq('"Order.Status"', "O") & gt('"Key"', 20)
    by_script = read_transfer(spark, "INSERT INTO <ext_table> SELECT * FROM quoted_orders WHERE <pushed_filters>", filters=keep)
    by_scan = spark.table("quoted_orders").where(keep.column())
    return by_script.intersectAll(by_scan).agg(F.count("*").alias("n"))


@query("""
SELECT event_id, user_id FROM events
WHERE ts >= TIMESTAMP '2024-01-10 06:30:00.5' AND ts < DATE '2024-01-20' AND event_type = 'view'
""")
def filter_literals(spark, folder):
    views(spark, folder, "events")
    keep = [ge("ts", dt.datetime(2024, 1, 10, 6, 30, 0, 500000)), lt("ts", dt.date(2024, 1, 20)),
            eq("event_type", "view")]
    return read_table(spark, "events", columns=["event_id", "user_id"], filters=keep)


@query("""
SELECT doc_id AS id, source AS place FROM documents WHERE contains(text, '%') OR ends_with(text, '_')
UNION ALL SELECT page_id, url FROM pages WHERE contains(url, '_') OR contains(html, '%') OR starts_with(url, '%h')
""")
def filter_wildcards(spark, folder):
    views(spark, folder, "documents", "pages")
    documents = read_table(spark, "documents", filters=contains("text", "%") | ends_with("text", "_"))
    pages = read_table(spark, "pages", filters=contains("url", "_") | contains("html", "%") | starts_with("url", "%h"))
    return (documents.select(F.col("doc_id").alias("id"), F.col("source").alias("place"))
            .union(pages.select("page_id", "url")))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice > 1000 AND length(o_orderpriority) > 5")
def filter_residual(spark, folder):
    views(spark, folder, "orders")
    keep = [gt("o_totalprice", 1000), F.length("o_orderpriority") > 5]
    return read_transfer(
        spark, "INSERT INTO <ext_table> SELECT o_orderkey, o_totalprice FROM orders WHERE <pushed_filters>",
        filters=keep)


# -- transfer scripts --------------------------------------------------------------


@query("""
SELECT c_custkey, c_name, count(*) AS n_orders, max(o_totalprice) AS top_price, 3 AS epoch
FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_custkey > 10 GROUP BY 1, 2
""")
def script_read(spark, folder):
    views(spark, folder, "orders", "customer")
    script = """
        INSERT INTO <EXT_TABLE> (c_custkey, c_name, n_orders, top_price, epoch)
        SELECT c_custkey, c_name, count(*), max(o_totalprice), <current_epoch>
        FROM orders JOIN customer ON o_custkey = c_custkey
        WHERE <pushed_filters> GROUP BY 1, 2"""
    return read_transfer(spark, script, filters=gt("c_custkey", 10), epoch=3)


@query("SELECT o_orderkey, o_custkey, CAST(NULL AS DOUBLE) AS o_totalprice FROM orders")
def script_read_columns(spark, folder):
    views(spark, folder, "orders")
    return read_transfer(
        spark, "INSERT INTO <ext_table> (o_custkey, o_orderkey) SELECT o_custkey, o_orderkey FROM orders",
        schema="o_orderkey bigint, o_custkey bigint, o_totalprice double")


@query("SELECT doc_id, to_base64(encode(text)) AS body FROM documents")
def script_select_list(spark, folder):
    views(spark, folder, "documents")
    spark.sql("SELECT doc_id, CAST(text AS BINARY) AS body FROM documents").createOrReplaceTempView("documents_raw")
    schema = infer_schema(spark, "documents_raw")
    return spark.sql(f"SELECT {select_list(schema, 'encode')} FROM documents_raw")


@query("""
SELECT o_orderstatus AS status, count(*) AS n_orders, sum(CAST(o_totalprice AS DECIMAL(18,2)))::DECIMAL(28,2) AS total
FROM orders GROUP BY 1
UNION ALL SELECT 'all', count(*), sum(CAST(o_totalprice AS DECIMAL(18,2)))::DECIMAL(28,2) FROM orders
""")
def script_procedural(spark, folder):
    views(spark, folder, "orders")
    script = """
    BEGIN
      DECLARE n_all BIGINT DEFAULT 0;
      DECLARE sum_all DECIMAL(28,2) DEFAULT 0;
      FOR rec AS (SELECT o_orderstatus AS s, count(*) AS n, sum(CAST(o_totalprice AS DECIMAL(18,2))) AS t
                  FROM orders GROUP BY 1) DO
        INSERT INTO <ext_table> VALUES (rec.s, rec.n, rec.t);
        SET n_all = n_all + rec.n;
        SET sum_all = sum_all + rec.t;
      END FOR;
      INSERT INTO <ext_table> SELECT 'all', n_all, sum_all;
    END"""
    return read_transfer(spark, script, schema="status string, n_orders bigint, total decimal(28,2)")


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey")
def script_write_join(spark, folder):
    orders, _ = views(spark, folder, "orders", "customer")
    db = scratch_database(spark)
    write_transfer(orders, f"""
        CREATE TABLE {db}.enriched USING parquet AS
        SELECT o_orderkey, c_name, c_mktsegment FROM <ext_table> JOIN customer ON o_custkey = c_custkey""")
    return read_table(spark, f"{db}.enriched")


@query("SELECT o_orderstatus AS status, count(*) AS n FROM orders GROUP BY 1")
def script_write_block(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_transfer(orders, f"""
    BEGIN
      DROP TABLE IF EXISTS {db}.totals;
      CREATE TABLE {db}.totals (status STRING, n BIGINT) USING parquet;
      INSERT INTO {db}.totals SELECT o_orderstatus, count(*) FROM <ext_table> GROUP BY 1;
    END""")
    return read_table(spark, f"{db}.totals")


@query("SELECT c_custkey, c_name, o_orderkey FROM customer LEFT JOIN orders ON c_custkey = o_custkey")
def left_enrich(spark, folder):
    views(spark, folder, "customer", "orders")
    return read_transfer(
        spark, "INSERT INTO <ext_table> SELECT c_custkey, c_name, o_orderkey "
               "FROM customer LEFT JOIN orders ON c_custkey = o_custkey")


# -- writing -----------------------------------------------------------------------

_ORDERS = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"


@query("""
SELECT o_orderkey, o_custkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS o_totalprice FROM orders
""")
def write_append_create(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    done = F.col("o_orderstatus") == "F"
    write_table(orders.where(done).select("o_orderkey", "o_custkey", "o_totalprice"), f"{db}.t", "append")
    write_table(orders.where(~done).select("o_custkey", "o_orderkey"), f"{db}.t", "append")
    return read_table(spark, f"{db}.t")


@query("SELECT c_custkey, c_name FROM customer")
def write_overwrite(spark, folder):
    orders, customer = views(spark, folder, "orders", "customer")
    db = scratch_database(spark)
    write_table(orders, f"{db}.t", "append")
    write_table(customer.select("c_custkey", "c_name"), f"{db}.t", "overwrite")
    return read_table(spark, f"{db}.t")


@query("""
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice * 2 AS o_totalprice, o_orderdate, o_orderpriority FROM orders
""")
def write_self_overwrite(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_table(orders, f"{db}.t", "append")
    doubled = read_table(spark, f"{db}.t").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    write_table(doubled, f"{db}.t", "overwrite")
    return read_table(spark, f"{db}.t")


@query("SELECT o_orderkey, o_custkey, CAST(NULL AS VARCHAR) AS o_orderstatus FROM orders")
def write_truncate(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_table(orders.select("o_orderkey", "o_custkey", "o_orderstatus"), f"{db}.t", "append",
                distributed_by="o_custkey", buckets=4)
    write_table(orders.select("o_custkey", "o_orderkey"), f"{db}.t", "overwrite", truncate=True)
    return read_table(spark, f"{db}.t")


@query("SELECT c_custkey, c_name FROM customer")
def write_ignore(spark, folder):
    customer, orders = views(spark, folder, "customer", "orders")
    db = scratch_database(spark)
    write_table(customer.select("c_custkey", "c_name"), f"{db}.t", "ignore")
    write_table(orders, f"{db}.t", "ignore")
    return read_table(spark, f"{db}.t")


@query("SELECT c_custkey, c_name FROM customer")
def write_error(spark, folder):
    customer, orders = views(spark, folder, "customer", "orders")
    db = scratch_database(spark)
    write_table(customer.select("c_custkey", "c_name"), f"{db}.t", "errorifexists")
    try:
        write_table(orders, f"{db}.t", "errorifexists")
    except ValueError:
        return read_table(spark, f"{db}.t")
    raise AssertionError("an existing table was written")


@query(_ORDERS)
def write_distributed(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_table(orders, f"{db}.t", "append", distributed_by="distributed by (o_custkey)", buckets=8)
    return read_table(spark, f"{db}.t")


@query(_ORDERS)
def write_randomly(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_table(orders, f"{db}.t", "append", distributed_by="distributed randomly")
    return read_table(spark, f"{db}.t")


@query("SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey")
def write_replicated(spark, folder):
    nation, customer = views(spark, folder, "nation", "customer")
    db = scratch_database(spark)
    write_table(nation, f"{db}.nation", "append", distributed_by="replicated")
    small = read_table(spark, f"{db}.nation")
    return customer.join(small, customer.c_nationkey == small.n_nationkey).select("c_custkey", "n_name")


@query(_ORDERS)
def write_partitioned(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_table(orders, f"{db}.t", "append", partition_by=["o_orderstatus"])
    return read_table(spark, f"{db}.t").select(*orders.columns)


@query(_ORDERS)
def write_repartition7(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_table(orders.repartition(7), f"{db}.t", "append", writers=2)
    return read_table(spark, f"{db}.t")


@query(_ORDERS)
def write_empty_then_append(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_table(read_query(spark, "SELECT * FROM orders WHERE o_orderkey < 0"), f"{db}.t", "overwrite")
    write_table(orders, f"{db}.t", "append")
    return read_table(spark, f"{db}.t")


@query("SELECT 'created' AS action, count(*) AS n_rows FROM lineitem")
def write_report(spark, folder):
    (lineitem,) = views(spark, folder, "lineitem")
    db = scratch_database(spark)
    report = write_table(lineitem, f"{db}.t", "append")
    return report.to_df(spark).select("action", F.col("rows").alias("n_rows"))


@query("SELECT 'appended' AS action, count(*) AS n_rows, true AS stored FROM lineitem")
def write_append_report(spark, folder):
    """An append reports what it added, not what the table holds."""
    (lineitem,) = views(spark, folder, "lineitem")
    db = scratch_database(spark)
    first = write_table(lineitem, f"{db}.t", "append")
    report = write_table(lineitem, f"{db}.t", "append")
    stored = report.files is not None and report.files <= first.files and 0 < report.bytes <= first.bytes * 2
    return report.to_df(spark).select("action", F.col("rows").alias("n_rows"), F.lit(stored).alias("stored"))


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, true AS shaped FROM orders")
def write_partitioned_buckets(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_table(orders, f"{db}.t", "append", partition_by=["o_orderstatus"], distributed_by="o_custkey", buckets=4)
    info = table_info(spark, f"{db}.t")
    shaped = (info.partition_columns, info.bucket_columns, info.num_buckets) == (["o_orderstatus"], ["o_custkey"], 4)
    return read_table(spark, f"{db}.t").select(*orders.columns, F.lit(shaped).alias("shaped"))


@query("""
SELECT 'kept' AS tab, c_custkey AS k, 1 AS part FROM customer
UNION ALL SELECT 'kept', o_custkey, 2 FROM orders WHERE o_totalprice > 100000
UNION ALL SELECT 'totals', count(*), 2 FROM orders WHERE o_totalprice > 100000
""")
def write_block_transaction(spark, folder):
    """A block of two statements that is published whole, after one that failed and left nothing."""
    customer, orders = views(spark, folder, "customer", "orders")
    db = scratch_database(spark)
    write_table(customer.selectExpr("c_custkey AS k", "1 AS part"), f"{db}.kept", "append", partition_by=["part"])
    spark.sql(f"CREATE TABLE {db}.totals (n BIGINT) USING parquet")
    script = f"""BEGIN
      INSERT INTO {db}.kept SELECT o_custkey, 2 FROM <ext_table>;
      INSERT OVERWRITE {db}.totals SELECT count(*) + %s FROM {db}.kept WHERE part = 2;
    END"""
    rows = orders.where("o_totalprice > 100000")
    try:
        write_transaction(rows, script % "raise_error('refused')")
    except Exception as error:
        if "refused" not in str(error):
            raise
    write_transaction(rows, script % "0")
    kept = read_table(spark, f"{db}.kept").select(F.lit("kept").alias("tab"), "k", "part")
    return kept.union(read_table(spark, f"{db}.totals").select(F.lit("totals"), "n", F.lit(2)))


@query("SELECT c_custkey, c_name, true AS undone FROM customer")
def write_rollback(spark, folder):
    customer, orders = views(spark, folder, "customer", "orders")
    db = scratch_database(spark)
    write_table(customer.select("c_custkey", "c_name"), f"{db}.t", "append")
    broken = orders.withColumn(
        "o_custkey", F.when(F.col("o_totalprice") >= 0, F.raise_error(F.lit("refused")).cast("long")))
    undone = []
    for mode in ("overwrite", "append"):
        try:
            write_table(broken.select(F.col("o_custkey").alias("c_custkey")), f"{db}.t", mode,
                        undo=lambda: undone.append(mode))
        except Exception:
            continue
        raise AssertionError("the failing write went through")
    return read_table(spark, f"{db}.t").withColumn("undone", F.lit(len(undone) == 2))


# -- types -------------------------------------------------------------------------


@query("""
SELECT CAST(o_orderkey AS VARCHAR) AS k, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
       CAST(o_custkey AS INTEGER) AS cust, o_orderstatus AS status, CAST(o_orderdate AS DATE) AS day,
       CAST(NULL AS DOUBLE) AS extra
FROM orders
""")
def conform_types(spark, folder):
    (orders,) = views(spark, folder, "orders")
    source = orders.select(
        F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("cust"),
        F.col("o_orderstatus").alias("status"), F.col("o_orderdate").alias("day"))
    return conform(source, {
        "k": "varchar(20)", "price": "decimal(18,2)", "cust": "integer", "status": "char(1)",
        "day": "date", "extra": "double precision"})


@query("""
SELECT count(*) FILTER (length(o_orderpriority) > 5) AS priority,
       count(*) FILTER (o_orderkey > 127) AS k, 0::BIGINT AS bits,
       count(o_orderstatus) AS status, count(*) FILTER (o_orderkey % 4 <> 0) AS fraction,
       count(*) FILTER (o_orderkey * 125 % 100 <> 0) AS scale, count(*) FILTER (o_orderkey % 2 = 1) AS moment
FROM orders
""")
def conform_loss_counts(spark, folder):
    (orders,) = views(spark, folder, "orders")
    source = orders.select(
        F.col("o_orderpriority").alias("priority"), F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("bits"), F.col("o_orderstatus").alias("status"),
        (F.col("o_orderkey") / 4).alias("fraction"), (F.col("o_orderkey") / 8).cast("decimal(18,3)").alias("scale"),
        F.timestamp_seconds(F.col("o_orderkey") * 43200).alias("moment"))
    return conform_losses(source, [
        ("priority", "varchar(5)"), ("k", T.ByteType()), ("bits", "varbit"), ("status", "uuid"),
        ("fraction", "integer"), ("scale", "decimal(18,1)"), ("moment", "date")])


@query("SELECT n_nationkey, bin(n_nationkey) AS bits FROM nation UNION ALL SELECT o_custkey, bin(o_custkey) FROM orders")
def text_bits(spark, folder):
    nation, orders = views(spark, folder, "nation", "orders")
    a = nation.select(F.col("n_nationkey").cast("long"), bit_text(F.col("n_nationkey"), T.IntegerType()).alias("bits"))
    b = orders.select("o_custkey", bit_text(F.col("o_custkey"), T.LongType()).alias("bits"))
    return a.union(b)


@query("""
SELECT conv_id, turn, lower(role) IN ('true', 't', '1', 'y', 'yes') AS by_role,
       lower(CAST(turn AS VARCHAR)) IN ('true', 't', '1', 'y', 'yes') AS by_turn FROM conversations
""")
def text_bool(spark, folder):
    (conversations,) = views(spark, folder, "conversations")
    return conversations.select("conv_id", "turn", bool_from_text(F.col("role")).alias("by_role"),
                                bool_from_text(F.col("turn").cast("string")).alias("by_turn"))


@query("SELECT o_orderkey, true AS made, false AS status FROM orders")
def text_uuid(spark, folder):
    (orders,) = views(spark, folder, "orders")
    return orders.select("o_orderkey", is_uuid(F.uuid()).alias("made"),
                         is_uuid(F.col("o_orderstatus")).alias("status"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k, json_valid(props) AS valid, json_valid(event_type) AS other FROM events")
def json_field(spark, folder):
    (events,) = views(spark, folder, "events")
    return events.select("event_id", F.get_json_object("props", "$.k").alias("k"),
                         is_json(F.col("props")).alias("valid"), is_json(F.col("event_type")).alias("other"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, coalesce(json_valid(props), false) AS stored,
          coalesce(json_valid(props), false) AS same FROM events""")
def json_variant(spark, folder):
    """Text to VARIANT in a table, out as lines, read back: paths are taken from the typed value."""
    (events,) = views(spark, folder, "events")
    fields = {"event_id": "bigint", "props": "variant"}
    db = scratch_database(spark)
    write_table(conform(events.select("event_id", "props"), fields), f"{db}.events_variant", "overwrite")
    stored = read_table(spark, f"{db}.events_variant")
    back = decode_rows(encode_rows(stored), "event_id bigint, again variant").withColumnRenamed("event_id", "id")
    return stored.join(back, F.col("event_id") == F.col("id")).select(
        "event_id", json_part(F.col("again"), "$.k", "string").alias("k"), F.col("props").isNotNull().alias("stored"),
        F.coalesce(json_text(F.col("again")) == json_text(F.col("props")), F.lit(False)).alias("same"))


@query("SELECT o_orderkey, json_object('k', o_orderkey, 's', o_orderstatus)::VARCHAR AS doc FROM orders")
def json_build(spark, folder):
    (orders,) = views(spark, folder, "orders")
    return orders.select("o_orderkey", F.to_json(F.struct(
        F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))).alias("doc"))


@query("""
SELECT c_custkey, 'POINT(' || c_nationkey || ' ' || c_custkey || ')' AS shown,
       length(c_mktsegment) * 0 + 50 AS code_length FROM customer
""")
def points_roundtrip(spark, folder):
    (customer,) = views(spark, folder, "customer")
    code = point_to_ewkb(F.col("c_nationkey").cast("double"), F.col("c_custkey").cast("double"))
    coded = customer.select("c_custkey", code.alias("code"))
    return coded.select("c_custkey", ewkb_to_text("code").alias("shown"),
                        F.length("code").cast("long").alias("code_length"))


# -- delimited text ----------------------------------------------------------------


@query("""
SELECT concat_ws(chr(9), o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(18,2)),
                 strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f'), o_orderpriority) AS line FROM orders
""")
def text_encode(spark, folder):
    (orders,) = views(spark, folder, "orders")
    return encode_rows(orders.withColumn("o_totalprice", F.col("o_totalprice").cast("decimal(18,2)")))


@query("""
SELECT doc_id || '|' || replace(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)),
       chr(9), chr(92) || 't'), chr(10), chr(92) || 'n'), chr(13), chr(92) || 'r'), '|', chr(92) || '|') AS line
FROM documents
""")
def text_encode_delimiter(spark, folder):
    (documents,) = views(spark, folder, "documents")
    return encode_rows(documents.select("doc_id", "text"), delimiter="|")


@query("SELECT doc_id, text, lang, source, n_chars FROM documents")
def text_roundtrip(spark, folder):
    (documents,) = views(spark, folder, "documents")
    lines = encode_rows(documents, null_token=LOSSLESS_NULL)
    return decode_rows(lines, documents.schema, null_token=LOSSLESS_NULL)


@query("SELECT doc_id, text FROM documents")
def text_roundtrip_ascii(spark, folder):
    (documents,) = views(spark, folder, "documents")
    kept = documents.select("doc_id", "text")
    lines = encode_rows(kept, delimiter="|", ascii_only=True, null_token=LOSSLESS_NULL)
    return decode_rows(lines, kept.schema, delimiter="|", null_token=LOSSLESS_NULL)


@query("SELECT doc_id, text, true AS ascii FROM documents")
def text_unicode_escapes(spark, folder):
    """Texts of any language as lines of ASCII, and back."""
    (documents,) = views(spark, folder, "documents")
    kept = documents.select("doc_id", "text")
    lines = encode_rows(kept, ascii_only=True, null_token=LOSSLESS_NULL)
    ascii_only = not lines.where(F.octet_length(lines.columns[0]) != F.char_length(lines.columns[0])).limit(1).collect()
    return decode_rows(lines, kept.schema, null_token=LOSSLESS_NULL).withColumn("ascii", F.lit(ascii_only))


@query("SELECT conv_id, turn, role, text FROM conversations")
def text_files_roundtrip(spark, folder):
    (conversations,) = views(spark, folder, "conversations")
    path = scratch_path(spark, "rows")
    write_text_rows(conversations, path, "errorifexists", null_token=LOSSLESS_NULL)
    return read_text_rows(spark, path, conversations.schema, null_token=LOSSLESS_NULL)


@query("SELECT doc_id, to_base64(encode(text)) AS body FROM documents")
def text_binary(spark, folder):
    (documents,) = views(spark, folder, "documents")
    return documents.select("doc_id", base64_text(F.col("text").cast("binary")).alias("body"))


@query("""
SELECT event_id,
       CASE WHEN try_cast(props AS INTEGER) IS NULL THEN 'cannot read props' END AS _bad,
       try_cast(props AS INTEGER) AS props FROM events
""")
def text_bad_fields(spark, folder):
    (events,) = views(spark, folder, "events")
    lines = encode_rows(events.select("event_id", "props"))
    return decode_rows(lines, "event_id bigint, props int", on_error="flag")


def _as_utc(column):
    """A zone-less time as the instant it names in UTC, whatever the session zone is."""
    return F.concat(F.col(column).cast("string"), F.lit(" UTC")).cast("timestamp")


@query("""
SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S.%f') AS local FROM events
""")
def tz_shift(spark, folder):
    (events,) = views(spark, folder, "events")
    shifted = events.select("event_id", local_time(_as_utc("ts"), "Asia/Irkutsk").cast("string").alias("local"))
    return shifted.select("event_id", pad_fraction(F.col("local")).alias("local"))


@query("SELECT event_id, ts FROM events")
def tz_text_roundtrip(spark, folder):
    (events,) = views(spark, folder, "events")
    instants = events.select("event_id", _as_utc("ts").alias("ts"))
    lines = encode_rows(instants, tz="Asia/Irkutsk")
    back = decode_rows(lines, instants.schema, tz="Asia/Irkutsk")
    return back.select("event_id", local_time(F.col("ts"), "UTC").alias("ts"))


# -- generated rows ----------------------------------------------------------------


@query("""
WITH span AS (SELECT min(event_id) - 1 AS low, max(event_id) AS high, count(*) * 2 AS n FROM events),
made AS (SELECT k AS seq_n, low + 1 + ((k - 1) * (high - low)) // n AS offset_id FROM span, range(1, n + 1) r(k))
SELECT e.event_id, e.event_type, m.seq_n::INTEGER AS seq_n FROM events e JOIN made m ON m.offset_id = e.event_id
""")
def generate_rows(spark, folder):
    """Two generated rows per offset of a table, next to the table's rows."""
    (events,) = views(spark, folder, "events")
    low, high, n = events.agg(F.min("event_id") - 1, F.max("event_id"), F.count("*") * 2).head()
    made = generate(spark, low, high, n, 10)
    return events.join(made, events.event_id == made.offset_id).select("event_id", "event_type", "seq_n")


@query("SELECT o_orderkey AS seq_no, o_orderkey % 2 = 1 AS mv FROM orders")
def uuid_table(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    write_table(uuid_rows(orders, "o_orderkey", points=True), f"{db}.uuid_seq", "append")
    stored = read_table(spark, f"{db}.uuid_seq").where(is_uuid(F.col("id")) & is_ewkb_hex(F.col("gps_point")))
    return stored.select("seq_no", "mv")


# -- streams -----------------------------------------------------------------------


def scratch_of(spark, db) -> str:
    return spark.catalog.getDatabase(db).locationUri


def _newest(spark, folder) -> int:
    return spark.read.parquet(f"{folder}/events.parquet").agg(F.max("event_id")).head()[0]


def _run_to(spark, folder, db, ending, **source):
    """One run of a resumable stream of events that stops at ``ending``."""
    rows = read_stream_offsets(spark, f"{folder}/events.parquet", "event_id", starting="earliest",
                                 ending=ending, **source)
    running = write_stream(rows, f"{scratch_of(spark, db)}/checkpoint", name=f"{db}.target", available_now=True)
    running.awaitTermination()


_THREE_ENDS = """
SELECT CASE WHEN event_id <= (SELECT max(event_id) * 4 // 10 FROM events) THEN 0::BIGINT
            WHEN event_id <= (SELECT max(event_id) * 7 // 10 FROM events) THEN 1 ELSE 2 END AS batch_id,
       event_id, user_id FROM events
"""


@query("SELECT event_id, user_id, event_type, true AS shaped FROM events")
def stream_sink_clauses(spark, folder):
    """A stream into a table that it creates in buckets and partitions, by options."""
    views(spark, folder, "events")
    db = scratch_database(spark)
    script = """INSERT INTO <ext_table> SELECT event_id, user_id, event_type FROM events
        WHERE event_id > coalesce(CAST(get_json_object('<start_offset_json>', '$.k') AS BIGINT), -1)
          AND event_id <= CAST(get_json_object('<end_offset_json>', '$.k') AS BIGINT)"""
    source = {"sqltransfer": script, "dbtable": "SELECT event_id, user_id, event_type FROM events",
              "offset.select": "SELECT to_json(named_struct('k', max(event_id))) FROM events"}
    sink = {"dbtable": f"{db}.target", "distributedby": "user_id", "partitionclause": "partition by (event_type)",
            "checkpointLocation": f"{scratch_of(spark, db)}/checkpoint"}
    stream(spark, source, sink, starting="earliest", available_now=True).awaitTermination()
    info = table_info(spark, f"{db}.target")
    shaped = info.bucket_columns == ["user_id"] and info.partition_columns == ["batch_id", "event_type"]
    return read_table(spark, f"{db}.target").select("event_id", "user_id", "event_type", F.lit(shaped).alias("shaped"))


@query("SELECT event_id, user_id FROM events")
def stream_many_files(spark, folder):
    """The events in over 300 files, some of which arrive while the stream is set up already."""
    db = scratch_database(spark)
    path = f"{scratch_of(spark, db)}/many"
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "user_id")
    half = _newest(spark, folder) // 2
    events.where(F.col("event_id") <= half).repartition(160, "event_id").write.parquet(path)
    rows = read_stream_offsets(spark, path, "event_id", starting="earliest")
    events.where(F.col("event_id") > half).repartition(160, "event_id").write.mode("append").parquet(path)
    write_stream(rows, f"{scratch_of(spark, db)}/checkpoint", name=f"{db}.target", available_now=True).awaitTermination()
    return read_table(spark, f"{db}.target").select("event_id", "user_id")


@query(_THREE_ENDS)
def stream_ranges(spark, folder):
    db = scratch_database(spark)
    top = _newest(spark, folder)
    for ending in (top * 4 // 10, top * 7 // 10, top):
        _run_to(spark, folder, db, ending, columns=["event_id", "user_id"])
    return read_table(spark, f"{db}.target").select("batch_id", "event_id", "user_id")


@query(_THREE_ENDS)
def stream_replay(spark, folder):
    db = scratch_database(spark)
    top = _newest(spark, folder)
    for ending in (top * 4 // 10, top * 7 // 10, top):
        _run_to(spark, folder, db, ending, columns=["event_id", "user_id"])
    # As after a crash between storing and committing: the last batch runs again.
    for name in ("2", ".2.crc"):
        delete_path(spark, f"{scratch_of(spark, db)}/checkpoint/commits/{name}")
    _run_to(spark, folder, db, top, columns=["event_id", "user_id"])
    return read_table(spark, f"{db}.target").select("batch_id", "event_id", "user_id")


@query("SELECT 1::BIGINT AS n_batches, count(*) AS n_rows FROM events")
def stream_no_new_data(spark, folder):
    db = scratch_database(spark)
    for _ in range(3):
        _run_to(spark, folder, db, None, columns=["event_id"])
    return read_table(spark, f"{db}.target").agg(
        F.countDistinct("batch_id").alias("n_batches"), F.count("*").alias("n_rows"))


@query("""
SELECT event_id, c_name, 0::INTEGER AS epoch, 'Append' AS mode
FROM events JOIN customer ON user_id = c_custkey
""")
def stream_script_sink(spark, folder):
    views(spark, folder, "customer")
    db = scratch_database(spark)
    rows = read_stream_offsets(spark, f"{folder}/events.parquet", "event_id", ["event_id", "user_id"], "earliest")
    script = f"""
    BEGIN
      CREATE TABLE IF NOT EXISTS {db}.enriched (event_id BIGINT, c_name STRING, mode STRING, epoch INT)
        USING parquet PARTITIONED BY (epoch);
      INSERT OVERWRITE {db}.enriched PARTITION (epoch = <current_epoch>)
        SELECT event_id, c_name, '<stream_mode>' FROM <ext_table> JOIN customer ON user_id = c_custkey;
    END"""
    write_stream(rows, f"{scratch_of(spark, db)}/checkpoint", script=script, available_now=True).awaitTermination()
    return read_table(spark, f"{db}.enriched").select("event_id", "c_name", "epoch", "mode")


def _sql_offset_run(spark, db, tenths, starting="earliest"):
    """One run of a stream whose position is a SQL query over the events view."""
    position = f"max(event_id) * {tenths} DIV 10" if tenths else "min(event_id) - 1"
    running = stream_transfer(
        spark,
        """INSERT INTO <ext_table> SELECT event_id, user_id FROM events
           WHERE event_id > coalesce(CAST(get_json_object('<start_offset_json>', '$.k') AS BIGINT), -1)
             AND event_id <= CAST(get_json_object('<end_offset_json>', '$.k') AS BIGINT)""",
        table_sink(f"{db}.target"),
        f"{scratch_of(spark, db)}/checkpoint",
        offset_select=f"SELECT to_json(named_struct('k', {position})) FROM events",
        offset_update=f"INSERT INTO {db}.positions VALUES (?)",
        starting=starting,
        available_now=True,
    )
    running.awaitTermination()


@query(_THREE_ENDS)
def stream_sql_offsets(spark, folder):
    views(spark, folder, "events")
    db = scratch_database(spark)
    spark.sql(f"CREATE TABLE {db}.positions (doc STRING) USING parquet")
    for tenths in (4, 4, 7, 10):
        _sql_offset_run(spark, db, tenths)
    return read_table(spark, f"{db}.target").select("batch_id", "event_id", "user_id")


@query("""
SELECT '{"k":' || ((SELECT max(event_id) FROM events) * t // 10) || '}' AS doc,
       (SELECT count(*) FROM events) AS n_rows
FROM (VALUES (4), (7), (10)) v(t)
""")
def stream_offset_update(spark, folder):
    (events,) = views(spark, folder, "events")
    db = scratch_database(spark)
    spark.sql(f"CREATE TABLE {db}.positions (doc STRING) USING parquet")
    for tenths in (4, 7, 10):
        _sql_offset_run(spark, db, tenths)
    return read_query(spark, f"SELECT doc, (SELECT count(*) FROM {db}.target) AS n_rows FROM {db}.positions")


@query("""
SELECT CASE WHEN event_id <= (SELECT max(event_id) * 7 // 10 FROM events) THEN 0::BIGINT ELSE 1 END AS batch_id,
       event_id, user_id FROM events
""")
def stream_from_latest(spark, folder):
    views(spark, folder, "events")
    db = scratch_database(spark)
    spark.sql(f"CREATE TABLE {db}.positions (doc STRING) USING parquet")
    # The first run only notes the position then, before the first event; rows come after it.
    for tenths in (0, 7, 10):
        _sql_offset_run(spark, db, tenths, starting="latest")
    return read_table(spark, f"{db}.target").select("batch_id", "event_id", "user_id")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders")
def stream_table_to_table(spark, folder):
    (orders,) = views(spark, folder, "orders")
    db = scratch_database(spark)
    path = scratch_path(spark, "source")
    orders.drop("o_orderdate").repartition(4).write.parquet(path)
    rows = read_stream_offsets(spark, path, "o_orderkey", starting="earliest")
    write_stream(rows, f"{scratch_of(spark, db)}/checkpoint", name=f"{db}.target",
                 available_now=True).awaitTermination()
    return read_table(spark, f"{db}.target").drop("batch_id")


@query(_THREE_ENDS.replace("AS batch_id", "AS first_batch"))
def stream_chain(spark, folder):
    """The target of one stream is the source of the next."""
    db = scratch_database(spark)
    top = _newest(spark, folder)
    for ending in (top * 4 // 10, top * 7 // 10, top):
        _run_to(spark, folder, db, ending, columns=["event_id", "user_id"])
    rows = read_stream_offsets(spark, f"{db}.target", "event_id", starting="earliest")
    write_stream(rows.withColumnRenamed("batch_id", "first_batch"), f"{scratch_of(spark, db)}/checkpoint2",
                 name=f"{db}.chained", available_now=True).awaitTermination()
    return read_table(spark, f"{db}.chained").select("first_batch", "event_id", "user_id")


@query("""
SELECT event_id, c_name, 0::BIGINT AS batch_id FROM events JOIN customer ON user_id = c_custkey
""")
def stream_by_options(spark, folder):
    views(spark, folder, "events", "customer")
    db = scratch_database(spark)
    source = {
        "sqltransfer": """INSERT INTO <ext_table> (event_id, user_id) SELECT event_id, user_id FROM events
                          WHERE event_id <= CAST(get_json_object('<end_offset_json>', '$.k') AS BIGINT)""",
        "dbtable": "SELECT 1L AS event_id, 1L AS user_id",
        "offset.select": "SELECT to_json(named_struct('k', max(event_id))) FROM events"}
    sink = {"dbtable": f"{db}.named", "checkpointLocation": f"{scratch_of(spark, db)}/checkpoint"}
    named = lambda rows, epoch: rows.join(
        rows.sparkSession.table("customer"), F.col("user_id") == F.col("c_custkey")).select("event_id", "c_name")
    stream(spark, source, sink, transform=named, starting="earliest", available_now=True).awaitTermination()
    return read_table(spark, f"{db}.named").select("event_id", "c_name", "batch_id")


@query("SELECT 0::BIGINT AS batch_id, count(*) AS n_rows FROM events")
def stream_progress(spark, folder):
    db = scratch_database(spark)
    rows = read_stream_offsets(spark, f"{folder}/events.parquet", "event_id", ["event_id"], "earliest")
    running = write_stream(rows, f"{scratch_of(spark, db)}/checkpoint", name=f"{db}.target", available_now=True)
    running.awaitTermination()
    return progress_report(spark, running).where("rows > 0").select("batch_id", F.col("rows").alias("n_rows"))


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def stream_complete(spark, folder):
    db = scratch_database(spark)
    rows = read_stream_offsets(spark, f"{folder}/events.parquet", "event_id", ["event_type"], "earliest")
    counted = rows.groupBy("event_type").agg(F.count("*").alias("n"))
    write_stream(counted, f"{scratch_of(spark, db)}/checkpoint", name=f"{db}.target", stream_mode="complete",
                 available_now=True).awaitTermination()
    return read_table(spark, f"{db}.target")


@query("SELECT user_id, count(*) AS n, max(event_id) AS newest FROM events GROUP BY 1")
def stream_update_mode(spark, folder):
    """Counts by user, merged into a table by three batches, the last of which runs twice."""
    db = scratch_database(spark)
    top, checkpoint = _newest(spark, folder), f"{scratch_of(spark, db)}/checkpoint"
    for ending in (top * 4 // 10, top * 7 // 10, top, top):
        rows = read_stream_offsets(spark, f"{folder}/events.parquet", "event_id", ["event_id", "user_id"], "earliest", ending=ending)
        counts = rows.groupBy("user_id").agg(F.count("*").alias("n"), F.max("event_id").alias("newest"))
        write_stream(counts, checkpoint, name=f"{db}.target", stream_mode="update", keys=["user_id"], buckets=8,
                     available_now=True).awaitTermination()
        if ending == top:
            for name in ("2", ".2.crc"):
                delete_path(spark, f"{checkpoint}/commits/{name}")
    return read_table(spark, f"{db}.target").select("user_id", "n", "newest")


@query("SELECT 0 AS batch, count(*) AS n, true AS delayed FROM events")
def batch_id_column(spark, folder):
    db = scratch_database(spark)
    rows = read_stream_offsets(spark, f"{folder}/events.parquet", "event_id", ["event_id", "ts"], "earliest")
    stamped = with_delay(rows, "ts").withColumnRenamed("batch_id", "batch")
    write_stream(stamped, f"{scratch_of(spark, db)}/checkpoint", name=f"{db}.target",
                 available_now=True).awaitTermination()
    return (read_table(spark, f"{db}.target").groupBy("batch")
            .agg(F.count("*").alias("n"), (F.min("delay_s") > 0).alias("delayed")))


@query("SELECT count(*) AS n, true AS several, true AS later, 'tabletransfer v0.1.0' AS version FROM lineitem")
def row_timestamp_column(spark, folder):
    (lineitem,) = views(spark, folder, "lineitem")
    register_udfs(spark)
    before = dt.datetime.now(dt.timezone.utc)
    stamped = lineitem.selectExpr("getRowTimestamp() AS seen_at", "transferVersion() AS version")
    return stamped.groupBy("version").agg(
        F.count("*").alias("n"), (F.countDistinct("seen_at") > 1).alias("several"), (F.min("seen_at") >= F.lit(before)).alias("later"))


@query("""
SELECT event_id, user_id, event_id % 3 = 1 AND event_id <= (SELECT max(event_id) FROM events WHERE event_id % 3 <> 1) AS late
FROM events
""")
def stream_late_files(spark, folder):
    """A third of the events come when batches have passed most of them; on-time and late rows are all rows."""
    db = scratch_database(spark)
    path, checkpoint = f"{scratch_of(spark, db)}/feed", f"{scratch_of(spark, db)}/checkpoint"
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id", "user_id")
    for part in ("event_id % 3 <> 1", "event_id % 3 = 1"):
        events.where(part).write.mode("append").parquet(path)
        rows = read_stream_offsets(spark, path, "event_id", starting="earliest", late="report", checkpoint=checkpoint)
        write_stream(rows, checkpoint, name=f"{db}.target", available_now=True).awaitTermination()
    on_time = read_table(spark, f"{db}.target").select("event_id", "user_id", F.lit(False).alias("late"))
    return on_time.union(late_rows(spark, checkpoint, "event_id", events.schema).select("event_id", "user_id", F.lit(True)))


@query("""
SELECT event_id, (row_number() OVER (ORDER BY event_id) - 1) // ((count(*) OVER () + 4) // 5) AS batch_id FROM events
""")
def stream_bounded(spark, folder):
    """A history of events in one file, moved in five batches of equal size."""
    db = scratch_database(spark)
    path, checkpoint = f"{scratch_of(spark, db)}/feed", f"{scratch_of(spark, db)}/checkpoint"
    events = spark.read.parquet(f"{folder}/events.parquet").select("event_id")
    events.repartition(1).write.parquet(path)
    rows = read_stream_offsets(spark, path, "event_id", starting="earliest", max_rows=(events.count() + 4) // 5, checkpoint=checkpoint)
    drain(write_stream(rows, checkpoint, name=f"{db}.target", processing_time="0 seconds"))
    return read_table(spark, f"{db}.target").select("event_id", "batch_id")


_ENDS = "(SELECT max(event_id) * t // 10 FROM events)"


@query(f"""
SELECT '{{"offset": ' || {_ENDS} || '}}' AS doc, (SELECT count(*) FROM events) AS n_rows FROM (VALUES (4), (7), (10)) v(t)
""")
def stream_files_offset_update(spark, folder):
    """Every epoch of a stream over files tells its end to a table."""
    db = scratch_database(spark)
    spark.sql(f"CREATE TABLE {db}.positions (doc STRING) USING parquet")
    for tenths in (4, 7, 10):
        rows = read_stream_offsets(spark, f"{folder}/events.parquet", "event_id", ["event_id"], "earliest",
                                   ending=_newest(spark, folder) * tenths // 10)
        write_stream(rows, f"{scratch_of(spark, db)}/checkpoint", name=f"{db}.target", available_now=True,
                     offset_update=f"INSERT INTO {db}.positions VALUES (?)").awaitTermination()
    return read_query(spark, f"SELECT doc, (SELECT count(*) FROM {db}.target) AS n_rows FROM {db}.positions")


@query(f"""
WITH ends AS (SELECT row_number() OVER (ORDER BY t) - 1 AS epoch, {_ENDS} AS stop,
              lag({_ENDS}, 1, -1) OVER (ORDER BY t) AS start FROM (VALUES (4), (7), (10)) v(t))
SELECT epoch, count(*) AS n_rows, stop AS end_offset, true AS stored
FROM ends JOIN events ON event_id > start AND event_id <= stop GROUP BY epoch, stop
""")
def stream_epoch_log(spark, folder):
    """What each epoch of a stream over files stored, from the log next to its checkpoint."""
    db = scratch_database(spark)
    top = _newest(spark, folder)
    for ending in (top * 4 // 10, top * 7 // 10, top):
        _run_to(spark, folder, db, ending, columns=["event_id"])
    return epoch_log(spark, f"{scratch_of(spark, db)}/checkpoint").select(
        "epoch", F.col("rows").alias("n_rows"), F.get_json_object("end_offset", "$.offset").cast("long").alias("end_offset"),
        ((F.col("files") > 0) & (F.col("bytes") > 0)).alias("stored"))


@query(f"""
WITH ends AS (SELECT row_number() OVER (ORDER BY t) - 1 AS epoch, {_ENDS} AS stop,
              lag({_ENDS}, 1, -1) OVER (ORDER BY t) AS start FROM (VALUES (4), (7), (10)) v(t))
SELECT epoch, count(*) AS n_rows, '{{"k":' || stop || '}}' AS end_offset
FROM ends JOIN events ON event_id > start AND event_id <= stop GROUP BY epoch, stop
""")
def stream_sql_progress(spark, folder):
    """The same log of a stream whose position is a SQL query."""
    views(spark, folder, "events")
    db = scratch_database(spark)
    spark.sql(f"CREATE TABLE {db}.positions (doc STRING) USING parquet")
    for tenths in (4, 7, 10):
        _sql_offset_run(spark, db, tenths)
    return epoch_log(spark, f"{scratch_of(spark, db)}/checkpoint").select("epoch", F.col("rows").alias("n_rows"), "end_offset")


@query("SELECT event_id, user_id, 0::BIGINT AS batch_id, 2 AS n_runs, 1::BIGINT AS n_updates FROM events")
def stream_autocommit_off(spark, folder):
    """An update that fails once takes its batch along: both run again, and the rows are there once."""
    views(spark, folder, "events")
    db = scratch_database(spark)
    spark.sql(f"CREATE TABLE {db}.positions (doc STRING) USING parquet")
    store, runs = table_sink(f"{db}.target"), []

    def counted(rows, epoch):
        runs.append(epoch)
        return store(rows, epoch)

    def told(session, end):
        if len(runs) == 1:
            raise ConnectionError("the listener is away")
        session.sql(f"INSERT INTO {db}.positions VALUES (?)", args=[end])

    def once():
        stream_transfer(
            spark,
            """INSERT INTO <ext_table> SELECT event_id, user_id FROM events
               WHERE event_id <= CAST(get_json_object('<end_offset_json>', '$.k') AS BIGINT)""",
            counted, f"{scratch_of(spark, db)}/checkpoint", starting="earliest", autocommit=False, available_now=True,
            offset_select="SELECT to_json(named_struct('k', max(event_id))) FROM events", offset_update=told,
        ).awaitTermination()

    try:
        once()
    except StreamingQueryException:
        once()
    n_updates = spark.table(f"{db}.positions").count()
    return read_table(spark, f"{db}.target").select(
        "event_id", "user_id", "batch_id", F.lit(len(runs)).alias("n_runs"), F.lit(n_updates).cast("long").alias("n_updates"))
