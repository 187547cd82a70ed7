"""Time the headline transfers. Prints one JSON line.

Every transfer runs ``RUNS`` times and the best time counts, as in a long-running
application: compiling the JVM's code and starting Python workers are not part of it.
``first_run`` has the time of the first run, which includes them.

BENCH_SF_DIR: folder with the tables (default /root/testdata/sf0.1)
BENCH_CPUS:   local cores (default 8)
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession, functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from tabletransfer.operators.textrows import decode_rows, encode_rows, read_text_rows, write_text_rows  # noqa: E402
from tabletransfer.plans.filters import gt  # noqa: E402
from tabletransfer.plans.scripts import read_transfer, write_transfer  # noqa: E402
from tabletransfer.session import configure, path_usage, scratch_database, scratch_path  # noqa: E402
from tabletransfer.sinks.tables import write_table  # noqa: E402
from tabletransfer.sources.generator import generate  # noqa: E402
from tabletransfer.sources.tables import read_parallel, read_table  # noqa: E402
from tabletransfer.streaming.ledger import stream_transfer  # noqa: E402
from tabletransfer.streaming.progress import with_delay  # noqa: E402
from tabletransfer.streaming.sink import table_sink, write_stream  # noqa: E402
from tabletransfer.streaming.source import read_stream_offsets  # noqa: E402


RUNS = 5


def drain(df):
    """Compute every row and column without keeping them."""
    df.write.format("noop").mode("overwrite").save()


def text_bytes_of(lines):
    """How many bytes the encoded lines have; computed when asked for."""
    return lambda: lines.agg(F.sum(F.octet_length("line") + 1)).head()[0]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    db = scratch_database(spark, "bench")
    lineitem = spark.read.parquet(f"{folder}/lineitem.parquet")
    lineitem.createOrReplaceTempView("lineitem")
    for name in ("orders", "customer", "events"):
        spark.read.parquet(f"{folder}/{name}.parquet").createOrReplaceTempView(name)
    n = lineitem.count()
    n_events = spark.table("events").count()
    n_orders = spark.table("orders").count()
    texts = scratch_path(spark, "bench_documents")
    spark.read.parquet(f"{folder}/documents.parquet").repartition(int(cpus)).write.parquet(texts)
    documents = spark.read.parquet(texts)
    n_documents = documents.count()

    # A stored copy in as many files as cores, as a transferred table would be.
    source = scratch_path(spark, "bench_rows")
    lineitem.repartition(int(cpus)).write.parquet(source)
    stored = spark.read.parquet(source)
    lines = scratch_path(spark, "bench_lines")
    times: dict[str, float] = {}
    first: dict[str, float] = {}
    rows: dict[str, int] = {}
    mbytes: dict[str, float] = {}

    def measure(name, count, action, size=None):
        spent = []
        for turn in range(RUNS):
            started = time.perf_counter()
            action(turn)
            spent.append(round(time.perf_counter() - started, 3))
        times[name], first[name], rows[name] = min(spent), spent[0], count
        if size:
            mbytes[name] = size() / 1e6

    def text_bytes():
        return path_usage(spark, f"{lines}_0")[1]

    measure("text_encode", n, lambda _: drain(encode_rows(stored)), text_bytes_of(encode_rows(stored)))
    measure("text_write", n, lambda i: write_text_rows(stored, f"{lines}_{i}", "errorifexists"), text_bytes)
    measure("text_read", n, lambda _: drain(read_text_rows(spark, f"{lines}_0", stored.schema)), text_bytes)
    measure("large_rows_text", n_documents, lambda _: drain(
        decode_rows(encode_rows(documents), documents.schema)), text_bytes_of(encode_rows(documents)))
    measure("large_rows_write", n_documents, lambda _: write_table(documents, f"{db}.d", "overwrite"),
            text_bytes_of(encode_rows(documents)))
    measure("write_append", n, lambda _: write_table(stored, f"{db}.t", "append"))
    measure("write_overwrite", n, lambda _: write_table(stored, f"{db}.t", "overwrite"))
    measure("write_truncate", n, lambda _: write_table(stored, f"{db}.t", "overwrite", truncate=True))
    measure("write_distributed", n, lambda _: write_table(
        stored, f"{db}.b", "overwrite", distributed_by="l_orderkey", buckets=int(cpus)))
    measure("write_partitioned", n, lambda _: write_table(
        stored, f"{db}.p", "overwrite", partition_by=["l_returnflag", "l_linestatus"]))
    measure("parallel_read", n, lambda _: drain(read_parallel(read_table(spark, f"{db}.t"), int(cpus))))
    measure("filtered_read", n, lambda _: drain(
        read_table(spark, f"{db}.t", columns=["l_orderkey", "l_quantity"], filters=gt("l_quantity", 25))))
    measure("script_read", n, lambda _: drain(read_transfer(spark, """
        INSERT INTO <ext_table> SELECT o_custkey, count(*) n, sum(l_extendedprice) total
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE <pushed_filters> GROUP BY 1""")))
    measure("script_write", n_orders, lambda i: write_transfer(spark.table("orders"), f"""
        CREATE TABLE {db}.enriched_{i} USING parquet AS
        SELECT o.*, c_name FROM <ext_table> o JOIN customer ON o_custkey = c_custkey"""))

    def table_to_table(turn):
        df = read_stream_offsets(spark, f"{folder}/events.parquet", "event_id", starting="earliest")
        write_stream(df, scratch_path(spark, "bench_ckpt"), name=f"{db}.events_copy_{turn}",
                     available_now=True).awaitTermination()

    measure("stream_table_to_table", n_events, table_to_table)

    def generated(count, payload):
        """One micro-batch of generated rows, each stamped, into a table."""

        def run(turn):
            source = lambda session, start, end, epoch: with_delay(
                generate(session, 0, 10, count, payload)).drop("batch_id")
            stream_transfer(
                spark, source, table_sink(f"{db}.generated_{payload}_{turn}"), scratch_path(spark, "bench_ckpt"),
                offset_select="SELECT '{\"offset_ts\":10}'", starting="earliest",
                available_now=True).awaitTermination()

        return run

    measure("stream_large_rows", 2_000, generated(2_000, 100_000), lambda: 2_000 * 100_000)
    measure("stream_short_rows", 200_000, generated(200_000, 10))
    spark.stop()
    print(json.dumps({
        "metric": "table transfer, sum of all transfers",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "first_run": first,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "cpus": int(cpus),
        "rows_per_sec": {k: int(rows[k] / t) for k, t in times.items()},
        "text_mb_per_sec": {k: round(v / times[k], 1) for k, v in mbytes.items()},
    }))


if __name__ == "__main__":
    main()
