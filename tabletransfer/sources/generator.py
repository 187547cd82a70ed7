"""Generated rows, as Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabletransfer.functions.points import point_to_ewkb


def generate(spark: SparkSession, start: int, end: int, rows: int, payload: int) -> DataFrame:
    """``rows`` rows whose offsets spread evenly over the range after ``start`` up to ``end``.

    Columns: ``id, seq_n, gen_ts, offset_id, payload``. ``seq_n`` counts from 1 within the range, and
    ids of ranges that follow each other do not meet. No rows when the range is empty.
    """
    span = max(end - start, 0)
    numbers = spark.range(1, rows + 1 if span else 1).withColumnRenamed("id", "seq")
    return numbers.select(
        F.concat_ws("-", F.lit(start), F.lit(end), "seq").alias("id"),
        F.col("seq").cast("int").alias("seq_n"),
        F.current_timestamp().alias("gen_ts"),
        F.expr(f"{start + 1}L + ((seq - 1) * {span}L) div {max(rows, 1)}L").alias("offset_id"),
        F.repeat(F.lit("0"), payload).alias("payload"),
    )


def uuid_rows(keys: DataFrame, key: str, points: bool = False, seed: int = 0) -> DataFrame:
    """A row for each row of ``keys``: ``id`` (random UUID), ``seq_no`` (its key), ``created_d``, ``mv`` (whether the
    key is odd) and, on request, ``gps_point``."""
    # Fixed names: the columns of the fixture tables.
    df = keys.select(
        F.uuid().alias("id"),
        F.col(key).cast("int").alias("seq_no"),
        F.current_timestamp().alias("created_d"),
        (F.pmod(F.col(key), F.lit(2)) == 1).alias("mv"),
    )
    if points:
        x = F.floor(F.rand(seed) * 51).cast("double")
        y = F.floor(F.rand(seed + 1) * 51).cast("double")
        df = df.withColumn("gps_point", point_to_ewkb(x, y))
    return df
