"""From raw documents to packed training sequences, stage by stage.

Every stage takes and returns all rows it does not reject. A row whose id is null is judged by its
text like any other, and further columns are handed on; the last stage returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabletransfer.llm.decontaminate import remove_documents
from tabletransfer.llm.minhash import near_duplicates
from tabletransfer.llm.mixture import pack
from tabletransfer.llm.quality import learn, passing
from tabletransfer.llm.repeats import remove_repeats
from tabletransfer.llm.shared import keep, settle


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows whose text the classifier predicts to be of quality 0 go."""
    return passing(docs, learn(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def _marked(rows: DataFrame) -> DataFrame:
    """``_row, id, group, repeated``: what a row is a copy by, its near copies or, without words, its equals."""
    groups = near_duplicates(rows, id_col="_row").select(F.col("doc_id").alias("_row"), "component_id", "n_shingles")
    blank = ~F.coalesce(F.col("text").rlike("[^ \\t-\\r]"), F.lit(False))
    marks = rows.select("_row", F.col("doc_id").cast("long").alias("id"), F.when(blank, F.sha2("text", 256)).alias("blank"))
    # A text without words is in no group; its row is repeated where id and text are equal.
    single = (F.col("n_shingles") == 0) & F.col("id").isNotNull()
    return marks.join(groups, "_row").select(
        "_row", "id", F.when(~single, F.col("component_id")).alias("group"),
        F.when(single, F.struct("id", "blank")).alias("repeated"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, one with the smallest id; only where all ids are null, one
    without. Of repeated rows without words one stays, too. Rows are told apart by a number written once."""
    rows = keep(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")
    marks = settle(lambda: _marked(rows), "marks")
    least = marks.groupBy("group", "repeated").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_row")).alias("least"))
    copies = marks.select("_row").join(least.select("least._row"), "_row", "left_anti")
    return rows.join(copies, "_row", "left_anti").select(*docs.columns)


def repeat_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 200 bytes and more that occur twice are cut out of the texts."""
    return remove_repeats(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of the benchmark go."""
    return remove_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all texts in sequences of 1024 tokens, sources in proportion."""
    return pack(docs)


STAGES = [("quality", quality), ("near_dedup", near_dedup), ("repeat_removal", repeat_removal),
          ("decontamination", decontamination), ("packing", packing)]

#: Nearest neighbours, token ids and the like have no SQL form; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the last stage returns; the tables of each stage go when the next one's result stands."""
    def after(stages: list) -> DataFrame:
        if not stages:
            return spark.read.parquet(f"{sf_dir}/documents.parquet")
        *before, (name, stage) = stages
        return settle(lambda: stage(spark, after(before), sf_dir), name)

    return after(STAGES)
