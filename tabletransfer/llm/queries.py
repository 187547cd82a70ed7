"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tabletransfer.llm.bestfit import pack_matrix
from tabletransfer.llm.bpe import round_trip_digests
from tabletransfer.llm.centroids import clusters, clusters_sql
from tabletransfer.llm.decontaminate import contamination
from tabletransfer.llm.divergence import DIVERGENCE_SQL, divergence
from tabletransfer.llm.hamming import search
from tabletransfer.llm.language import languages
from tabletransfer.llm.minhash import near_duplicates
from tabletransfer.llm.mixture import pack
from tabletransfer.llm.quality import quality_scores
from tabletransfer.llm.repeats import repeats
from tabletransfer.llm.rollups import maintained
from tabletransfer.llm.shared import new_path
from tabletransfer.llm.warc import round_trip


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_matrix(_table(spark, sf_dir, "documents"))


def op4_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_table(spark, sf_dir, "documents"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(_table(spark, sf_dir, "documents"))


def op6_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats(_table(spark, sf_dir, "documents"))


def op7_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return maintained(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), new_path(spark, "rollup"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(_table(spark, sf_dir, "pages"), new_path(spark, "warc"))


def op10_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(_table(spark, sf_dir, "embeddings"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence(_table(spark, sf_dir, "documents"))


def op13_prefix_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip_digests(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_minhash, op2_decontamination, op3_bestfit_packing, op4_mixture_packing, op5_language, op6_repeats, op7_rollups,
    op8_quality, op9_warc, op10_multi_index_hashing, op11_centroids, op12_divergence,
    op13_prefix_bpe)}
ORACLES: dict[str, str] = {"op11_centroids": clusters_sql(), "op12_divergence": DIVERGENCE_SQL}
