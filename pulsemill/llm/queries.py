"""The corpus queries: opN_<name>(spark, sf_dir), each over its whole table, and DuckDB SQL where SQL can express the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import stages
from .common import cut
from .filter_audit import AUDIT_SQL, audit_filters
from .lm_scoring import score_texts
from .mixing import mix_sources, mixing_sql
from .near_dedup import near_duplicates
from .packing import pack
from .periodic_runs import planted, run_digests
from .personal_data import personal_digests
from .quality_rules import QUALITY_SQL, quality_rules
from .secret_scan import secret_digests
from .simhash import simhash_groups
from .substring_dedup import remove_repeats
from .toxicity import score_toxicity
from .webp_columns import read_media, to_media


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir), shingle=3, threshold_pct=85)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir))


def op3_toxicity_knn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_digests(documents(spark, sf_dir))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_digests(documents(spark, sf_dir))


def op6_webp_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_media(cut(to_media(documents(spark, sf_dir))), keep_pixels=False)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir))


def op9_pack_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(documents(spark, sf_dir))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_filters(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op12_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(documents(spark, sf_dir), shingle=3)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(planted(documents(spark, sf_dir)))


QUERIES = {f.__name__: f for f in (op1_minhash_near_dedup, op2_mix_sources, op3_toxicity_knn, op4_personal_data, op5_secret_scan, op6_webp_columns, op7_quality_rules, op8_substring_dedup, op9_pack_buckets, op10_lm_scoring, op11_filter_audit, op12_simhash_near_dedup, op13_periodic_runs)}

QUERIES["pipeline"] = stages.run

ORACLE: dict[str, str] = {"op2_mix_sources": mixing_sql(), "op7_quality_rules": QUALITY_SQL, "op11_filter_audit": AUDIT_SQL}
