"""The stages of the corpus pipeline: toxicity, near-duplicates, secrets, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; run() writes each stage's result as
Parquet in the shared checkpoint folder and reads it again for the next. All stages but the last return the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import broadcast_if_small, cut, skew_join
from .mixing import mix_sources
from .near_dedup import near_duplicates
from .packing import pack
from .secret_scan import mask_secrets
from .toxicity import reject_toxic


#: Name of the number that tells rows apart inside a stage.
ROW = "row"


def _numbered(docs: DataFrame) -> DataFrame:
    """row and doc (all columns of docs), written once so that the numbers stay the same for all that reads them."""
    return cut(docs.select(F.monotonically_increasing_id().alias(ROW), F.struct(*docs.columns).alias("doc")))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is under the threshold; all labels of the table are learnt from. Rows are scored one by one, null and repeated ids too."""
    return reject_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group (five-word shingles, similarity 0.8): the one with the smallest id.

    Rows are told apart by a number of their own: rows that share a doc_id stay or go each by its own text, a null doc_id is
    compared like any other and stays only if no row of its group has one. Rows without words stay.
    """
    rows = _numbered(docs)
    groups = near_duplicates(rows.select(F.col(ROW).alias("doc_id"), "doc.text")).select(F.col("doc_id").alias(ROW), "component_id")
    groups = cut(groups.join(rows.select(ROW, F.col("doc.doc_id").alias("id")), ROW))
    # Sums on the map side, so a large group is a row for each task. Groups of one row are not in the table.
    first = groups.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("nameless"), "id", ROW)).alias("first"), F.count("*").alias("rows")).filter("rows > 1")
    first = cut(first.select("component_id", F.col(f"first.{ROW}").alias("first"), "rows"), narrow=True)
    gone = cut(skew_join(groups, first, ["component_id"], "rows").filter(F.col("first") != F.col(ROW)).select(ROW), narrow=True)
    return rows.join(broadcast_if_small(gone, 40), ROW, "left_anti").select("doc.*")


def mask_all_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with each secret replaced by its kind; n_chars follows the text. Rows are masked one by one; null texts stay null."""
    masked = mask_secrets(docs)
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else masked


def sample_mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents sampled so that sources, languages and topics have their target shares of the tokens.

    Each row is drawn on its own cell's probability, also with a null or repeated doc_id. Rows without words go.
    """
    rows = _numbered(docs)
    chosen = cut(mix_sources(rows.select(ROW, "doc.doc_id", "doc.text", "doc.lang", "doc.source"), carried=(ROW,)).filter("sampled").select(ROW), narrow=True)
    return rows.join(broadcast_if_small(chosen, 40), ROW, "left_semi").select("doc.*")


def pack_batches(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each packed sequence: document, piece, length, bucket, batch and slot. Rows with null or repeated ids are packed one by one."""
    return pack(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("secrets", mask_all_secrets),
    ("mixing", sample_mixture),
    ("packing", pack_batches),
]

#: Nearest neighbours and dynamic programming aren't expressible in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
