"""From raw documents to piece ids: quality filter, near-duplicate removal, benchmark
decontamination, masking of live-looking secrets, SentencePiece encoding.

Each stage takes (spark, docs, sf_dir), works on all its predecessor kept and returns a
DataFrame, which is written as Parquet and read again as the next one's docs. All but the
last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bankroll.llm import decontam, neardup, quality_cnn, secret_scan, sentencepiece_np
from bankroll.llm.common import ship, table, written
from bankroll.llm.queries import quality_weights

LEAST_QUALITY = 0.7


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose quality score is 0.7 or more. The classifier learns from the labelled
    rows of ``docs`` that are not held out."""
    weights = quality_weights(ship(spark), docs, sf_dir)
    scored = quality_cnn.score(docs.withColumnRenamed("score", "__score"), weights, keep=[
        "__score" if c == "score" else c for c in docs.columns])
    kept = scored.filter(F.col("score") >= LEAST_QUALITY)
    return kept.drop("score").toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    ship(spark)
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item lies."""
    return decontam.clean(docs, table(ship(spark), sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; live-looking secrets are masked and ``n_chars`` follows the text."""
    masked = secret_scan.mask_live(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document that is left."""
    ship(spark)
    return sentencepiece_np.encode(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("pieces", pieces)]

#: A network, MinHash and Viterbi segmentation are beyond SQL; tests hold run() against a
#: brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
