"""The corpus pipeline: toxicity, line dedup, SimHash near-dedup, benchmark decontamination, pieces.

Every stage reads what the one before it wrote as Parquet in the shared folder, so a lost executor costs
tasks, not stages. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colonnade.llm.decontamination import decontaminate
from colonnade.llm.line_dedup import dedup_lines
from colonnade.llm.pieces import encode, load
from colonnade.llm.simhash import simhash_dedup
from colonnade.llm.toxicity import drop_toxic
from colonnade.session import scratch_path
from colonnade.tables import Tables


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the kernel machine scores under 0.5."""
    return drop_toxic(docs, Tables(spark, sf_dir).labels)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of recurring templates."""
    return dedup_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints link (four-word shingles, four bits)."""
    return simhash_dedup(docs, 4, 4)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    return decontaminate(docs, Tables(spark, sf_dir).benchmark)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The columns of documents with the best segmentation, its score and two further ones."""
    out = encode(docs, load(), 3)
    return out.select("row.*", F.size("ids").alias("n_pieces"), "ids", "piece_score", "alternatives", F.col("decoded").eqNullSafe(F.col("row.text")).alias("round_trip"))


STAGES = [
    ("toxicity", toxicity),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("pieces", pieces),
]

#: A string kernel with landmarks, trained here, has no SQL; tests/llm runs the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result reads the last stage's table."""
    docs = Tables(spark, sf_dir).documents
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
