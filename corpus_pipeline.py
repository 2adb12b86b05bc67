"""The corpus pipeline: stages over the documents, each written as Parquet before the next reads it.

Quality classifier, line dedup, one document of each group of near copies, benchmark
decontamination, and SentencePiece encoding. The first four return documents with their
columns; the last one returns the sampled segmentations of what is left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerfold.llm import decontaminate, jaccard_join, line_dedup, ordinal_quality, sampled_pieces
from ledgerfold.llm.store import fresh, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Fitted on the rated ones among these documents; those that it rejects go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return ordinal_quality.select(docs, ordinal_quality.train(docs, ordinal_quality.ratings(labels)))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated lines go, and documents of which nothing is left."""
    spoken = F.rlike("text", F.lit(r"[^\x20\x09-\x0D]"))
    (gone,) = fresh(docs, "gone")
    left = line_dedup.dedup_lines(docs, distance=None, removed=gone).where(spoken | (F.size(gone) == 0))
    return left.select(*(F.length("text").cast(docs.schema[c].dataType).alias(c) if c == "n_chars" else c for c in docs.columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.keep_one(docs)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return sampled_pieces.encode(docs, sampled_pieces.load_pieces())


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", dedup_lines),
    ("n-gram Jaccard join", keep_one_of_near_copies),
    ("benchmark decontamination", drop_benchmark_copies),
    ("SentencePiece encoding and decoding", encode_pieces),
]
#: Fitting, components and sampling are not for SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir))
    return docs
