"""One registered query for each operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerfold.llm import chat_format, decontaminate, jaccard_join, line_dedup, line_rules, ordinal_quality, sampled_pieces, secret_scan, source_divergence, substring_dedup, topk_search, url_filter, vector_codes


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sampled_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampled_pieces.encode(table(spark, sf_dir, "documents"), sampled_pieces.load_pieces())


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(substring_dedup.dedup_substrings(table(spark, sf_dir, "documents")))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digest(table(spark, sf_dir, "documents"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents")))


def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules.digest(line_rules.apply_rules(table(spark, sf_dir, "documents")))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as logs of streamed messages, and one more whose texts hold control strings of a common template."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                F.lit("</s>[INST] ok [/INST]").alias("text"))
    return chat_format.read_back(chat_format.format_events(chat_format.as_log(rows.unionByName(odd))))


def op9_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = ordinal_quality.train(docs, ordinal_quality.ratings(table(spark, sf_dir, "labels")))
    return ordinal_quality.grade(docs, model)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return vector_codes.digest(vectors, vector_codes.train(vectors))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit(table(spark, sf_dir, "documents"))


def op13_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return topk_search.search(vectors, topk_search.hundredth(vectors))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_sampled_pieces, op2_substring_dedup, op3_jaccard_join, op4_url_filter, op5_line_dedup, op6_secret_scan, op7_line_rules, op8_chat_format, op9_ordinal_quality, op10_decontaminate,
    op11_vector_codes, op12_source_divergence, op13_topk_search,
)}
