"""The operators as queries on the given tables, and their SQL where SQL can say it."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fathomline.llm import chat_events, decontaminate, fuzzy_lines, language_crf, lsh_forest, mixing, perplexity, secret_scan, spelling_variants, token_alignment, toxicity_mil, vector_graphs, warc_writer


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(folder, f"{name}.parquet"))


def op1_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The table names no owner or repository: a source stands for an owner, its texts in one language for a repository."""
    docs = table(spark, folder, "documents")
    repository = F.concat(F.coalesce("source", F.lit("")), F.lit("/"), F.coalesce("lang", F.lit("")))
    return secret_scan.secret_scan(docs, F.col("source"), repository)


def fold(n: int, key: str = "doc_id"):
    """A document's fold: crc32 of its id as text, modulo n (a null id counts as empty text)."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % n


def op2_language_crf(spark: SparkSession, folder: str) -> DataFrame:
    return language_crf.predict_languages(table(spark, folder, "documents"), fold(5) == 0)


def op3_toxicity_mil(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_mil.predict_toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"), fold(4) == 2)


def op4_warc_writer(spark: SparkSession, folder: str) -> DataFrame:
    return warc_writer.round_trip(spark, table(spark, folder, "pages"))


def op5_perplexity(spark: SparkSession, folder: str) -> DataFrame:
    return perplexity.quality_rules(table(spark, folder, "documents"))


def op6_lsh_forest(spark: SparkSession, folder: str) -> DataFrame:
    return lsh_forest.similarity_join(table(spark, folder, "documents"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sizes(table(spark, folder, "documents"))


def op8_chat_events(spark: SparkSession, folder: str) -> DataFrame:
    text = "\\### Assistant: </turn> ok"
    columns = F.array(*[F.struct(F.lit(i).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(text).alias("text")) for i, r in enumerate(("user", "assistant"))])
    extra = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.inline(columns))
    rows = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_events.chat_format(rows)


def op9_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op10_fuzzy_lines(spark: SparkSession, folder: str) -> DataFrame:
    return fuzzy_lines.line_dedup(table(spark, folder, "documents"))


def op11_vector_graphs(spark: SparkSession, folder: str) -> DataFrame:
    return vector_graphs.near_vectors(table(spark, folder, "embeddings"))


def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_variants.spelling_variants(table(spark, folder, "documents"))


def op13_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, folder, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_language_crf": op2_language_crf,
    "op3_toxicity_mil": op3_toxicity_mil,
    "op4_warc_writer": op4_warc_writer,
    "op5_perplexity": op5_perplexity,
    "op6_lsh_forest": op6_lsh_forest,
    "op7_mixing": op7_mixing,
    "op8_chat_events": op8_chat_events,
    "op9_decontaminate": op9_decontaminate,
    "op10_fuzzy_lines": op10_fuzzy_lines,
    "op11_vector_graphs": op11_vector_graphs,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_alignment": op13_token_alignment,
}

ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": secret_scan.SQL,
    "op4_warc_writer": warc_writer.SQL,
    "op8_chat_events": chat_events.SQL,
    "op12_spelling_variants": spelling_variants.SQL,
}
