"""A corpus pipeline: documents through five stages, each written and read again before the next.

Each stage works on all that the one before kept. All but the last return the columns of documents.

- quality: documents that the base rules or the perplexity bands reject go.
- lines: of lines that are equal or nearly so, the first stays; a document left without a line goes.
- similar: of each class of documents connected by similar texts, the one with the smallest doc_id stays.
- benchmark: documents that hold a passage of the benchmark go.
- mix: sources are brought to their target weights; returned is one row per document with the words that the mix takes.

Null or empty texts have no words and are rejected by the first stage. Repeated rows are rows of their own until the third
stage, which keeps one row of each class. Columns that documents has beyond the usual ones are carried along. A stage deletes
its own tables but the one that its result is read from.
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fathomline.llm import decontaminate, fuzzy_lines, lsh_forest, mixing, perplexity  # noqa: E402
from fathomline.session import Stages  # noqa: E402

ROW, LOST = "_corpus_pipeline_row", "_corpus_pipeline_lost"


def numbered(docs: DataFrame) -> DataFrame:
    """docs with a number per row. docs is a stored table, so that the number is the same each time it is read."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def with_rows(docs: DataFrame, rows: DataFrame, how: str) -> DataFrame:
    """The rows of docs whose number is (left_semi) or is not (left_anti) in rows."""
    return numbered(docs).join(rows.select(F.col("row").alias(ROW)), ROW, how).select(*[f"`{c}`" for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = numbered(docs).select(F.col(ROW).alias("row"), F.col("lang").cast("string").alias("lang"), "text")
    stages = Stages(spark)
    judged = perplexity.verdicts(perplexity.measure(rows, ["row", "lang"], stages))
    stages.keep("perplexity-scores")
    return with_rows(docs, judged.filter("kept"), "left_semi")


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stages = Stages(spark)
    rows = numbered(docs).select(F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    lost = stages.write(fuzzy_lines.repeated_lines(rows, stages), "pipeline-lost").select(F.col("row").alias(ROW), F.col("lines").alias(LOST))
    stages.keep("pipeline-lost")
    joined = numbered(docs).join(lost, ROW, "left")
    kept = fuzzy_lines.without_lines(F.col("text"), F.col(LOST))
    text = F.when(F.col(LOST).isNull(), F.col("text")).otherwise(kept)
    n_chars = F.when(F.col(LOST).isNull(), F.col("n_chars")).otherwise(F.length("text").cast(docs.schema["n_chars"].dataType))
    changed = joined.withColumn("text", text).withColumn("n_chars", n_chars)
    return changed.filter(F.col(LOST).isNull() | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*[f"`{c}`" for c in docs.columns])


def similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    stages = Stages(spark)
    rows = numbered(docs).select(F.col(ROW).alias("doc_id"), "text")
    found, linked = lsh_forest.similarity_classes(rows, stages)
    by_text = found.join(linked.select("digest", "root"), "digest", "left").select(F.col("doc_id").alias("row"), F.coalesce("root", "digest").alias("class"))
    ids = numbered(docs).select(F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("doc_id"))
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row")
    first = by_text.join(ids, "row").groupBy("class").agg(F.min(place)["row"].alias("row"))
    first = stages.write(first.select("row"), "pipeline-first")
    stages.keep("pipeline-first")
    return with_rows(docs, first, "left_semi")


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    items = spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet"))
    stages = Stages(spark)
    found = decontaminate.find_contamination(docs, items, stages).select("row").distinct()
    found = stages.write(found, "pipeline-found")
    stages.keep("pipeline-found")
    return with_rows(docs, found, "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_sizes(docs)


STAGES = [("quality", quality), ("lines", lines), ("similar", similar), ("benchmark", benchmark), ("mix", mix)]

ORACLE_SQL = None  # perplexity, min-hashes and fingerprints are beyond SQL; tests compare the stages with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    stages, before = Stages(spark), None
    for name, stage in STAGES[:-1]:
        docs = stages.write(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before:
            stages.remove(before)  # read for the last time
        before = f"pipeline-{name}"
    return STAGES[-1][1](spark, docs, sf_dir)
