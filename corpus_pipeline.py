"""From documents to packed sequences: language, near copies, repeated passages, benchmark, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsnorm.llm import common, decontamination, language, near_dedup, packing, substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
NO_ID = 1 << 62  # rows without doc_id are numbered from here
LEAST_COVERAGE = 0.3  # share of a text's n-grams that its best language must hold


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is learned from their lang labels; others, and those without a letter, go."""
    filters = language.fit(docs.select("doc_id", "text", "lang"))
    return language.keep_known(docs.select(COLUMNS), filters, LEAST_COVERAGE)


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays, the one of least doc_id (null last): five words, similarity 0.8.

    Rows are told apart by their place in the input, so a row with a text of its own stays whatever other rows share its
    doc_id, rows without doc_id are treated like any, and of a row that is there twice one is left. Texts without a word are
    copies of nothing; all of them stay.
    """
    rows = common.with_row(docs)
    found = near_dedup.near_duplicates(rows.select(F.col("row").alias("doc_id"), "text"), shingle=5, percent=80)
    found = found.select(F.col("doc_id").alias("row"), "component_id").join(rows.select("row", F.col("doc_id").alias("id")), "row")
    found = common.stage(found, "groups")
    order = F.struct(F.col("id").isNull(), "id", "row")
    stay = found.groupBy("component_id").agg(F.min_by("row", order).alias("row")).select("row")
    gone = common.stage(found.select("row").join(stay, "row", "left_anti"), "gone")  # by row, so no task has a whole group
    alone, shared = common.divide(rows, F.xxhash64("row"), gone.select(F.xxhash64("row").alias("h")))
    return alone.select(COLUMNS).unionByName(shared.join(gone, "row", "left_anti").select(COLUMNS))


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages that stand in a document of smaller doc_id are cut out; n_chars follows the text.

    All rows stay. Rows without doc_id come after all others, each a document of its own; rows that share a doc_id
    count as one and keep each other's passages. Null texts stay null. Without rows there is nothing to do.
    """
    rows = common.with_row(docs).withColumn("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.col("row") + NO_ID))
    cut = substring_dedup.dedup_substrings(rows.select(COLUMNS))
    cut = cut.withColumn("n_chars", F.when(F.size("removed_spans") > 0, F.length("text")).otherwise(F.col("n_chars")))
    return cut.withColumn("doc_id", F.when(F.col("doc_id") < NO_ID, F.col("doc_id"))).select(COLUMNS)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold ten consecutive words of a benchmark item go, each by its own text, whatever its doc_id."""
    rows = common.with_row(docs).withColumn("own", F.col("doc_id")).withColumn("doc_id", F.col("row"))
    kept = decontamination.clean(rows, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return kept.withColumn("doc_id", F.col("own")).select(COLUMNS)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 ids."""
    return packing.pack(docs, TOKENIZER, length=1024, end=0)


STAGES = [
    ("language_id", known_language),
    ("near_dedup", one_of_near_copies),
    ("substring_dedup", without_repeats),
    ("decontamination", without_benchmark),
    ("packing", packed),
]
ORACLE_SQL = None  # packing needs a tokenizer, language ID a model: tests/llm/test_operators.py compares the stages with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; each result is written to the shared folder and read by the next.

    Null texts and texts without a letter go in the first stage. An empty table of documents gives no sequences, an empty
    benchmark hits nothing; further columns of the input are not carried.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.stage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
