"""The operators on the driver's tables: each query applies one to its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tsnorm.llm import (
    chat, common, decontamination, hard_negatives, language, near_dedup, packing, quality, search, sharding, substring_dedup, token_files,
    url_filter, whitening,
)
from tsnorm.llm.oracles import ORACLES

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RULES = [("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block")]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = language.fit(docs.filter(~language.held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()).select("doc_id", "text", "lang"))
    found = language.predict(docs, filters)
    return found.select("doc_id", language.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "coverage")


def op2_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text"))
    rows = table(spark, sf_dir, "conversations").select(own.columns).unionByName(own)
    back = chat.read_back(chat.windows(rows))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # a digest is over a whole conversation, so its text meets in one row here, and only here
    whole = back.select("conv_id", F.struct("window", told.alias("told"), "target").alias("w"), F.size("turns").alias("n"), "chars").groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list("w")).alias("w"), F.sum("chars").alias("formatted_chars"))
    target = F.array_join(F.transform("w", lambda x: x["target"]), "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.encode(F.array_join(F.transform("w", lambda x: x["told"]), ""), "UTF-8"), 256).alias("turns_sha256"),
        F.length(target).cast("long").alias("loss_chars"), F.sha2(F.encode(target, "UTF-8"), 256).alias("loss_sha256"), "formatted_chars")


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"), shingle=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, length=1024, end=0)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op5_top_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False)))
    rows = table(spark, sf_dir, "embeddings").filter(whole).select(
        common.row_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vec"))
    rows = common.stage(rows, "vectors")
    return search.top_products(rows, rows.filter(F.col("vec_id") % 50 == 0), k=5)


def op6_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"))
    placed = sharding.shard(rows, "doc_id", shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "removed_spans", "removed_words", (F.size("removed_spans") > 0).alias("repeats"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = url_filter.judge_urls(table(spark, sf_dir, "pages"), RULES)
    return found.select("page_id", "host", "path", "rule", "verdict")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.hits(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)
    names = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(names, "UTF-8"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_folder(spark, "token_files")
    token_files.write(table(spark, sf_dir, "documents"), path, TOKENIZER, end=2)
    return token_files.digests(token_files.read(spark, path))


def op11_quality_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    base, policy = quality.POLICIES[0], quality.POLICIES[-1]
    rows = quality.decide(quality.ledger(table(spark, sf_dir, "documents")), policy)
    failed = F.col("failed").bitwiseAND(F.lit(quality.mask(base)).cast("long")) != 0
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), "kept", "n_lines", "failed")


def finite_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """embeddings with a vector that has no null and no entry that is not finite."""
    return table(spark, sf_dir, "embeddings").filter(F.col("embedding").isNotNull() & F.forall(
        "embedding", lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = finite_vectors(spark, sf_dir).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda c: F.floor(64 * c.cast("double")) + 1_000_000).alias("x"))
    return whitening.whiten(common.stage(rows, "vectors"), components=16)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = finite_vectors(spark, sf_dir).filter("label is not null").select(
        common.row_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), moved.cast("long").alias("label"),
        F.transform("embedding", lambda x: F.floor(256 * x.cast("double"))).alias("vec"))
    rows = common.stage(rows, "vectors")
    return hard_negatives.hard_negatives(rows, rows.filter("vec_id % 100 = 0"), positives=5, negatives=5)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_language_id, op2_chat_windows, op3_near_duplicates, op4_packing, op5_top_products, op6_hash_ring, op7_substring_dedup,
        op8_url_filter, op9_decontamination, op10_token_files, op11_quality_ledger, op12_whitening, op13_hard_negatives, pipeline)
}
__all__ = ["ORACLES", "QUERIES"]
