"""The registered queries of the operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import bpe, conversation_repair, cover_tree, decontamination, fill_middle, language, line_dedup, ngram_join, secret_scan, sharding, substring_dedup, suffix_dedup, toxicity
from paperloom.llm.common import held_out, table
from paperloom.llm.oracles import ORACLES  # noqa: F401

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@query
def op1_count_vector_join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.near_duplicates(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op2_boosted_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    labels = table(spark, folder, "labels").select("doc_id", "toxic").where(~held_out(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    predicted = (F.col("score") >= 0.3).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"))


@query
def op3_feistel_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard_rows(docs, 40).drop("row_number")


@query
def op4_rank_order_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    profiles = language.train_profiles(docs.where(~held_out(F.col("doc_id"))))
    found = language.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


@query
def op5_blob_ledger_secrets(spark: SparkSession, folder: str) -> DataFrame:
    versions = table(spark, folder, "documents").select("doc_id", "text")
    found, _ = secret_scan.find_secrets(versions)
    spans = F.col("secret_spans")
    names = secret_scan.span_names(spans)
    counts = [secret_scan.count_of(spans, kind).cast("long").alias(f"n_{kind}") for kind in secret_scan.KINDS]
    return found.select("doc_id", *counts, F.sha2(names.cast("binary"), 256).alias("base_sha256"), names.alias("spans"))


@query
def op6_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.without_repeats(table(spark, folder, "documents").select("doc_id", "text")).drop("kept_bytes")


@query
def op7_cover_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return cover_tree.top_k(vectors, vectors.where("vec_id % 100 = 0"), 10)


@query
def op8_matrix_bpe(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.encode(docs, path, public_tokenizers.PATTERN, with_ids=False)
    return coded.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op9_fuzzy_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return line_dedup.line_report(table(spark, folder, "documents").select("doc_id", "text"))


@query
def op10_broadcast_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontamination.find_leaks(docs, table(spark, folder, "benchmark"))
    ids = F.array_join("leak_items", ",")
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("leak_items").cast("long").alias("n_items"),
        F.sha2(ids.cast("binary"), 256).alias("items_sha256"),
        decontamination.contaminated(found).alias("contaminated"),
    )


@query
def op12_framed_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = fill_middle.fim_digests(fill_middle.fill_in_middle(docs))
    cuts = [F.col("cut1").alias("prefix_chars"), (F.col("cut2") - F.col("cut1")).alias("middle_chars")]
    return found.select(F.col("key").alias("doc_id"), "n", "form", *cuts, "output_sha256", "restored_sha256")


@query
def op13_survivor_repair(spark: SparkSession, folder: str) -> DataFrame:
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    damaged = conversation_repair.damage(conversations)
    found = conversation_repair.repair_digests(conversation_repair.repair(damaged))
    same = F.col("conv_id").eqNullSafe(F.col("conv"))
    whole = conversations.select("conv_id").distinct().join(found, same, "left").drop("conv")
    empty = F.sha2(F.lit("").cast("binary"), 256)
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return whole.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", empty).alias("repaired_sha256"))


@query
def op11_seed_and_extend(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = substring_dedup.without_repeated_passages(docs)
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
