"""The registered queries of this folder: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (alignment, ann, chat, decontaminate, langid, mixing, quality, secrets, simhash, substrings, suffixtree,
               trie, webtext)
from .common import bound_arrow_batches, read_table, remainder


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("hit_items"), ",").cast("binary"), 256).alias("items_sha256"),
                        "contaminated")


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = secrets.scan(docs, secrets.train(docs))
    return found.select("doc_id", "n_candidates", "n_secrets", "findings",
                        F.sha2(F.coalesce("redacted", F.lit("")).cast("binary"), 256).alias("redacted_sha256"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = langid.fit(docs.where(~held_out))
    return langid.identify(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op4_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = F.lit("</s>[INST] ok [/INST]")
    probe = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), said.alias("text"))
    back = chat.read_back(chat.format_conversations(turns.unionByName(probe)))
    digest = lambda parts: F.sha2(F.array_join(parts, "").cast("binary"), 256)
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), digest(lines).alias("turns_sha256"),
                       F.length(F.array_join("loss_texts", "")).cast("long").alias("loss_chars"),
                       digest(F.col("loss_texts")).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op5_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    vectors = ann.valid(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    return ann.search(ann.build(vectors), vectors.where(F.col("id") % 20 == 0))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = substrings.remove_repeats(docs)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                        F.sha2("kept", 256).alias("kept_sha256"))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    found = mixing.taken(mixing.plan(docs, ["doc_id"]))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = webtext.extract(pages, webtext.fit(pages))
    return found.select("page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("long").alias("n_chars"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs).select("doc_id", "fingerprint", "component_id")


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = remainder(F.col("doc_id"), 5) == 0
    labels = read_table(spark, sf_dir, "labels")
    model = quality.fit(docs.where(~held_out), labels.where(~(remainder(F.col("doc_id"), 5) == 0)))
    return quality.classify(docs.select("doc_id", "text", held_out.alias("held_out")), model).drop("text")


def op11_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffixtree.score(docs, remainder(F.col("doc_id"), 7) != 2)
    return found.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    bound_arrow_batches(spark)
    return alignment.align(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    nodes = trie.prefix_trie(trie.rebuilt(trie.ordered_turns(turns)))
    return nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


QUERIES = {f.__name__: f for f in (
    op1_benchmark_decontamination, op2_secret_scan, op3_language_id, op4_chat_formatting, op5_nearest_neighbours,
    op6_substring_dedup, op7_source_mixing, op8_html_extraction, op9_simhash_near_dedup, op10_quality_classifier, op11_lm_scoring,
    op12_tokenizer_alignment, op13_prefix_trie)}
