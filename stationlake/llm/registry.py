"""The thin queries of the operators, over their whole tables, and their DuckDB SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stationlake.llm import (align, bpe, chat_format, ctw, decontaminate, html_text, line_dedup, mixing, near_dedup, passages,
                             quality_rules, topk_index, turn_trie)
from stationlake.llm.common import read_table
from stationlake.llm.oracles import ORACLE

__all__ = ["ORACLE", "QUERIES"]

VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk_index.search(vectors.where(F.col("vec_id") % 50 == 0), vectors, k=5)


def op2_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rendered = chat_format.rotate(read_table(spark, sf_dir, "conversations"))
    span = F.transform("spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["stop"].cast("string")))
    return rendered.select(
        "conv_id", "perspective", "part", F.col("n_turns").cast("bigint").alias("n_turns"),
        F.length("text").cast("bigint").alias("n_chars"),
        F.expr("aggregate(spans, 0L, (n, s) -> n + s.stop - s.start)").alias("n_target_chars"),
        F.sha2("text", 256).alias("text_sha256"), F.array_join(span, ",").alias("spans"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (quality_rules.quality(read_table(spark, sf_dir, "documents"))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    "base_failed", "kept"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return (line_dedup.dedup_lines(docs)
            .select("doc_id", "n_lines", "n_removed", "n_runs", "longest_run",
                    F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")))


def op6_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ctw.score(read_table(spark, sf_dir, "documents"))


def op7_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passages.repeated_passages(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return passages.with_classes(found).select("doc_id", "start", "stop", "other_id", "other_start", "other_stop", "n_matched",
                                               "class_id")


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "html")
    return html_text.extract(pages).select("page_id", "n_text_chars", "n_text_lines", "text")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"),
                        "source", "copies")


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"), VOCABULARY, public_tokenizers.PATTERN)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.scored(read_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                        public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.PATTERN)


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


def op13_turn_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = turn_trie.numbered_turns(read_table(spark, sf_dir, "conversations"))
    return turn_trie.trie(*turn_trie.rebuilt(turns))


QUERIES = {f.__name__: f for f in (op1_topk_search, op2_near_dedup, op3_chat_format, op4_quality_rules, op5_line_dedup,
                                   op6_context_tree, op7_fuzzy_passages, op8_html_text, op9_mixing, op10_byte_bpe,
                                   op11_token_alignment, op12_decontaminate,
                                   op13_turn_trie)}
