"""Registered queries of the operators, each over its whole table."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from nutrilake.llm import (alignment, chat, html_text, jaccard, language, line_dedup, mixing, packing, quality,
                           repeats, topk, toxicity, whitening)
from nutrilake.llm.oracles import ORACLES
from nutrilake.sources.tables import read_table, table_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    batches = line_dedup.file_batches(spark, table_path(sf_dir, "documents"))
    kept = line_dedup.dedup_lines(docs, batches)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score_toxicity(docs, read_table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted")


def op4_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.top_k(vectors, vectors.where(F.col("id") % 100 == 0), k=10)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = jaccard.similar_documents(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality.rule_ledger(read_table(spark, sf_dir, "documents"))
    judged = quality.apply_policy(ledger, "v2")
    base = F.col("fail_bits").bitwiseAND(F.lit(quality.mask(quality.BASE))) != 0
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", base.alias("base_failed"), "kept", "fail_bits")


def op7_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = mixing.plan_mix(read_table(spark, sf_dir, "documents"))
    return plan.select("doc_id", "size", "source_size", "target",
                       (F.col("size") * F.col("copies")).cast("long").alias("taken"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(read_table(spark, sf_dir, "pages"))


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_chats(read_table(spark, sf_dir, "conversations"))


def op10_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"), keep_text=False)


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    aligned = alignment.align_tokens(read_table(spark, sf_dir, "documents"), tokenizer_path(),
                                     public_tokenizers.path("piece_bpe_32k.model"), keep_groups=False)
    return aligned.withColumnRenamed("groups", "groups_sha256")


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.identify_language(docs).select("doc_id", "held_out", "lang_pred", "score")


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_line_dedup, op2_best_fit_packing, op3_toxicity, op4_exact_top_k,
        op5_jaccard_join, op6_quality_rules, op7_source_mix,
        op8_html_extraction, op9_chat_formatting, op10_repeat_removal, op11_token_alignment,
        op12_language_id, op13_embedding_whitening)}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLES.items() if k in QUERIES}
