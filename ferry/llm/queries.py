"""The registered queries of this subpackage, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ferry.llm.chat import chat_digest, format_chat
from ferry.llm.common import table
from ferry.llm.decontaminate import contamination, find_passages
from ferry.llm.jaccard import JoinParams, similarity_components
from ferry.llm.language import held_out, predict, train
from ferry.llm.packing import pack_documents, text_cluster, word_length
from ferry.llm.quality import mcd_verdict, quality_stats
from ferry.llm.repair import damaged, repair_conversations, repair_digest, turn_gaps
from ferry.llm.repeats import remove_repeats
from ferry.llm.sharding import RingParams, shard_rows
from ferry.llm.spelling import SpellingParams, corpus_words, spelling_variants, vocabulary
from ferry.llm.token_blocks import token_file_digest
from ferry.llm.token_counts import count_edited
from ferry.llm.warc import archive_round_trip

HARD_TEXT = "\\### Assistant: </turn> ok"


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near copies of every document: 3-word shingles, similarity 0.9 or more."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return similarity_components(docs, JoinParams(words=3, percent=90)).select("doc_id", "n_shingles", "component_id")


def tokenizer_file(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, written as PFOR files and read back."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_file_digest(docs, tokenizer_file(), end_id=0)


def op3_language_ecoc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by classifiers that never saw the held-out quarter."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs.select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    return predict(rows, model).drop("text")


def op4_ring_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 39 of equal row counts by a hash ring with bounded loads."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return shard_rows(docs, RingParams(shards=40)).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document, by a positional index of the documents."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return contamination(find_passages(docs, table(spark, sf_dir, "benchmark"))).drop("row", "n_near_items")


def op6_quality_mcd(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base statistics and the verdict of the robust outlier rule for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return mcd_verdict(quality_stats(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts look like a template's control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    hard = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(HARD_TEXT).alias("text"))
    return chat_digest(format_chat(rows.unionByName(hard)))


def op8_warc_normaliser(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as monolithic gzip WARC files, normalised, and read back through their index."""
    return archive_round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in training sequences of 2,048 words, without copies or a crowding source."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    text = F.col("text")
    return pack_documents(docs, word_length(text), text_cluster(text)).drop("row")


def op10_edit_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document before and after masking personal data and repeated lines."""
    return count_edited(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file())


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by the planted faults and repaired by the cheapest edits."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_digest(*repair_conversations(damaged(rows), turn_gaps(rows)))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with planted misspellings, their near words and the forms they lead to."""
    p = SpellingParams()
    words = corpus_words(table(spark, sf_dir, "documents").select("doc_id", "text"), p.min_chars)
    return spelling_variants(vocabulary(words, p.min_count), p)


def op13_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the strings of 200 bytes that occur anywhere else."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_token_files": op2_token_files,
    "op3_language_ecoc": op3_language_ecoc,
    "op4_ring_sharding": op4_ring_sharding,
    "op5_decontamination": op5_decontamination,
    "op6_quality_mcd": op6_quality_mcd,
    "op7_chat_format": op7_chat_format,
    "op8_warc_normaliser": op8_warc_normaliser,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_edit_token_counts": op10_edit_token_counts,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_suffix_dedup": op13_suffix_dedup,
}
