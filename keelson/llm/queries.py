"""The operators as queries over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keelson.llm import (
    bpe, html_text, id_files, jaccard, lm_scores, oracles, quality, repair, sharding, substrings, templates, trie, warc, winnow)
from keelson.llm.frames import small_batches

#: Vocabulary files are read where the tokenizers package lies; they are not part of this library.
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = oracles.SQL


def query(fn):
    def run(spark: SparkSession, folder: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, folder)
    QUERIES[fn.__name__] = run
    return fn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query
def op8_byte_sharding(spark, folder):
    """Eight contiguous shards of ``documents`` by bytes."""
    shards = sharding.byte_shards(sharding.sized(table(spark, folder, "documents")), 8)
    return shards.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


@query
def op1_warc_revisits(spark, folder):
    """Archives of ``pages`` with repeated payloads as revisits, as read back."""
    return warc.deduplicate(table(spark, folder, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "uri")


@query
def op5_quality_rules(spark, folder):
    """The ledger of all ``documents`` and the verdict of the full policy."""
    rows = quality.ledger(table(spark, folder, "documents"))
    return rows.select(
        F.col("key").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.accepted("base")).alias("base_failed"), quality.accepted("full").alias("kept"), "failed",
        "n_lines", "n_letters", "n_upper", "n_shouted", "n_insults", quality.sole_failure("full").alias("sole_failure"))


@query
def op3_html_main_text(spark, folder):
    """Main text of every row of ``pages``."""
    return html_text.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op10_bpe_round_trip(spark, folder):
    """Ids of all ``documents`` and what they decode to, as digests."""
    return bpe.digests(table(spark, folder, "documents"), BYTE_BPE).select(
        F.col("key").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")


@query
def op9_jaccard_join(spark, folder):
    """Components of all ``documents`` under links of 85 percent."""
    return jaccard.classes(table(spark, folder, "documents"), size=4, percent=85).select(
        F.col("key").alias("doc_id"), "n_shingles", "component_id")


@query
def op2_substring_dedup(spark, folder):
    """All ``documents`` without passages of 35 words that also stand elsewhere."""
    return substrings.remove_repeats(table(spark, folder, "documents"), 35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op7_template_decontamination(spark, folder):
    """All ``documents`` that hold an item of ``benchmark``, verbatim or re-parameterised."""
    return templates.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark")).select(
        F.col("key").alias("doc_id"), F.col("item").alias("item_id"), "run", "slots", "same_values")


@query
def op4_stupid_backoff(spark, folder):
    """Scores of all ``documents`` under their own trigram counts."""
    return lm_scores.scores(table(spark, folder, "documents"), 3).select(
        F.col("key").alias("doc_id"), "n_words", F.round("log_score", 4).alias("log_score"),
        F.round("mean_log_score", 4).alias("mean_log_score"))


@query
def op6_token_id_files(spark, folder):
    """Token ids of all ``documents`` in coded files, as read back."""
    manifest = id_files.write_ids(table(spark, folder, "documents"), WORD_BPE, end=2)
    return id_files.read_ids(manifest).withColumnRenamed("key", "doc_id")


@query
def op12_winnowing_fingerprints(spark, folder):
    """Fingerprints of all ``documents``, beside those of an edited text and of the next one."""
    return winnow.edits(table(spark, folder, "documents")).withColumnRenamed("key", "doc_id")


@query
def op11_conversation_repair(spark, folder):
    """All ``conversations``, damaged by a checksum and repaired at the least cost."""
    return repair.repaired(repair.damaged(table(spark, folder, "conversations"))).withColumnRenamed("conv", "conv_id")


@query
def op13_conversation_trie(spark, folder):
    """Prefix trie of all ``conversations`` with heads taken from every twentieth one."""
    return trie.prefix_trie(table(spark, folder, "conversations"), trie.stride_base(20), trie.checksum_head(4), 3).drop("fa", "fb")
