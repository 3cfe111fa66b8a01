"""The operators as queries: name -> function of (session, folder of the tables)."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.llm import bpe, conversation_trie, embedding_dedup, exact_dedup, fill_middle, jaccard, mixing, packing, quality, secret_scan, suffix_dedup, token_records, url_filters
from tillwright.llm.common import table
from tillwright.session import work_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


@query
def op1_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    return url_filters.filter_urls(table(spark, folder, "pages"))


@query
def op2_token_records(spark: SparkSession, folder: str) -> DataFrame:
    path = work_dir(spark, "token-records")
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    token_records.write_records(table(spark, folder, "documents"), tokenizer, path)
    token_records.write_index(spark, path)
    return token_records.read_index(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


@query
def op5_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, folder, "documents"))


@query
def op6_bpe(spark: SparkSession, folder: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN)


@query
def op3_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


@query
def op4_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score(docs.select("doc_id", "text"), model).select(
        "doc_id", quality.held_out().alias("held_out"), "score",
        F.when(F.col("score") >= quality.GOOD, 1).otherwise(0).alias("predicted"),
    )


@query
def op10_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(table(spark, folder, "documents"))
    return mixed.withColumn("chance", F.round("chance", 6))


@query
def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, folder, "documents")).drop("found")


@query
def op9_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_texts(table(spark, folder, "documents"))


@query
def op8_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.cut_repeats(table(spark, folder, "documents"))


@query
def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    made = fill_middle.fill_in_middle(table(spark, folder, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


@query
def op12_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    turns = conversation_trie.numbered(table(spark, folder, "conversations"))
    return conversation_trie.trie(conversation_trie.regrown(turns))
