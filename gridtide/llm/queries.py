"""The operators' registered queries, with production parameters over whole tables, and SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from . import (
    bpe, chat, collocations, langid, maxscore, mixing, neardup, resampling, rules, sharding, tokencounts,
    urls, whitening,
)
from .support import table

#: Vocabulary of the encoding query.
VOCABULARY = "byte_bpe_50k.json"
#: Vocabulary of the counting query.
PIECES = "piece_bpe_32k.model"


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    forest = rules.fit(docs, table(spark, sf_dir, "labels"))
    wanted = [
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "anomaly",
    ]
    return rules.judge(docs, forest).select(*wanted)


def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return urls.judge(pages).select("page_id", "host", "path", "rule", "verdict")


def mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    copies = mixing.replicate(docs).select("doc_id", "source", "copies", "copy")
    return mixing.shuffled(copies).select("doc_id", "source", "copies", "copy", "position")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ratio = resampling.fit(docs, table(spark, sf_dir, "labels"))
    found = resampling.resample(docs, ratio)
    return found.select("doc_id", "n_grams", "log_weight", "gumbel_key", "kept")


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.fold_of("doc_id") == langid.HELD_OUT
    profiles = langid.fit(docs.where(~held))
    found = langid.predict(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.format_digests(chat.with_probe(table(spark, sf_dir, "conversations")))


def bpe_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = bpe.encode(docs, public_tokenizers.path(VOCABULARY), ids=False)
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", maxscore.quantized(F.col("embedding")).alias("v")
    )
    return maxscore.search(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.sharded(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def whitened(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(
        "vec_id", maxscore.quantized(F.col("embedding")).alias("x")
    )
    return whitening.whitened(vectors, whitening.fit(vectors))


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("text", "lang"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # a store of its own, so that every run does all the work
    cache = scratch_dir(spark, "token-counts")
    found = tokencounts.token_counts(docs, public_tokenizers.path(PIECES), cache)
    return found.select("doc_id", "n_bytes", "n_tokens", "over_limit")


QUERIES = {
    "op1_quality_rules": quality_rules,
    "op2_url_filters": url_filters,
    "op3_mix_sources": mix_sources,
    "op4_quality_classifier": quality_classifier,
    "op5_language_id": language_id,
    "op6_chat_format": chat_format,
    "op7_bpe": bpe_encode,
    "op8_top_k": top_k,
    "op9_near_duplicates": near_duplicates,
    "op10_shards": shards,
    "op11_whitening": whitened,
    "op12_collocations": phrases,
    "op13_token_counts": token_counts,
}
