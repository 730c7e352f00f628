"""A training-data pipeline: each stage reads what the one before it wrote."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import bpe, mixing, neardup, resampling, rules
from gridtide.llm.queries import VOCABULARY
from gridtide.llm.support import table
from gridtide.session import scratch_dir


# Every stage takes nulls in any column, empty and long texts, repeated rows and an empty table,
# and all but the last return the columns of documents as they came, whatever their names.


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the fixed rules and are not anomalous.

    A null or empty text fails the rules; repeated rows share one verdict; ties with the
    threshold stay; an empty table stays empty.
    """
    forest = rules.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    return _whole(rules.judge(_carried(docs), forest, text="_doc.text").where("kept"))


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled for their likeness to well-labelled ones.

    A null text, or one shorter than an n-gram, is neither like nor unlike them; rows that
    repeat their id and text share one verdict; ties at the cut all stay; an empty table stays
    empty.
    """
    ratio = resampling.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"))
    found = resampling.resample(_carried(docs), ratio, key="_doc.doc_id", text="_doc.text")
    return _whole(found.where("kept"))


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates.

    Null, empty and wordless texts are one group; of a group the smallest id stays, a null id
    only where there is no other; of repeated rows one stays; an empty table stays empty.
    """
    return neardup.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out towards the target weights, in a global random order.

    A null source is a source; null and empty texts have no characters and count as they are;
    equal ids, and null ids, draw alike; an empty table stays empty.
    """
    copies = mixing.replicate(_carried(docs), source="_doc.source", key="_doc.doc_id", text="_doc.text")
    return _whole(mixing.dealt(copies, key="_doc.doc_id"))


def bpe_encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of ids and decoded text.

    A null or empty text has no tokens; repeated rows are repeated; an empty table stays empty.
    """
    path = public_tokenizers.path(VOCABULARY)
    found = bpe.encode(docs.select("doc_id", "lang", "source", "text"), path)
    return found.select("doc_id", "lang", "source", "ids", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("mix_sources", mix_sources),
    ("bpe_encode", bpe_encode),
]

#: SQL has neither the forest, the fingerprints nor the merges; tests compare with brute force.
ORACLE_SQL = None


def _carried(docs: DataFrame) -> DataFrame:
    """Whole rows as one column, so that an operator's columns clash with none of theirs."""
    return docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_doc"))


def _whole(found: DataFrame) -> DataFrame:
    return found.select("_doc.*")


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    folder = scratch_dir(spark, "pipeline")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
