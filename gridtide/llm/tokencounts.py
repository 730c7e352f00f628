"""Token counts through a cache of digests.

A text is reduced to what its tokenizer sees, and counted under the digest of that and the
digest of the tokenizer.  Stored counts are joined; only distinct texts without one are
encoded, and their counts are appended to the store.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass
from pathlib import Path

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .support import BROADCAST_ROWS, as_bytes, cut, per_text, spare, with_columns

#: Texts with more tokens are marked.
LIMIT = 4096
#: Layout of the store; a folder for each tokenizer version.
STORED = "digest binary, n_tokens long, version string"
#: How sentencepiece writes a space; texts that differ only in that have equal tokens.
SPACE_MARK = "▁"


@dataclass(frozen=True)
class Tokenizer:
    """A vocabulary file of the tokenizers library (``.json``) or of sentencepiece (``.model``)."""

    path: str

    def version(self) -> str:
        """Digest of the vocabulary and of how it is read."""
        kind = Path(self.path).suffix
        return hashlib.sha256(kind.encode() + b"\0" + Path(self.path).read_bytes()).hexdigest()

    def spaces_marked(self) -> bool:
        """Whether the model takes texts as they are, but for writing spaces as a mark."""
        if not self.path.endswith(".model"):
            return False
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        model.ParseFromString(Path(self.path).read_bytes())
        spec = model.normalizer_spec
        return (
            spec.escape_whitespaces
            and not spec.remove_extra_whitespaces
            and not spec.precompiled_charsmap
            and not model.trainer_spec.treat_whitespace_as_suffix
        )

    def normal(self, text: Column) -> Column:
        """The text as far as the tokenizer tells texts apart; null is empty."""
        text = F.coalesce(text.cast("string"), F.lit(""))
        return F.replace(text, F.lit(SPACE_MARK), F.lit(" ")) if self.spaces_marked() else text

    def counter(self):
        """Function from a list of texts to their numbers of tokens."""
        if self.path.endswith(".model"):
            from sentencepiece import SentencePieceProcessor

            model = SentencePieceProcessor(model_file=self.path)
            return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]
        from tokenizers import Tokenizer as Library

        library = Library.from_file(self.path)
        library.no_truncation()
        library.no_padding()
        return lambda texts: [
            len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)
        ]


def stored(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``digest, n_tokens`` kept for a version; two writers may have stored one digest twice."""
    try:
        rows = spark.read.schema(STORED).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], STORED)
    rows = rows.where(F.col("version") == version)
    return rows.groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def counted(texts: DataFrame, tokenizer: Tokenizer) -> DataFrame:
    """``digest, n_tokens`` of ``digest, content``."""

    def make():
        count = tokenizer.counter()
        return lambda batch: pa.array(count([x.decode("utf-8", "replace") for x in batch]), pa.int64())

    return texts.select("digest", per_text(make, "long")(as_bytes("content")).alias("n_tokens"))


def add_missing(docs: DataFrame, tokenizer: Tokenizer, cache: str) -> int:
    """Encode each distinct ``digest, content`` the store lacks and append it; how many there were.

    Copies are reduced to one for each task before the shuffle, so a text that a third of all
    rows repeat travels once a task, and is encoded once.
    """
    spark, version = docs.sparkSession, tokenizer.version()
    distinct = docs.select("digest").distinct()
    known = stored(spark, cache, version)
    missing = cut(distinct.join(known, "digest", "left_anti"))
    n = missing.count()
    if not n:
        return 0
    few = n <= BROADCAST_ROWS
    # few digests go to the texts; otherwise the texts, one for each digest, go to the digests
    rows = docs.join(F.broadcast(missing), "digest", "left_semi") if few else docs
    texts = rows.groupBy("digest").agg(F.any_value("content").alias("content"))
    if not few:
        texts = texts.join(missing, "digest", "left_semi")
    rows = counted(texts, tokenizer).withColumn("version", F.lit(version))
    rows.write.mode("append").partitionBy("version").parquet(cache)
    return n


def token_counts(
    docs: DataFrame, vocabulary: str, cache: str, limit: int = LIMIT, text: str = "text"
) -> DataFrame:
    """Add ``n_bytes, n_tokens, over_limit`` to each document.

    ``cache`` is a folder every executor can reach; it need not exist.  Counts are those of the
    library without begin, end or other added tokens; special strings inside a text are treated
    as the library does by default.

    * a null text is empty: no bytes, and as many tokens as the library gives an empty text;
    * texts are encoded whole, however long; repeated rows are repeated in the result and
      encoded once; rows are told apart by text only, so ids may be null or repeated;
    * an empty table gives an empty result and leaves the store as it is;
    * input columns with a result's name are replaced, all others stay.
    """
    tokenizer = Tokenizer(vocabulary)
    content = tokenizer.normal(F.col(text))
    digest = F.unhex(F.sha2(content.cast("binary"), 256))
    add_missing(docs.select(digest.alias("digest"), content.alias("content")), tokenizer, cache)
    own_digest, its_digest, counts = spare(docs, "_own", "_digest", "_tokens")
    # cut, so that the join reads a plain exchange, which adaptive execution splits where one
    # digest holds many rows
    known = cut(stored(docs.sparkSession, cache, tokenizer.version()))
    known = known.select(F.col("digest").alias(its_digest), F.col("n_tokens").alias(counts))
    size = F.length(F.coalesce(F.col(text).cast("binary"), F.lit("").cast("binary")))
    # sizes and digests are made before the join, so a text nobody selects is not shuffled
    own = with_columns(docs, {"n_bytes": size.cast("long"), own_digest: digest})
    own = own.join(known, F.col(own_digest) == F.col(its_digest))
    found = {"n_tokens": F.col(counts), "over_limit": F.col(counts) > limit}
    return with_columns(own, found).drop(own_digest, its_digest, counts)
