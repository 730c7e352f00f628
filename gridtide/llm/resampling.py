"""Quality classifier by importance resampling.

Two generative models over hashed byte n-grams are counted: one from well-labelled target
documents, one from the whole raw corpus.  The log-ratio of the two models for a document, the
sum over all its n-grams, is its log importance weight; Gumbel noise hashed from its id is
added, and the documents with the k largest sums are kept, which samples k documents without
replacement in proportion to their weights.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mixing import unit
from .support import (
    LABELLED_ROWS, as_bytes, best_cut, cut, labelled_sample, per_text, unpacked, with_columns,
)

GRAM, BUCKETS = 4, 1 << 16
SEED = 23
#: Losing all labelled good rows is this many times as bad as keeping all bad ones.
GOOD_COUNTS = 20.0
#: Keys are compared as integers of this many parts of one.
PARTS = 1 << 20
BITS = 10


def grams(data: bytes | None) -> np.ndarray:
    """Bucket of every window of GRAM bytes, as a hash."""
    if not data or len(data) < GRAM:
        return np.empty(0, np.int64)
    x = np.frombuffer(data, np.uint8).astype(np.uint32)
    word = x[:-3] | x[1:-2] << np.uint32(8) | x[2:-1] << np.uint32(16) | x[3:] << np.uint32(24)
    return ((word * np.uint32(2654435761)) >> np.uint32(16)).astype(np.int64)


@dataclass
class Ratio:
    """Log-ratio of target to raw probability for each bucket, and the cut on labelled rows."""

    table: np.ndarray
    threshold: float | None = None

    def log_weight(self, data: bytes | None) -> tuple[int, float]:
        found = grams(data)
        if not len(found):
            return 0, 0.0
        return len(found), float(self.table[found].sum())


def count_grams(docs: DataFrame, group: Column, groups: int, text: str = "text") -> np.ndarray:
    """Counts of all buckets, one row for each value of ``group`` from 0.

    Each task sums its own texts; what reaches the driver is at most one row for each group
    and bucket.
    """

    def run(batches):
        table = np.zeros((groups, BUCKETS), np.int64)
        for part in unpacked(batches):
            for data, kind in zip(*part):
                table[kind] += np.bincount(grams(data), minlength=BUCKETS)
        kind, bucket = np.nonzero(table)
        yield pa.RecordBatch.from_arrays(
            [pa.array(kind, pa.int32()), pa.array(bucket, pa.int32()), pa.array(table[kind, bucket])],
            ["kind", "bucket", "n"],
        )

    found = docs.select(as_bytes(text), group.cast("int")).mapInArrow(run, "kind int, bucket int, n long")
    sums = found.groupBy("kind", "bucket").agg(F.sum("n").alias("n")).toPandas()
    table = np.zeros((groups, BUCKETS), np.int64)
    table[sums["kind"], sums["bucket"]] = sums["n"]
    return table


def ratio_of(target: np.ndarray, raw: np.ndarray) -> Ratio:
    """The same share of uniform mass keeps n-grams that neither model has seen neutral."""
    parts = [0.98 * x / max(1, x.sum()) + 0.02 / BUCKETS for x in (target, raw)]
    return Ratio(np.log(parts[0] / parts[1]))


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Ratio | None:
    """Models and cut; None without well-labelled documents.

    The raw model counts the whole corpus; the target model counts at most ``rows`` labelled
    documents, those with quality 1.  The cut is found on weights of labelled documents under
    a target model of the other half of them, so a small sample is not taken for easier than
    the corpus.
    """
    half = F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(2))
    sample = labelled_sample(docs, labels, "quality", rows).withColumn("_half", half)
    groups = F.when(F.col("_label") == 1, F.col("_half") + 1).otherwise(0)
    counts = count_grams(sample, groups, 3)
    target = counts[1] + counts[2]
    if not target.any():
        return None
    raw = count_grams(docs, F.lit(0), 1)[0]
    ratio = ratio_of(target, raw)
    weights = [weighed_text(ratio_of(counts[2 - i], raw), "text") for i in range(2)]
    both = sample.select("_label", F.when(F.col("_half") == 0, weights[0]).otherwise(weights[1]).alias("w"))
    found = both.select("_label", "w.*").where("n_grams > 0").toPandas()
    good = found["_label"] == 1
    ratio.threshold = best_cut(
        sorted(found.loc[good, "log_weight"]), sorted(found.loc[~good, "log_weight"]), GOOD_COUNTS
    )
    return ratio


def weighed_text(ratio: Ratio | None, text: str) -> Column:
    """Struct (n_grams, log_weight) of a text column."""

    def make():
        def apply(batch):
            rows = [(len(grams(x)), 0.0) if ratio is None else ratio.log_weight(x) for x in batch]
            n, weight = zip(*rows) if rows else ((), ())
            return pa.StructArray.from_arrays(
                [pa.array(n, pa.int64()), pa.array(weight, pa.float64())], ["n_grams", "log_weight"]
            )

        return apply

    return per_text(make, "n_grams long, log_weight double")(as_bytes(text))


def gumbel_key(weight: Column, *ids: Column) -> Column:
    """Log weight plus standard Gumbel noise, in integer parts."""
    noise = -F.log(-F.log((unit(SEED, *ids) * (1 << 52) + 0.5) / float(1 << 52)))
    return F.round((weight + noise) * PARTS).cast("long")


def cut_of_top(keys: DataFrame, k: int) -> int | None:
    """The k-th largest value of the long column ``key``; None for k = 0.

    The range of values is narrowed by counts in 1024 bins a round; nothing is sorted.
    """
    low, high, n = keys.agg(F.min("key"), F.max("key"), F.count("key")).first()
    if k <= 0 or not n:
        return None
    left = min(k, n)
    while low < high:
        width = max(1, -(-(high - low + 1) // (1 << BITS)))
        part = F.floor((F.col("key") - F.lit(low)) / F.lit(width)).alias("part")
        inside = keys.where(F.col("key").between(low, high))
        bins = sorted(inside.groupBy(part).count().collect(), reverse=True)
        for bucket, count in bins:
            if left <= count:
                break
            left -= count
        low, high = low + bucket * width, min(high, low + (bucket + 1) * width - 1)
    return low


def resample(
    docs: DataFrame, ratio: Ratio | None, keep: int | None = None, key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Add ``n_grams, log_weight, gumbel_key`` and ``kept`` to each document.

    ``keep`` is the number of documents to sample.  By default it is the number whose log
    weight reaches the cut found on labelled rows, so that about as many documents are taken
    as look like the target; without a cut all are kept.

    * a null text, or one shorter than an n-gram, has log weight 0: neither like nor unlike;
    * the noise depends on the id, so equal texts may differ in ``kept`` near the cut, and rows
      repeated with their id agree; a null id is an id; rows that tie at the cut are all kept;
    * an empty table gives an empty result; input columns with a result's name are replaced.
    """
    one = with_columns(docs, {"_weighed": weighed_text(ratio, text)})
    new = {c: F.col(f"_weighed.{c}") for c in ("n_grams", "log_weight")}
    one = with_columns(one, new).drop("_weighed")
    sampled = with_columns(one, {"gumbel_key": gumbel_key(F.col("log_weight"), F.col(key))})
    threshold = None if ratio is None else ratio.threshold
    if keep is None and threshold is None:
        return with_columns(sampled, {"kept": F.lit(True)})
    keys = cut(sampled.select(F.col("gumbel_key").alias("key"), "log_weight"))
    if keep is None:
        keep = keys.where(F.col("log_weight") >= threshold).count()
    edge = cut_of_top(keys, keep)
    kept = F.lit(False) if edge is None else F.col("gumbel_key") >= F.lit(edge)
    return with_columns(sampled, {"kept": kept})
