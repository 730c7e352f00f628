"""Exact top-k inner products by MaxScore over shards.

Every component of a vector is a term whose posting list is that component of all vectors of
a shard.  A query orders its terms by how much they can add.  The strongest, essential, terms
are traversed for all vectors; once the rest cannot lift a vector over the k-th best score,
they are non-essential and are only probed for vectors that are still competitive.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import cut

#: Vectors of a shard and queries of a block: what one group holds at most, about.
SHARD_ROWS, BLOCK_ROWS = 4096, 4096
#: Terms added between two looks at the bounds.
STEP = 8


def quantized(vector: Column) -> Column:
    """``floor(256 * x)`` of each component; null for vectors that take no part."""
    infinite = float("inf")
    sound = F.forall(
        vector,
        lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < infinite),
    )
    # forall is null where a component is
    whole = F.transform(vector, lambda x: F.floor(F.lit(256.0) * x.cast("double")))
    return F.when(F.coalesce(sound, F.lit(False)), whole)


def matrix(rows: pa.ChunkedArray, width: int, kind=float) -> np.ndarray:
    """Vectors as columns, one row a term; short vectors end in zeros."""
    out = np.zeros((width, len(rows)), kind)
    for i, vector in enumerate(rows.to_pylist()):
        out[: len(vector), i] = vector
    return out


def kth(values: np.ndarray, k: int):
    """The k-th largest value."""
    if values.dtype == object:
        return sorted(values.tolist())[-k]
    return np.partition(values, len(values) - k)[len(values) - k]


def best(
    query: np.ndarray, postings: np.ndarray, low: np.ndarray, high: np.ndarray, own: np.ndarray, k: int, bar=None
):
    """Places and scores of the vectors that can be among the k best (ties included).

    ``low`` and ``high`` bound each term over the shard; ``own`` marks vectors left out.  A
    ``bar``, the k-th best score of another shard, has to be reached as well.  Terms that have
    been added for all vectors are essential; once some vectors cannot reach the bar, the terms
    that are left are only probed for the others.
    """
    ends = np.stack([query * low, query * high])
    floors, room = ends.min(axis=0), np.abs(ends[1] - ends[0])
    order = np.argsort(-room, kind="stable")
    # what terms from here on add at least, and can add beyond that
    rest = np.append(np.cumsum(room[order][::-1])[::-1], 0)
    least = np.append(np.cumsum(floors[order][::-1])[::-1], 0)
    alive = np.flatnonzero(~own)
    partial = np.zeros(len(alive), postings.dtype)
    for at in range(0, len(order), STEP):
        terms = order[at : at + STEP]
        part = postings[terms] if len(alive) == postings.shape[1] else postings[np.ix_(terms, alive)]
        partial = partial + query[terms] @ part
        done = min(at + STEP, len(order))
        # a vector ends between its partial score and that plus rest, both above least
        marks = [kth(partial, k)] if len(alive) > k else []
        if bar is not None:
            marks.append(bar - least[done])
        if marks:
            keep = partial + rest[done] >= max(marks)
            if not keep.all():
                alive, partial = alive[keep], partial[keep]
    return alive, partial


def exact_kind(peak: float, width: int):
    """A number type in which sums of ``width`` products up to ``peak`` squared are exact."""
    most = peak * max(width, 1) * 4
    return float if most < 2**53 else object


def search(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best vectors of every query.

    Both tables have ``vec_id`` and ``v``, an array of whole numbers.  A query never finds rows
    of its own id; ties go to the smaller id.  Queries are cut into blocks and vectors into
    shards by hash, of the row as well as of the id; each pair of block and shard is one
    bounded group, and only its k best rows are merged.  One shard is searched first, and the
    k-th best score of each query there is the bar that it brings to all others.

    * rows with a null id or vector take no part; a vector shorter than another ends in zeros;
    * repeated rows are found repeatedly; a query repeated with its vector is asked once, and
      queries of one id with different vectors compete for its k ranks;
    * an empty side gives an empty result; other columns are ignored;
    * scores are exact: groups with large components are computed in whole numbers of any size.
      Only a reported score that a long cannot hold raises an ArithmeticError.
    """
    vectors = vectors.where("vec_id is not null and v is not null").select("vec_id", "v")
    queries = queries.where("vec_id is not null and v is not null").select("vec_id", "v").distinct()
    shards = max(1, -(-vectors.count() // SHARD_ROWS))
    blocks = max(1, -(-queries.count() // BLOCK_ROWS))
    # equal rows may go to different shards: the place of a row is part of the hash
    shard = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(shards)).cast("int")
    vectors = vectors.withColumn("shard", shard)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("vec_id", "v"), F.lit(blocks)).cast("int"))

    def group(left: pa.Table, right: pa.Table) -> pa.Table:
        found = {"query_id": [], "vec_id": [], "score": []}
        if len(left) and len(right):
            sides = [side["v"].to_pylist() for side in (left, right)]
            width = max(len(v) for side in sides for v in side)
            # by the larger side, so that any product and any bound is exact
            peak = max((abs(x) for side in sides for v in side for x in v), default=0)
            kind = exact_kind(float(peak) ** 2, width)
            postings, asked = matrix(left["v"], width, kind), matrix(right["v"], width, kind)
            low, high = postings.min(axis=1), postings.max(axis=1)
            ids = left["vec_id"].to_numpy()
            bars = right["bar"].to_pylist()
            for i, query in enumerate(right["vec_id"].to_pylist()):
                at, score = best(asked[:, i], postings, low, high, ids == query, k, bars[i])
                if kind is object:
                    score = [int(x) for x in score]
                    first = sorted(range(len(at)), key=lambda j: (-score[j], ids[at[j]]))[:k]
                    if any(abs(score[j]) >= 2**63 for j in first):
                        raise ArithmeticError("a score is no long")
                    scores = [score[j] for j in first]
                else:
                    first = np.lexsort((ids[at], -score))[:k]
                    scores = score[first].astype(np.int64).tolist()
                found["query_id"] += [query] * len(first)
                found["vec_id"] += ids[at[first]].tolist()
                found["score"] += scores
        return pa.table({c: pa.array(x, pa.int64()) for c, x in found.items()})

    def searched(some: DataFrame, asked: DataFrame, n_shards: int, first: int) -> DataFrame:
        every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        every_shard = F.explode(F.sequence(F.lit(first), F.lit(first + n_shards - 1))).alias("shard")
        # both sides may come from one table: new names tell their columns apart
        left = some.select("shard", every_block, "vec_id", "v").toDF("shard", "block", "vec_id", "v")
        right = asked.select(every_shard, "block", "vec_id", "v", "bar").toDF("shard", "block", "vec_id", "v", "bar")
        left, right = (side.groupBy("shard", "block") for side in (left, right))
        return left.cogroup(right).applyInArrow(group, "query_id long, vec_id long, score long")

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def ranked(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    merged = searched(
        vectors.where("shard = 0"), queries.withColumn("bar", F.lit(None).cast("long")), 1, 0
    )
    if shards > 1:
        merged = cut(ranked(merged).drop("rank"))
        # scores of one query only fall in from here on
        bars = merged.groupBy("query_id").agg(F.min("score").alias("bar"), F.count("*").alias("n"))
        bars = bars.where(F.col("n") == k).select(F.col("query_id").alias("vec_id"), "bar")
        asked = queries.join(bars, "vec_id", "left").select("block", "vec_id", "v", "bar")
        merged = merged.unionByName(searched(vectors.where("shard > 0"), asked, shards - 1, 1))
    return ranked(merged).select("query_id", "rank", "vec_id", "score")
