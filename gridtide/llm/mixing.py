"""Mixing sources to target weights by Poisson replication.

A document of a source that should be seen r times on average gets a Poisson(r) number of
copies: the distribution is inverted at a number in [0, 1) hashed from seed and id, so a
rerun, or a larger corpus with the same rates, repeats the same decisions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .support import BROADCAST_ROWS, cut, spare, with_columns

SEED = 17
#: Production weights; a source that is not named, or null, has weight 1.
WEIGHTS = {"src0": 4.0, "src1": 3.0, "src2": 2.0, "src3": 0.5}
#: A larger rate is the sum of several Poisson numbers, so that exp(-rate) stays a normal number.
MAX_STEP = 256.0
#: Rows of one position bucket, about.
BUCKET_ROWS = 100_000


def unit(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) with 52 random bits, from the md5 of seed and parts."""
    text = F.concat_ws(":", F.lit(str(seed)), *[F.coalesce(p.cast("string"), F.lit("-")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / 2**52


def poisson_table(rate: Column) -> Column:
    """Cumulated probabilities of 0, 1, 2, ... events, up to where they reach 1 in a double."""
    top = F.ceil(rate + 12 * F.sqrt(rate) + 24).cast("int")
    start = F.struct(F.exp(-rate).alias("p"), F.array(F.exp(-rate)).alias("table"))
    steps = F.aggregate(
        F.sequence(F.lit(1), top),
        start,
        lambda s, k: F.struct(
            (s["p"] * rate / k).alias("p"),
            F.concat(
                s["table"], F.array(F.element_at(s["table"], -1) + s["p"] * rate / k)
            ).alias("table"),
        ),
    )
    return steps["table"]


def rates(docs: DataFrame, weights: dict[str, float], source: str, text: str) -> DataFrame:
    """``source, rate, parts, table``: mean copies of a document of each source.

    The copies of a source should make up its share of the weights, in characters, and all
    of them together as many characters as there are now.
    """
    for name, weight in weights.items():
        if not (0 <= weight < math.inf):
            raise ValueError(f"weight of {name} is {weight}")
    size = F.coalesce(F.length(text), F.lit(0)).cast("long")
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("chars"))
    weight = F.lit(1.0)
    if weights:
        known = F.create_map(*[F.lit(x) for pair in sorted(weights.items()) for x in pair])
        weight = F.coalesce(known[F.col("source")], F.lit(1.0))
    sizes = cut(sizes.select("source", "chars", weight.cast("double").alias("weight")))
    whole = sizes.where("chars > 0").agg(
        F.sum("chars").alias("all_chars"), F.sum("weight").alias("all_weight")
    )
    chars, weighed = whole.first()
    # a weight sum of doubles over sources; rounding hides the order they were added in
    share = F.col("weight") / F.lit(round(weighed or 1.0, 9))
    rate = F.when(F.col("chars") > 0, F.round(share * F.lit(float(chars or 0)) / F.col("chars"), 9)).otherwise(1.0)
    rated = sizes.select("source", rate.alias("rate"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_STEP)).cast("int")
    rated = rated.withColumn("parts", parts)
    return rated.withColumn("table", poisson_table(F.col("rate") / F.col("parts")))


def replicate(
    docs: DataFrame,
    weights: dict[str, float] | None = None,
    seed: int = SEED,
    source: str = "source",
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Each document as often as its Poisson number says, with ``copies`` and ``copy`` from 0.

    * a null source is a source of its own; a source without characters keeps rate 1;
    * weight 0 removes a source, and documents that draw 0 are left out: that is the method;
    * equal ids draw equal numbers, so repeated rows are repeated alike; a null id draws as one;
    * an empty table gives an empty result; input columns with a result's name are replaced.
    """
    known = cut(rates(docs, WEIGHTS if weights is None else weights, source, text))
    few = known.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    rated, of = spare(docs, "_rated", "_of")
    known = known.select(F.col("source").alias(of), F.struct("parts", "table").alias(rated))
    match = F.col(source).eqNullSafe(F.col(of))
    # beyond the checked size Spark joins by shuffle and splits a hot source
    joined = docs.join(F.broadcast(known) if few else known, match)
    parts, table = F.col(rated)["parts"], F.col(rated)["table"]
    draws = F.transform(
        F.sequence(F.lit(1), parts), lambda i: F.size(F.filter(table, lambda p: p <= unit(seed, F.col(key), i)))
    )
    copies = F.aggregate(draws, F.lit(0), lambda a, b: a + b)
    named = with_columns(joined, {"copies": copies}).drop(rated, of)
    # an empty sequence would count down, so documents without copies go first
    return with_columns(
        named.where("copies > 0"), {"copy": F.explode(F.sequence(F.lit(0), F.col("copies") - 1))}
    )


def _placed(rows: DataFrame, key: str, mix: str, seed: int, bucket_rows: int) -> DataFrame:
    """Add ``mix``: a number in [0, 1) hashed from seed, id and copy.

    Rows of one id that are more than a bucket holds (a null id may be a third of all) would
    share few numbers; for those the number is hashed from the row's place as well.  Places are
    read from a written copy of the rows, so that every later pass sees the same ones.
    """
    number = unit(seed + 1, F.col(key), F.col("copy"))
    ident, marked, place = spare(rows, "_id", "_heavy", "_place")
    counts = rows.groupBy(F.col(key).alias(ident)).agg(F.count("*").alias("n"))
    heavy = cut(counts.where(F.col("n") > bucket_rows).select(ident))
    # as many ids as buckets at most
    many = heavy.count()
    if not many:
        return with_columns(rows, {mix: number})
    heavy = heavy.withColumn(marked, F.lit(True))
    heavy = F.broadcast(heavy) if many <= BROADCAST_ROWS else heavy
    stored = cut(rows).withColumn(place, F.monotonically_increasing_id())
    joined = stored.join(heavy, F.col(key).eqNullSafe(F.col(ident)), "left")
    own = unit(seed + 1, F.col(key), F.col("copy"), F.col(place))
    return with_columns(joined, {mix: F.when(F.col(marked), own).otherwise(number)}).drop(ident, marked, place)


def shuffled(
    rows: DataFrame, seed: int = SEED, key: str = "doc_id", bucket_rows: int = BUCKET_ROWS
) -> DataFrame:
    """Add ``position``: a gapless global order by a hash of id and copy.

    The hash is cut into buckets of about equal size; a bucket's first position is the number
    of rows in the buckets before it, so no task orders more than one bucket.

    * a null id is an id; rows that repeat id and copy stand in any order, and an id with more
      rows than a bucket is spread by the places of its rows;
    * texts are not read; an empty table gives an empty result; an input column ``position``
      is replaced, all others stay.
    """
    mix, bucket, before = spare(rows, "_mix", "_bucket", "_before")
    mixed = _placed(rows, key, mix, seed, bucket_rows)
    ids = cut(mixed.groupBy(F.floor(F.col(mix) * 4096).alias(bucket)).count())
    many = ids.agg(F.sum("count")).first()[0] or 0
    step = max(1, 2 ** math.ceil(math.log2(max(1, many / bucket_rows / 4096))))
    fine = F.floor(F.col(mix) * (4096 * step))
    counts = ids if step == 1 else mixed.groupBy(fine.alias(bucket)).count()
    so_far = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(F.col(bucket), F.coalesce(F.sum("count").over(so_far), F.lit(0)).alias(before))
    order = Window.partitionBy(bucket).orderBy(mix, key, "copy")
    placed = with_columns(mixed, {bucket: fine}).join(starts, bucket)
    place = F.col(before) + F.row_number().over(order) - 1
    return with_columns(placed, {"position": place}).drop(mix, bucket, before)


def dealt(rows: DataFrame, seed: int = SEED, key: str = "doc_id") -> DataFrame:
    """Rows in a global random order by the same hash, one exchange, without positions.

    Rows are dealt by id, copy and place, so rows that repeat an id, or have none, are spread
    over all partitions.  Texts are whole, repeated rows stay repeated, an empty table gives
    an empty result, and all input columns stay.
    """
    mix, place = spare(rows, "_mix", "_place")
    mixed = with_columns(rows, {mix: unit(seed + 1, F.col(key), F.col("copy"))})
    mixed = mixed.withColumn(place, F.xxhash64(mix, F.monotonically_increasing_id()))
    return mixed.repartition(place).sortWithinPartitions(mix, place).drop(mix, place)
