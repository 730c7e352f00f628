"""Near-duplicates: SimHash fingerprints linked through BK-trees.

Fingerprints that differ in at most three bits agree in whole blocks of bits, so trees are
built for each shard of fingerprints that agree in some blocks.  A node's children are keyed
by their Hamming distance to it, and a search follows only the edges within the radius.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import similar
from .components import connected_components
from .similar import shingle_hashes
from .support import as_bytes, cut, per_text, with_columns

SEED, WIDTH, RADIUS, BITS = 42, 3, 3, 64
#: Rows of one tree; a larger shard is cut into parts, and each pair of parts is a group.
TREE_ROWS = 1024
#: Fingerprints for which a random shard should hold a row, about, before more blocks must agree.
SHARD_BITS = 6


def fingerprint(data: bytes | None) -> int:
    """SimHash over three-word shingles, A-Z lower-cased; 0 without a word."""
    hashes = shingle_hashes(data, WIDTH, SEED)
    if not len(hashes):
        return 0
    bits = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 4096):
        part = hashes[at : at + 4096].astype("<u8").view(np.uint8).reshape(-1, 8)
        bits += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * bits > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``fp``, the fingerprint as a signed long."""

    def make():
        def apply(batch):
            return pa.array(np.array([fingerprint(x) for x in batch], np.uint64).view(np.int64))

        return apply

    return with_columns(docs, {"fp": per_text(make, "long")(as_bytes(text))})


class BKTree:
    """Values by Hamming distance: a child is kept under its distance to its parent."""

    def __init__(self):
        self.values: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, value: int) -> None:
        new, node = len(self.values), 0
        self.values.append(value)
        self.children.append({})
        while new:
            distance = (value ^ self.values[node]).bit_count()
            after = self.children[node].setdefault(distance, new)
            if after == new:
                return
            node = after

    def within(self, value: int, radius: int) -> list[int]:
        """Places of all values at most ``radius`` away."""
        found, todo = [], [0] if self.values else []
        values, children = self.values, self.children
        while todo:
            node = todo.pop()
            distance = (value ^ values[node]).bit_count()
            if distance <= radius:
                found.append(node)
            edges = children[node]
            if edges:
                low, high = distance - radius, distance + radius
                if len(edges) <= high - low:
                    todo += [child for d, child in edges.items() if low <= d <= high]
                else:
                    todo += [edges[d] for d in range(low, high + 1) if d in edges]
        return found


def links(planted: list[int], asked: list[int] | None, radius: int = RADIUS) -> list[tuple[int, int]]:
    """Edges that join the values of a group as far as links within the radius do.

    ``planted`` go into the tree; ``asked`` look them up, or the planted each other if None.
    At most one edge a value is returned, to the first member of its class.
    """
    tree = BKTree()
    values = planted + (asked or [])
    parent = list(range(len(values)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, value in enumerate(values):
        if asked is None or i >= len(planted):
            for j in tree.within(value, radius):
                a, b = root(i), root(j)
                if a != b:
                    parent[max(a, b)] = min(a, b)
        if i < len(planted):
            tree.add(value)
    return [(values[root(i)], v) for i, v in enumerate(values) if values[root(i)] != v]


def block_masks(rows: int, radius: int = RADIUS) -> list[int]:
    """Bit masks of which values within the radius agree under at least one.

    With radius + t blocks, values that differ in ``radius`` bits agree in t whole blocks; t
    grows with the number of rows, so that a mask of random values keeps shards small.
    """
    for t in range(1, 8):
        n = radius + t
        edges = [BITS * i // n for i in range(n + 1)]
        blocks = [(1 << b) - (1 << a) for a, b in zip(edges, edges[1:])]
        masks = [sum(chosen) for chosen in combinations(blocks, t)]
        if rows >> min(m.bit_count() for m in masks) <= 1 << SHARD_BITS:
            break
    return masks


def signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def linked(distinct: DataFrame, rows: int) -> DataFrame:
    """Edges ``a, b`` between distinct fingerprints ``fp`` that keep their components."""
    masks = block_masks(rows)
    shard = F.explode(
        F.array(
            *[F.xxhash64(F.lit(i), F.col("fp").bitwiseAND(F.lit(signed(m)))) for i, m in enumerate(masks)]
        )
    )
    keyed = distinct.select("fp", shard.alias("shard"))
    large = keyed.groupBy("shard").count().where(F.col("count") > TREE_ROWS)
    parts = F.ceil(F.coalesce("count", F.lit(1)) / TREE_ROWS).cast("int")
    placed = keyed.join(large, "shard", "left").select("fp", "shard", parts.alias("parts"))
    own = F.pmod(F.xxhash64("fp", F.lit(1)), F.col("parts")).cast("int")
    placed = placed.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    )
    cells = placed.select(
        "shard",
        F.least("own", "other").alias("first"),
        F.greatest("own", "other").alias("second"),
        (F.col("own") > F.col("other")).alias("asks"),
        "fp",
    )
    group = ["shard", "first", "second"]
    # a row alone in its group has no partner there
    ordered = cells.repartition(*group).sortWithinPartitions(*group, "asks", "fp")

    def run(batches):
        held, planted, asked, a, b = None, [], [], [], []

        def close():
            if held and len(planted) + len(asked) > 1:
                same = held[1] == held[2]
                for x, y in links(planted, None if same else asked):
                    a.append(signed(x))
                    b.append(signed(y))

        for batch in batches:
            rows = zip(*(c.to_pylist() for c in batch.columns))
            for shard, first, second, asks, fp in rows:
                if (shard, first, second) != held:
                    close()
                    held, planted, asked = (shard, first, second), [], []
                (asked if asks else planted).append(fp & ((1 << BITS) - 1))
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])
                a, b = [], []
        close()
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return ordered.mapInArrow(run, "a long, b long")


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, fp, component_id`` of every row: the smallest id its fingerprint reaches.

    Equal fingerprints are one node, so copies cost one row however many they are; a shard
    with many fingerprints is worked through in pairs of parts.

    * null and empty texts, and texts without a word, have fingerprint zero and are linked
      like any other; texts are read whole;
    * a null id takes no part in the smallest id; a component of null ids only has none;
    * repeated rows are repeated in the result; an empty table gives an empty result;
      other columns are ignored.
    """
    named = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    own = cut(fingerprints(named).select("doc_id", "fp"))
    distinct = cut(own.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    nodes = connected_components(linked(distinct.select("fp"), distinct.count()))
    rooted = distinct.join(nodes.select(F.col("node").alias("fp"), "root"), "fp", "left")
    rooted = rooted.select("fp", F.coalesce("root", "fp").alias("root"), "first_id")
    least = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = rooted.join(least, "root").select("fp", "component_id")
    return own.join(classes, "fp").select("doc_id", "fp", "component_id")


def _bounded(ids: DataFrame) -> DataFrame:
    """Ids that go to every task if they are few; otherwise Spark joins them by shuffle."""
    return F.broadcast(ids) if ids.count() <= similar.BROADCAST_IDS else ids


def deduplicated(
    docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = similar.WIDTH,
    similarity: float = similar.SIMILARITY,
) -> DataFrame:
    """One row of each class of similar texts, unchanged: that with the smallest id.

    Texts are linked whose shingles of ``width`` words have a Jaccard similarity of at least
    ``similarity``; texts without a word are one class.  Of rows of a
    class that share its smallest id, or whose ids are all null, the first by digest of text
    and row stays; rows of one id in several classes are kept for each.
    """
    named = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    found = similar.similar_texts(named, width, similarity)
    # the smallest id of a class, and one set that has it
    by_id = F.struct(F.col("first_id").isNull(), "first_id", "set")
    chosen = found.groupBy("root").agg(F.min(by_id).alias("_c"))
    chosen = cut(chosen.select(F.col("_c.first_id").alias(key), F.col("_c.set").alias("_set")))
    names = [f"`{c}`" for c in docs.columns]
    ids = chosen.where(F.col(key).isNotNull()).select(key).distinct()
    counts = named.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias(key)).agg(F.count("*").alias("_rows"))
    # rows of no chosen id go; of repeated ids and null ids the chosen text is looked for below
    gone = counts.join(ids, key, "left_anti").select(key)
    repeated = cut(counts.where("_rows > 1").join(ids, key, "left_semi").select(key))
    left = cut(gone.unionByName(repeated))
    kept = docs.where(F.col(key).isNotNull()).join(_bounded(left), key, "left_anti").select(*names)
    parts = []
    if not repeated.isEmpty():
        parts.append(docs.join(_bounded(repeated), key, "left_semi").select(*names))
    if not chosen.where(F.col(key).isNull()).isEmpty():
        parts.append(docs.where(F.col(key).isNull()).select(*names))
    for rows in parts:
        row = rows.select(
            F.struct(*names).alias("_row"), similar.shingle_set(f"`{text}`", width).alias("_set")
        )
        own, digest = F.col("_row").getField(key), F.sha2(F.col("_row").getField(text).cast("binary"), 256)
        same = (row["_set"] == chosen["_set"]) & own.eqNullSafe(chosen[key])
        first = F.min_by("_row", F.struct(digest, F.sha2(F.to_json("_row"), 256)))
        once = row.join(chosen, same, "left_semi").groupBy(own.alias("_id"), "_set").agg(first.alias("_row"))
        kept = kept.unionByName(once.select("_row.*"))
    return kept
