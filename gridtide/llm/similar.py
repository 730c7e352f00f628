"""Classes of texts whose word shingles agree to a given share (Jaccard similarity).

Texts that share all minima of a band of MinHash values form a shard.  Within a shard their
SimHash fingerprints are put into a BK-tree, and a search that follows only the edges within a
radius finds which texts can be similar at all; links are confirmed by comparing the shingles.
Before that a find must pass a bound: as many shingles as the parities of two sets differ in,
at least, are in only one of them, and similar sets of their sizes differ in no more than so many.
Fingerprints have many bits, because at a similarity of 0.8 about 15 % of them differ, and
shards are no blocks of those bits, because none that is worth shuffling would agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .support import as_bytes, cut, gathered, per_text, tidy

#: Words of a shingle, and the similarity from which texts are linked.
WIDTH, SIMILARITY = 5, 0.8
SEED = 7
#: At 0.8 a pair shares no band with probability (1 - 0.8 ** 6) ** 40 < 1e-5; above, less.
BANDS, BAND_ROWS = 40, 6
#: At 0.8 a pair of sets of six shingles or more differs in 165 bits at most, on average, with a
#: deviation of 12; sets of four and five shingles in 192.
BITS, RADIUS = 1024, 240
#: Bits of parities for a shingle, about, and for a set, at least and at most.
PARITY_BITS, LEAST_BITS, MOST_BITS = 4, 256, 1 << 16
#: Shingles that are permuted at once, so that the products stay in the cache.
CHUNK = 256
#: Rows of one tree; a larger shard is cut into parts, and each pair of parts is a group.
TREE_ROWS = 4096
#: Bands that are searched first: they join most families before the others are looked at.
FIRST_BANDS = 5
#: Each round takes finds up to this many times as many as the one before.
GROWTH = 8
#: Rows with shingles that are worth a task.
SHINGLE_ROWS = 2048
#: Ids that are sent to every task on purpose, at most.
BROADCAST_IDS = 200_000


def shingle_hashes(data: bytes | None, width: int, seed: int) -> np.ndarray:
    """Hash of each run of ``width`` words, A-Z lower-cased; of all words if there are fewer."""
    words = (data or b"").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    text = memoryview(b" ".join(words))
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1)
    starts = ends - sizes - 1
    width = min(width, len(words))
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[: len(words) - width + 1].tolist(), (ends[width - 1 :] - 1).tolist())
    return np.array([digest(text[a:b], seed) for a, b in spans], np.uint64)


def permutations() -> np.ndarray:
    """Odd factors; a product with one of them permutes the 64-bit hashes."""
    rng = np.random.default_rng(SEED)
    return rng.integers(0, 1 << 64, (BANDS * BAND_ROWS, 1), np.uint64) | np.uint64(1)


def bands(hashes: np.ndarray, factors: np.ndarray) -> list[int]:
    """One key for each band of minima; none for a text without a word."""
    if not len(hashes):
        return []
    least = np.full(len(factors), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), CHUNK):
        np.minimum(least, (factors * hashes[at : at + CHUNK]).min(axis=1), out=least)
    digest = xxhash.xxh64_intdigest
    keys = [digest(least[i : i + BAND_ROWS].tobytes(), i) for i in range(0, len(least), BAND_ROWS)]
    return np.array(keys, np.uint64).view(np.int64).tolist()


def mixed(values: np.ndarray) -> np.ndarray:
    """64-bit numbers well mixed, each bit depending on all."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def words_of_bits() -> tuple[np.ndarray, np.ndarray]:
    """What makes a shingle's hash into the words of its bits, and the bits that break ties."""
    step = np.uint64(0x9E3779B97F4A7C15)
    salts = mixed(np.arange(1, BITS // 64 + 1, dtype=np.uint64) * step)
    ties = np.unpackbits(mixed(salts + step).view(np.uint8))
    return salts, ties.astype(np.int64)


def fingerprint(hashes: np.ndarray, salts: np.ndarray, ties: np.ndarray) -> bytes:
    """SimHash of a set: the majority of each bit; a draw goes as for every other set."""
    ones = np.zeros(BITS, np.int64)
    # counts of so many rows fit into a byte
    for at in range(0, len(hashes), 255):
        rows = mixed(hashes[at : at + 255, None] ^ salts)
        ones += np.unpackbits(rows.view(np.uint8), axis=1).sum(axis=0, dtype=np.uint8)
    return np.packbits(4 * ones + 2 * ties - 1 > 2 * len(hashes)).tobytes()


def parities(hashes: np.ndarray) -> bytes:
    """Odd sketch of a set: for each remainder of the hashes, whether an odd number has it.

    The number of bits is a power of two that grows with the set, so that few shingles which
    are in only one of two similar sets meet in a bit and hide each other.
    """
    size = LEAST_BITS
    while size < min(MOST_BITS, PARITY_BITS * len(hashes)):
        size *= 2
    counts = np.bincount((hashes & np.uint64(size - 1)).astype(np.int64), minlength=size)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def difference(a: int, a_size: int, b: int, b_size: int) -> int:
    """Shingles that are in only one of two sets, at least: never more than there are.

    The larger of two sketches of so many bits is folded to the size of the other one.
    """
    while a_size != b_size:
        if a_size < b_size:
            a, a_size, b, b_size = b, b_size, a, a_size
        a_size //= 2
        a = (a >> a_size) ^ (a & ((1 << a_size) - 1))
    return (a ^ b).bit_count()


def _sketched(width: int, keys: bool, shingles: bool):
    fields = {"id": pa.binary()}
    if keys:
        fields |= {"bands": pa.list_(pa.int64()), "fp": pa.binary(), "odd": pa.binary(), "n": pa.int64()}
    if shingles:
        fields["shingles"] = pa.list_(pa.int64())
    kind = pa.struct(list(fields.items()))

    def make():
        factors, (salts, ties) = permutations(), words_of_bits()

        def apply(batch):
            rows = []
            for data in batch:
                # np.unique sorts, so equal sets have equal bytes
                hashes = np.unique(shingle_hashes(data, width, SEED))
                row = {"id": xxhash.xxh128_digest(hashes.tobytes())}
                if keys:
                    row["bands"] = bands(hashes, factors)
                    row["fp"] = fingerprint(hashes, salts, ties)
                    row["odd"], row["n"] = parities(hashes), len(hashes)
                if shingles:
                    row["shingles"] = hashes.view(np.int64)
                rows.append(row)
            return pa.array(rows, kind)

        return apply

    parts = ["id:binary"] + ["bands:array<long>", "fp:binary", "odd:binary", "n:long"] * keys + ["shingles:array<long>"] * shingles
    return per_text(make, f"struct<{','.join(parts)}>")


def shingle_set(text: str = "text", width: int = WIDTH):
    """Column: 128-bit name of the set of shingles of a text."""
    return _sketched(width, False, False)(as_bytes(text))["id"]


def similar_texts(
    docs: DataFrame, width: int = WIDTH, similarity: float = SIMILARITY
) -> DataFrame:
    """``set, first_id, root`` of each set of shingles among ``doc_id, text``.

    ``first_id`` is the smallest id with the set, and ``root`` is equal for the sets that
    links reach.  Texts without a word have the empty set, which is linked to no other.
    """
    if not SIMILARITY <= similarity <= 1:
        raise ValueError("bands and radius are made for similarities from 0.8 to 1")
    found = docs.select("doc_id", _sketched(width, True, False)(as_bytes("text")).alias("_s"))
    sets = found.groupBy(F.col("_s.id").alias("set")).agg(
        F.min("doc_id").alias("first_id"),
        *[F.any_value(f"_s.{name}").alias(name) for name in ("bands", "fp", "odd", "n")],
    )
    # the checkpoint keeps these numbers
    sets = cut(sets.withColumn("node", F.monotonically_increasing_id()))
    nodes = sets.select("set", "first_id", "node")
    members = sets.select("node", F.posexplode("bands").alias("turn", "band"))
    shared = members.groupBy("band").agg(F.count("*").alias("_n")).where("_n > 1")
    members = members.join(shared, "band").select("band", "turn", "node", F.col("_n").alias("rows"))
    # similar sets differ in so many shingles, at most, as both their rooms hold
    room = F.col("n") * (1 - similarity) / (1 + similarity)
    members = cut(members.join(sets.select("node", "fp", "odd", room.alias("room")), "node"))
    roots = _joined(docs, nodes, members, width, similarity)
    if roots is None:
        return nodes.select("set", "first_id", F.col("node").alias("root"))
    return nodes.join(roots, "node", "left").select(
        "set", "first_id", F.coalesce("root", "node").alias("root")
    )


class Tree:
    """A BK-tree over long fingerprints, which gives what is within a radius one by one."""

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

    def within(self, value: int, radius: int) -> Iterator[int]:
        """Places of the values at most ``radius`` away, always in the same order."""
        todo = [0] if self.values else []
        while todo:
            node = todo.pop()
            distance = (value ^ self.values[node]).bit_count()
            if distance <= radius:
                yield node
            low, high = distance - radius, distance + radius
            todo += [child for d, child in self.children[node].items() if low <= d <= high]


def candidates(members: DataFrame, first: int, last: int, closest: bool = False) -> DataFrame:
    """``band, a, b, more``: what searches of each shard find from number ``first`` to ``last``.

    Only the closest one of a search, if asked for: it is the likeliest to be similar.

    ``members`` has ``band, node, fp, odd, room, rows, root``.  Each row asks the tree of the rows
    before it (and those of other parts, in a large shard).  A find is within the radius, and its
    parities do not rule out that it is similar.  ``more`` tells that a search has finds
    behind ``last``, or others than the closest one.  Pairs of one root are known to be joined and left out; only those up to
    ``last`` are counted.
    """
    parts = F.ceil(F.col("rows") / TREE_ROWS).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    placed = members.withColumn("parts", parts).withColumn("own", own)
    # only the rows of a large shard go to several groups
    others = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    alone = placed.where("parts = 1").withColumn("other", F.lit(0))
    placed = alone.unionByName(placed.where("parts > 1").withColumn("other", others))
    cells = placed.select(
        "band", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
        (F.col("own") > F.col("other")).alias("asks"), "node", "fp", "odd", "room", "root",
    )
    group = ["band", "low", "high"]
    ordered = cells.repartition(*group).sortWithinPartitions(*group, "asks", "node")
    schema = "band long, a long, b long, more boolean"

    def run(batches):
        held, tree, planted, out = None, Tree(), [], []
        for batch in batches:
            for band, low, high, asks, node, fp, odd, room, root in zip(*(c.to_pylist() for c in batch.columns)):
                if (band, low, high) != held:
                    held, tree, planted = (band, low, high), Tree(), []
                value = int.from_bytes(fp, "little")
                bits, size = int.from_bytes(odd, "little"), 8 * len(odd)
                if asks or low == high:
                    finds, number = [], 0
                    for place in tree.within(value, RADIUS):
                        other, other_root, other_bits, other_size, other_room = planted[place]
                        if number >= last and other_root == root:
                            continue
                        if difference(bits, size, other_bits, other_size) > room + other_room + 1e-5:
                            continue
                        if number >= last:
                            out.append((band, None, None, True))
                            break
                        if number >= first and other_root != root:
                            finds.append(((value ^ tree.values[place]).bit_count(), other))
                        number += 1
                    if closest and len(finds) > 1:
                        out.append((band, None, None, True))
                        finds = [min(finds)]
                    out += [(band, min(node, other), max(node, other), False) for _, other in finds]
                if not asks:
                    tree.add(value)
                    planted.append((node, root, bits, size, room))
            if out:
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.bool_()]
                columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["band", "a", "b", "more"])
                out = []
        del tree, planted
        tidy()

    return ordered.mapInArrow(run, schema)


def _joined(docs, nodes, members, width: int, similarity: float) -> DataFrame | None:
    """``node, root`` of the components of all pairs that are similar; None without any.

    A round takes one find of each search, the next those up to the eighth, then up to the
    64th and so on: first only the closest one of them, then all, if that has not joined the
    shard.  Shards whose members earlier links join as a whole are left out, so a family of
    near copies costs a few comparisons a member.  A tree has at most TREE_ROWS rows, so there
    are few rounds, and after the last one every pair within the radius is joined or was
    compared.

    Links of earlier rounds go on as stars, a link from each node to its root.  Rounds are many
    and get ever smaller, so each step has as many tasks as its rows are worth.
    """
    shingles, roots, searched, first, closest = None, None, None, 0, False
    rows = members.count()
    placed = gathered(members, rows).withColumn("root", F.col("node"))
    while True:
        whole = placed.groupBy("band").agg(F.min("root").alias("_low"), F.max("root").alias("_high"))
        whole = whole.where("_low < _high")
        if searched is not None:
            whole = whole.join(searched, "band", "left_semi")
        placed = placed.join(whole, "band").drop("_low", "_high")
        placed, searched = cut(gathered(placed, rows)), None
        rows = placed.count()
        if not rows:
            return roots
        placed = gathered(placed, rows)
        # the first round runs twice: over some bands, then over all that are left
        early = shingles is None
        last = max(1, GROWTH * first)
        some = placed.where(F.col("turn") < FIRST_BANDS) if early else placed
        found = cut(candidates(some, first, last, closest))
        finds = found.count()
        found = gathered(found, finds)
        pairs = found.where(~F.col("more")).select("a", "b").distinct()
        if early:
            shingles = cut(_shingles(docs, nodes, placed, width))
            shingles = gathered(shingles, shingles.count(), SHINGLE_ROWS)
        fresh = cut(_confirmed(gathered(pairs, finds), shingles, similarity))
        if not early:
            # shards, not their rows, are held against those with finds left
            searched = found.where("more").select("band").distinct()
            first = first if closest else last
        # behind the first find, the closest ones go before all
        closest = not early and not closest
        links = fresh.count()
        if links:
            stars = 0 if roots is None else roots.count()
            if stars:
                fresh = fresh.unionByName(roots.select(F.col("root").alias("a"), F.col("node").alias("b")))
            roots = connected_components(gathered(fresh, links + stars))
            roots = cut(gathered(roots, links + stars))
            own = roots.withColumnRenamed("root", "_root")
            placed = placed.join(own, "node", "left").withColumn("root", F.coalesce("_root", "node")).drop("_root")
            placed = gathered(placed, rows)


def _shingles(docs, nodes, members, width: int) -> DataFrame:
    """``node, n, shingles`` of the nodes in shards, taken from a text of their smallest id."""
    wanted = cut(nodes.join(members.select("node").distinct(), "node", "left_semi"))
    ids = wanted.select(F.col("first_id").alias("doc_id")).distinct()
    # few ids go to the texts; otherwise Spark joins by shuffle
    ids = F.broadcast(ids) if wanted.count() <= BROADCAST_IDS else ids
    # a null id is found by null-safe equality
    texts = docs.join(ids, docs["doc_id"].eqNullSafe(ids["doc_id"]), "left_semi")
    rows = texts.select("doc_id", _sketched(width, False, True)(as_bytes("text")).alias("_s"))
    rows = rows.select("doc_id", F.col("_s.id").alias("set"), F.col("_s.shingles").alias("shingles"))
    same = rows["doc_id"].eqNullSafe(wanted["first_id"]) & (rows["set"] == wanted["set"])
    found = rows.join(wanted, same).groupBy("node").agg(F.any_value("shingles").alias("shingles"))
    return found.withColumn("n", F.size("shingles"))


def _confirmed(pairs: DataFrame, shingles: DataFrame, similarity: float) -> DataFrame:
    """The pairs ``a, b`` whose shingles are similar enough."""
    rows = pairs.count()
    sizes = shingles.select("node", "n")
    known = pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b")
    # texts of too different length need no comparison
    near = known.where(F.least("n_a", "n_b") >= similarity * F.greatest("n_a", "n_b") - 1e-6)
    whole = shingles.select("node", "shingles")
    first = gathered(near.join(whole.toDF("a", "s_a"), "a"), rows, SHINGLE_ROWS)
    both = gathered(first.join(whole.toDF("b", "s_b"), "b"), rows, SHINGLE_ROWS)
    common = F.size(F.array_intersect("s_a", "s_b"))
    enough = common * (1 + similarity) >= similarity * (F.col("n_a") + F.col("n_b")) - 1e-6
    return both.where(enough).select("a", "b")
