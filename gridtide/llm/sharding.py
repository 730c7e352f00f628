"""Sharding by histogram sort: shards of nearly equal bytes, sorted by a hash of the text.

Candidate boundaries probe the key range.  In each round the bytes below all candidates are
counted exactly over all partitions, and only the cells in which a boundary must lie are probed
again, 64 times finer, until every boundary meets its tolerance.  Then the rows are exchanged
once.  DataFrame operations only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import cut, spare, with_columns

SHARDS = 8
#: A shard boundary may be off by this share of a shard.
TOLERANCE = 0.001
#: Parts of the sort key with their bits: hash of the text, id, place of the row.
PARTS = (("h", 60), ("i", 64), ("m", 64))
FIRST_BITS, NEXT_BITS = 12, 6
#: Rows of one sorted part, about, and parts of a shard at most.
PART_ROWS, MAX_PARTS = 100_000, 512
LEAST = -(2**63)


def _digits(bits: int) -> int:
    return -(-bits // 4)


@dataclass(frozen=True)
class Probe:
    """Cells of one round: whole parts of the key, and a prefix of the next part."""

    part: int
    bits: int

    @property
    def hidden(self) -> int:
        """Bits of the part that the prefix leaves open."""
        return PARTS[self.part][1] - self.bits

    def finer(self) -> Probe | None:
        if self.hidden:
            return Probe(self.part, min(PARTS[self.part][1], self.bits + NEXT_BITS))
        return Probe(self.part + 1, NEXT_BITS) if self.part + 1 < len(PARTS) else None

    def cell(self) -> Column:
        """Ordered like the key: hex digits of equal length."""
        texts = []
        for name, bits in PARTS[: self.part + 1]:
            # flipping the sign bit makes signed order unsigned order
            value = F.col(name).bitwiseXOR(F.lit(LEAST)) if bits == 64 else F.col(name)
            if name == PARTS[self.part][0]:
                value = F.shiftrightunsigned(value, self.hidden)
            texts.append(F.lpad(F.hex(value), _digits(bits), "0"))
        return F.concat(*texts)

    def values(self, cell: str) -> list[int]:
        """Unsigned values of the parts a cell names; the last one is a prefix."""
        found, at = [], 0
        for _, bits in PARTS[: self.part + 1]:
            found.append(int(cell[at : at + _digits(bits)], 16))
            at += _digits(bits)
        return found

    def key(self, values: list[int]) -> tuple[int, ...]:
        """The least key with these values of its first parts."""
        whole = values + [0] * (len(PARTS) - len(values))
        return tuple(v + LEAST if bits == 64 else v for v, (_, bits) in zip(whole, PARTS))

    def bound(self, cell: str) -> tuple[int, ...]:
        """First key of a cell."""
        values = self.values(cell)
        return self.key([*values[:-1], values[-1] << self.hidden])

    def end(self, cell: str) -> tuple[int, ...]:
        """First key behind a cell."""
        values = self.values(cell)
        values[-1] = (values[-1] + 1) << self.hidden
        for part in range(self.part, 0, -1):
            if values[part] >> PARTS[part][1]:
                values[part] = 0
                values[part - 1] += 1
        return self.key(values)

    def holds(self, cell: str) -> str:
        """Name, in this round, of the cell that a cell of the next round lies in."""
        width = sum(_digits(bits) for _, bits in PARTS[: self.part + 1])
        if len(cell) > width:
            return cell[:width]
        last = _digits(PARTS[self.part][1])
        step = min(NEXT_BITS, self.hidden)
        return cell[:-last] + f"{int(cell[-last:], 16) >> step:0{last}X}"


def sort_key(key: str, text: str) -> dict[str, Column]:
    """60 bits of a hash of the text, then the id; the place of a row is added where needed."""
    return {
        "h": F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 4),
        "i": F.coalesce(F.col(key).cast("long"), F.lit(LEAST)),
        "m": F.lit(LEAST),
    }


def splitters(keys: DataFrame, shards: int, parts: int, tolerance: float) -> list[tuple[int, ...]]:
    """First key of each of the ``shards * parts`` parts but the first, in order.

    Every ``parts``-th one bounds a shard and meets the tolerance, or lies beside a single row
    that is too large for it; the others only need to keep parts at a part's size.
    """
    total, rows = keys.agg(F.sum("size"), F.count("*")).first()
    n = shards * parts
    probe = Probe(0, FIRST_BITS)
    if not rows:
        return [probe.key([])] * (n - 1)
    slack = tolerance * total / shards
    targets = {j: total * j / n for j in range(1, n)}
    found: dict[int, tuple[int, ...]] = {}
    previous, cells = None, {None: 0}
    while targets:
        cell = probe.cell()
        level = keys
        if None not in cells:
            level = keys.where(previous.cell().isin([c for c in cells]))
        counted = level.groupBy(cell.alias("cell")).agg(F.sum("size").alias("size"), F.count("*").alias("n"))
        # at most one cell a boundary is probed, so rows here are bounded by parts and bits
        found_cells: dict = {}
        for row in counted.collect():
            up = None if None in cells else previous.holds(row["cell"])
            found_cells.setdefault(up, []).append((row["cell"], row["size"], row["n"]))
        finer, again = probe.finer(), {}
        for up, below in cells.items():
            for name, size, count in sorted(found_cells.get(up, [])):
                inside = [j for j, t in targets.items() if below <= t < below + size]
                for j in inside:
                    before, after = targets[j] - below, below + size - targets[j]
                    limit = slack if j % parts == 0 else total / n
                    if min(before, after) <= limit or count == 1 or finer is None:
                        found[j] = probe.bound(name) if before <= after else probe.end(name)
                        del targets[j]
                    else:
                        again[name] = below
                below += size
        previous, probe, cells = probe, finer, again
        if probe is None or not cells:
            break
    last = (1 << PARTS[0][1], LEAST, LEAST)
    bounds = [found.get(j, last) for j in range(1, n)]
    for j in range(1, len(bounds)):
        bounds[j] = max(bounds[j], bounds[j - 1])
    return bounds


def part_of(bounds: list[tuple[int, ...]], key: Column) -> Column:
    """Number of boundaries at or below a key, by binary search in a constant array."""
    if not bounds:
        return F.lit(0)
    names = [name for name, _ in PARTS]
    known = F.array(*[F.struct(*[F.lit(v).cast("long").alias(n) for n, v in zip(names, b)]) for b in bounds])
    # after each step the answer lies between the two numbers
    steps = F.sequence(F.lit(1), F.lit(len(bounds).bit_length()))

    def halve(state, _):
        middle = F.floor((state["low"] + state["high"]) / 2).cast("int")
        inside = state["low"] < state["high"]
        below = inside & (key < known[F.least(middle, F.lit(len(bounds) - 1))])
        return F.struct(
            F.when(inside & ~below, middle + 1).otherwise(state["low"]).alias("low"),
            F.when(below, middle).otherwise(state["high"]).alias("high"),
        )

    start = F.struct(F.lit(0).alias("low"), F.lit(len(bounds)).alias("high"))
    return F.aggregate(steps, start, halve)["low"]


def sharded(
    docs: DataFrame,
    shards: int = SHARDS,
    tolerance: float = TOLERANCE,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Add ``size, text_crc32, shard, slot``: shards of nearly equal bytes, slots without gaps.

    Slots follow the sort key, so equal texts stand side by side; a group of equal texts is
    divided by id where a boundary falls into it, and rows equal in text and id, if together
    they are more than the tolerance, by their places.  Places are read from a written copy
    of the rows, which every later pass sees alike; without such rows none is written.

    * a null text has no bytes, size 1 and the crc of nothing, like an empty one;
    * a null id sorts before all others;
    * fewer rows than shards leave shards empty; an empty table gives an empty result;
      input columns with a result's name are replaced, all others stay.
    """
    data = F.coalesce(F.col(text), F.lit("")).cast("binary")
    size = (F.length(data) + 1).cast("long")
    (name,) = spare(docs, "_key")
    order = [n for n, _ in PARTS]

    def keyed(rows: DataFrame, own: dict[str, Column]) -> DataFrame:
        return rows.withColumn(name, F.struct(*[own[n].alias(n) for n in order]))

    own = keyed(docs, sort_key(key, text))
    keys = cut(own.select(*[F.col(name)[n].alias(n) for n in order], size.alias("size")))
    rows, total = keys.agg(F.count("*"), F.sum("size")).first()
    heavy = keys.groupBy("h", "i").agg(F.sum("size").alias("size"), F.count("*").alias("n"))
    heavy = heavy.where((F.col("n") > 1) & (F.col("size") > tolerance * (total or 0) / shards))
    # as many as tolerances fit into the whole, at most
    heavy = cut(heavy.select(F.struct("h", "i").alias("same")))
    if not heavy.isEmpty():
        stored, (mark,) = cut(docs), spare(docs, "_mark")
        parts = sort_key(key, text)
        same = F.struct(parts["h"].alias("h"), parts["i"].alias("i"))
        known = F.broadcast(heavy.select(F.col("same").alias(mark)))
        place = F.monotonically_increasing_id()
        (at,) = spare(docs, "_at")
        joined = stored.withColumn(at, place).join(known, same == F.col(mark), "left")
        m = F.when(F.col(mark).isNotNull(), F.col(at)).otherwise(F.lit(LEAST))
        own = keyed(joined, parts | {"m": m}).drop(mark, at)
        keys = cut(own.select(*[F.col(name)[n].alias(n) for n in order], size.alias("size")))
    parts = max(1, min(MAX_PARTS, -(-rows // (shards * PART_ROWS))))
    bounds = splitters(keys, shards, parts, tolerance)
    part = part_of(bounds, F.struct(*order))
    counts = keys.groupBy(part.alias("part")).count()
    at_part, at_shard, start = spare(own, "_part", "_shard", "_start")
    before = Window.partitionBy(at_shard).orderBy(at_part).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        F.col("part").alias(at_part), F.floor(F.col("part") / parts).cast("int").alias(at_shard), "count"
    )
    starts = starts.withColumn(start, F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    placed = own.withColumn(at_part, part_of(bounds, F.col(name))).join(starts, at_part)
    in_order = Window.partitionBy(at_part).orderBy(name)
    slot = (F.col(start) + F.row_number().over(in_order) - 1).cast("long")
    found = {"size": size, "text_crc32": F.crc32(data), "shard": F.col(at_shard), "slot": slot}
    return with_columns(placed, found).drop(name, at_part, at_shard, start)
