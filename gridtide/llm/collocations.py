"""Phrase collocations by multikey quicksort of suffixes.

Every word starts a suffix of up to four words.  Suffixes are routed by their leading words, so
that all that begin alike meet; there a three-way quicksort partitions pointers to them word by
word.  The size of an equal partition is the count of the phrase its suffixes share, and a
partition that is too small for a phrase is left unsorted.

How many words lead is found by counting: a word (or two, or three) that begins too many
suffixes for one group leads together with the word behind it.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import chain, count
from math import ceil, log2

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import as_bytes, cut, unpacked

#: Words of the longest phrase.
LONGEST = 4
#: Occurrences a phrase needs; rows in the report of a language.
LEAST, TOP = 30, 2000
#: A phrase goes if a longer one around it occurs this often, as parts of its own occurrences.
ABSORBED, OF = 80, 100
SCALE = 2_000_000
UNKNOWN = "und"
#: Words that a task holds at once, and suffixes of one routed group, about.
BLOCK_WORDS, GROUP_SUFFIXES = 1 << 21, 1 << 20
#: Buckets in which suffixes are counted by their leading words: powers of two.
FEWEST_BUCKETS, MOST_BUCKETS = 12, 22
#: Partitions this small are sorted and counted in one step.
SMALL = 1 << 12

#: Every mark that ends a piece is written as a comma, which no word can hold.
END = b","
_MARKS = bytes.maketrans(b".;:!?\n\x0b\x0c\r\t", END * 9 + b" ")


def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """``lang, words, ids``: texts of one language as word numbers, with 0 behind each piece.

    ``words[0]`` is the end of a piece.  A block ends with a whole text; what it holds is
    bounded by BLOCK_WORDS and one text.
    """
    index, ids, held = {}, {}, 0

    def close():
        for lang, own in index.items():
            yield lang, list(own), np.fromiter(chain(ids[lang], (0,) * LONGEST), np.int32)

    for part in unpacked(batches):
        for text, lang in zip(*part):
            if lang not in index:
                index[lang], ids[lang] = defaultdict(count().__next__), []
                index[lang][END]  # number 0
            number, found = index[lang].__getitem__, ids[lang]
            before = len(found)
            found += map(number, text.lower().translate(_MARKS).replace(END, b" , ").split())
            found.append(0)
            held += len(found) - before
            if held >= BLOCK_WORDS:
                yield from close()
                index, ids, held = {}, {}, 0
    yield from close()


def hashes(lang: str, words: list[bytes]) -> np.ndarray:
    seed = xxhash.xxh64_intdigest(lang.encode())
    return np.array([xxhash.xxh64_intdigest(w, seed) for w in words], np.uint64)


def extended(lead: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of leading words and one more."""
    mixed = (lead ^ (lead >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9) + word
    return (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)


def suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct suffixes of a block as rows of word numbers, 0 behind their end, and counts."""
    first = ids[:-1].astype(np.int64)
    second = np.where(first > 0, ids[1:], 0)
    pairs, pair = np.unique(first << 32 | second, return_inverse=True)
    pair = pair.reshape(-1)
    nothing = int(np.searchsorted(pairs, 0))
    at = np.flatnonzero(first[:-2] > 0)
    rest = np.where(second[at] > 0, pair[at + 2], nothing)
    both, n = np.unique(pair[at] << 32 | rest, return_counts=True)
    halves = [pairs[both >> 32], pairs[both & 0xFFFFFFFF]]
    columns = [f(x) for x in halves for f in (lambda v: v >> 32, lambda v: v & 0xFFFFFFFF)]
    return np.stack(columns, axis=1).astype(np.int32), n


def places(ids: np.ndarray) -> list[np.ndarray]:
    """The first, second, ... of the leading words at each word, 0 behind the end of its piece."""
    at = np.flatnonzero(ids[:-LONGEST] > 0)
    found = [ids[at]]
    for step in range(1, LONGEST - 1):
        found.append(np.where(found[-1] > 0, ids[at + step], 0))
    return found


def leading(columns: list[np.ndarray], known: np.ndarray) -> list[np.ndarray]:
    """Hashes of the first one, two, ... words; ``known`` are those of words."""
    found = [known[columns[0]]]
    for column in columns[1:]:
        found.append(extended(found[-1], known[column]))
    return found


def heat(docs: DataFrame, bits: int) -> DataFrame:
    """Suffixes by bucket of their first ``depth`` words; depth 0 has the words of a language."""

    def run(batches):
        table = np.zeros((LONGEST - 1, 1 << bits), np.int64)
        totals: dict[str, int] = defaultdict(int)
        for lang, words, ids in blocks(batches):
            rows = places(ids)
            totals[lang] += len(rows[0])
            for depth, value in enumerate(leading(rows, hashes(lang, words))):
                bucket = (value >> np.uint64(64 - bits)).astype(np.int64)
                table[depth] += np.bincount(bucket, minlength=1 << bits)
        yield _heat_batch(list(totals), [0] * len(totals), [0] * len(totals), list(totals.values()))
        for depth, row in enumerate(table, 1):
            at = np.flatnonzero(row)
            yield _heat_batch([None] * len(at), np.full(len(at), depth), at, row[at])

    schema = "lang string, depth int, bucket int, n long"
    found = docs.mapInArrow(run, schema)
    return found.groupBy("lang", "depth", "bucket").agg(F.sum("n").alias("n"))


def _heat_batch(lang, depth, bucket, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(lang, pa.string()), pa.array(depth, pa.int32()), pa.array(bucket, pa.int32()), pa.array(n, pa.int64())],
        ["lang", "depth", "bucket", "n"],
    )


ROUTED = "lang string, depth int, cell long, words binary, ids array<int>, n array<int>"


def routed(docs: DataFrame, hot: list[list[int]], bits: int, cells: int) -> DataFrame:
    """Suffixes of each block, a row for each group they are routed to.

    ``depth`` is the number of leading words that the suffixes of a group share the routing
    by; ``words`` are joined by spaces; ``ids`` has the places among them, from 1, of all first words, then of all second ones and
    so on: they come in order, so the long runs of equal numbers take little room in a shuffle.
    """

    def run(batches):
        marks = np.zeros((LONGEST - 1, 1 << bits), bool)
        for depth, found in enumerate(hot):
            marks[depth, found] = True
        for lang, words, ids in blocks(batches):
            rows, n = suffixes(ids)
            if not len(rows):
                continue
            leads = leading(list(rows.T), hashes(lang, words))
            depth, route, going = np.ones(len(rows), np.int64), leads[0].copy(), np.ones(len(rows), bool)
            for d in range(LONGEST - 1):
                going &= marks[d, (leads[d] >> np.uint64(64 - bits)).astype(np.int64)]
                depth[going], route[going] = d + 2, leads[d + 1][going]
            cell = (route % np.uint64(cells)).astype(np.int64)
            group = depth * cells + cell
            order = np.argsort(group, kind="stable")
            ends = np.flatnonzero(np.diff(group[order], append=-1)) + 1
            yield from _routed_batches(lang, words, rows[order], n[order], depth[order], cell[order], ends)

    return docs.mapInArrow(run, ROUTED)


def _routed_batches(lang, words, rows, n, depth, cell, ends) -> Iterator[pa.RecordBatch]:
    held, number = np.zeros(len(words), bool), np.zeros(len(words), np.int32)
    first = 0
    for some in np.array_split(ends, max(1, len(ends) // 256)):
        begin, own, places = first, [], []
        for end in some:
            part = rows[first:end]
            held[part] = True
            held[0] = False  # the end of a piece has no entry in the words
            used = np.flatnonzero(held)
            held[used] = False
            number[used] = np.arange(1, len(used) + 1)
            own.append(b" ".join(map(words.__getitem__, used.tolist())))
            places.append(number[part].T.reshape(-1))
            first = end
        offsets = np.append(begin, some) - begin
        counts = n[begin:first]
        heads = some - 1
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([lang] * len(some), pa.string()),
                pa.array(depth[heads], pa.int32()),
                pa.array(cell[heads], pa.int64()),
                pa.array(own, pa.binary()),
                pa.ListArray.from_arrays((offsets * LONGEST).astype(np.int32), pa.array(np.concatenate(places))),
                pa.ListArray.from_arrays(offsets.astype(np.int32), pa.array(counts, pa.int32())),
            ],
            ["lang", "depth", "cell", "words", "ids", "n"],
        )


def quicksort(rows: np.ndarray, n: np.ndarray, whole: int, least: int) -> Iterator[tuple[np.ndarray, int]]:
    """Phrases (as word numbers) and their counts, from suffixes that occur ``n`` times each.

    Phrases of at least ``whole`` words have all their suffixes here: those below ``least`` are
    left out, with all that begins with them.  Shorter ones have others elsewhere, and
    all are returned.
    """
    todo = [(np.arange(len(rows)), 0)]
    while todo:
        at, depth = todo.pop()
        complete = depth + 1 >= whole
        if not len(at) or complete and int(n[at].sum()) < least:
            continue
        key = rows[at, depth]
        if len(at) > SMALL:
            pivot = np.partition(key[:: len(key) // 9], 4)[4]
            todo += [(at[key < pivot], depth), (at[key > pivot], depth)]
            at, key = at[key == pivot], key[:0]
            firsts, sizes = np.zeros(1, np.int64), n[at].sum(keepdims=True)
        else:
            order = np.argsort(key, kind="stable")
            at, key = at[order], key[order]
            firsts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            sizes = np.add.reduceat(n[at], firsts)
        ends = np.append(firsts[1:], len(at))
        words = rows[at[firsts], depth]
        taken = (words > 0) & (sizes >= least) if complete else words > 0
        for i in np.flatnonzero(taken).tolist():
            same = at[firsts[i] : ends[i]]
            yield rows[same[0], : depth + 1], int(sizes[i])
            if depth + 1 < rows.shape[1]:
                todo.append((same, depth + 1))


class Group:
    """The suffixes routed to one group, with their own word numbers."""

    def __init__(self):
        self.index = defaultdict(count(1).__next__)
        self.rows, self.n, self.held, self.limit = [], [], 0, 2 * GROUP_SUFFIXES

    def add(self, words: list[bytes], ids: np.ndarray, n: np.ndarray) -> None:
        number = np.fromiter(chain((0,), map(self.index.__getitem__, words)), np.int32)
        self.rows.append(number[ids.reshape(LONGEST, -1).T])
        self.n.append(n.astype(np.int64))
        self.held += len(n)
        if self.held > self.limit:
            self.combine()
            self.limit = 2 * max(self.held, GROUP_SUFFIXES)

    def combine(self) -> None:
        """One row for each distinct suffix."""
        rows, n = np.concatenate(self.rows), np.concatenate(self.n)
        order = np.lexsort(rows.T[::-1])
        rows, n = rows[order], n[order]
        first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
        self.rows, self.n, self.held = [rows[first]], [np.add.reduceat(n, first)], len(first)

    def phrases(self, whole: int, least: int) -> Iterator[tuple[bytes, int, int]]:
        """Text, words and count of each phrase."""
        words = [b"", *self.index]
        rows, n = np.concatenate(self.rows), np.concatenate(self.n)
        for phrase, size in quicksort(rows, n, whole, least):
            yield b" ".join([words[i] for i in phrase.tolist()]), len(phrase), size


def phrase_counts(docs: DataFrame, least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of all phrases that occur often enough, and ``lang, n``.

    ``docs`` has ``text, lang``.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN))
    texts = docs.where("text is not null").select(as_bytes("text").alias("text"), lang.alias("lang"))
    # about a word in five bytes; the estimate only sets the sizes of groups
    words = (texts.agg(F.sum(F.length("text"))).first()[0] or 0) // 5
    cells = max(1, ceil(words / GROUP_SUFFIXES))
    bits = min(MOST_BUCKETS, max(FEWEST_BUCKETS, ceil(log2(8 * cells))))
    limit = max(GROUP_SUFFIXES, 4 * words >> bits)
    counted = cut(heat(texts, bits))
    totals = counted.where("depth = 0 and n > 0").select("lang", "n")
    # at most three quarters of the buckets, and few unless all words are equally common
    hot: list[list[int]] = [[] for _ in range(LONGEST - 1)]
    for row in counted.where((F.col("depth") > 0) & (F.col("n") > limit)).collect():
        hot[row["depth"] - 1].append(row["bucket"])

    def run(batches):
        held, group, out = None, None, []

        def close():
            if group is not None:
                for phrase, words, size in group.phrases(held[1], least):
                    out.append((held[0], phrase, words, size))

        def batch():
            kinds = [pa.string(), pa.binary(), pa.int32(), pa.int64()]
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            return pa.RecordBatch.from_arrays(columns, ["lang", "phrase", "words", "f"])

        for part in batches:
            keys = zip(*(part.column(i).to_pylist() for i in range(3)))
            texts, ids, counts = (part.column(i) for i in range(3, 6))
            for i, key in enumerate(keys):
                if key != held:
                    close()
                    held, group = key, Group()
                    if len(out) > 1 << 14:
                        yield batch()
                        out.clear()
                words = texts[i].as_py().split(b" ")
                group.add(words, ids[i].values.to_numpy(), counts[i].values.to_numpy())
        close()
        if out:
            yield batch()

    keys = ["lang", "depth", "cell"]
    # partitions grow in number with the words, and not in size
    sent = routed(texts, hot, bits, cells).repartition(cells, *keys).sortWithinPartitions(*keys)
    parts = sent.mapInArrow(run, "lang string, phrase binary, words int, f long")
    counts = parts.groupBy("lang", F.col("phrase").cast("string").alias("phrase"), "words")
    return cut(counts.agg(F.sum("f").alias("f")).where(F.col("f") >= least)), totals


def floored(a: Column, below: Column) -> Column:
    """``floor(SCALE * a / below)`` of longs, exact beyond 64 bits."""
    wide = F.lit(SCALE).cast("decimal(8,0)") * a.cast("decimal(20,0)")
    return F.call_function("div", wide, below.cast("decimal(20,0)"))


def scored(counts: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of each candidate at its lowest cut."""
    candidates = counts.where("words > 1").withColumnRenamed("f", "a")
    split = F.split("phrase", " ")
    cuts = candidates.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("words") - 1)))
    cuts = cuts.withColumn("left", F.array_join(F.slice(split, 1, F.col("k")), " ")).withColumn(
        "right", F.array_join(F.slice(split, F.col("k") + 1, F.col("words")), " ")
    )
    # every part of a frequent phrase is frequent, so the joins find it
    known = counts.select("lang", "phrase", "f")
    cuts = cuts.join(known.toDF("lang", "left", "l"), ["lang", "left"])
    cuts = cuts.join(known.toDF("lang", "right", "r"), ["lang", "right"])
    lowest = F.min(F.struct(floored(F.col("a"), F.col("l") + F.col("r")).alias("score"), "k", "l", "r"))
    found = cuts.groupBy("lang", "phrase", "words", "a").agg(lowest.alias("cut"))
    return found.select("lang", "phrase", "words", "a", "cut.l", "cut.r", "cut.score")


def absorbing(counts: DataFrame) -> DataFrame:
    """``lang, phrase, longer``: the highest count of a longer phrase around each phrase."""
    split = F.split("phrase", " ")
    longer = counts.where("words > 2")
    sized = longer.withColumn("size", F.explode(F.sequence(F.lit(2), F.col("words") - 1)))
    placed = sized.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)))
    inner = F.array_join(F.slice(split, F.col("first"), F.col("size")), " ")
    return placed.groupBy("lang", inner.alias("phrase")).agg(F.max("f").alias("longer"))


def collocations(
    docs: DataFrame, least: int = LEAST, top: int = TOP, text: str = "text", lang: str = "lang"
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the best phrases of each language.

    A phrase is two to four words of one piece of a text, of which ``a`` are counted, overlaps
    included; cut where that scores least, its parts occur ``l`` and ``r`` times.  ``n`` are
    all words of the language.

    * a null or empty text has no words; a null language is ``und``, one with that name;
    * texts are read whole; repeated rows count again; ids are not read;
    * ties go to the higher count, then to the phrase that is first by bytes;
    * a language without a frequent phrase has no rows; an empty table gives an empty result;
    * other columns are ignored.
    """
    named = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"))
    counts, totals = phrase_counts(named, least)
    wide = "decimal(30,0)"
    gone = F.col("longer").cast(wide) * OF >= F.col("a").cast(wide) * ABSORBED
    kept = scored(counts).join(absorbing(counts), ["lang", "phrase"], "left")
    kept = kept.where(F.col("longer").isNull() | ~gone)
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
