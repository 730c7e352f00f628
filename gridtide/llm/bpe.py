"""Byte-level BPE with forced boundaries.

A pair of bytes that occurs inside no token can never be merged across.  Where such a pair is
some byte before a white-space byte, the pre-tokenizer's pattern also starts afresh, so a text
is cut there and the fragments are encoded independently, each distinct one once; inside a
pre-token every such pair is a further cut.  The parts are merged side by side in arrays and
their ids concatenated.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import as_bytes, per_text, with_columns

#: The pre-tokenizer of byte-level vocabularies (fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
SPACES = b"\t\n\x0b\x0c\r "
#: Distinct fragments a worker remembers, about.
REMEMBERED = 100_000
#: Parts up to this many bytes are merged as rows of an array, so many cells at once.
WIDE, CELLS = 64, 1 << 17
NEVER = np.int32(2**31 - 1)

#: Marks that stand alone behind letters.
MARKS = frozenset(".,;:!?")

_pretokens = regex.compile(PATTERN)
#: The same pattern for texts of ASCII bytes only.
_ascii_pretokens = re.compile(
    rb"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
)
_fragments = re.compile(rb"[\t-\r ]*[^\t-\r ]+|[\t-\r ]+")


def byte_alphabet() -> dict[str, int]:
    """Byte for each character that byte-level vocabularies write.

    Printable bytes stand for themselves; the others are numbered from code point 256 on.
    """
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def pretokens(fragment: bytes) -> list[bytes]:
    """Matches of the pattern; letters, with a space before and a mark behind, need no search."""
    if fragment.isascii():
        core = fragment[1:] if fragment[0] == 32 else fragment
        if core.isalpha():
            return [fragment]
        return _ascii_pretokens.findall(fragment)
    text = fragment.decode("utf-8", "replace")
    core = text[1:] if text[0] == " " else text
    if core.isalpha():
        return [fragment]
    if core[-1:] in MARKS and core[:-1].isalpha():
        return [fragment[:-1], fragment[-1:]]
    return [p.encode() for p in _pretokens.findall(text)]


class Vocabulary:
    """Tokens, merges and the byte pairs that occur inside tokens, read from tokenizer JSON."""

    def __init__(self, source: str):
        model = json.loads(source)
        letters = byte_alphabet()
        added = {t["content"].encode(): t["id"] for t in model["added_tokens"]}
        ids = {
            bytes(letters[c] for c in token): i
            for token, i in model["model"]["vocab"].items()
            if token.encode() not in added
        }
        self.added = added
        tokens = [b""] * (max([*ids.values(), *added.values()]) + 1)
        for token, i in [*ids.items(), *added.items()]:
            tokens[i] = token
        self.inside = np.zeros((256, 256), bool)
        for token in ids:
            x = np.frombuffer(token, np.uint8)
            self.inside[x[:-1], x[1:]] = True
        self.single = np.array([ids[bytes([b])] for b in range(256)], np.int32)
        pairs = {}
        for rank, merge in enumerate(model["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            a, b = (bytes(letters[c] for c in side) for side in (left, right))
            pairs[ids[a] << 32 | ids[b]] = (rank, ids[a + b])
        self.keys = np.array(sorted(pairs), np.int64)
        self.ranks = np.array([pairs[k][0] for k in self.keys.tolist()] + [NEVER], np.int32)
        self.merged = np.array([pairs[k][1] for k in self.keys.tolist()] + [0], np.int32)
        a, b = np.divmod(np.arange(1 << 16), 256)
        self.byte_pairs = self.look(self.single[a], self.single[b]).reshape(256, 256)
        #: Pairs of another byte and a white-space byte that a token does contain.
        self.unsafe = [bytes([a, b]) for b in SPACES for a in np.flatnonzero(self.inside[:, b]) if a not in SPACES]
        self.text = Joined(tokens)
        self.decimal = Joined([b"%d," % i for i in range(len(tokens))])
        self.known: dict[bytes, bytes] = {}
        self.older: dict[bytes, bytes] = {}

    # -------------------------------------------------------------- cutting

    def fragments(self, data: bytes) -> list[bytes]:
        """Data cut where a byte and a following white-space byte occur together in no token."""
        found = _fragments.findall(data)
        if any(pair in data for pair in self.unsafe):
            joined: list[bytes] = []
            for part in found:
                if joined and self.inside[joined[-1][-1], part[0]]:
                    joined[-1] += part
                else:
                    joined.append(part)
            return joined
        return found

    # ------------------------------------------------------------- encoding

    def look(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Place of each pair among the merges; the last place for pairs that do not merge."""
        key = a.astype(np.int64) << 32 | b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), at, len(self.keys)).astype(np.int32)

    def merge_rows(self, data: np.ndarray, used: np.ndarray) -> np.ndarray:
        """Ids (padded by -1) of rows of bytes, always merging the first pair of lowest rank."""
        ids = np.where(used, self.single[data], np.int32(-1))
        at = np.where(used[:, 1:], self.byte_pairs[data[:, :-1], data[:, 1:]], np.int32(len(self.keys)))
        rank, rows = self.ranks[at], np.arange(len(ids))
        work, active = ids, rows
        columns = np.arange(ids.shape[1])
        while True:
            first = rank.argmin(axis=1)
            some = rank[np.arange(len(work)), first] != NEVER
            if not some.all():
                ids[active[~some]] = work[~some]
                work, rank, at, first, active = (x[some] for x in (work, rank, at, first, active))
            if not len(work):
                return ids
            here = np.arange(len(work))
            new = self.merged[at[here, first]]
            source = np.minimum(columns + (columns > first[:, None]), ids.shape[1] - 1)
            moved = np.take_along_axis(work, source, axis=1)
            moved[:, -1] = -1
            moved[here, first] = new
            # a pair moves with its left token
            at = np.take_along_axis(at, np.minimum(source[:, :-1], at.shape[1] - 1), axis=1)
            at[:, -1] = len(self.keys)
            work = moved
            after = np.minimum(first + 1, ids.shape[1] - 1)
            right = np.where(first + 1 < ids.shape[1], work[here, after], -1)
            inner = np.minimum(first, at.shape[1] - 1)
            at[here, inner] = self.look(new, right)
            before = np.maximum(first - 1, 0)
            left = np.where(first > 0, work[here, before], -1)
            at[here, before] = np.where(first > 0, self.look(left, new), at[here, before])
            rank = self.ranks[at]

    def merge_long(self, part: bytes) -> list[int]:
        """The same for one part of any length, by a heap of pairs over a linked list."""
        ids = self.single[np.frombuffer(part, np.uint8)].tolist()
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        heap = []

        def push(i):
            j = after[i]
            key = ids[i] << 32 | ids[j]
            at = int(np.searchsorted(self.keys, key)) if j >= 0 else len(self.keys)
            if at < len(self.keys) and self.keys[at] == key:
                heapq.heappush(heap, (int(self.ranks[at]), i, ids[i], ids[j], int(self.merged[at])))

        for i in range(n - 1):
            push(i)
        while heap:
            _, i, a, b, new = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j], after[i] = new, -1, after[j]
            if after[j] >= 0:
                before[after[j]] = i
            if before[i] >= 0:
                push(before[i])
            push(i)
        return [x for x in ids if x >= 0]

    def encode_new(self, fragments: list[bytes]) -> list[bytes]:
        """Ids, as little-endian 32-bit integers, of fragments not seen yet."""
        pieces, sizes = [], []
        for fragment in fragments:
            own = pretokens(fragment)
            pieces += own
            sizes.append(len(own))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        starts = np.cumsum([0, *map(len, pieces)])[:-1]
        cut = np.zeros(len(data) + 1, bool)
        cut[starts], cut[-1] = True, True
        cut[1:-1] |= ~self.inside[data[:-1], data[1:]]
        edges = np.flatnonzero(cut)
        lengths = np.diff(edges)
        # a part has at most as many ids as bytes: each is written from where its bytes begin
        flat = np.full(len(data), -1, np.int32)
        for width in (1, 2, 4, 8, 16, 32, WIDE):
            chosen = np.flatnonzero((lengths <= width) & (lengths > width // 2))
            for k in range(0, len(chosen), CELLS // width):
                own = chosen[k : k + CELLS // width]
                place = edges[own][:, None] + np.arange(width)
                used = np.arange(width) < lengths[own][:, None]
                rows = data[np.minimum(place, len(data) - 1)]
                ids = self.merge_rows(rows, used) if width > 1 else self.single[rows]
                flat[place[used]] = ids[used]
        for i in np.flatnonzero(lengths > WIDE).tolist():
            ids = self.merge_long(data[edges[i] : edges[i + 1]].tobytes())
            flat[edges[i] : edges[i] + len(ids)] = ids
        filled = flat >= 0
        found = flat[filled].tobytes()
        count = np.concatenate([[0], np.cumsum(filled)]) * 4
        firsts = np.concatenate([starts, [len(data)]])[np.cumsum([0, *sizes])]
        ends = count[firsts].tolist()
        return [found[a:b] for a, b in zip(ends, ends[1:])]

    def encode(self, batch: Iterable[bytes | None]) -> list[np.ndarray]:
        """Token ids of whole texts; a null text has none."""
        split: list[list] = []
        for data in batch:
            split.append([data or b""])
            for token, i in self.added.items():
                cutup: list = []
                for part in split[-1]:
                    if isinstance(part, bytes) and token in part:
                        for k, piece in enumerate(part.split(token)):
                            cutup += [i, piece] if k else [piece]
                    else:
                        cutup.append(part)
                split[-1] = cutup
        lists = [
            [f for part in parts for f in (self.fragments(part) if isinstance(part, bytes) else [part])]
            for parts in split
        ]
        seen: set = set()
        for found in lists:
            seen.update(found)
        new = [f for f in seen if f not in self.known and isinstance(f, bytes)]
        if len(self.known) + len(new) > REMEMBERED // 2:
            # what was not used since the last turn is forgotten
            self.known, self.older = {}, self.known
            new = [f for f in seen if isinstance(f, bytes)]
        again = [f for f in new if f in self.older]
        self.known.update(zip(again, map(self.older.__getitem__, again)))
        new = [f for f in new if f not in self.older]
        if new:
            self.known.update(zip(new, self.encode_new(new)))
        for i in self.added.values():
            self.known[i] = np.array([i], "<i4").tobytes()
        look = self.known.__getitem__
        return [np.frombuffer(b"".join(map(look, found)), "<i4") for found in lists]

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of ids, special tokens included; bytes that are no UTF-8 are replaced."""
        data = self.text.of(ids)
        try:
            data.decode()
        except UnicodeDecodeError:
            return data.decode("utf-8", "replace").encode()
        return data


class Joined:
    """Strings by number, concatenated in arrays."""

    def __init__(self, strings: list[bytes]):
        self.size = np.array([len(s) for s in strings], np.int64)
        self.start = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(strings), np.uint8)

    def of(self, ids: np.ndarray) -> bytes:
        size = self.size[ids]
        shift = self.start[ids] - (np.cumsum(size) - size)
        place = np.arange(int(size.sum())) + np.repeat(shift, size)
        return self.data[place].tobytes()


FIELDS = "ids array<int>, n_tokens long, ids_sha256 string, decoded_sha256 string"


def encode(
    docs: DataFrame, path: str, text: str = "text", ids: bool = True
) -> DataFrame:
    """Add ``n_tokens, ids_sha256, decoded_sha256`` and, if wanted, ``ids`` to each document.

    ``path`` names a tokenizer JSON the driver can read; its content, a few MB whatever the
    corpus, goes to the tasks.

    * a null or empty text has no tokens, and its digests are those of nothing;
    * the text of an added token is that token, as the vocabulary says;
    * equal texts get equal ids, repeated rows stay repeated, texts are encoded whole;
    * an empty table gives an empty result; input columns with a result's name are replaced.
    """
    with open(path, encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = FIELDS if ids else FIELDS.partition(", ")[2]
    names = [f.split()[0] for f in fields.split(", ")]

    def make():
        # built for each task, so that workers at rest do not hold one each
        words = Vocabulary(source.value)

        def apply(batch):
            found = {n: [] for n in ("ids", *names)}
            for own in words.encode(batch):
                text_ids = words.decimal.of(own)[:-1]
                if ids:
                    found["ids"].append(own)
                found["n_tokens"].append(len(own))
                found["ids_sha256"].append(hashlib.sha256(text_ids).hexdigest())
                found["decoded_sha256"].append(hashlib.sha256(words.decode(own)).hexdigest())
            kinds = {"ids": pa.list_(pa.int32()), "n_tokens": pa.int64()}
            arrays = [pa.array(found[n], kinds.get(n, pa.string())) for n in names]
            return pa.StructArray.from_arrays(arrays, names)

        return apply

    one = with_columns(docs, {"_bpe": per_text(make, fields)(as_bytes(text))})
    return with_columns(one, {n: F.col(f"_bpe.{n}") for n in names}).drop("_bpe")


def decode(docs: DataFrame, path: str, ids: str = "ids", text: str = "text") -> DataFrame:
    """Replace or add ``text``: what the token ids stand for; null ids give a null text."""
    with open(path, encoding="utf-8") as file:
        source = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Vocabulary(source.value)
        for batch in batches:
            rows = (None if x is None else words.decode(np.array(x, np.int64)).decode() for x in batch.to_pylist())
            yield pa.array(rows, pa.string())

    run.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return with_columns(docs, {text: F.arrow_udf(run, "string")(F.col(ids))})
