"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter n-gram is the product of its letters'
vectors, each permuted by its place; a text is the sum of its n-grams, and a language the sum
of its texts scaled to equal length.  The predicted language has the largest cosine.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import as_bytes, per_text, unpacked, with_columns

SIZE, GRAM = 1024, 3
SEED = 29
#: Languages are read into every task; more values of lang than this are no language labels.
MAX_LANGUAGES = 4096
#: Unit vectors are added as integers of this scale, so the order of adding does not matter.
SCALE = 1 << 20
#: Texts whose n-grams are multiplied at once, and letters at which a block is closed.
BLOCK_TEXTS, BLOCK_LETTERS = 256, 1 << 20
#: Distinct n-grams whose vectors are held at once.
BLOCK_GRAMS = 4096
HELD_OUT, FOLDS = 2, 4

_folded: np.ndarray | None = None


def folded() -> np.ndarray:
    """Lower-case letter of every code point; 32 for all that is no letter."""
    global _folded
    if _folded is None:
        table = np.full(0x110000, 32, np.uint32)
        for code in range(0x110000):
            char = chr(code)
            if char.isalpha():
                table[code] = ord(char.lower()[0])
        _folded = table
    return _folded


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """Random +1/-1 rows, a fixed function of the code point (splitmix64 of code and word)."""
    words = np.arange(SIZE // 64, dtype=np.uint64)
    x = codes.astype(np.uint64)[:, None] * np.uint64(SIZE) + words + np.uint64(SEED << 40)
    x = x * np.uint64(0x9E3779B97F4A7C15) + np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    bits = np.unpackbits(x.view(np.uint8).reshape(len(codes), -1), axis=1)
    return (2.0 * bits - 1).astype(np.float32)


def gram_vectors(grams: np.ndarray) -> np.ndarray:
    """Vectors of packed n-grams: letter i is rolled by its distance to the end."""
    out = np.ones((len(grams), SIZE), np.float32)
    for place in range(GRAM):
        code = (grams >> np.uint64(21 * (GRAM - 1 - place))) & np.uint64(0x1FFFFF)
        letters, at = np.unique(code, return_inverse=True)
        out *= np.roll(letter_vectors(letters), GRAM - 1 - place, axis=1)[at]
    return out


def letters_of(data: bytes | None) -> np.ndarray:
    """Folded letters of a text with single spaces around its words; empty without a letter."""
    if not data:
        return np.empty(0, np.uint64)
    codes = np.frombuffer(data.decode("utf-8", "replace").encode("utf-32-le", "replace"), np.uint32)
    low = folded()[codes]
    letter = low != 32
    if not letter.any():
        return np.empty(0, np.uint64)
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    body = low[keep]
    return np.concatenate([[32], body, [32]] if body[-1] != 32 else [[32], body]).astype(np.uint64)


def bundles(batch: list):
    """Blocks ``(first, vectors)``: the summed n-grams of consecutive texts, zero without letter."""
    first = 0
    while first < len(batch):
        packed, owner, size, last = [], [], 0, first
        while last < len(batch) and last - first < BLOCK_TEXTS and size < BLOCK_LETTERS:
            x = letters_of(batch[last])
            if len(x) >= GRAM:
                packed.append(x[:-2] << np.uint64(42) | x[1:-1] << np.uint64(21) | x[2:])
                owner.append(np.full(len(x) - 2, last - first, np.int64))
            size += len(x)
            last += 1
        out = np.zeros((last - first, SIZE), np.float32)
        if packed:
            grams, at = np.unique(np.concatenate(packed), return_inverse=True)
            owner = np.concatenate(owner)
            for part in range(0, len(grams), BLOCK_GRAMS):
                width = min(BLOCK_GRAMS, len(grams) - part)
                chosen = (at >= part) & (at < part + width)
                cells = owner[chosen] * width + at[chosen] - part
                table = np.bincount(cells, minlength=len(out) * width).reshape(len(out), width)
                out += table.astype(np.float32) @ gram_vectors(grams[part : part + width])
        yield first, out
        first = last


@dataclass
class Profiles:
    languages: list[str]
    vectors: np.ndarray

    def predict(self, batch: list) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for _, vectors in bundles(batch):
            length = np.linalg.norm(vectors.astype(np.float64), axis=1)
            cosine = vectors.astype(np.float64) @ self.vectors.T / np.maximum(length, 1e-9)[:, None]
            for row, size in zip(cosine, length):
                best = int(row.argmax()) if size and len(row) else -1
                names.append(self.languages[best] if best >= 0 else "und")
                scores.append(min(1.0, max(0.0, float(row[best]))) if best >= 0 else 0.0)
        return names, scores


def fold_of(key: str):
    """Fold of a document by the crc32 of its id as text; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % FOLDS, F.lit(0))


def fit(docs: DataFrame, text: str = "text", lang: str = "lang") -> Profiles:
    """Profiles of all languages, from every labelled text.

    A task sends one integer vector for each language it has seen, so what is shuffled depends
    on tasks and languages, not on texts.
    """

    def run(batches):
        sums: dict[str, np.ndarray] = {}
        for texts, names in unpacked(batches):
            for first, vectors in bundles(texts):
                length = np.linalg.norm(vectors, axis=1)
                whole = np.rint(vectors / np.maximum(length, 1e-9)[:, None] * SCALE).astype(np.int64)
                for i in np.flatnonzero(length):
                    name = names[first + i]
                    sums[name] = sums.get(name, 0) + whole[i]
            if len(sums) > 64:
                yield from sent(sums)
                sums = {}
        yield from sent(sums)

    def sent(sums):
        for name, vector in sums.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * SIZE), pa.array(range(SIZE), pa.int32()), pa.array(vector)],
                ["lang", "place", "v"],
            )

    labelled = docs.where(F.col(lang).isNotNull()).select(as_bytes(text), lang)
    found = labelled.mapInArrow(run, "lang string, place int, v long")
    sums = found.groupBy("lang", "place").agg(F.sum("v").alias("v"))
    rows = sums.limit(MAX_LANGUAGES * SIZE + 1).toPandas()
    if len(rows) > MAX_LANGUAGES * SIZE:
        raise ValueError(f"more than {MAX_LANGUAGES} values of {lang}")
    rows = rows.sort_values(["lang", "place"])
    vectors = rows["v"].to_numpy(np.float64).reshape(-1, SIZE)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1), 1e-9)[:, None]
    return Profiles(sorted(rows["lang"].unique()), vectors)


def predict(docs: DataFrame, profiles: Profiles, text: str = "text") -> DataFrame:
    """Add ``lang_pred`` and ``score`` (cosine, 0 to 1) to each document.

    * null, empty and letterless texts are ``und`` with score 0, as are all texts if no
      language was learned; of equal cosines the alphabetically first language is taken;
    * equal texts get equal results, repeated rows stay repeated, texts are read whole;
    * an empty table gives an empty result; input columns with a result's name are replaced.
    """

    def make():
        def apply(batch):
            names, scores = profiles.predict(batch)
            return pa.StructArray.from_arrays(
                [pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
            )

        return apply

    found = per_text(make, "lang_pred string, score double")(as_bytes(text))
    one = with_columns(docs, {"_lang": found})
    new = {c: F.col(f"_lang.{c}") for c in ("lang_pred", "score")}
    return with_columns(one, new).drop("_lang")
