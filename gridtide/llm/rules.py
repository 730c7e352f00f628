"""Quality rules: rule statistics of each text, judged by an isolation forest.

Each statistic is taken as its distance outside the range of well-labelled documents, so these
share one point and everything unusual lies apart from it.  The forest is grown on labelled
rows; a document that few random splits isolate is anomalous, and the score from which on it
is rejected is calibrated on the same rows.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .support import LABELLED_ROWS, as_bytes, best_cut, labelled_sample, per_text, with_columns

SPACES = b" \t\n\r\x0b\f"
CONTINUATION = bytes(range(0x80, 0xC0))
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
MARKS = b"!?"
COUNTS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper",
    "n_marks",
)
MIN_WORDS = 50
REPEAT_PERCENT = 50
TREES, SAMPLE, SEED = 100, 64, 11
#: Share of well-labelled rows outside the range on each side, and its margin in widths.
TAIL, MARGIN = 0.001, 0.5


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    n = len(words)
    if n < 4:
        return 0
    index = dict(zip(dict.fromkeys(words), range(n)))
    ids = np.fromiter(map(index.__getitem__, words), np.int64, n)
    size = len(index)
    pairs = ids[:-1] * size + ids[1:]
    if size > 1 << 21:  # three ids no longer fit into 63 bits
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * size + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = np.diff(windows[order]) == 0
    again = np.zeros(n - 2, bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(n, bool)
    for shift in range(3):
        covered[shift : n - 2 + shift] |= again
    return int(np.count_nonzero(covered))


def counts(data: bytes | None) -> tuple[int, ...]:
    """The values of ``COUNTS`` for one UTF-8 text; a null text has none of anything."""
    if not data:
        return (0,) * len(COUNTS)
    words = data.split()
    lines = [line for line in data.split(b"\n") if line and not line.isspace()]
    return (
        len(words),
        len(data.translate(None, SPACES + CONTINUATION)),
        len(data) - len(data.translate(None, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeat_words(words),
        len(lines),
        len(data) - len(data.translate(None, UPPER)),
        len(data) - len(data.translate(None, MARKS)),
    )


def features(table: np.ndarray) -> np.ndarray:
    """Rates that do not depend on the length of a text, one row a document."""
    words, chars, symbols, dup, repeat, lines, upper, marks = table.T.astype(np.float64)
    some, line, letter = np.maximum(words, 1), np.maximum(lines, 1), np.maximum(chars, 1)
    return np.stack(
        [chars / some, symbols / letter, dup / line, repeat / some, upper / letter, marks / letter],
        axis=1,
    )


def excess(rates: np.ndarray, low, high) -> np.ndarray:
    """Distance of each rate outside its range."""
    return np.maximum(rates - high, 0) + np.maximum(low - rates, 0)


def average_path(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search in a binary tree of n rows."""
    n = np.asarray(n, np.float64)
    safe = np.maximum(n, 2)
    path = 2 * (np.log(np.maximum(safe - 1, 1)) + np.euler_gamma) - 2 * (safe - 1) / safe
    return np.where(n > 2, path, np.where(n == 2, 1.0, 0.0))


@dataclass
class Forest:
    """Complete binary trees; a leaf keeps its path length, an inner node its split."""

    feature: np.ndarray
    value: np.ndarray
    leaf: np.ndarray
    depth: int
    scale: float
    low: np.ndarray | float = -np.inf
    high: np.ndarray | float = np.inf
    threshold: float | None = None

    def anomaly(self, rates: np.ndarray) -> np.ndarray:
        return self.scores(excess(rates, self.low, self.high))

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Anomaly of each row, from 0 to 1."""
        trees = np.arange(len(self.feature))
        out = np.empty(len(x))
        for at in range(0, len(x), 4096):
            part = x[at : at + 4096]
            rows = np.arange(len(part))[:, None]
            node = np.zeros((len(part), len(trees)), np.int64)
            for _ in range(self.depth):
                split = self.feature[trees, node]
                right = part[rows, np.maximum(split, 0)] >= self.value[trees, node]
                node = np.where(split < 0, node, 2 * node + 1 + right)
            out[at : at + 4096] = np.exp2(-self.leaf[trees, node].mean(axis=1) / self.scale)
        return out


def grow(x: np.ndarray, trees: int = TREES, sample: int = SAMPLE, seed: int = SEED) -> Forest:
    """An isolation forest over the rows of x, which must be in a fixed order."""
    rng = np.random.default_rng(seed)
    size = min(sample, len(x))
    depth = max(1, int(np.ceil(np.log2(max(size, 2)))))
    nodes = 2 ** (depth + 1) - 1
    feature = np.full((trees, nodes), -1, np.int64)
    value, leaf = np.zeros((trees, nodes)), np.zeros((trees, nodes))
    for t in range(trees):
        todo = [(0, 0, x[rng.choice(len(x), size, replace=False)])]
        while todo:
            node, level, rows = todo.pop()
            low, high = rows.min(axis=0), rows.max(axis=0)
            varied = np.flatnonzero(high > low)
            if level == depth or len(rows) < 2 or not len(varied):
                leaf[t, node] = level + average_path(len(rows))
                continue
            f = rng.choice(varied)
            cut = rng.uniform(low[f], high[f])
            feature[t, node], value[t, node] = f, cut
            right = rows[:, f] >= cut
            if right.all():
                value[t, node] = cut = np.nextafter(cut, np.inf)
                right = rows[:, f] >= cut
            for child, part in ((2 * node + 1, rows[~right]), (2 * node + 2, rows[right])):
                if len(part):
                    todo.append((child, level + 1, part))
                else:
                    leaf[t, child] = level + 1
    return Forest(feature, value, leaf, depth, max(float(average_path(size)), 1.0))


def fit(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Forest | None:
    """Forest and threshold from at most ``rows`` labelled documents.

    None without well-labelled documents: then nothing is anomalous.  Without badly labelled
    ones the forest has no threshold and rejects nothing either.
    """
    sample = labelled_sample(docs, labels, "quality", rows)
    stats = sample.select("_label", counted("text").alias("s")).select("_label", "s.*")
    found = stats.toPandas().sort_values(["_label", *COUNTS])
    found = found[~base_failed(found["n_words"], found["n_repeat_words"])]
    rates, good = features(found[list(COUNTS)].to_numpy()), found["_label"].to_numpy() == 1
    if not good.any():
        return None
    low, high = np.quantile(rates[good], [TAIL, 1 - TAIL], axis=0)
    low, high = low - MARGIN * (high - low), high + MARGIN * (high - low)
    forest = grow(excess(rates, low, high))
    forest.low, forest.high = low, high
    calm = 1 - forest.anomaly(rates)
    edge = best_cut(list(calm[good]), list(calm[~good]))
    forest.threshold = None if edge is None else 1 - edge
    return forest


def base_failed(n_words, n_repeat_words):
    """The fixed rules, for columns of Spark and pandas alike."""
    return (n_words < MIN_WORDS) | (100 * n_repeat_words > REPEAT_PERCENT * n_words)


def counted(text: str):
    """Struct of ``COUNTS`` of a text column."""

    def make():
        def apply(batch):
            table = np.array([counts(x) for x in batch], np.int64).reshape(-1, len(COUNTS))
            return pa.StructArray.from_arrays([pa.array(c) for c in table.T], list(COUNTS))

        return apply

    return per_text(make, ", ".join(f"{c} long" for c in COUNTS))(as_bytes(text))


def judge(docs: DataFrame, forest: Forest | None, text: str = "text") -> DataFrame:
    """Add the counts, ``base_failed``, ``anomaly`` (0 to 1) and ``kept`` to each document.

    * a null or empty text has zero words and fails the base rule;
    * equal texts get equal values, repeated rows stay repeated;
    * an empty table gives an empty result; input columns with a result's name are replaced;
    * texts are read whole; no rate depends on length, so a long clean text is not anomalous.
    """

    def make():
        def apply(batch):
            table = np.array([counts(x) for x in batch], np.int64).reshape(-1, len(COUNTS))
            score = np.zeros(len(table)) if forest is None else forest.anomaly(features(table))
            columns = [*map(pa.array, table.T), pa.array(score)]
            return pa.StructArray.from_arrays(columns, [*COUNTS, "anomaly"])

        return apply

    schema = ", ".join(f"{c} long" for c in COUNTS) + ", anomaly double"
    stats = per_text(make, schema)(as_bytes(text))
    one = with_columns(docs, {"_rules": stats})
    failed = base_failed(F.col("_rules.n_words"), F.col("_rules.n_repeat_words"))
    usable = forest is not None and forest.threshold is not None
    calm = F.col("_rules.anomaly") <= F.lit(forest.threshold) if usable else F.lit(True)
    new = {c: F.col(f"_rules.{c}") for c in (*COUNTS, "anomaly")}
    return with_columns(one, new | {"base_failed": failed, "kept": ~failed & calm}).drop("_rules")
