"""Token counts, whitening and phrases against libraries and brute force."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from gridtide.llm import collocations, queries, tokencounts, whitening

FOLDER = "/root/testdata/sf0.001"
PIECES = public_tokenizers.path(queries.PIECES)
ODD = "doc_id long, text string, lang string, N_TOKENS string, _key int"


def docs_of(spark, texts):
    rows = [(i % 7 or None, text, None, "x", i) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, ODD)


# ----------------------------------------------------------------------- 13


def odd_texts():
    rng = random.Random(2)
    parts = ["a", " ", "  ", "▁", "\n", "\t", "é", "日本", "<s>", "</s>", "<unk>", "<0x0A>", "\u0000", "😀", "the ", "12"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(12))) for _ in range(400)]
    return [*texts, None, "", " ", "▁", "a b", "a▁b", "word " * 30_000, None, ""]


@pytest.mark.parametrize("name", ["piece_bpe_32k.model", "byte_bpe_50k.json", "word_bpe_49k.json"])
def test_counts_equal_the_library(spark, tmp_path, name):
    path = public_tokenizers.path(name)
    texts = odd_texts()
    docs = docs_of(spark, texts)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor

        count = SentencePieceProcessor(model_file=path).encode
    else:
        from tokenizers import Tokenizer

        library = Tokenizer.from_file(path)
        count = lambda text: library.encode(text, add_special_tokens=False).ids
    found = tokencounts.token_counts(docs, path, str(tmp_path / "store"), limit=5)
    assert found.columns == ["doc_id", "text", "lang", "_key", "n_bytes", "n_tokens", "over_limit"]
    got = {r["_key"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in found.collect()}
    want = {}
    for i, text in enumerate(texts):
        n = len(count(text or ""))
        want[i] = (len((text or "").encode()), n, n > 5)
    assert got == want


def test_only_new_texts_are_encoded(spark, tmp_path):
    cache, tokenizer = str(tmp_path / "store"), tokencounts.Tokenizer(PIECES)

    def keyed(texts):
        content = tokenizer.normal(F.col("text"))
        docs = docs_of(spark, texts).select(content.alias("content"))
        return docs.select(F.unhex(F.sha2(F.col("content").cast("binary"), 256)).alias("digest"), "content")

    assert tokencounts.add_missing(keyed(["x", "x", "a b", "a▁b", None, ""]), tokenizer, cache) == 3
    assert tokencounts.add_missing(keyed(["x", "a b", "new"]), tokenizer, cache) == 1
    assert tokencounts.add_missing(keyed([""]), tokenizer, cache) == 0
    assert tokencounts.token_counts(docs_of(spark, ["x"]).limit(0), PIECES, cache).count() == 0
    assert spark.read.parquet(cache).count() == 4
    # counts of another version are not looked at, and a digest stored twice counts once
    other = tokencounts.Tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    assert tokencounts.add_missing(keyed(["x"]), other, cache) == 1
    spark.read.parquet(cache).coalesce(1).write.mode("append").partitionBy("version").parquet(cache)
    assert tokencounts.stored(spark, cache, tokenizer.version()).count() == 4
    assert tokencounts.token_counts(docs_of(spark, ["x", "x"]), PIECES, cache).count() == 2


def test_many_misses_go_by_shuffle(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tokencounts, "BROADCAST_ROWS", 3)
    texts = [f"text {i % 50}" for i in range(200)]
    found = tokencounts.token_counts(docs_of(spark, texts), PIECES, str(tmp_path / "store"))
    plain = tokencounts.token_counts(docs_of(spark, texts), PIECES, str(tmp_path / "store"))
    assert sorted(map(str, found.collect())) == sorted(map(str, plain.collect())) and found.count() == 200


# ----------------------------------------------------------------------- 11


@pytest.mark.parametrize("seed", range(20))
def test_rank_one_updates(seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 40))
    d = np.sort(rng.choice([0.0, 1.0, 2.0, 1e-9, 1e6], k) if seed % 2 else rng.random(k) * 10.0 ** rng.integers(-6, 6))
    u = np.linalg.qr(rng.normal(size=(k, k)))[0]
    v = rng.normal(size=k) * (rng.random(k) < 0.7) * 10.0 ** rng.integers(-8, 4)
    rho = float(10.0 ** rng.integers(-3, 3))
    whole = u @ np.diag(d) @ u.T + rho * np.outer(v, v)
    got, turned = whitening.rank_one(d, u, rho, v)
    size = max(np.abs(whole).max(), 1e-300)
    assert np.abs(turned @ np.diag(got) @ turned.T - whole).max() <= 1e-12 * size * k
    assert np.abs(turned.T @ turned - np.eye(k)).max() < 1e-12 and (np.diff(got) >= 0).all()


def whitened_by_numpy(x, components=4):
    fit = np.unique(x, axis=0).astype(object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = (fit - sums / n).astype(float)
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    order = np.argsort(-values)[:components]
    order = order[values[order] > 1e-9 * values.max()]
    scores = ((x - sums / n).astype(float)) @ vectors[:, order] / np.sqrt(values[order])
    deviations = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(row, sums)) for row in x]
    return n, scores, values[order] / values.sum(), deviations


def test_whitening_equals_numpy(spark, monkeypatch):
    monkeypatch.setattr(whitening, "FAN", 2)
    rng = np.random.default_rng(3)
    x = np.floor(rng.normal(size=(500, 9)) * [1, 90, 3, 700, 20, 40, 0.1, 250, 5]).astype(np.int64)
    x[:, 2] = 2 * x[:, 4]  # rank is not full
    x[400:] = x[7]
    rows = [(i, v.tolist(), "note") for i, v in enumerate(x)] + [(-1, None, None), (None, x[0].tolist(), None)]
    vectors = spark.createDataFrame(rows, "vec_id long, x array<long>, COMPONENT string").repartition(7)
    model = whitening.fit(vectors)
    got = whitening.whitened(vectors, model).toPandas()
    n, scores, explained, deviations = whitened_by_numpy(x)
    assert len(got) == 4 * 501 and set(got["n"]) == {n} == {len(np.unique(x, axis=0))}
    table = got[got["vec_id"].notna()].pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    table = table * np.sign((table * scores).sum(axis=0))
    assert np.abs(table - scores).max() < 1e-9
    assert np.allclose(got.groupby("component")["explained"].first(), explained, rtol=1e-10)
    assert got["identity_error"].nunique() == 1 and got["identity_error"].iloc[0] < 1e-10
    first = got[(got["component"] == 1) & got["vec_id"].notna()].set_index("vec_id")["deviation"]
    assert [first[i] for i in range(500)] == deviations


def test_whitening_of_little(spark):
    def run(rows, components=4):
        vectors = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "vec_id long, x array<long>")
        return whitening.whitened(vectors, whitening.fit(vectors, components)).orderBy("vec_id", "component").collect()

    assert run([None]) == [] and run([[1, 2]]) == [] and run([[1, 2]] * 3) == [] and run([[]]) == []
    two = run([[0, 0], [2, 0], [2], [0, 0]])
    assert [(r["vec_id"], r["component"], r["n"], r["deviation"]) for r in two] == [
        (0, 1, 2, 4), (1, 1, 2, 4), (2, 1, 2, 4), (3, 1, 2, 4)]
    assert [abs(round(r["whitened"], 12)) for r in two] == [1.0] * 4 and two[0]["explained"] == 1.0
    # exact where 64 bits do not suffice on the way, null where they do not for the result
    big = run([[3 * 10**9 + 1, 0], [3 * 10**9, 0], [0, 0], [-(4 * 10**9), 1]])
    sums, n = [2 * 10**9 + 1, 1], 4
    want = [(n * (3 * 10**9 + 1) - sums[0]) ** 2 + 1, None, sums[0] ** 2 + 1, None]
    assert want[0] >= 2**63 and {r["vec_id"]: r["deviation"] for r in big}[2] == want[2]
    assert {r["vec_id"]: r["deviation"] for r in big}[0] is None
    assert run([[1, 2, 3], [4, 5, 7], [0, 1, 1]], 2)[-1]["component"] == 2
    model = whitening.fit(spark.createDataFrame([(1, [1]), (2, [5])], "vec_id long, x array<long>"))
    longer = spark.createDataFrame([(1, [1, 2])], "vec_id long, x array<long>")
    with pytest.raises(Exception, match="reshape|size"):
        whitening.whitened(longer, model).collect()


# ----------------------------------------------------------------------- 12


def phrases_by_counting(rows, least, top):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            words = [w for w in re.split("[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for m in range(1, 5):
                counts[lang].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    want = []
    for lang, found in counts.items():
        kept = []
        for phrase, a in found.items():
            if len(phrase) < 2 or a < least:
                continue
            cuts = [(2_000_000 * a // (found[phrase[:k]] + found[phrase[k:]]), k) for k in range(1, len(phrase))]
            score, k = min(cuts)
            around = [f for p, f in found.items() if len(p) > len(phrase) and f >= least
                      and any(p[i : i + len(phrase)] == phrase for i in range(len(p)))]
            if not any(100 * f >= 80 * a for f in around):
                kept.append((-score, -a, " ".join(phrase).encode(), found[phrase[:k]], found[phrase[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            want.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(want)


@pytest.mark.parametrize("group, block, small", [(1 << 20, 1 << 20, 64), (40, 300, 2), (3, 60, 1)])
def test_phrases_equal_counting(spark, monkeypatch, group, block, small):
    monkeypatch.setattr(collocations, "GROUP_SUFFIXES", group)
    monkeypatch.setattr(collocations, "BLOCK_WORDS", block)
    monkeypatch.setattr(collocations, "SMALL", small)
    rng = random.Random(9)
    words = ["A", "b", "c d", "É", "e", "hot", "hot", "pair", "pair", "x\x1cy", "日本"]
    gaps = [" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n", "\x0b", " ; "]
    rows = [("".join(rng.choice(words) + rng.choice(gaps) for _ in range(rng.randrange(60))), rng.choice(["en", "de", None, "und", ""]))
            for _ in range(250)]
    rows += [(None, "en"), ("", "de"), (" .,\t", "fr"), ("hot pair " * 900, "en"), ("hot pair " * 900, "en"), (None, None)]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("N", F.lit(1))
    got = sorted(map(tuple, collocations.collocations(docs, least=5, top=40).collect()))
    assert got == phrases_by_counting(rows, 5, 40)
    assert collocations.collocations(docs.limit(0)).count() == 0
    assert collocations.collocations(docs.where("text is null")).count() == 0


@pytest.mark.parametrize("seed", range(10))
def test_quicksort_counts(seed):
    rng = np.random.default_rng(seed)
    rows = rng.integers(0, 6, (800, 4)).astype(np.int32)
    rows[:, 0] += 1
    for d in range(1, 4):
        rows[rows[:, d - 1] == 0, d] = 0
    n = rng.integers(1, 5, 800)
    want = Counter()
    for row, size in zip(rows.tolist(), n.tolist()):
        for depth in range(1, 5):
            if row[depth - 1]:
                want[tuple(row[:depth])] += size
    for whole in (1, 2, 3):
        got = [(tuple(p.tolist()), s) for p, s in collocations.quicksort(rows, n, whole, 12)]
        assert len(got) == len(set(got))
        assert dict(got) == {p: s for p, s in want.items() if s >= 12 or len(p) < whole}


def test_scores_are_exact_beyond_64_bits(spark):
    rows = [(3 * 10**17, 10**18 + 7), (7, 3), (1, 2_000_001)]
    got = spark.createDataFrame(rows, "a long, below long").select(collocations.floored(F.col("a"), F.col("below")))
    assert [r[0] for r in got.collect()] == [2_000_000 * a // b for a, b in rows]
