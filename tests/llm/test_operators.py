"""Each operator against brute force or a round trip, and on awkward rows."""

import hashlib
import random
import sys
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline  # noqa: E402
from gridtide.llm import (  # noqa: E402
    bpe, chat, langid, maxscore, mixing, neardup, queries, resampling, rules, sharding, similar, sql,
    support, templates, urls,
)
from gridtide.llm.components import connected_components  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path(queries.VOCABULARY)
DOCS = "doc_id long, text string, lang string, source string, N_WORDS int, kept string"


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and long texts, repeated rows, names that clash."""
    rows = [
        (1, "Hello there world. " * 30, "en", "a", 1, "x"),
        (1, "Hello there world. " * 30, "en", "a", 1, "x"),
        (2, None, "en", None, None, None),
        (3, "", None, "a", 3, "y"),
        (None, "one two", "de", "b", 4, "z"),
        (4, " \n\t ", "fr", "a", 5, ""),
        (5, "wort " * 40_000, "de", "b", 6, None),
        (6, "### $$$ 123", "en", "a", 7, "x"),
    ]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (6, 0, 0), (5, 1, 0), (None, 1, 0), (3, None, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def table(spark, name):
    return spark.read.parquet(f"{FOLDER}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(sql.ORACLES))
def test_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    want = con.execute(sql.ORACLES[name]).df()
    got = queries.QUERIES[name](spark, FOLDER).toPandas()[list(want.columns)]
    assert len(want)
    assert sorted(map(str, got.itertuples(index=False, name=None))) == sorted(
        map(str, want.itertuples(index=False, name=None))
    )


# ------------------------------------------------------------------ 1 and 4


def slow_counts(text):
    words = __import__("re").findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip(" \t\n\r\x0b\f")]
    dup = sum(line in lines[:i] for i, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


@pytest.mark.parametrize("seed", range(40))
def test_rule_counts(seed):
    rng = random.Random(seed)
    text = "".join(rng.choices(["a", "b", "é ", " ", "\n", " ", "x\n", "##", " a b"], k=rng.randrange(60)))
    assert rules.counts(text.encode())[:5] == slow_counts(text)


def test_rules_on_labels_and_odd_rows(spark, odd, labels):
    docs, marks = table(spark, "documents"), table(spark, "labels")
    found = rules.judge(docs, rules.fit(docs, marks)).join(marks, "doc_id").where(~F.col("base_failed"))
    kept = {r["quality"]: r["k"] for r in found.groupBy("quality").agg(F.avg(F.col("kept").cast("int")).alias("k")).collect()}
    assert kept[1] > 0.97 and kept[0] < 0.2
    got = rules.judge(odd, rules.fit(odd, labels)).collect()
    assert len(got) == 8 and not any(r["kept"] for r in got if r["n_words"] < 50)
    assert rules.fit(odd, labels.limit(0)) is None
    assert rules.judge(odd.limit(0), None).count() == 0


def test_forest_isolates_outliers():
    x = np.concatenate([np.random.default_rng(1).normal(size=(500, 3)), [[9.0, 9, 9]]])
    assert rules.grow(x).scores(x).argmax() == 500
    assert rules.grow(np.zeros((3, 2))).scores(np.zeros((1, 2))).shape == (1,)


def test_path_lengths_by_walking():
    rng = np.random.default_rng(4)
    x = np.round(rng.normal(size=(300, 4)), 1)
    forest = rules.grow(x)

    def harmonic_path(n):
        return 0.0 if n < 2 else 1.0 if n == 2 else 2 * (np.log(n - 1) + np.euler_gamma) - 2 * (n - 1) / n

    def depth(tree, node, row, level):
        f = forest.feature[tree, node]
        if f < 0:
            assert forest.leaf[tree, node] >= level
            return forest.leaf[tree, node]
        return depth(tree, 2 * node + 1 + int(row[f] >= forest.value[tree, node]), row, level + 1)

    assert [round(float(rules.average_path(n)), 9) for n in (1, 2, 3, 64)] == [
        round(harmonic_path(n), 9) for n in (1, 2, 3, 64)]
    for row in x[:20]:
        mean = np.mean([depth(t, 0, row, 0) for t in range(len(forest.feature))])
        assert forest.scores(row[None])[0] == pytest.approx(2 ** (-mean / harmonic_path(64)))


def test_query_keeps_what_its_forest_keeps(spark):
    docs, marks = table(spark, "documents"), table(spark, "labels")
    forest = rules.fit(docs, marks)
    got = {r["doc_id"]: r for r in queries.quality_rules(spark, FOLDER).collect()}
    for r in docs.collect():
        counts = rules.counts(r["text"] and r["text"].encode())
        score = float(forest.anomaly(rules.features(np.array([counts])))[0])
        failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
        assert tuple(got[r["doc_id"]])[1:6] == (counts[0], *slow_counts(r["text"])[1:])
        assert got[r["doc_id"]]["kept"] == (not failed and score <= forest.threshold)


def slow_grams(text):
    data = (text or "").encode()
    words = [int.from_bytes(data[i : i + 4], "little") for i in range(len(data) - 3)]
    return [(w * 2654435761 % 2**32) >> 16 for w in words]


def test_resampling_by_hand(spark):
    import math
    rng = random.Random(12)
    good, bad = ["alpha ", "beta ", "gamma "], ["#x1 ", "zz9 ", "beta "]
    texts = ["".join(rng.choices(good if i % 3 else bad, k=rng.choice([3, 40, 400]))) for i in range(60)]
    texts += ["".join(rng.choices(good, k=5000)), None, "", "abc", "abcd"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    marks = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(40)], "doc_id long, quality int")
    ratio = resampling.fit(docs, marks)
    target = [g for i in range(40) if i % 3 for g in slow_grams(texts[i])]
    raw = [g for t in texts for g in slow_grams(t)]

    def share(found):
        return lambda g: 0.98 * found.count(g) / len(found) + 0.02 / 65536

    ratios = {g: math.log(share(target)(g) / share(raw)(g)) for g in set(raw)}
    got = {r["doc_id"]: r for r in resampling.resample(docs, ratio, keep=20).collect()}
    keys = {}
    for i, text in enumerate(texts):
        own = slow_grams(text)
        weight = sum(ratios[g] for g in own)
        assert got[i]["n_grams"] == len(own) and got[i]["log_weight"] == pytest.approx(weight, rel=1e-9, abs=1e-9)
        number = int(hashlib.md5(f"{resampling.SEED}:{i}".encode()).hexdigest()[:13], 16) / 2**52
        noise = -math.log(-math.log((number * 2**52 + 0.5) / 2**52))
        keys[i] = weight + noise
        assert got[i]["gumbel_key"] / resampling.PARTS == pytest.approx(keys[i], abs=1e-5)
    # a text of 5000 words has the log-ratio of all its n-grams
    assert got[60]["n_grams"] > 25_000
    best = sorted(keys, key=lambda i: -keys[i])[:20]
    assert {i for i in got if got[i]["kept"]} == set(best)


def test_resampling(spark, odd, labels):
    docs, marks = table(spark, "documents"), table(spark, "labels")
    found = resampling.resample(docs, resampling.fit(docs, marks), keep=100).toPandas()
    assert found["kept"].sum() == 100
    assert found.loc[found["kept"], "gumbel_key"].min() > found.loc[~found["kept"], "gumbel_key"].max()
    got = resampling.resample(odd, resampling.fit(odd, labels))
    assert got.count() == 8 and got.dtypes[-1] == ("kept", "boolean")
    assert resampling.fit(odd, labels.limit(0)) is None
    assert resampling.resample(odd.limit(0), None).count() == 0


def test_best_cut():
    assert support.best_cut([2.0, 3.0], [0.0, 1.0]) == 1.5
    assert support.best_cut([], [1.0]) is None


# ------------------------------------------------------------------------ 2


def test_aliases(spark):
    def link(to):
        return f'<html><link rel="canonical" href="{to}"></html>'

    rows = [
        (1, "https://a.example.com/x", link("https://www.example.net/bad")),
        (2, "https://b.example.com/y", link("//a.example.com/x")),
        (3, "http://free.example.com/z", '<meta http-equiv="refresh" content="0; url=http://example.net/en/1">'),
        (4, "http://example.net/q", link("http://free.example.com/z")),
        (5, "http://c.example.com/k", "<!-- " + link("http://example.net/") + " -->"),
        (6, None, link("http://example.net/")),
        (7, "no scheme", None),
        (8, "HTTP://EXAMPLE.ORG/fr/é?u=1#t", ""),
        (9, "http://a.example.com/x#part", None),
        (9, "http://a.example.com/x#part", None),
    ]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("RULE", F.lit(1))
    got = {r["page_id"]: (r["host"], r["rule"], r["verdict"]) for r in urls.judge(pages).collect()}
    assert {k: v[2] for k, v in got.items()} == {
        1: "block", 2: "block", 3: "allow", 4: "block", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "block",
    }
    assert got[8] == ("example.org", "org/fr/", "allow") and got[6][0] == got[7][0] == ""
    assert urls.judge(pages).count() == 10 and urls.judge(pages.limit(0)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(40)] + [(100 + i, 101 + i) for i in range(20)]
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    ends = {x for a, b in edges if a != b for x in (a, b)}
    got = connected_components(spark.createDataFrame([*edges, (None, 1)], "a long, b long")).collect()
    assert sorted((r["node"], r["root"]) for r in got) == sorted((x, root(x)) for x in ends)


# ------------------------------------------------------------------------ 3


def test_mixing(spark, odd):
    docs = spark.range(4000).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") < 3000, "big").otherwise("small").alias("source"),
        F.lit("text").alias("text"),
    )
    got = mixing.shuffled(mixing.replicate(docs, {"big": 1.0, "small": 1.0})).toPandas()
    assert sorted(got["position"]) == list(range(len(got)))
    share = got["source"].value_counts(normalize=True)
    assert abs(share["big"] - 0.5) < 0.05 and abs(len(got) - 4000) < 300
    assert (got.groupby("doc_id")["copy"].max() + 1 == got.groupby("doc_id")["copies"].first()).all()
    assert mixing.shuffled(mixing.replicate(odd)).count() >= 0
    assert mixing.replicate(odd.limit(0)).count() == 0
    many = mixing.replicate(docs.limit(40), {"big": 1.0}).select("doc_id").count()
    assert many > 0
    with pytest.raises(ValueError):
        mixing.replicate(odd, {"a": -1.0})


def test_mixing_keeps_clashing_columns(spark):
    names = ["rate", "parts", "_source", "_table", "_rated", "_of", "_mix", "_place", "_bucket", "_before", "_id"]
    docs = spark.range(50).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.lit("text").alias("text"),
        *[F.concat(F.lit(n), F.col("id")).alias(n) for n in names],
    )
    copies = mixing.replicate(docs)
    for found in (mixing.shuffled(copies), mixing.dealt(copies)):
        rows = found.collect()
        assert rows and all(r[n] == f"{n}{r['doc_id']}" for r in rows for n in names)


def test_repeated_and_null_ids_are_spread(spark):
    rows = [(None, i) for i in range(900)] + [(5, i) for i in range(600)] + [(100 + i, i) for i in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, row long").withColumn("copy", F.lit(0)).repartition(6)
    got = mixing.shuffled(docs, bucket_rows=100).toPandas()
    assert sorted(got["position"]) == list(range(2000))
    pairs = [(None if np.isnan(a) else int(a), int(b)) for a, b in zip(got["doc_id"], got["row"])]
    assert Counter(pairs) == Counter(rows)
    null = got.loc[got["doc_id"].isna(), "position"]
    # the null ids stand all over the order
    assert null.min() < 100 and null.max() > 1900 and 800 < null.mean() < 1200
    merging = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(merging, "false")
    try:
        parts = mixing.dealt(docs).select(F.spark_partition_id().alias("p")).toPandas()["p"].value_counts()
    finally:
        spark.conf.set(merging, "true")
    assert parts.sum() == 2000 and parts.max() < 1000


def test_large_rates_are_sums(spark):
    docs = spark.createDataFrame([(i, "s" if i else "t", "x" * (1 if i == 1 else 900)) for i in range(2)], "doc_id long, source string, text string")
    got = mixing.replicate(docs, {"s": 1.0, "t": 1.0}).groupBy("source").count().collect()
    assert 350 < {r["source"]: r["count"] for r in got}["s"] < 550


# ------------------------------------------------------------------------ 5


def test_language(spark, odd):
    docs = table(spark, "documents")
    profiles = langid.fit(docs.where(langid.fold_of("doc_id") != langid.HELD_OUT))
    held = langid.predict(docs, profiles).where(langid.fold_of("doc_id") == langid.HELD_OUT)
    assert held.agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0] > 0.95
    got = {r["doc_id"]: r for r in langid.predict(odd, profiles).collect()}
    assert [got[i]["lang_pred"] for i in (2, 3, 4, 6)] == ["und"] * 4
    assert all(0 <= r["score"] <= 1 for r in got.values())
    none = langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in langid.predict(odd, none).collect()} == {"und"}


def test_profiles_by_hand(spark):
    def letters(text):
        low = "".join(c.lower()[0] if c.isalpha() else " " for c in text)
        return " " + " ".join(low.split()) + " " if low.split() else ""

    def bundle(text):
        low, total = letters(text), np.zeros(langid.SIZE)
        for gram in zip(low, low[1:], low[2:]):
            rows = langid.letter_vectors(np.array([ord(c) for c in gram]))
            total += np.prod([np.roll(row, 2 - i) for i, row in enumerate(rows)], axis=0)
        return total

    learned = [("Der die das, und!", "de"), ("the of And", "en"), ("und der 12 Rest", "de"), ("le la les É", "fr"), ("...", "fr"), (None, "xx"), ("no label", None)]
    docs = spark.createDataFrame(learned, "text string, lang string")
    profiles = langid.fit(docs)
    sums = {}
    for text, lang in learned:
        if lang and text and letters(text):
            own = bundle(text)
            sums[lang] = sums.get(lang, 0) + np.rint(own / np.linalg.norm(own) * langid.SCALE)
    assert profiles.languages == sorted(sums)
    texts = ["der rest", "of the", "Les la", "é", "x1y", "und the la", "日本 語", "  ", None]
    asked = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    for r in langid.predict(asked, profiles).collect():
        own = bundle(texts[r["doc_id"]] or "")
        if not own.any():
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        cosine = {k: own @ v / np.linalg.norm(own) / np.linalg.norm(v) for k, v in sums.items()}
        best = max(sorted(cosine), key=cosine.get)
        assert r["lang_pred"] == best and r["score"] == pytest.approx(min(1, max(0, cosine[best])), abs=1e-5)


# ------------------------------------------------------------------------ 6


@pytest.mark.parametrize("seed", range(30))
def test_chat_round_trip(seed):
    rng = random.Random(seed)
    parts = [*chat.CONTROLS, "\\", "\n", "<", "|", "[", "a", "</s", "s>", "é", " ", "INST]"]
    turns = [
        {"role": rng.choice(["user", "assistant", "x</s>", ""]), "text": "".join(rng.choices(parts, k=rng.randrange(9)))}
        for _ in range(rng.randrange(5))
    ]
    pieces = list(chat.render(iter(turns)))
    assert list(chat.read_turns(t for t, _ in pieces)) == [(t["role"], t["text"]) for t in turns]
    loss = "".join(chat.unescape(t) for t, generated in pieces if generated)
    assert loss == "".join(t["text"] for t in turns if t["role"] == "assistant")


def test_chat_rows(spark):
    rows = [(1, 1, "assistant", "b", 1), (1, 0, "user", "a", 2), (None, None, None, None, 3), (2, 0, "assistant", "x", 4), (2, 0, "assistant", "x", 4)]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, n_turns int")
    got = {r["conv_id"]: r for r in chat.format_digests(chat.with_probe(talk)).collect()}
    assert got[1]["turns_sha256"] == hashlib.sha256(b"user\na\nassistant\nb\n").hexdigest()
    assert (got[2]["n_turns"], got[2]["loss_chars"], got[None]["n_turns"], got[-7]["n_turns"]) == (2, 2, 1, 2)
    assert chat.formatted(talk).count() == 5 and chat.format_digests(talk.limit(0)).count() == 0


def test_formatted_loses_nothing(spark):
    rows = [(c, t, role, f"{role} {c} <s> {t}") for c in (1, 2, None) for t, role in enumerate(["user", "assistant", "user"])]
    talk = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    other = "{% for t in turns %}{{ t.role ~ ': ' }}{% generation %}{{ t.text }}{% endgeneration %}{{ '\\n' }}{% endfor %}{{ 'END' }}"
    for template in (chat.TEMPLATE, other, chat.TEMPLATE + "tail"):
        got = {}
        for r in chat.formatted(talk, template).orderBy("conv_id", "turn_index").collect():
            got[r["conv_id"]] = got.get(r["conv_id"], "") + r["formatted"]
            assert all(0 <= s["start"] < s["end"] <= len(r["formatted"]) for s in r["loss_spans"])
        for conv in (1, 2, None):
            turns = [{"role": r, "text": x} for c, _, r, x in rows if c == conv]
            assert got[conv] == "".join(t for t, _ in chat.render(iter(turns), template))
    with pytest.raises(Exception, match="end with a turn"):
        chat.format_digests(talk, other).collect()


def test_digests_come_from_rows_and_spans():
    rows = [("<|turn|>user<|text|>hi</s>\n", []), ("<|turn|>assistant<|text|>a<\\s>b</s>\n", [{"start": 25, "end": 30}])]
    got = chat.Digest().read(rows)
    assert got[0] == 2 and got[2:4] == (4, hashlib.sha256(b"a<s>").hexdigest()) and got[4] == sum(len(t) for t, _ in rows)
    wrong = chat.Digest().read([rows[0], (rows[1][0], [{"start": 24, "end": 30}])])
    assert wrong[3] != got[3]


def test_templates():
    def run(source, **data):
        return "".join(t for t, _ in templates.compile_template(source, {"up": str.upper})(data))

    assert run("{% set a = 'x' ~ 1 %}{{ a }}{% if a == 'x1' and not b %}y{% elif b %}n{% else %}z{% endif %}", b=False) == "x1y"
    assert run("{% for x in xs %}{{ loop.index }}{{ x.k|up }}{{ ',' if not loop.last else '' }}{% endfor %}", xs=[{"k": "a"}, {"k": "b"}]) == "1A,2B"
    folded = templates.fold(templates.parse("a{{ 'b' ~ 'c' }}{% if 1 == 2 %}x{% else %}d{% endif %}"), {})
    assert folded == templates.Node("block", None, (templates.Node("text", "abcd"),))
    for bad in ("{% if x %}", "{{ a( }}", "{{ x.__class__ }}", "{% for loop in x %}{% endfor %}", "{{ nothing }}", "{{ x|none_such }}"):
        with pytest.raises(templates.TemplateError):
            run(bad, x="text")


# ------------------------------------------------------------------------ 7


def test_bpe_equals_library(spark, odd):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(VOCABULARY)
    words = bpe.Vocabulary(open(VOCABULARY, encoding="utf-8").read())
    rng = random.Random(3)
    parts = ["a", "'s", "'", "!", "  ", "\n\n", "\t", "\r\n", " ", "　", "é", "日本", "12", "don't",
             "<|endoftext|>", "\x1c", "\x85", " the", "=" * 70, "a" * 90, "😀", "é", "\u0000"]
    texts = ["".join(rng.choices(parts, k=rng.randrange(14))) for _ in range(3000)]
    texts += [r["text"] or "" for r in table(spark, "documents").collect()]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    got = words.encode([t.encode() for t in texts])
    assert [x.tolist() for x in got] == want
    assert [words.decode(x).decode() for x in got] == [library.decode(x, skip_special_tokens=False) for x in want]
    coded = bpe.encode(odd, VOCABULARY)
    back = bpe.decode(coded, VOCABULARY, text="back")
    assert back.where("back <> coalesce(text, '')").count() == 0 and back.count() == 8
    assert bpe.encode(odd.limit(0), VOCABULARY).count() == 0


# ------------------------------------------------------------------------ 8


def test_search_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, size=(300, 7))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(300, None), (None, [1] * 7), (301, []), (302, x[0].tolist())]
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>")
    got = maxscore.search(vectors, vectors.where("vec_id % 20 = 0"), k=5).collect()
    full = {i: np.array(v + [0] * (7 - len(v))) for i, v in rows if i is not None and v is not None}
    want = []
    for q in (i for i in full if i % 20 == 0):
        best = sorted((-int(full[q] @ v), i) for i, v in full.items() if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(best)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert maxscore.search(vectors.limit(0), vectors, 5).count() == 0
    bad = [(1, [1.0, None]), (2, [float("nan")]), (3, [float("inf")]), (4, [0.5, -0.1]), (5, None)]
    floats = spark.createDataFrame(bad, "vec_id long, e array<float>")
    assert [r["v"] for r in floats.orderBy("vec_id").select(maxscore.quantized(F.col("e")).alias("v")).collect()] == [
        None, None, None, [128, -26], None,
    ]


@pytest.mark.parametrize("shard, block", [(4096, 4096), (16, 3)])
def test_search_in_whole_numbers_with_repeated_ids(spark, monkeypatch, shard, block):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", shard)
    monkeypatch.setattr(maxscore, "BLOCK_ROWS", block)
    rng = np.random.default_rng(6)
    large = 256 * 60_000
    rows = [(i, [int(v) for v in rng.integers(-large, large, 64)]) for i in range(60)]
    rows += [(3, [10**8 + 1] * 64)] * 2 + [(20, [10**8] * 64), (20, [-(10**8) - 1] * 64)] + [(7, rows[7][1])] * 40
    vectors = spark.createDataFrame(rows, "vec_id long, v array<long>").repartition(5)
    got = maxscore.search(vectors, vectors.where("vec_id % 20 = 0"), k=5).collect()
    want = []
    for q in (0, 20, 40):
        asked = {tuple(v) for i, v in rows if i == q}
        found = sorted((-sum(a * b for a, b in zip(v, x)), i) for v in asked for i, x in rows if i != q)[:5]
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found)]
    assert sorted(map(tuple, got)) == sorted(want)
    assert max(s for *_, s in want) > 2**53
    wide = spark.createDataFrame([(1, [2**62]), (2, [2**62])], "vec_id long, v array<long>")
    with pytest.raises(Exception, match="no long"):
        maxscore.search(wide, wide).collect()


def test_bar_of_another_shard_loses_nothing():
    rng = np.random.default_rng(8)
    for _ in range(60):
        x = rng.integers(-9, 10, (30, 24)).astype(float)
        query, k = rng.integers(-9, 10, 30).astype(float), 4
        scores = query @ x
        bar = float(np.sort(scores)[-k]) - float(rng.integers(0, 60))
        at, found = maxscore.best(query, x, x.min(axis=1), x.max(axis=1), np.zeros(24, bool), k, bar)
        top = set(np.flatnonzero(scores >= np.sort(scores)[-k]).tolist())
        assert top <= set(at.tolist()) and (found == scores[at]).all()
        high, _ = maxscore.best(query, x, x.min(axis=1), x.max(axis=1), np.zeros(24, bool), k, scores.max() + 1)
        assert not len(high)


# ------------------------------------------------------------------------ 9


def slow_fingerprint(text):
    words = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    if not words:
        return 0
    width = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + width]), 42) for i in range(len(words) - width + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_near_duplicates(spark, odd, monkeypatch):
    for r in odd.collect():
        assert neardup.fingerprint(r["text"] and r["text"].encode()) == slow_fingerprint(r["text"])
    monkeypatch.setattr(neardup, "TREE_ROWS", 8)  # parts of large shards are exercised
    rng = random.Random(4)
    base = [rng.getrandbits(64) for _ in range(40)]
    values = {b for b in base}
    for b in base[:10]:
        for _ in range(25):
            values.add(b ^ sum(1 << k for k in rng.sample(range(64), rng.randrange(1, 5))))
    values = sorted(values)
    frame = spark.createDataFrame([(neardup.signed(v),) for v in values], "fp long")
    parent = {v: v for v in values}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if (a ^ b).bit_count() <= 3:
                parent[max(root(a), root(b))] = min(root(a), root(b))
    found = connected_components(neardup.linked(frame, len(values))).collect()
    got = {}
    for r in found:
        got.setdefault(r["root"], set()).add(r["node"] & (2**64 - 1))
    want = {}
    for v in values:
        want.setdefault(root(v), set()).add(v)
    assert sorted(map(sorted, got.values())) == sorted(sorted(s) for s in want.values() if len(s) > 1)


def test_components_of_fingerprints_end_to_end(spark, monkeypatch):
    monkeypatch.setattr(neardup, "TREE_ROWS", 16)
    rng = random.Random(21)
    base = [f"w{rng.randrange(3000)}" for _ in range(900)]
    rows = [(i, " ".join(base[: 900 - i] if i % 2 else base[i:])) for i in range(40)]
    rows += [(100 + i, " ".join(rng.choices(["p", "q", "r", "s", "t"], k=rng.randrange(12)))) for i in range(80)]
    rows += [(None, rows[0][1]), (None, "lonely words of nobody"), (7, "other text of seven"), (7, "other text of seven"),
             (500, None), (501, ""), (502, " \n")]
    docs = spark.createDataFrame([(a, b, 1) for a, b in rows], "doc_id long, text string, FP int").repartition(4)
    prints = [slow_fingerprint(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(i)] = min(doc, least.get(root(i), doc))
    want = [(doc, neardup.signed(prints[i]), least.get(root(i))) for i, (doc, _) in enumerate(rows)]
    got = [tuple(r) for r in neardup.near_duplicates(docs).collect()]
    assert sorted(map(str, got)) == sorted(map(str, want))
    assert len({w[2] for w in want}) < len(rows) - 15
    assert neardup.near_duplicates(docs.limit(0)).count() == 0


def test_masks_leave_no_pair_out():
    rng = random.Random(6)
    for rows in (10, 1 << 24, 1 << 40):
        masks = neardup.block_masks(rows)
        for _ in range(300):
            flip = sum(1 << k for k in rng.sample(range(64), 3))
            assert any(flip & m == 0 for m in masks)


def test_deduplicated(spark, odd):
    kept = neardup.deduplicated(odd)
    assert kept.columns == odd.columns
    # 2, 3 and 4 have no word and share fingerprint zero
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["1", "2", "5", "6", "None"]
    assert neardup.deduplicated(odd.limit(0)).count() == 0


def replaced(words, share):
    """A copy whose 5-word shingles have about the similarity to those of ``words``."""
    n = len(words) - 4
    lost = round(n * (1 - share) / (1 + share))  # shingles without a partner on each side
    return ["other" + w if len(words) - lost <= i else w for i, w in enumerate(words)]


def test_similar_copies_go(spark):
    rng = random.Random(8)
    rows, gone = [], set()
    for i, share in enumerate([0.6, 0.7, 0.76, 0.81, 0.84, 0.88, 0.92, 0.95, 0.97] * 6):
        words = [f"w{rng.randrange(5000)}" for _ in range(rng.randrange(200, 900))]
        rows += [(i, " ".join(words)), (1000 + i, " ".join(replaced(words, share)).upper().replace(" ", "\n"))]
        gone |= {1000 + i} if share > 0.8 else set()
    # a chain of copies, each like its neighbours only, and a family of many
    words = [f"c{rng.randrange(5000)}" for _ in range(400)]
    for i in range(5):
        rows.append((2000 + i, " ".join(words[i * 30 :] + [f"x{j}" for j in range(i * 30)])))
    gone |= {2001, 2002, 2003, 2004}
    for i in range(300):
        rows.append((3000 + i, " ".join(f"f{j}" if j != i else "own" for j in range(300))))
    gone |= set(range(3001, 3300))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for found in (neardup.deduplicated(docs), corpus_pipeline.simhash_dedup(spark, docs, FOLDER)):
        kept = [r["doc_id"] for r in found.select("doc_id").collect()]
        assert sorted(kept) == sorted({r[0] for r in rows} - gone)


def jaccard(a, b):
    x, y = ({tuple(t[i : i + 5]) for i in range(len(t) - 4)} or {tuple(t)} for t in (a, b))
    return len(x & y) / len(x | y)


@pytest.mark.parametrize("rows", [4096, 20])
def test_classes_equal_comparing_all_pairs(spark, monkeypatch, rows):
    monkeypatch.setattr(similar, "TREE_ROWS", rows)
    rng = random.Random(31)
    texts = []
    for size in (5, 6, 9, 12, 30, 80, 200):
        for _ in range(6):
            words = [f"w{rng.randrange(4000)}" for _ in range(size)]
            for _ in range(6):
                own = list(words)
                for _ in range(rng.randrange(1 + size // 12)):
                    own[rng.randrange(size)] = f"n{rng.randrange(9000)}"
                texts.append(own)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if jaccard(texts[i], texts[j]) >= 0.8:
                parent[max(root(i), root(j))] = min(root(i), root(j))
    want = sorted({root(i) for i in range(len(texts))})
    assert sorted(r["doc_id"] for r in neardup.deduplicated(docs).collect()) == want


def test_unlike_family_takes_few_rounds(spark, monkeypatch):
    rounds, pairs = [], []
    search, confirm = similar.candidates, similar._confirmed

    def counted(members, first, last, closest=False):
        rounds.append((first, last, closest))
        return search(members, first, last, closest)

    def compared(found, shingles, similarity):
        pairs.append(found.count())
        return confirm(found, shingles, similarity)

    monkeypatch.setattr(similar, "candidates", counted)
    monkeypatch.setattr(similar, "_confirmed", compared)
    common = [f"c{i}" for i in range(140)]
    rows = [(i, " ".join(common + [f"own{i}x{j}" for j in range(60)])) for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert neardup.deduplicated(docs).count() == 600
    # of 179,700 pairs
    assert len(rounds) <= 10 and sum(pairs) < 30_000


def test_parities_never_rule_out_a_similar_set():
    rng = np.random.default_rng(3)
    for size in (1, 4, 40, 63, 66, 300, 3000, 40_000):
        a = rng.integers(0, 1 << 64, size, np.uint64)
        for lost in {0, 1, size // 9, size // 2, size}:
            b = np.concatenate([a[lost:], rng.integers(0, 1 << 64, lost // 2, np.uint64)])
            apart = len(np.setxor1d(a, b))
            x, y = similar.parities(a), similar.parities(b)
            sides = [(int.from_bytes(z, "little"), 8 * len(z)) for z in (x, y)]
            least = similar.difference(*sides[0], *sides[1])
            assert least == similar.difference(*sides[1], *sides[0]) <= apart
            # and nearly all of few differences are seen
            assert apart > size / 4 or len(x) != len(y) or 8 * len(x) == similar.MOST_BITS or least >= 0.8 * apart - 2


def test_loners_of_a_family_are_not_compared_with_all(spark, monkeypatch):
    pairs, confirm = [], similar._confirmed

    def compared(found, shingles, similarity):
        pairs.append(found.count())
        return confirm(found, shingles, similarity)

    monkeypatch.setattr(similar, "_confirmed", compared)
    rng = random.Random(12)
    rows = []
    # one word of 200 replaced: similar to each other; five words: at most 0.77, to any other text
    for i in range(400):
        words = [f"c{j}" for j in range(200)]
        for at in rng.sample(range(5, 195, 5), 1 if i < 200 else 5):
            words[at] = f"own{i}x{at}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in neardup.deduplicated(docs).collect())
    assert kept == [0, *range(200, 400)]
    # of 59,900 with a loner
    assert sum(pairs) < 4000


def test_repeated_ids_of_unequal_text(spark):
    def words(k):
        return " ".join(f"{k}v{i}" for i in range(60))

    rows = [
        (1, words("a"), "x"),
        (5, words("a") + " end", "near 1"),
        (5, words("b"), "own class"),
        (5, words("b").upper(), "own class again"),
        (5, words("c"), "another"),
        (None, words("d"), "no id"),
        (None, words("d") + " end", "no id again"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, note string")
    kept = {
        tuple(sorted((r["doc_id"] or 0, r["text"][:1].lower()) for r in got.collect()))
        for got in (neardup.deduplicated(docs.repartition(n)) for n in (1, 5))
    }
    assert kept == {((0, "d"), (1, "a"), (5, "b"), (5, "c"))}


# ----------------------------------------------------------------------- 10


@pytest.mark.parametrize("copies", [0, 400])
def test_shards(spark, copies):
    rng = random.Random(7)
    rows = [(i, "x" * rng.randrange(400)) for i in range(900)] + [(1000 + i, "same " * 60) for i in range(copies)]
    docs = spark.createDataFrame([*rows, (None, None), (5, "x")], "doc_id long, text string").withColumn("SIZE", F.lit(0))
    got = sharding.sharded(docs).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(got) == len(rows) + 2 and sums.max() - sums.min() <= 2 * 401 and len(sums) == 8
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert all(zlib.crc32((r.text or "").encode()) == r.text_crc32 for r in got.itertuples())
    assert sharding.sharded(docs.limit(0)).count() == 0
    assert sharding.sharded(docs.limit(3)).count() == 3


def test_shards_of_repeated_rows(spark):
    rows = [(7, "the same row " * 8)] * 1000 + [(i, "x" * (i % 300)) for i in range(1000)] + [(None, None)] * 200
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    docs = docs.withColumns({c: F.lit(c) for c in ("h", "i", "m", "_key", "_at", "_mark", "_part", "_shard", "_start")})
    got = sharding.sharded(docs).toPandas()
    sums = got.groupby("shard")["size"].sum()
    assert len(got) == 2200 and len(sums) == 8
    assert sums.max() - sums.min() <= 2 * (301 + sums.sum() / 8 * sharding.TOLERANCE)
    for _, part in got.groupby("shard"):
        assert sorted(part["slot"]) == list(range(len(part)))
    assert all((got[c] == c).all() for c in ("h", "i", "m", "_key", "_at", "_mark", "_part", "_shard", "_start"))
    # the rows of a shard are in one stretch of the key, so equal texts touch at most two ends
    spread = got.groupby("text_crc32")["shard"].agg(["min", "max", "nunique"])
    assert (spread["max"] - spread["min"] + 1 == spread["nunique"]).all()


def test_query_of_shards_by_hand(spark):
    got = queries.shards(spark, FOLDER).toPandas().set_index("doc_id")
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in table(spark, "documents").collect()}
    assert len(got) == len(texts) and set(got["law"]) == {"bytes"} and got["grown_shard"].isna().all()
    for i, data in texts.items():
        assert (got.loc[i, "size"], got.loc[i, "text_crc32"]) == (len(data) + 1, zlib.crc32(data))
    sums = got.groupby("shard")["size"].sum()
    assert sums.max() - sums.min() <= 2 * max(map(len, texts.values()))


@pytest.mark.parametrize("cell", [(0, 12, "FFF"), (0, 60, "F" * 15), (1, 6, "F" * 15 + f"{63:016X}"), (2, 64, "A" * 15 + "F" * 32)])
def test_ends_of_cells(cell):
    part, bits, name = cell
    probe = sharding.Probe(part, bits)
    first, after = probe.bound(name), probe.end(name)
    assert first < after and all(isinstance(v, int) for v in after)
    finer = probe.finer()
    if finer is not None:
        inner = probe.values(name)
        wide = sum(sharding._digits(b) for _, b in sharding.PARTS[: finer.part + 1])
        child = name + "0" * (wide - len(name)) if finer.part > part else (
            name[: -sharding._digits(sharding.PARTS[part][1])] + f"{inner[-1] << (finer.bits - bits):0{sharding._digits(sharding.PARTS[part][1])}X}")
        assert probe.holds(child) == name.rjust(len(name), "0") or probe.values(probe.holds(child)) == inner
        assert finer.bound(child) == first


# ----------------------------------------------------------------- pipeline


def test_stages_keep_the_columns_of_documents(spark, odd, labels, monkeypatch):
    monkeypatch.setattr(corpus_pipeline, "table", lambda spark, folder, name: labels)
    extra = {c: F.concat(F.lit(c), F.col("doc_id")) for c in ("n_words", "copies", "copy", "_doc", "_rules", "anomaly")}
    docs = odd.drop("N_WORDS").withColumns(extra)
    names = docs.columns
    before = {tuple(map(str, r)) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        found = stage(spark, docs, FOLDER)
        assert found.columns == names, name
        assert {tuple(map(str, r)) for r in found.collect()} <= before, name
        assert stage(spark, docs.limit(0), FOLDER).count() == 0
    assert corpus_pipeline.bpe_encode(spark, docs, FOLDER).count() == 8


def test_pipeline_by_hand(spark):
    """Each stage again by plain Python, on the models that the stages fit."""
    docs, marks = table(spark, "documents"), table(spark, "labels")
    rows = {r["doc_id"]: r for r in docs.collect()}
    forest = rules.fit(docs, marks)

    def passes(text):
        counts = rules.counts(text and text.encode())
        score = float(forest.anomaly(rules.features(np.array([counts])))[0])
        return counts[0] >= 50 and 100 * counts[4] <= 50 * counts[0] and score <= forest.threshold

    left = {i: r for i, r in rows.items() if passes(r["text"])}
    first = spark.createDataFrame(list(left.values()), docs.schema)
    ratio = resampling.fit(first, marks)
    weights = {i: ratio.log_weight(r["text"].encode())[1] for i, r in left.items()}
    noise = {}
    for i in left:
        number = int(hashlib.md5(f"{resampling.SEED}:{i}".encode()).hexdigest()[:13], 16)
        noise[i] = -np.log(-np.log((number + 0.5) / 2**52))
    n = len(left)
    if ratio.threshold is not None:
        n = sum(w >= ratio.threshold for w in weights.values())
    order = sorted(left, key=lambda i: -round((weights[i] + noise[i]) * resampling.PARTS))
    left = {i: left[i] for i in order[:n]}
    words = {i: r["text"].lower().split() for i, r in left.items()}
    parent = {i: i for i in left}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    names = sorted(left)
    shingles = {i: {tuple(w[j : j + 5]) for j in range(len(w) - 4)} for i, w in words.items()}
    for a in names:
        for b in names:
            if b < a and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
                parent[max(root(a), root(b))] = min(root(a), root(b))
    left = {i: left[i] for i in names if root(i) == i}
    copies = Counter(r["doc_id"] for r in mixing.replicate(spark.createDataFrame(list(left.values()), docs.schema)).collect())
    got = Counter(r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).select("doc_id").collect())
    assert got == copies and len(got) > 20


def test_pipeline(spark, tmp_path):
    docs = table(spark, "documents")
    names = docs.columns
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{tmp_path}/{number}")
        after = spark.read.parquet(f"{tmp_path}/{number}")
        if number < 4:
            assert after.columns == names
        if number < 3:
            assert 0 < after.count() <= docs.count()
        docs = after
    whole = corpus_pipeline.run(spark, FOLDER)
    key = ["doc_id", "n_tokens", "ids_sha256"]
    assert sorted(map(tuple, whole.select(*key).collect())) == sorted(map(tuple, docs.select(*key).collect()))
    texts = {r["doc_id"]: r["text"] for r in table(spark, "documents").collect()}
    for r in whole.collect():
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_few_edges_take_few_tasks(spark):
    # adaptive execution that joins no partitions leaves a task for each of them in every step
    settings = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    context = spark.sparkContext
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)]
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        context.setJobGroup("few edges", "few edges")
        found = connected_components(spark.createDataFrame(edges, "a long, b long"))
        assert {(r["node"], r["root"]) for r in found.collect()} == (
            {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 140)}
        )
    finally:
        context.setLocalProperty("spark.jobGroup.id", None)
        context.setLocalProperty("spark.job.description", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    tracker = context.statusTracker()
    stages = {s for job in tracker.getJobIdsForGroup("few edges") for s in tracker.getJobInfo(job).stageIds}
    ran = sum(info.numCompletedTasks for info in map(tracker.getStageInfo, stages) if info)
    assert ran < 2500
