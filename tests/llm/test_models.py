"""Quality and language on held-out rows."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from qirtas.llm import language, quality


def test_sum_of_squares_identity():
    rng = np.random.default_rng(1)
    w = rng.normal(size=(30, 1 + quality.RANK)).astype(np.float32)
    f, v = np.array([3, 7, 9, 20]), np.array([0.5, 1.0, 0.2, 0.7], np.float32)
    pairs = sum(float(w[a, 1:] @ w[b, 1:]) * v[i] * v[j] for i, a in enumerate(f) for j, b in enumerate(f) if i < j)
    got = quality.machine(1, np.zeros(4, int), f, v, w, 0.25)[0]
    assert abs(got - (0.25 + float(w[f, 0] @ v) + pairs)) < 1e-4


def test_quality_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    learn = lambda c: F.pmod(F.crc32(c.cast("string")), F.lit(3)) != 1
    rows = quality.score_quality(d, labels, learn).join(labels, "doc_id").filter(~learn(F.col("doc_id"))).collect()
    assert np.mean([(r.score >= 0.5) == (r.quality == 1) for r in rows]) > 0.95


def test_quality_of_odd_rows(spark, make, odd_rows):
    docs = make(odd_rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in quality.score_quality(docs, none, lambda d: F.lit(True)).collect()} == {0.5}
    some = spark.createDataFrame([(2, 0), (4, 1), (5, None), (6, 3)], "doc_id long, quality int")
    got = quality.score_quality(docs, some, lambda d: F.lit(True)).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    assert quality.score_quality(make([]), none, lambda d: F.lit(True)).collect() == []


def test_language_on_held_out_rows(spark):
    d = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learn = lambda c: F.pmod(F.crc32(c.cast("string")), F.lit(4)) != 2
    rows = language.predict_language(d, learn).join(d.select("doc_id", "lang"), "doc_id").filter(~learn(F.col("doc_id"))).collect()
    assert np.mean([r.lang == r.lang_pred for r in rows]) > 0.95


def test_language_of_odd_rows(make, odd_rows):
    got = {(r.doc_id, r.lang_pred == "und") for r in language.predict_language(make(odd_rows), lambda d: F.lit(True)).collect()}
    assert {(1, True), (2, True), (3, True), (9, True), (4, False), (8, False)} <= got
    assert language.predict_language(make([]), lambda d: F.lit(True)).collect() == []
    assert {r.lang_pred for r in language.predict_language(make([(1, "abc", None, None)]), lambda d: F.lit(True)).collect()} == {"und"}


def test_presence_is_a_set():
    text = "ABab ab"
    every = np.arange(language.HASHED, dtype=np.int32)
    one = np.packbits(language.marks(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), every, language.HASHED), axis=1)
    grams = {text.lower()[i : i + n] for n in language.SIZES for i in range(len(text) - n + 1)}
    assert np.bitwise_count(one).sum() == len(grams)
    assert np.allclose(language.kernel(one, one), 1)


def test_letters():
    from qirtas.llm.text import flat

    data, off = flat(pa.array(["a", "1", "é", "漢", "!", ""]))
    assert language.has_letter(data, off).tolist() == [True, False, True, True, False, False]


def test_rare_languages_in_their_own_scripts(make):
    """The others' n-grams fill every slot and vary more than those of languages with 2 % of the rows each."""
    rng = random.Random(7)
    scripts = {"hy": 0x561, "ka": 0x10D0, "am": 0x1200, "th": 0xE01, "he": 0x5D0, "bn": 0x995, "ko": 0xAC00}
    write = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    short = lambda start: write([chr(start + i) for i in range(4)], 6)
    rows = [(i, write("abcdefghijklmno " if i % 2 else "lmnopqrstuvwxyz ", 1500), "ab"[i % 2]) for i in range(260)]
    rows += [(1000 + i, short(start), lang) for lang, start in scripts.items() for i in range(6)]
    held = {5000 + 10 * j + i: (lang, short(start)) for j, (lang, start) in enumerate(scripts.items()) for i in range(10)}
    docs = make(rows + [(i, t, None) for i, (_, t) in held.items()])
    got = {r.doc_id: r.lang_pred for r in language.predict_language(docs, lambda d: F.lit(True)).collect()}
    assert {i: got[i] for i in held} == {i: lang for i, (lang, _) in held.items()}
    assert [got[i] for i in range(260)] == ["ab"[i % 2] for i in range(260)]


def test_values_are_the_kernel_machine():
    rng = np.random.default_rng(3)
    sets, product = rng.random((5, 40)) < 0.3, rng.normal(size=(40, 3)).astype(np.float32)
    sets[2] = False
    want = (sets.astype(float) @ product) / np.sqrt(np.maximum(sets.sum(axis=1), 1))[:, None]
    assert np.allclose(language.values(sets, product), want, atol=1e-5)


def test_smallest_counts_a_key_once(spark):
    from qirtas.llm.shared import smallest

    rows = [("a", 1)] * 5000 + [("a", i) for i in range(30)] + [("b", 7)] * 3 + [(None, 1), ("c", None)]
    df = spark.createDataFrame(rows, "g string, k long").repartition(5)
    got = smallest(df, "g", "k", 10).collect()
    hashes = {r.k: r.h for r in df.filter("k is not null").select("k", (F.xxhash64("k").bitwiseAND((1 << 62) - 1)).alias("h")).collect()}
    assert {r.k for r in got if r.g == "a"} == set(sorted(range(30), key=hashes.get)[:10]) and len(got) == 11
    assert [r.k for r in got if r.g == "b"] == [7] and smallest(df.limit(0), "g", "k", 10).collect() == []


def test_equal_rows_by_the_thousand_lose_no_language(make):
    rows = [(1, "the house and the garden", "en")] * 6000 + [(2 + i, f"la maison et le jardin {i}", "fr") for i in range(20)]
    got = {(r.doc_id, r.lang_pred) for r in language.predict_language(make(rows), lambda d: F.lit(True), per_lang=10).distinct().collect()}
    assert (1, "en") in got and (5, "fr") in got


def test_a_doc_id_by_the_thousand_is_learnt_from_once(spark, make, monkeypatch):
    seen = []
    fit = quality.fit
    monkeypatch.setattr(quality, "fit", lambda samples, size: seen.append(samples) or fit(samples, size))
    rows = [(1, "good words", None)] * 3000 + [(1, "another text", None)] + [(i, f"bad ### words {i}", None) for i in range(2, 30)]
    labels = spark.createDataFrame([(1, 1)] + [(i, 0) for i in range(2, 30)], "doc_id long, quality int")
    got = quality.score_quality(make(rows), labels, lambda d: F.lit(True), per_class=10).collect()
    assert len(got) == len(rows) and sorted(s[2] for s in seen[0]) == [0] * 10 + [1]
    size = max(s[0].nbytes + s[1].nbytes for s in seen[0])
    quality.score_quality(make(rows), labels, lambda d: F.lit(True), per_class=10, learn_bytes=3 * size).collect()
    assert [s[2] for s in seen[1]].count(0) == 3 and [s[2] for s in seen[1]].count(1) == 1


def test_scores_of_given_weights(spark, make):
    """The whole score by plain loops: features of one text, linear terms and all pairs."""
    rng = np.random.default_rng(2)
    size = (1 << quality.BITS) + (len(quality.STATISTICS) + 1) * (quality.BINS + 1)
    w = rng.normal(size=(size, 1 + quality.RANK)).astype(np.float32) * 0.1
    texts = ["one two two three", "", "A # b\nc", "漢字 漢字 x"]
    for _, n, row, f, v in quality.features(pa.array(texts), [pa.array([len(t) for t in texts])]):
        got = quality.machine(n, row, f, v, w, 0.5)
        for i in range(n):
            own = [(int(a), float(b)) for r, a, b in zip(row, f, v, strict=True) if r == i]
            want = 0.5 + sum(float(w[a, 0]) * b for a, b in own)
            want += sum(float(w[a, 1:] @ w[c, 1:]) * b * d for j, (a, b) in enumerate(own) for c, d in own[:j])
            assert abs(got[i] - want) < 1e-3
            words = set(texts[i].lower().split())
            assert len(own) == len(words) + len(quality.STATISTICS) + 1


def brute_language(rows, landmarks, texts):
    """Kernel, whitening and ridge by sets and plain loops, with the module's choice of landmarks."""
    low = lambda t: bytes(32 if c in b"\t\n\x0b\x0c\r" else c | 32 if 65 <= c <= 90 else c for c in t.encode())
    slot = lambda g: ((int.from_bytes(g, "little") * 2654435761 + len(g) * 40503) % 2**32) >> 16
    grams = lambda t: {slot(b[i : i + n]) for b in [low(t)] for n in language.SIZES for i in range(len(b) - n + 1)}
    k = lambda a, b: len(a & b) / (max(len(a), 1) * max(len(b), 1)) ** 0.5
    sets, langs = [grams(t) for t, _ in rows], [lang for _, lang in rows]
    names = sorted(set(langs))
    rng = np.random.default_rng(5)
    own = [rng.permutation([i for i, x in enumerate(langs) if x == name]) for name in names]
    chosen = [o[turn] for turn in range(landmarks) for o in own if turn < len(o)][:landmarks]
    z = [sets[i] for i in chosen]
    found, vectors = np.linalg.eigh(np.array([[k(a, b) for b in z] for a in z]))
    white = vectors[:, found > 1e-6] / np.sqrt(found[found > 1e-6])
    phi = np.array([[k(a, b) for b in z] for a in sets]) @ white
    out = np.array([[k(grams(t), b) for b in z] for t in texts]) @ white
    f = []
    for name in names:
        y = np.array([1.0 if x == name else -1.0 for x in langs])
        each = np.array([len(langs) / (len(names) * langs.count(x)) for x in langs])
        w = np.linalg.solve(phi.T @ (phi * each[:, None]) + language.RIDGE * len(langs) * np.eye(phi.shape[1]), phi.T @ (y * each))
        f.append(out @ w)
    return np.array(f).T, names


def test_language_model_by_plain_loops():
    rng = random.Random(11)
    write = lambda letters: "".join(rng.choice(letters) for _ in range(60))
    rows = [(write("abcde F" if i % 3 else "cdefgh\n"), "xy"[i % 3 == 0]) for i in range(24)]
    every = np.arange(language.HASHED, dtype=np.int32)

    def sets(texts):
        data, off = language.flat(pa.array(texts))
        return language.marks(data, off, every, language.HASHED)

    product, names = language.fit(np.packbits(sets([t for t, _ in rows]), axis=1), [lang for _, lang in rows], 8)
    texts = [write("abcdefgh ") for _ in range(6)] + ["", "q"]
    want, order = brute_language(rows, 8, texts)
    assert order == names and np.allclose(language.values(sets(texts), product), want, atol=1e-3)
