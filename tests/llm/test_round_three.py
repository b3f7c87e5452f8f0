"""Spelling variants, filter audit and exact inner products, against brute force and their SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from itertools import permutations

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qirtas.llm import audit, kdtree, oracles, spelling


def under_sql(name, **tables):
    """Rows of a query's SQL over Spark tables, sorted by its columns' names."""
    con = duckdb.connect()
    for table, df in tables.items():
        con.register(table, df.toArrow())
    got = con.execute(oracles.ORACLES[name])
    names = [c[0] for c in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted((tuple(r[i] for i in order) for r in got.fetchall()), key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*sorted(df.columns)).collect()), key=str)


# spelling


def brute_words(rows, least):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = {}
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 6:
                found[run] = found.get(run, 0) + 1
    return {w: n for w, n in found.items() if n >= least}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_variants(rows, least=5, times=5):
    n = brute_words(rows, least)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    best = {w: min(v, key=lambda x: (-n[x], x)) for w, v in near.items() if v}
    form = {w: b for w, b in best.items() if n[b] >= times * n[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted(((form.get(w), n[form[w]] if w in form else None, n[w], len(near[w]), root(w), w) for w in n), key=str)


def word_rows(seed, n, letters="abcàÉ×", docs=40):
    rng = random.Random(seed)
    pool = ["".join(rng.choice(letters) for _ in range(rng.randrange(6, 10))) for _ in range(30)]
    pool += [w[: (k := rng.randrange(len(w)))] + rng.choice(letters) * rng.randrange(3) + w[k + rng.randrange(2) :] for w in pool for _ in range(6)]
    return [(i, " ".join(rng.choice(pool[: rng.choice((5, 30, len(pool)))]) + rng.choice((",", "1", "", "A漢")) for _ in range(n // docs))) for i in range(docs)]


@pytest.mark.parametrize(("seed", "group"), [(1, 64), (2, 2), (3, 8)])
def test_variants_against_brute_force(spark, make, seed, group):
    rows = word_rows(seed, 4000)
    got = rows_of(spelling.spelling_variants(make(rows), group=group))
    assert got == brute_variants(rows) and sum(r[0] is not None for r in got) > 10 and any(r[3] > 3 for r in got)


def test_variants_follow_their_sql(make):
    docs = make(word_rows(5, 3000))
    assert rows_of(spelling.spelling_variants(docs)) == under_sql("op11_spelling_variants", documents=docs)


def test_roots_are_at_the_ends_of_chains(make):
    chain = ["aaaaaab", "aaaaabb", "aaaabbb", "aaabbbb"]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(5 * 6**i))
    got = {r.word: (r.form, r.root) for r in spelling.spelling_variants(make([(1, text)])).collect() if r.word in chain}
    assert got == {w: (chain[i + 1] if i < 3 else None, chain[3]) for i, w in enumerate(chain)}


def test_variants_of_odd_rows(spark, make, odd_rows):
    rows = [(i, t) for i, t, *_ in odd_rows] + [(50, "Straße straße STRASSE " * 9), (None, "straße " * 5), (51, "y" * 300_000 + " " + "y" * 299_999)] * 3
    docs = make(rows).withColumn("word", F.lit(1)).withColumn("n", F.lit(2)).withColumn("key", F.lit("x"))
    assert rows_of(spelling.spelling_variants(docs, least=3)) == brute_variants(rows, least=3)
    assert spelling.spelling_variants(make([])).collect() == [] and spelling.spelling_variants(make([(1, None), (2, "a b")])).collect() == []


def test_repeated_rows_count_by_the_thousand(make):
    rows = [(1, "variant")] * 3000 + [(2, "variand varianz")] * 7
    assert rows_of(spelling.spelling_variants(make(rows))) == brute_variants(rows)


def test_a_segment_that_most_words_share(spark):
    """Half of a word is the same in all: pairs must still be those of brute force, and few rows may meet."""
    rng = random.Random(8)
    words = sorted({"common" + "".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(1500)} | {"common" + "".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(500)})
    df = spelling.write_table(spark.createDataFrame([(w, 9) for w in words], "word string, n long"), "t")
    got = {(r.word, r.other) for r in spelling.near_words(df, group=16).collect()}
    gone = {}
    for w in words:
        for i in range(len(w)):
            gone.setdefault((i, len(w), w[:i] + w[i + 1 :]), []).append(w)
    known = set(words)
    want = {(a, b) for g in gone.values() for a in g for b in g if a != b}
    want |= {p for (_, _, rest), g in gone.items() if rest in known for a in g for p in ((a, rest), (rest, a))}
    assert got == want and want


def test_checksums_of_runs():
    texts = ["héllo Wörld", "", "x" * 200 + " ÿÀ", "a"]
    data, off = spelling.flat(pa.array(texts))
    starts, ends, length = spelling.letter_runs(data, off)
    runs = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert [r.decode() for r in runs] == ["héllo", "Wörld", "x" * 200, "ÿÀ", "a"] and length.tolist() == [len(r.decode()) for r in runs]
    before = np.full(len(runs), zlib.crc32(b"7:"), np.uint32)
    assert spelling.checksums(data, starts, ends - starts, before).tolist() == [zlib.crc32(b"7:" + r) for r in runs]


# audit


def brute_audit(docs, labels):
    good, toxic = {i for i, q, _ in labels if q == 1} - {None}, {i for i, _, t in labels if t == 1} - {None}
    least = {}
    for i, text, _ in docs:
        if i is not None:
            least[text or ""] = min(i, least.get(text or "", i))
    seen = []
    for i, text, lang in docs:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * sum("A" <= c <= "Z" for c in text) > 3 * len(text)}
        fails |= {"D": any(c in "#$%&*|" for c in text), "E": i is not None and least[text] < i}
        seen.append((lang or "", {f for f, bad in fails.items() if bad}, i in good, i in toxic))
    out = []
    for part in {s[0] for s in seen}:
        own = [s for s in seen if s[0] == part]
        lost, rows = {}, []
        for order in permutations("ABCDE"):
            left = list(own)
            for k, f in enumerate(order):
                here = [s for s in left if f in s[1]]
                left = [s for s in left if f not in s[1]]
                lost[f] = lost.get(f, 0) + len(here)
                failing = sum(f in s[1] for s in own)
                rows.append([f, ("".join(order), k + 1), len(left), len(here), failing - len(here), sum(s[1] == {f} for s in own), sum(s[2] for s in here), sum(s[3] for s in here)])
        out += [(o, good_lost, kept, part, redundant, removed, lost[f], step, toxic_lost, unique) for f, (o, step), kept, removed, redundant, unique, good_lost, toxic_lost in rows]
    return sorted(out, key=str)


def audit_columns(df):
    return sorted((tuple(r) for r in df.select("filter_order", "good_lost", "kept", "part", "redundant", "removed", "shapley", "step", "toxic_lost", "unique_fails").collect()), key=str)


def audit_rows(seed, n=150):
    rng = random.Random(seed)
    word = lambda: rng.choice(["alpha", "Beta", "gamma", "Δ", "x#", "y", "ZZ"]) + (str(rng.randrange(400)) if rng.random() < 0.7 else "")
    texts = [rng.choice((" ", "\n\t")).join(word() for _ in range(rng.choice((0, 5, 199, 200, 260)))) for _ in range(n // 2)]
    return [(i, rng.choice(texts), rng.choice(("en", "fr", None, ""))) for i in range(n)]


def test_audit_against_brute_force_and_sql(spark, make):
    docs = audit_rows(1)
    rng = random.Random(2)
    labels = [(rng.randrange(200), rng.choice((0, 1, None)), rng.choice((0, 1))) for _ in range(120)]
    table, marked = make(docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = audit.audit_filters(table, marked)
    assert audit_columns(got) == brute_audit(docs, labels)
    assert rows_of(got) == under_sql("op12_filter_audit", documents=table, labels=marked)


def test_audit_of_odd_rows(spark, make, odd_rows):
    docs = [(i, t, lang) for i, t, lang, *_ in odd_rows] + [(None, "one two", "en"), (None, None, None), (60, "copy", "de")] + [(i, "copy " * 300, "de") for i in range(70, 400)]
    labels = [(2, 1, 0), (2, None, 1), (6, 1, 1), (None, 1, 1), (80, 1, 0)]
    table = make(docs).withColumn("part", F.lit("x")).withColumn("mask", F.lit(3)).withColumn("quality", F.lit(1))
    marked = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("lang", F.lit("xx"))
    assert audit_columns(audit.audit_filters(table, marked)) == brute_audit(docs, labels)
    assert audit.audit_filters(make([]), marked).collect() == []
    assert audit_columns(audit.audit_filters(make(docs), marked.limit(0))) == brute_audit(docs, [])


def test_words_of_a_text_in_pieces(monkeypatch):
    raw = b" a bb\x0bccc a\x1cb  bb " * 40
    whole = audit.words_of(raw)
    monkeypatch.setattr(audit, "PIECE", 7)
    assert audit.words_of(raw) == whole == (len(raw.split()), len(set(raw.split())))


def test_table_of_first_failures():
    for mask in range(32):
        for j, order in enumerate(audit.ORDERS):
            fails = [mask >> "ABCDE".index(c) & 1 for c in order]
            assert audit.FIRST[mask, j] == (fails.index(1) if any(fails) else 5)


# inner products


VECTORS = "vec_id long, embedding array<float>, label int"


def brute_top(rows, k=10):
    v = {}
    for i, x in rows:
        if i is not None and x and all(c is not None and np.isfinite(c) for c in x):
            v.setdefault(i, []).append([int(np.floor(1024.0 * float(np.float32(c)))) for c in x])
    out = []
    for q in (i for i in v if i % 100 == 0):
        best = min(v[q])
        scores = sorted((-sum(a * b for a, b in zip(best, x, strict=True)), i) for i, own in v.items() if i != q for x in own)[:k]
        out += [(q, n + 1, -s, i) for n, (s, i) in enumerate(scores)]
    return sorted(out)


def top(spark, rows, **options):
    df = spark.createDataFrame([(i, x, 0) for i, x in rows], VECTORS).repartition(3)
    return sorted((r.query_id, r["rank"], r.score, r.vec_id) for r in kdtree.exact_top_k(df, df.filter("vec_id % 100 = 0"), **options).collect())


@pytest.mark.parametrize(("dim", "spread", "options"), [(1, 1.0, {}), (3, 0.2, {"shard": 64}), (16, 1.0, {"shard": 100, "block": 3}), (48, 40_000.0, {"shard": 200})])
def test_inner_products_against_brute_force(spark, dim, spread, options):
    rng = np.random.default_rng(dim)
    centers = rng.normal(size=(6, dim))
    points = (centers[rng.integers(0, 6, 900)] + rng.normal(size=(900, dim)) * 0.3) * spread
    rows = [(i, [float(c) for c in p]) for i, p in enumerate(points)]
    assert top(spark, rows, **options) == brute_top(rows)


def test_one_vector_many_times(spark):
    rng = np.random.default_rng(4)
    same = [0.25, -0.5, 1.0]
    rows = [(i, same if i % 3 else [float(c) for c in rng.normal(size=3)]) for i in range(2500)] + [(100, same), (7, same), (7, same)]
    assert top(spark, rows, shard=256) == brute_top(rows)


def test_inner_products_of_odd_rows(spark):
    rows = [(0, [0.0, 0.0]), (1, [1.0, 2.0]), (2, None), (3, [float("nan"), 1.0]), (4, [1.0, None]), (5, [float("inf"), 0.0]), (None, [1.0, 1.0]), (6, [-1.0, 0.5]), (100, [0.5, 0.5]), (200, None), (7, [1.0, 2.0])]
    assert top(spark, rows + [(8, [1.0, 2.0, 3.0]), (9, []), (10, [1e30, 0.0])]) == brute_top(rows)
    assert top(spark, []) == [] and top(spark, [(0, [1.0])]) == [] and top(spark, [(1, [1.0]), (2, [1.0])]) == []


def test_inner_products_follow_their_sql(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, [float(c) for c in rng.normal(size=8)], 0) for i in range(400)], VECTORS)
    assert rows_of(kdtree.exact_top_k(df, df.filter("vec_id % 100 = 0"), shard=50)) == under_sql("op13_inner_products", embeddings=df)


def test_boxes_bound_their_rows_and_leave_shards_closed():
    rng = np.random.default_rng(6)
    points = np.concatenate([rng.integers(-50, 50, (400, 5)) + 3000 * c for c in (np.eye(5, dtype=int)[0], np.eye(5, dtype=int)[1])])
    ids, ordered, boxes, nodes = kdtree.build_tree(np.arange(800), points, 10, leaf=16)
    assert sorted(ids.tolist()) == list(range(800))
    for (first, n, left, right), (low, high) in zip(nodes, boxes, strict=True):
        if not left:
            own = ordered[first : first + n]
            assert (own.min(axis=0) == low).all() and (own.max(axis=0) == high).all()
        else:
            assert (low == np.minimum(boxes[left][0], boxes[right][0])).all() and (high == np.maximum(boxes[left][1], boxes[right][1])).all()
    q = rng.integers(-9, 9, (7, 5))
    bound = kdtree.box_bounds(q, boxes)
    assert (bound[:, 0] >= (q @ ordered.T).max(axis=1)).all()
    query = np.array([[1, 0, 0, 0, 0]], np.float64)
    found = kdtree.Found(np.array([-1]), np.array([kdtree.NONE]), 10)
    opened = kdtree.search_tree(found, query, (ids, ordered.astype(float), boxes.astype(float), nodes))
    assert 0 < opened < (nodes[:, 2] == 0).sum() / 2
    assert found.score[0].tolist() == sorted((points @ query[0].astype(int)).tolist())[::-1][:10]


def test_digest_of_a_text():
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([""]), pa.array(["a é"])], ["doc_id", "part", "text"])
    out = next(audit.measure(iter([batch])))
    assert out.column(3)[0].as_py() == hashlib.sha256("a é".encode()).digest() and out.column(2)[0].as_py() == 1
