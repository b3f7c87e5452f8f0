"""Mixing, fingerprints, token files, neighbours, pieces, counts, the pipeline."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from qirtas.llm import ann, bpe, mixing, pieces, token_counts, token_files, winnowing
from qirtas.llm.queries import PIECES, VOCABULARY, vocabulary
from qirtas.llm.text import flat, sliding_min, word_bounds, word_hashes


def test_words():
    texts = ["a  b\n", "", "c", "\x0bd\x1ce f ", None, "g h"]
    data, off = flat(pa.array(texts))
    starts, ends, first = word_bounds(data, off)
    words = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert words == [w for t in texts for w in (t or "").encode().split()]
    assert np.diff(first).tolist() == [len((t or "").encode().split()) for t in texts]
    assert len(set(word_hashes(data, starts, ends).tolist())) == len(set(words))


def test_sliding_minimum_takes_the_rightmost():
    rng = np.random.default_rng(2)
    for w in (1, 2, 3, 7, 16):
        h = rng.integers(0, 5, 60)
        value, at = sliding_min(h, w)
        for i in range(60 - w + 1):
            part = h[i : i + w].tolist()
            assert value[i] == min(part) and at[i] == i + max(j for j in range(w) if part[j] == min(part))


def test_targets_fill_up():
    assert mixing.fill_targets([100, 100, 100], [5, 2, 1], 3) == pytest.approx([187.5, 75.0, 37.5])
    got = mixing.fill_targets([10, 1000, 0], [5, 2, 1], 3)
    assert got[0] == 30 and got[2] == 0 and sum(got) == pytest.approx(1010)


def test_quotas_are_exact():
    draws = [1000, 17, 0, 250]
    q = mixing.split_quotas(draws, 7, 3)
    assert q.sum(axis=1).tolist() == draws and q.min() >= 0 and np.ptp(q.sum(axis=0)) <= 3
    assert (q == mixing.split_quotas(draws, 7, 3)).all()


def test_mix(make):
    rng = random.Random(1)
    rows = [(i, " ".join(["w"] * rng.randrange(1, 60)), None, rng.choice(["a", "b", "c", "d", None])) for i in range(600)]
    got = mixing.mix_sources(make(rows), shards=4).collect()
    again = mixing.mix_sources(make(rows), shards=4).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)
    source = {r[0]: r[3] for r in rows}
    taken, target = Counter(), {}
    for r in got:
        assert r.taken == r["size"] * len(r.draws) and len(r.draws) <= 3
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    for s, t in target.items():
        assert abs(taken[s] - t) <= 40
    docs = make(rows)
    assert sum(len(r.text.split()) for r in mixing.mixed_documents(docs).collect()) == sum(r.taken for r in mixing.mix_sources(docs).collect())


def test_mix_of_odd_rows(make, odd_rows):
    got = mixing.mix_sources(make(odd_rows), shards=2).collect()
    assert len(got) == len(odd_rows) and {r["size"] for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert mixing.mix_sources(make([])).collect() == []


def test_fingerprints(make, odd_rows):
    rng = random.Random(5)
    rows = [(i * 3, "".join(rng.choice("ab cdeé\n") for _ in range(rng.randrange(0, 400)))) for i in range(80)] + [(r[0], r[1]) for r in odd_rows if r[0] is not None and r[0] != 6]
    rows = list({i: (i, t) for i, t in rows}.values())
    got = {r.doc_id: r for r in winnowing.fingerprints(make(rows)).collect()}
    order = sorted(rows)
    assert len(got) == len(rows)
    for (i, t), (_, after) in zip(order, order[1:] + order[:1], strict=True):
        t, after = t or "", after or ""
        n = len(t) // 4
        edited = t[: len(t) - n] + after[:n]
        assert got[i].n_chars == len(t) and got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == slow_fingerprint(t) and got[i].edited_fingerprint == slow_fingerprint(edited)
    assert winnowing.fingerprints(make([])).collect() == []


def slow_fingerprint(t):
    """Windows one by one; hashes from the operator's own short texts."""
    k, w = winnowing.GRAM, winnowing.WINDOW
    if not t:
        return ""
    if len(t) < k:
        return winnowing.written(*winnowing.select([winnowing.code_points(t)])[0])
    gram = {g: int(winnowing.select([winnowing.code_points(g)])[0][0][0]) for g in {t[i : i + k] for i in range(len(t) - k + 1)}}
    h = [gram[t[i : i + k]] for i in range(len(t) - k + 1)]
    kept = sorted({max(range(i, min(i + w, len(h))), key=lambda j: (-h[j], j)) for i in range(max(1, len(h) - w + 1))})
    return winnowing.written(np.array([h[i] for i in kept], np.uint32), np.array(kept))


def test_shared_passages_share_a_fingerprint():
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(winnowing.GRAM + winnowing.WINDOW - 1))
    for _ in range(20):
        a, b = ("".join(rng.choice("xyz ") for _ in range(rng.randrange(60))) + passage + "".join(rng.choice("uvw") for _ in range(rng.randrange(60))) for _ in range(2))
        (x, _), (y, _) = winnowing.select([winnowing.code_points(a), winnowing.code_points(b)])
        assert len(np.intersect1d(x, y))
    h, p = winnowing.read_back(winnowing.written(x, np.arange(len(x)) * 3))
    assert (h == x).all() and (p == np.arange(len(x)) * 3).all()


def test_coded_numbers():
    rng = np.random.default_rng(1)
    for sizes in ([0], [1], [3], [4], [5], [1000], [0, 7, 0, 4, 1, 250], []):
        n = np.array(sizes, np.int64)
        x = rng.integers(0, 1 << rng.integers(1, 33, int(n.sum())), dtype=np.uint64).astype(np.uint32)
        control, data, quads, counts = token_files.pack(x, n)
        got, used = token_files.unpack(control, data, n)
        assert (got == x).all() and used == len(data) == counts.sum() and len(control) == quads.sum() == (-(-n // 4)).sum()


def test_files_are_read_in_steps(monkeypatch):
    rng = np.random.default_rng(7)
    n = np.array([3, 0, 9, 1, 40, 2, 2], np.int64)
    x = rng.integers(0, 70_000, int(n.sum())).astype(np.uint32)
    control, data, quads, counts = token_files.pack(x, n)
    cut = lambda a, sizes: [bytes(p) for p in np.split(a, np.cumsum(sizes)[:-1])]
    raw = token_files.file_bytes([None, 1, 2, 3, 4, 5, 6], n.tolist(), cut(control, quads), cut(data, counts))
    for step in (1, 5, 12, 1000):
        monkeypatch.setattr(token_files, "STEP_IDS", step)
        steps = list(token_files.read_steps(raw))
        assert [d for s in steps for d in s[0]] == [None, 1, 2, 3, 4, 5, 6] and np.concatenate([s[2] for s in steps]).tolist() == x.tolist()
        assert all(len(s[2]) <= step or len(s[0]) == 1 for s in steps)


def test_encoder_is_the_library():
    rng = random.Random(2)
    parts = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "12", ",", "_", " the", "\r\n", "漢", "<|endoftext|>", " ", " ", "\x0b", "'ll", "²", "\x1c"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(12))) for _ in range(1500)] + ["", None]
    for own in (texts, [t for t in texts if not t or t.isascii() and "\x1c" not in t]):
        enc = bpe.Encoder(vocabulary(VOCABULARY))
        got = []
        for _, ids, n in enc.column(pa.array(own, pa.string())):
            got += np.split(ids, np.cumsum(n)[:-1])
        assert [x.tolist() for x in got] == [x.tolist() for x in enc.whole([t or "" for t in own])]


def test_added_tokens_as_the_library_has_them(make):
    """Against a tokenizer loaded afresh, with its defaults."""
    from tokenizers import Tokenizer

    fresh, rng = Tokenizer.from_file(vocabulary(VOCABULARY)), random.Random(8)
    parts = ["a", " the", " ", "\n", "é", "12", "漢", "<|endoftext|>", "<|endof", "text|>", "<|", "\u00a0"]
    texts = ["a <|endoftext|> b", "<|endof", "text|>", "<|endoftext|>", "", None, "<|endoftext|><|endoftext|>"]
    texts += ["".join(rng.choice(parts) for _ in range(rng.randrange(9))) for _ in range(800)]
    for own in (texts, [t for t in texts if not t or "\u00a0" not in t], texts[:1], ["x", "y"]):
        want, got = [fresh.encode(t or "", add_special_tokens=False).ids for t in own], []
        for _, ids, n in bpe.Encoder(vocabulary(VOCABULARY)).column(pa.array(own, pa.string())):
            got += np.split(ids, np.cumsum(n)[:-1])
        assert [x.tolist() for x in got] == want
    assert fresh.encode(texts[0], add_special_tokens=False).ids == [64, 220, 50256, 275]
    docs = make([(i, t) for i, t in enumerate(texts)])
    n = [len(fresh.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert {r.n_tokens: r.n_docs for r in token_counts.token_counts(docs, vocabulary(VOCABULARY)).collect()} == Counter(n)


def test_added_tokens_in_files(spark, make):
    from tokenizers import Tokenizer

    fresh, start = Tokenizer.from_file(vocabulary(VOCABULARY)), 0
    texts = ["one", "a <|endoftext|> b", "<|endoftext|>", "<|endof", "text|> two"]
    files, ranks = token_files.write_token_files(make(list(enumerate(texts))), vocabulary(VOCABULARY), end_id=2)
    for r in sorted(token_files.read_token_files(spark, files, ranks).collect(), key=lambda r: r.start):
        ids = np.array(fresh.encode(texts[r.doc_id], add_special_tokens=False).ids + [2], "<u4")
        assert (r.start, r.n_tokens, zlib.crc32(r.ids)) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)


def test_token_files(spark, make, odd_rows):
    docs = make([(r[0], r[1]) for r in odd_rows])
    files, ranks = token_files.write_token_files(docs, vocabulary(VOCABULARY), end_id=2)
    got = sorted(token_files.read_token_files(spark, files, ranks).collect(), key=lambda r: r.start)
    enc, start = bpe.encoder(vocabulary(VOCABULARY)), 0
    assert [r.doc_id for r in got] == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 9]
    texts = {r[0]: r[1] or "" for r in odd_rows}
    for r in got:
        ids = np.append(enc.whole([texts[r.doc_id]])[0], 2).astype("<u4")
        assert (r.start, r.n_tokens, zlib.crc32(r.ids)) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    files, ranks = token_files.write_token_files(make([]), vocabulary(VOCABULARY), end_id=2)
    assert token_files.read_token_files(spark, files, ranks).collect() == []


def test_chunks_that_come_again_are_kept_when_the_cache_is_full(monkeypatch):
    """A word of every text goes to the library's model once, however often the cache is full; ids are the library's."""
    monkeypatch.setattr(bpe, "CACHE", 6)
    enc, asked = bpe.Encoder(vocabulary(VOCABULARY)), Counter()
    library = enc.library

    def tokenize(shown):
        asked[shown] += 1
        return library.model.tokenize(shown)

    rng = random.Random(3)
    texts = [" ".join(["always", *("".join(rng.choices("abcdefgh", k=7)) for _ in range(3)), "always."]) for _ in range(60)]
    with monkeypatch.context() as m:
        m.setattr(enc, "library", SimpleNamespace(model=SimpleNamespace(tokenize=tokenize)))
        got = [ids.tolist() for t in texts for _, ids, _ in enc.column(pa.array([t]))]
    assert got == [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert asked["always"] == 1 and len(enc.cache) + len(enc.before) < 30


def test_words_and_marks_have_the_ids_of_the_library():
    """Words of ASCII and other letters with marks, digits and signs before and after them."""
    enc, rng = bpe.Encoder(vocabulary(VOCABULARY)), random.Random(5)
    pieces_ = ["foo", "Bar", "caf\u00e9", "\u00aa", "\u00b5m", "\u00df", "9", "\u00b2", "_", "'s", "'", ".", ",", ";", ":", "!", "?", "?!", "$", "\u00d7", "\u0631", "\n", " ", "  "]
    texts = ["".join(rng.choices(pieces_, k=rng.randint(1, 9))) for _ in range(4000)]
    for a, ids, n in enc.column(pa.array(texts)):
        ends = np.cumsum(n)
        for t, x, y in zip(texts[a : a + len(n)], ends - n, ends, strict=True):
            assert ids[x:y].tolist() == enc.library.encode(t, add_special_tokens=False).ids, t


def test_places_of_token_files(spark):
    """Files of several tasks, out of order and one task without any: each begins where all before it end."""
    rows = [(t, f, s, p, f"{t}-{f}-{s}-{p}", 1, 10 * t + f + 3 * s + p + 1) for t in (0, 1, 4, 11) for f in (0, 1) for s in (4, 70) for p in (0, 1, 2)]
    made = spark.createDataFrame(rows[::-1], token_files.FILES).repartition(5)
    want, before = {}, 0
    for r in sorted(rows):
        want[r[4]], before = before, before + r[6]
    assert {r.path: r.before for r in token_files.with_places(made).collect()} == want


def test_token_counts(make, odd_rows):
    enc = bpe.encoder(vocabulary(VOCABULARY))
    n = [len(enc.whole([r[1] or ""])[0]) for r in odd_rows]
    for r in token_counts.token_counts(make(odd_rows), vocabulary(VOCABULARY)).collect():
        assert r.n_docs == n.count(r.n_tokens) and r.docs_at_least == sum(x >= r.n_tokens for x in n) and r.tokens_at_least == sum(x for x in n if x >= r.n_tokens)
        assert r.truncated_total == sum(min(x, r.n_tokens) for x in n) and r.share_up_to == pytest.approx(sum(x <= r.n_tokens for x in n) / len(n))
    assert token_counts.token_counts(make([]), vocabulary(VOCABULARY)).collect() == []


def test_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 24)).astype(np.float32)
    x[50:300] = x[0]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(2000, None), (2001, [0.0] * 24), (2002, [float("nan")] * 24), (2100, [1.0])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4)
    got: dict = {}
    for r in ann.nearest(t, t.filter("vec_id % 100 = 0")).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    hit = 0
    for q in range(0, 1500, 100):
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(axis=1))
        d[q] = np.inf
        want = np.lexsort((np.arange(1500), d))[:10]
        hit += len({v for v, _ in got[q]} & set(want.tolist()))
        assert [s for _, s in got[q]] == [d[v] for v, _ in got[q]]
    assert set(got) == set(range(0, 1500, 100)) and hit >= 0.97 * 150
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert ann.nearest(empty, empty).collect() == []


def every_path(p, word):
    into = p.edges(word)

    def go(b):
        return [(0.0, ())] if b == 0 else [(s + t, ids + i) for a, t, i in into[b] for s, ids in go(a)]

    return sorted(go(len(word)), key=lambda x: -x[0])


def test_best_segmentations():
    p, rng = pieces.Pieces(vocabulary(PIECES)), random.Random(6)
    for _ in range(120):
        t = "".join(rng.choice(["a", "e", "th", "in", " ", "er", "漢", "\n", "é"]) for _ in range(rng.randrange(1, 7)))
        _, ids, n, scores, others = next(iter(p.column(pa.array([t, "", None]), 4)))
        paths = every_path(p, "▁" + t.replace(" ", "▁"))
        own = ids[: n[0]]
        assert scores[0] == pytest.approx([s for s, _ in paths[:4]]) and n.tolist()[1:] == [0, 0]
        each = [tuple(own.tolist())] + [tuple(pieces.replaced(own, c).tolist()) for c in others[0]]
        assert len(set(each)) == len(each) and all(dict((i, s) for s, i in paths)[e] == pytest.approx(s) for e, s in zip(each, scores[0], strict=True))
        assert p.decode(own, np.array([len(own)]))[0].tobytes().decode() == t


def test_pieces_round_trip(make, odd_rows):
    got = pieces.piece_summary(make(odd_rows), vocabulary(PIECES)).collect()
    text = {r[0]: r[1] or "" for r in odd_rows}
    assert len(got) == len(odd_rows) and all(r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest() for r in got)
    ranks = pieces.segmentations(make([(1, "hello there")]), vocabulary(PIECES)).orderBy("rank").collect()
    assert [r["rank"] for r in ranks] == [1, 2, 3] and ranks[0].score >= ranks[1].score >= ranks[2].score
    assert pieces.piece_summary(make([]), vocabulary(PIECES)).collect() == []


def test_pipeline(spark, make, odd_rows):
    import corpus_pipeline

    passage = " ".join(f"p{i}" for i in range(70))
    other = " ".join(f"q{i}" for i in range(90))
    rows = odd_rows + [(50, f"start {passage} end of the first", "en", "a"), (51, f"{other} {passage}", "en", "a"), (52, f"{other} {passage} !", "en", "b")]
    docs = make(rows)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["language"](spark, docs, "")
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {None, 4, 5, 6, 7, 8, 50, 51, 52}
    once = stages["near_duplicates"](spark, kept, "")
    assert sorted((r.doc_id for r in once.collect()), key=str) == sorted([None, 4, 5, 6, 8, 50, 51], key=str)
    cut = {r.doc_id: r for r in stages["repeated_passages"](spark, once, "").collect()}
    assert cut[51].text == other and cut[51].n_chars == len(other) and cut[50].text == rows[-3][1]
    assert stages["source_mix"](spark, once, "").columns == docs.columns
    assert stages["pieces"](spark, once, "").filter(F.col("n_pieces") > 0).count() == 7


CLASHES = ("_id", "_n", "_sha", "_kept", "_draws", "_words", "_key", "_shard", "_order", "row", "key", "own", "kept", "times", "there", "words", "node", "g", "h", "n", "bucket", "block", "label", "score", "src", "size", "draws", "a b", "x.y")


def with_clashes(docs):
    return docs.select("*", *[F.lit(c).alias(c) for c in CLASHES])


def test_stages_pass_clashing_columns_on(spark, make, odd_rows):
    import corpus_pipeline

    docs = with_clashes(make(odd_rows + [(60, " ".join(f"p{i}" for i in range(70)), None, "a"), (61, " ".join(["x", *(f"p{i}" for i in range(70)), *(f"y{i}" for i in range(60))]), "en", "a")]))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, "")
        rows = out.collect()
        assert out.columns == docs.columns and rows, name
        assert all(r[c] == c for r in rows for c in CLASHES), name
        assert stage(spark, docs.limit(0), "").collect() == [], name
    assert corpus_pipeline.STAGES[-1][1](spark, docs, "").count() == 13


def test_operators_ignore_clashing_columns(spark, make, odd_rows):
    from qirtas.llm import language, quality, repeats, similar

    plain, docs = make(odd_rows), with_clashes(make(odd_rows))
    labels = spark.createDataFrame([(2, 1), (4, 1), (5, 0), (5, 1), (6, 0), (None, 1), (8, None), (9, 7)], "doc_id long, quality int")
    path = vocabulary(VOCABULARY)
    for run in (
        lambda d: repeats.remove_repeats(d), lambda d: similar.similar_components(d), lambda d: language.predict_language(d, lambda i: i.isNotNull()), lambda d: quality.score_quality(d, labels, lambda i: i.isNotNull()),
        lambda d: mixing.mix_sources(d, shards=2), lambda d: token_counts.token_counts(d, path), lambda d: pieces.piece_summary(d, vocabulary(PIECES)),
        lambda d: winnowing.fingerprints(d.filter("doc_id is not null and doc_id <> 6")), lambda d: token_files.read_token_files(spark, *token_files.write_token_files(d, path, end_id=2)),
    ):
        assert sorted(map(str, run(docs).collect())) == sorted(map(str, run(plain).collect()))


def test_likeness_of_edited_texts(make):
    rows = [(1, "the quick brown fox jumps over the lazy dog and runs away " * 20), (2, "something else entirely without any likeness whatever to it " * 20), (3, None)]
    got = {r.doc_id: r for r in winnowing.fingerprints(make(rows)).collect()}
    assert 0.3 < got[1].near_edited <= 1 and got[1].near_next < 0.1 and all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got.values())


def test_draws_follow_the_distribution():
    rng = np.random.default_rng(4)
    for good, bad, n in ((5, 7, 4), (50, 3, 20), (1000, 4000, 900), (4, 0, 3), (0, 5, 2)):
        x = np.array([mixing.hypergeometric(rng, good, bad, n) for _ in range(3000)])
        all_ = good + bad
        var = n * good * bad * (all_ - n) / (all_**2 * max(all_ - 1, 1))
        assert abs(x.mean() - n * good / all_) <= 5 * (var / 3000) ** 0.5 + 1e-9 and abs(x.var() - var) <= 0.15 * var + 1e-9
        assert x.min() >= max(0, n - bad) and x.max() <= min(n, good)
    q = mixing.split_quotas([10**11, 5, 3 * 10**10], 6, 2)
    assert q.sum(axis=1).tolist() == [10**11, 5, 3 * 10**10] and np.ptp(q.sum(axis=0)) <= 3 and q.min() >= 0


def test_targets_and_sizes_against_sql(spark, make, odd_rows):
    """Sizes and targets by DuckDB, where no target is cut."""
    import duckdb

    rows = [r for r in odd_rows if r[0] not in (4, 5)] + [(90, "w " * 40, "en", None)] + [(20 + i, "w " * (50 + i % 7), "en", "abc"[i % 3]) for i in range(60)]
    con = duckdb.connect()
    con.execute("create table d (doc_id bigint, text varchar, source varchar)")
    con.executemany("insert into d values (?, ?, ?)", [(r[0], r[1], r[3]) for r in rows])
    want = con.execute("""with s as (select doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as size from d), t as (select source, sum(size) as source_size, row_number() over (order by source nulls last) as k from s group by 1),
      w as (select *, [5, 2, 1][(k - 1) % 3 + 1] as w from t), a as (select *, w / sum(w) over () * sum(source_size) over () as target from w) select doc_id, size, source_size, target from s join a on s.source is not distinct from a.source""").fetchall()
    got = mixing.mix_sources(make(rows), cap=1e9, shards=4).select("doc_id", "size", "source_size", "target").collect()
    near = lambda x: (str(x[0]), x[1], x[2], round(x[3], 6))
    assert sorted(map(near, got)) == sorted(map(near, want))


def test_the_best_path_does_not_depend_on_the_length(monkeypatch):
    """Words of 24 and 25 bytes, many of them with paths of equal scores, solved together and one by one."""
    p, rng = pieces.Pieces(vocabulary(PIECES)), random.Random(9)
    words = [(" " + "".join(rng.choice(parts) for _ in range(40)))[:n].encode() for n in (5, 23, 24, 25, 26) for parts in ("ab", "aaab", "ththe", "0123", "#") for _ in range(12)]
    words += [(" " + "é" * 12).encode()[:25], (" 漢" * 1 + "字" * 7).encode()]
    monkeypatch.setattr(pieces, "TOGETHER", 64)
    together = p.solve(words)
    monkeypatch.setattr(pieces, "TOGETHER", 0)
    for w, a, b in zip(words, together, p.solve(words), strict=True):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:]), w


def test_neighbours_in_several_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(400, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(7, x[7].tolist()), (500, [None] * 16), (600, [1.0] * 15 + [None])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    run = lambda: sorted(map(tuple, ann.nearest(t, t.filter("vec_id % 20 = 0")).collect()))
    whole = run()
    monkeypatch.setattr(ann, "QUERY_BLOCK", 6)
    assert run() == whole and len(whole) == 20 * 10


def test_hot_keys_are_joined_whole(spark):
    from qirtas.llm import shared

    rows = shared.write_table(spark.range(5000).select((F.when(F.col("id") < 4000, 1).otherwise(F.col("id") % 50 + 2)).alias("k"), "id"), "hot-rows")
    keyed = shared.write_table(rows.groupBy("k").agg(F.count("*").alias("rows"), F.min("id").alias("m")), "hot-keys")
    got = shared.join_split(rows, keyed, "k")
    assert got.columns == ["k", "id", "m"] and sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(keyed.drop("rows"), "k").collect()))
    few = shared.smallest(rows, "k", "id", 100).groupBy("k").count().collect()
    assert {r.k: r["count"] for r in few} == {k: 100 if k == 1 else 20 for k in range(1, 52)}
    assert shared.sifted(rows, rows.filter("id < 3"), "id").filter("id < 3").count() == 3


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from qirtas.llm import shared

    far = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(master="spark://x"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared.shared_dir(far)
