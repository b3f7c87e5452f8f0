"""Substring dedup against a brute-force version."""

from __future__ import annotations

import hashlib
import random

import pytest

from qirtas.llm.repeats import remove_repeats


def brute(rows, length):
    words = [(i, (t or "").encode().split()) for i, t in rows]
    first: dict = {}
    for i, w in words:
        if i is not None:
            for p in range(len(w) - length + 1):
                k = tuple(w[p : p + length])
                first[k] = min(first.get(k, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - length + 1) if i is not None else ():
            if first[tuple(w[p : p + length])] < i:
                gone.update(range(p, p + length))
        kept = b" ".join(x for p, x in enumerate(w) if p not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


def found(docs, length):
    key = lambda r: tuple(str(x) for x in r)
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in remove_repeats(docs, length).collect()), key=key)


def passages(seed, count):
    """Texts of shared passages, edited copies, runs of one word, in shuffled order."""
    rng = random.Random(seed)
    pieces = [[f"w{rng.randrange(40)}" for _ in range(rng.randrange(20, 80))] for _ in range(8)] + [["same"] * rng.randrange(10, 70), ["a", "b"] * 30]
    rows = []
    for i in rng.sample(range(10 * count), count):
        words = [w for p in rng.choices(pieces, k=rng.randrange(1, 5)) for w in (p if rng.random() < 0.7 else p[rng.randrange(10) :])]
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"e{rng.randrange(5)}"
        rows.append((i, " ".join(words)))
    return rows + [(rows[0][0] + 1, rows[0][1])] * 2


@pytest.mark.parametrize("seed, length", [(1, 50), (2, 20), (3, 17)])
def test_against_brute_force(make, seed, length):
    rows = passages(seed, 60)
    key = lambda r: tuple(str(x) for x in r)
    assert found(make(rows), length) == sorted(brute(rows, length), key=key)


def test_odd_rows(make, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows] + [(20, odd_rows[3][1]), (20, "other text " * 60), (21, "other text " * 60), (None, "other text " * 60)]
    key = lambda r: tuple(str(x) for x in r)
    assert found(make(rows), 50) == sorted(brute(rows, 50), key=key)


def test_empty_table(make):
    assert found(make([]), 50) == []


def test_shortest_texts_and_ends(make):
    """Texts of one edge and a few more, which begin and end where others do."""
    w = [f"w{i}" for i in range(56)]
    rows = [(1, " ".join(w)), (2, " ".join(w[:50])), (3, " ".join(w[3:53])), (4, " ".join(["x", *w[2:54], "y"])), (5, " ".join(w[:52])), (6, " ".join(w[6:])), (7, " ".join([*w[:51], *w[:51]]))]
    key = lambda r: tuple(str(x) for x in r)
    assert found(make(rows), 50) == sorted(brute(rows, 50), key=key)
