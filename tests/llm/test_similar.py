"""N-gram Jaccard join against all pairs."""

from __future__ import annotations

import random

import numpy as np
import pytest

from qirtas.llm.components import components
from qirtas.llm.similar import first_part, least_overlap, overlap_needed, search_links, similar_components


def brute(rows, percent=75, k=5):
    def shingles(t):
        w = (t or "").encode().lower().split() if (t or "").isascii() else "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "").encode().split()
        return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())

    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    least: dict = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return sorted(((d, len(s), least.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))), key=str)


def found(docs):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in similar_components(docs).collect()), key=str)


def edited(seed, bases, copies):
    rng = random.Random(seed)
    hot = [f"h{i}" for i in range(60)]
    rows, n = [], 0
    for _ in range(bases):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.randrange(3, 120))] + (hot if rng.random() < 0.5 else [])
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 25)):
                w[rng.randrange(len(w))] = rng.choice(["x", "Y", "z"])
            rows.append((n * 7 % 10007, " ".join(w)))
            n += 1
    return rows


@pytest.mark.parametrize("seed, bases, copies", [(1, 25, 8), (2, 2, 150), (3, 120, 2)])
def test_against_all_pairs(make, seed, bases, copies):
    rows = edited(seed, bases, copies)
    assert found(make(rows)) == brute(rows)


def test_odd_rows(make, odd_rows):
    rows = [(r[0], r[1]) for r in odd_rows] + [(30, "ONE two"), (31, "É two"), (32, "é two")]
    assert found(make(rows)) == brute(rows)


def test_empty_table(make):
    assert found(make([])) == []


def test_group_search_finds_all_connections():
    rng = np.random.default_rng(3)
    for split in (None, 15):
        base = np.unique(rng.integers(1, 1 << 60, 80, dtype=np.uint64))
        sets = [np.unique(np.concatenate([rng.choice(base, 60 + int(rng.integers(20)), replace=False), rng.integers(1, 1 << 60, int(rng.integers(10)), dtype=np.uint64)])) for _ in range(30)]
        links = set(search_links(sets, 75, split))
        want = [(a, b) for b in range(30) for a in range(b) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 75 * len(np.union1d(sets[a], sets[b])) and (split is None or (a < split <= b))]

        def classes(pairs):
            root = list(range(30))
            for a, b in pairs:
                ra, rb = root[a], root[b]
                root = [ra if r == rb else r for r in root]
            return [[root.index(r)] for r in root]

        assert classes(links) == classes(want)


def test_first_parts_of_linked_sets_meet():
    rng = np.random.default_rng(5)
    hot = np.sort(rng.integers(1, 1 << 60, 40, dtype=np.uint64))
    for _ in range(200):
        base = np.unique(np.concatenate([rng.integers(1, 1 << 60, int(rng.integers(1, 60)), dtype=np.uint64), rng.choice(hot, int(rng.integers(40)), replace=False)]))
        a = np.unique(rng.choice(base, max(1, int(len(base) * 0.9)), replace=False))
        if 100 * len(a) >= 75 * len(base):
            (p, l), (q, m) = first_part(a, hot, 75), first_part(base, hot, 75)
            assert len(np.intersect1d(p, q)) >= min(l, m)


def test_thresholds():
    for n in range(1, 60):
        assert least_overlap(n, 75) == min(c for c in range(n + 1) if 100 * c >= 75 * n)
        for m in range(1, 60):
            assert overlap_needed(n, m, 75) == min(c for c in range(n + m + 1) if 100 * c >= 75 * (n + m - c))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(1, 41)) and all(got[i] == 100 for i in range(101, 140))
