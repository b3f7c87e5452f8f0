"""Nearest thumbnails by bounds, against comparing all pairs."""

from __future__ import annotations

import numpy as np
import pytest

from qirtas.operators import thumbnails


def made(n, seed, side=16):
    """Pages of a few kinds, with noise."""
    rng = np.random.default_rng(seed)
    kinds = np.random.default_rng(0).integers(0, 256, (12, 4, 4)).repeat(side // 4, axis=1).repeat(side // 4, axis=2)
    return np.clip(kinds[rng.integers(0, 12, n)] + rng.normal(0, 12, (n, side, side)), 0, 255).astype(np.uint8)


def test_bounds_are_below_the_error():
    a, b = made(20, 1), made(30, 2)
    full = ((a[:, None].astype(float) - b[None]) ** 2).mean(axis=(2, 3))
    for scale in (1, 2, 3, 5, 16, 40):
        low = thumbnails.lower_bounds(a, b, scale)
        assert (low <= full + 1e-6).all()
    assert np.allclose(thumbnails.lower_bounds(a, b, 16), full)


@pytest.mark.parametrize("block", [7, 256])
def test_nearest_is_that_of_all_pairs(spark, block):
    a, b = made(40, 3), np.concatenate([made(90, 4), made(5, 5).repeat(2, axis=0), np.full((1, 16, 16), 255, np.uint8)])
    a = np.concatenate([a, np.full((1, 16, 16), 128, np.uint8)])
    rows = lambda x, p: spark.createDataFrame([(f"{p}{i:03d}", g.tobytes()) for i, g in enumerate(x)] + [(f"{p}x", None), (f"{p}y", b"short")], "name string, grey binary")
    got = {r.target: r for r in thumbnails.nearest_pages(rows(a, "t"), rows(b, "s"), "name", "name", width=16, block=block).collect()}
    full = ((a[:, None].astype(float) - b[None]) ** 2).mean(axis=(2, 3))
    for i in range(len(a)):
        j = int(np.argmin(full[i]))
        want = (f"s{j:03d}", full[i, j]) if full[i, j] < thumbnails.MOST else (None, None)
        assert (got[f"t{i:03d}"].source, got[f"t{i:03d}"].mse) == want
    assert got["tx"].source is None and got["ty"].pairs == 0 and len(got) == len(a) + 2
    assert sum(r.compared for r in got.values()) < 0.2 * len(a) * len(b)


def test_full_comparisons_grow_slower_than_pairs():
    shares = []

    def plain(n, seed):
        rng = np.random.default_rng(seed)
        return np.clip(rng.integers(20, 230, (n, 2, 2)).repeat(8, axis=1).repeat(8, axis=2) + rng.normal(0, 3, (n, 16, 16)), 0, 255).astype(np.uint8)

    for n in (50, 200, 800):
        a, b = plain(n, 6), plain(n, 7)
        shares.append(sum(c for _, _, c in thumbnails.nearest_in(a, b, thumbnails.MOST)) / n / n)
    assert shares[0] > shares[1] > shares[2] and shares[2] < 0.1


def test_thumbnails_of_pages():
    page = np.full((100, 80), 255, np.uint8)
    page[20:60, 10:50] = 40
    small = thumbnails.normalised(page, 32, 40)
    moved = np.full((120, 120), 255, np.uint8)
    moved[50:90, 60:100] = 40
    assert small.shape == (40, 32) and np.abs(small.astype(float) - thumbnails.normalised(moved, 32, 40)).mean() < 1
    g = np.arange(24, dtype=np.uint8).reshape(4, 6)
    assert thumbnails.resized(g, 3, 2).tolist() == [[round(g[2 * i : 2 * i + 2, 2 * j : 2 * j + 2].mean()) for j in range(3)] for i in range(2)] and (thumbnails.resized(g, 6, 4) == g).all()
    wide = thumbnails.resized(g, 4, 4)
    assert wide.shape == (4, 4) and abs(float(wide.mean()) - float(g.mean())) < 1


def test_empty_tables(spark):
    none = spark.createDataFrame([], "name string, grey binary")
    one = spark.createDataFrame([("a", b"abcd")], "name string, grey binary")
    assert thumbnails.nearest_pages(none, one, "name", "name").collect() == [] and [tuple(r) for r in thumbnails.nearest_pages(one, none, "name", "name").collect()] == [("a", None, None, 0, 0)]
