"""Preparation of grey pages, by direct loops on small ones."""

from __future__ import annotations

import numpy as np
import pytest

from qirtas.operators import contrast

rng = np.random.default_rng(1)
PAGES = [rng.integers(0, 256, (h, w), dtype=np.uint8) for h, w in ((1, 1), (3, 7), (16, 16), (19, 23))] + [np.full((9, 9), 77, np.uint8), np.where(rng.random((20, 30)) < 0.2, 30, 220).astype(np.uint8)]


def brute_otsu(g):
    values, best = g.reshape(-1).tolist(), None
    for t in sorted(set(values)):
        a, b = [v for v in values if v <= t], [v for v in values if v > t]
        spread = len(a) * len(b) * (sum(a) / len(a) - sum(b) / len(b)) ** 2 if b else -1.0
        if best is None or spread > best[0] + 1e-9 * abs(best[0]):
            best = (spread, t)
    return best[1]


@pytest.mark.parametrize("g", PAGES)
def test_thresholds(g):
    assert contrast.otsu(g) == brute_otsu(g)
    at = lambda y, x: int(g[min(max(y, 0), g.shape[0] - 1), min(max(x, 0), g.shape[1] - 1)])
    means = [[sum(at(y + i, x + j) for i in range(-2, 3) for j in range(-2, 3)) / 25 for x in range(g.shape[1])] for y in range(g.shape[0])]
    assert np.allclose(contrast.window_means(g, 5), means)
    assert (contrast.local_threshold(g, 5, 7) == np.where(g > np.rint(means) - 7, 255, 0)).all()


@pytest.mark.parametrize("g", PAGES)
def test_contrast(g):
    n = {v: int((g == v).sum()) for v in range(256)}
    first = min(v for v in n if n[v])
    if n[first] < g.size:
        want = {v: round(sum(n[u] for u in range(v + 1)) - n[first]) * 255.0 / (g.size - n[first]) for v in n}
        assert all(abs(int(a) - want[int(v)]) <= 0.5 + 1e-9 for a, v in zip(contrast.equalised(g).reshape(-1), g.reshape(-1), strict=True))
    else:
        assert (contrast.equalised(g) == g).all() and (contrast.stretched(g) == g).all()
    ordered = sorted(g.reshape(-1).tolist())
    cut = int(g.size * 5 // 100)
    low, high = ordered[cut], ordered[-1 - cut]
    if high > low:
        want = [min(max(int((int(v) - low) * 255.0 / (high - low) + 1e-9), 0), 255) for v in g.reshape(-1)]
        assert np.abs(contrast.stretched(g, 5).reshape(-1).astype(int) - want).max() <= 1


@pytest.mark.parametrize("g", PAGES)
def test_neighbourhoods(g):
    at = lambda y, x: int(g[min(max(y, 0), g.shape[0] - 1), min(max(x, 0), g.shape[1] - 1)])
    around = lambda y, x: sorted(at(y + i, x + j) for i in (-1, 0, 1) for j in (-1, 0, 1))
    assert contrast.median3(g).tolist() == [[around(y, x)[4] for x in range(g.shape[1])] for y in range(g.shape[0])]
    w = np.exp(-(np.arange(-4, 5) ** 2) / 2)
    w = w / w.sum()
    blur = [[sum(w[i + 4] * w[j + 4] * at(y + i, x + j) for i in range(-4, 5) for j in range(-4, 5)) for x in range(g.shape[1])] for y in range(g.shape[0])]
    assert np.allclose(contrast.smoothed(g, 1.0), blur) and np.abs(contrast.sharpened(g) - np.clip(1.5 * g - 0.5 * np.array(blur), 0, 255)).max() <= 0.5 + 1e-6


@pytest.mark.parametrize("g", PAGES[2:])
def test_limited_contrast(g):
    tiles, clip = 2, 2.0
    height, width = g.shape
    h, w = -(-height // tiles), -(-width // tiles)
    tables = {}
    for a in range(tiles):
        for b in range(tiles):
            own = [int(g[min(y, height - 1), min(x, width - 1)]) for y in range(a * h, a * h + h) for x in range(b * w, b * w + w)]
            most = max(int(clip * h * w / 256), 1)
            n = [own.count(v) for v in range(256)]
            over = sum(max(k - most, 0) for k in n)
            n = [min(k, most) + over // 256 for k in n]
            left = over % 256
            for i in range(left):
                n[i * max(256 // left, 1)] += 1
            tables[a, b] = [round(sum(n[: v + 1]) * (255.0 / (h * w))) for v in range(256)]
    got = contrast.limited_contrast(g, clip, tiles)
    for y in range(height):
        for x in range(width):
            fy, fx = (y + 0.5) / h - 0.5, (x + 0.5) / w - 0.5
            a, b = int(np.floor(fy)), int(np.floor(fx))
            t = lambda i, j: min(tables[min(max(i, 0), tiles - 1), min(max(j, 0), tiles - 1)][g[y, x]], 255)
            want = (t(a, b) * (1 - fx + b) + t(a, b + 1) * (fx - b)) * (1 - fy + a) + (t(a + 1, b) * (1 - fx + b) + t(a + 1, b + 1) * (fx - b)) * (fy - a)
            assert abs(int(got[y, x]) - want) <= 0.5 + 1e-6


@pytest.mark.parametrize("turn", [-6, -2, 0, 3, 8])
def test_skew_of_lines(turn):
    page = np.full((240, 240), 255, np.uint8)
    y, x = np.mgrid[:240, :240]
    page[np.mod(np.rint(y - (x - 120) * np.tan(np.radians(turn))), 24) < 4] = 0
    assert abs(contrast.skew(page) - turn) <= 0.25
    assert abs(contrast.skew(contrast.straightened(page))) <= 0.75 and contrast.skew(np.full((5, 5), 9, np.uint8)) == 0.0


def test_pages_as_rows(spark):
    rows = [(i, g.shape[1], g.shape[0], g.tobytes()) for i, g in enumerate(PAGES)] + [(90, 3, 3, None), (91, None, 2, b""), (92, 5, 5, b"short")]
    pages = spark.createDataFrame(rows, "id long, width int, height int, grey binary")
    found = {r.id: (r.threshold, r.dark, r.pixels) for r in contrast.otsu_thresholds(contrast.histograms(pages.filter("id < 92"), "id"), "id").collect()}
    assert found == {i: (brute_otsu(g), int((g <= brute_otsu(g)).sum()), g.size) for i, g in enumerate(PAGES)}
    got = {(r.id, r.variant): r for r in contrast.page_variants(pages, "id", sorted(contrast.VARIANTS)).collect()}
    assert len(got) == len(rows) * len(contrast.VARIANTS) and all(len(r.grey) == r.width * r.height for r in got.values())
    assert all(bytes(got[i, "prepared"].grey) == contrast.prepared(g).tobytes() for i, g in enumerate(PAGES)) and bytes(got[90, "binary"].grey) == b""
    with pytest.raises(ValueError, match="unknown variants"):
        contrast.page_variants(pages, "id", ["none"])
