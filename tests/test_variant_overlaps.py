"""The token overlap of every two readings, by brute force."""

from __future__ import annotations

import re
from itertools import combinations

import pytest

from qirtas.operators import evaluate
from qirtas.plans import catalog


def words(t):
    return re.findall("[0-9A-Za-z؀-ۿ]+", (t or "").translate(str.maketrans("٠١٢٣٤٥٦٧٨٩", "0123456789")).lower().replace("ـ", " "))


def overlap(a, b):
    a, b = words(a), words(b)
    there = set(b)
    return sum(w in there for w in a) / len(a) if a and b else 0.0


def close(got, want):
    """Rounding at a tie may go either way in the last place."""
    assert got.keys() == want.keys()
    assert all(abs(x - y) < 5.1e-5 for k in want for x, y in zip(got[k], want[k], strict=True))


def test_every_two_configurations(spark):
    texts = {(1, "x"): "a a b c", (1, "y"): "A d", (1, "z"): "", (2, "x"): "عـ ١٢ نص", (2, "y"): "نص 12 12 12", (3, "x"): "alone", (4, "x"): None, (4, "y"): "é !", (5, "x"): "no", (5, "y"): "yes"}
    rows = spark.createDataFrame([(d, c, t) for (d, c), t in texts.items()], "d long, c string, t string")
    found = evaluate.pairwise_overlap(rows, "d", "c", "t").collect()
    want = {(d, a, b): (overlap(texts[d, a], texts[d, b]), overlap(texts[d, b], texts[d, a])) for (d, a), (e, b) in combinations(sorted(texts), 2) if d == e}
    assert len(found) == len(want)
    close({(r.d, r.config, r.other): (r.left_in_right, r.right_in_left) for r in found}, want)


@pytest.mark.parametrize("size", ["sf0.001"])
def test_every_two_readings_of_whole_texts(spark, size):
    want = {}
    for r in spark.read.parquet(f"/root/testdata/{size}/documents.parquet").collect():
        own = {"empty": "", "half": r.text[: len(r.text) // 2], "lower": r.text.lower(), "raw": r.text}
        want |= {(r.doc_id, a, b): (overlap(own[a], own[b]), overlap(own[b], own[a])) for a, b in combinations(sorted(own), 2)}
    found = catalog.QUERIES["variant_overlaps"](spark, f"/root/testdata/{size}").collect()
    assert len(found) == len(want)
    close({(r.doc_id, r.config, r.other): (r.left_in_right, r.right_in_left) for r in found}, want)


def test_a_batch_is_taken_a_few_rows_at_a_time():
    import pyarrow as pa

    from qirtas.functions import udfs

    n = 2 * udfs.OVERLAP_ROWS + 1
    batch = pa.RecordBatch.from_arrays([pa.array(range(n)), pa.array([["y", "x", None]] * n), pa.array([["a b", "a", "c"]] * n)], ["key", "config", "tokens"])
    out = list(udfs.token_overlaps(iter([batch, batch.slice(0, 0)])))
    assert [len(x) for x in out] == [udfs.OVERLAP_ROWS, udfs.OVERLAP_ROWS, 1]
    assert [r for x in out for r in x.to_pylist()] == [{"key": i, "config": "x", "other": "y", "left_in_right": 1.0, "right_in_left": 0.5} for i in range(n)]
