"""The character error rate of every passage, by brute force over code points."""

from __future__ import annotations

from qirtas.plans import catalog


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row = row, [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
    return row[-1]


def test_every_passage(spark, tmp_path):
    texts = ["café au lait", "السلام عليكم ورحمة الله", "plain ascii words", "漢字\U0001f600\U0001f600 mixed é", "é", "", None, "aaaa é aaaa", "\U0001f600" * 9]
    spark.createDataFrame(list(enumerate(texts)), "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    want = {i: round(distance(t, t[4:]) / len(t), 6) if t else 0.0 for i, t in enumerate(texts)}
    assert {r.item_id: r.cer for r in catalog.QUERIES["character_errors_whole"](spark, str(tmp_path)).collect()} == want


def test_every_passage_of_a_whole_table(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()
    got = {r.item_id: r.cer for r in catalog.QUERIES["character_errors_whole"](spark, "/root/testdata/sf0.01").collect()}
    assert set(got) == {r.item_id for r in rows} and any(not r.text.isascii() for r in rows)
    for r in [x for x in rows if not x.text.isascii()]:
        assert abs(got[r.item_id] - distance(r.text, r.text[4:]) / len(r.text)) < 1e-6
