"""The pipeline's language stage: what it keeps and what it fills in."""

from __future__ import annotations

import random

import corpus_pipeline


def test_texts_stay_when_nothing_can_be_learnt(spark, make):
    rows = [(1, "clean words"), (2, "漢字"), (3, "é"), (4, "12 34 !"), (5, ""), (6, None)]
    kept = corpus_pipeline.known_language(spark, make(rows), "").collect()
    assert {(r.doc_id, r.text, r.lang) for r in kept} == {(1, "clean words", None), (2, "漢字", None), (3, "é", None)}


def test_a_missing_language_is_filled(spark, make):
    rng = random.Random(4)
    write = lambda letters: "".join(rng.choice(letters) for _ in range(200))
    rows = [(i, write("abcdefgh " if i % 2 else "stuvwxyz "), ("aa" if i % 2 else "bb") if i < 80 else None) for i in range(100)] + [(200, "漢字漢字", None), (201, write("abcdefgh "), "zz")]
    kept = {r.doc_id: r.lang for r in corpus_pipeline.known_language(spark, make(rows), "").collect()}
    assert kept == {i: "aa" if i % 2 else "bb" for i in range(100)} | {200: None, 201: "zz"}


def test_run_is_its_stages_in_order(spark, tmp_path):
    """The whole run on a small table, against its stages called one after another."""
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    base = [" ".join(word() for _ in range(120)) for _ in range(12)]
    rows = [(i, t, "aa", "s" if i % 3 else "t", len(t) if t is not None else None) for i, t in enumerate([*base, base[0], base[1] + " more", base[2] + " " + base[3], "12 34", None])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(2).write.parquet(f"{tmp_path}/documents.parquet")
    want = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        want = stage(spark, want, str(tmp_path))
    key = lambda df: sorted(str(r) for r in df.collect())
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert key(got) == key(want) and {r.doc_id for r in got.collect()} <= set(range(12))


def test_two_texts_under_one_doc_id_each_follow_their_group(spark, make):
    """The copy of 5 goes though another text of 6 stays."""
    a, b = "one two three four five six", "seven eight nine ten eleven twelve"
    kept = corpus_pipeline.near_duplicates(spark, make([(5, a), (6, a), (6, b), (7, b + " "), (8, None), (8, None)]), "").collect()
    assert sorted((r.doc_id, r.text) for r in kept if r.text) == [(5, a), (6, b)] and [r.doc_id for r in kept if r.text is None] == [8]
