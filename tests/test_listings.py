"""Prefix joins, equal sets of keys, levels of measures."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from qirtas.operators import levels, prefixes


def test_matches_are_those_of_every_pair(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("abé") for _ in range(rng.randrange(n)))
    names = [(i, word(7)) for i in range(80)] + [(100, None), (101, ""), (102, "ab")]
    keys = [(word(4), i) for i in range(25)] + [("", 50), (None, 51), ("ab", 52), ("ab", 53)]
    a, b = spark.createDataFrame(names, "id long, name string"), spark.createDataFrame(keys, "prefix string, key long")
    got = sorted((r.id, r.key) for r in prefixes.prefix_matches(a, "name", b, "prefix").collect())
    assert got == sorted((i, k) for i, n in names for p, k in keys if n is not None and p is not None and n.startswith(p))
    longest = {r.id: r.prefix for r in prefixes.longest_prefix(a, "id", "name", b, "prefix").collect()}
    assert longest == {i: max((p for p, _ in keys if p is not None and n.startswith(p)), key=len) if n is not None else None for i, n in names}
    assert prefixes.prefix_matches(a, "name", b.limit(0), "prefix").collect() == [] and prefixes.longest_prefix(a.limit(0), "id", "name", b, "prefix").collect() == []


def test_targets_and_their_errors(spark):
    files = spark.createDataFrame([("A1.pdf",), ("a2.PDF",), ("B.pdf",), ("B.pdf",), ("c.pdf",), (None,)], "name string")
    wanted = spark.createDataFrame([("A", "first"), ("a", "first"), ("B", "second")], "prefix string, key string")
    assert {(r.key, r.name) for r in prefixes.select_targets(files, "name", wanted, "prefix", "key").collect()} == {("first", "a2.PDF"), ("second", "B.pdf")}
    more = wanted.union(spark.createDataFrame([("Z", "third")], wanted.schema))
    with pytest.raises(Exception, match="missing target: third"):
        prefixes.select_targets(files, "name", more, "prefix", "key").collect()
    found = spark.createDataFrame([("x", 1), ("y", 2)], "key string, n int")
    with pytest.raises(Exception, match="surplus key: y"):
        prefixes.same_keys(found, found.filter("key = 'x'"), "key").collect()
    assert prefixes.same_keys(found, found.union(found), "key").count() == 2 and prefixes.same_keys(found.limit(0), found.limit(0), "key").collect() == []


def test_inventory_of_a_folder(spark):
    pages = spark.createDataFrame([("a", " one "), ("a", None), ("a", "  "), ("b", "xy")], "name string, text string")
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    got = prefixes.folder_inventory(pages, files, "name", F.col("text")).orderBy("name").collect()
    assert [tuple(r) for r in got] == [("a", 3, 1, 3), ("b", 1, 1, 2), ("c", 0, 0, 0)]


def test_levels_add_up(spark):
    rows = [("r", "d1", 1, "a bb 12/3/2020", 1.0, None), ("r", "d1", 2, None, None, 0.5), ("r", "d2", 1, "1 2 3 x", 3.0, None), ("s", "d1", 1, "المادة 12 word\nno text", None, None)]
    df = spark.createDataFrame(rows, "c string, d string, p int, t string, s double, k double")
    got = {(r.level, r.config, r.document, r.page): r for r in levels.document_levels(df, "c", "d", "p", "t", "s", "k").collect()}
    assert len(got) == 1 + 2 + 3 + 4
    top, page = got[("all", None, None, None)], got[("page", "s", "d1", 1)]
    assert (top.pages, top.tokens, top.single, top.fragments, top.failed, top.passed) == (4, 12, 5, 4, 3, 1)
    assert page.articles == 1 and page.tokens == 5 and page.avg_score == -1.0 and page.avg_confidence == 0.0
    for level, keys in (("configuration", 1), ("document", 2)):
        for k, r in got.items():
            if k[0] == level:
                own = [x for y, x in got.items() if y[0] == "page" and y[1 : 1 + keys] == k[1 : 1 + keys]]
                assert all(r[c] == sum(x[c] for x in own) for c in (*levels.COUNTS, "pages", "failed", "passed"))
    assert got[("document", "r", "d1", None)].avg_score == 1.0 and got[("configuration", "r", None, None)].avg_score == 2.0 and got[("configuration", "r", None, None)].avg_confidence == 0.5
    assert [r.level for r in levels.document_levels(df.limit(0), "c", "d", "p", "t").collect()] == []
