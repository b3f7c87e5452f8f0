"""The merge's rule for every pair of turns, by brute force."""

from __future__ import annotations

import re
import unicodedata

import pytest

from qirtas.functions.metrics import NO_TEXT_REPLIES, SEEN_WORDS, SEEN_WORDS_ARABIC
from qirtas.functions.text import INVISIBLE
from qirtas.plans import catalog

MARKS = [*range(0x610, 0x61B), *range(0x64B, 0x660), 0x670, *range(0x6D6, 0x6EE)]
TABLE = {ord(c): None for c in INVISIBLE + "ـ"}
LETTERS = dict.fromkeys(MARKS) | str.maketrans("أإآٱى٠١٢٣٤٥٦٧٨٩", "ااااي0123456789")
TURNS = [
    "un café déjà vu, très court", "un café déjà vu, très court et puis une suite bien plus longue que la première",
    "المادة ٥ من القانون رقم 123/45 بتاريخ 1/2/2020", "نص عربي قصير", "", None, "----- ===== !!!!! a b c 1 2 3",
    "plain words that are quite ordinary and have no mark at all", "plain words that are quite ordinary and have no mark at all", "no text visible", "كَتَبَ الطالبُ الدرسَ في دفترِه وقرأه مرتين قبل النوم",
    "ﬁne ① ｗｉｄｅ", "漢字" * 30, "a" * 40, "é" * 44,
]


def reply(t):
    t = " ".join(t.lower().split()).strip("()[]{} .")
    seen = "image" in t and "text" in t and any(w in t for w in SEEN_WORDS) or "الصورة" in t and "نص" in t and any(w in t for w in SEEN_WORDS_ARABIC)
    return bool(t) and (t.startswith("scanned with") or "camscanner" in t or seen or any(t.startswith(x.strip("()[]{} .")) for x in NO_TEXT_REPLIES))


def normal(t):
    t = "\n".join(x.rstrip() for x in re.split("\r\n|\r|\n", t or "") if not reply(x)).strip()
    t = "" if reply(t) else t
    return " ".join(unicodedata.normalize("NFKC", t).translate(TABLE).translate(LETTERS).split())


def score(t):
    w, arabic = t.split(), len(re.findall("[؀-ۿ]", t))
    if not t or reply(t):
        return -1.0
    fields = sum(re.search(p, t) is not None for p in (r"\b\d[\d/\-]{2,}\b", r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b", r"(المادة|مادة)\s+\d+"))
    letters = len(re.findall(r"[A-Za-z\d]", t)) + arabic
    out = min(len(w), 120) / 120 * 1.2 + 1 / 12 * 0.25 + min(letters / max(len(t), 1), 1) * 0.45 + fields * 0.12 + (0.2 if arabic else 0)
    out -= sum(len(x) == 1 for x in w) / len(w) * 1.6 + sum(len(x) <= 2 and any(c.isdigit() for c in x) for x in w) / len(w) * 1.3
    return out - min(len(re.findall(r"(.)\1{4,}", t)), 3) * 0.1 - (0.2 if len(w) >= 20 else 0)


def rule(a, b):
    a, b = normal(a), normal(b)
    if not a or not b:
        return "neither" if not a and not b else "primary_only" if a else "secondary_only"
    if 0.7 <= len(a) / len(b) <= 1.3:
        return "verify"
    q, r = score(a), score(b)
    return "primary_quality" if q > r + 0.2 else "secondary_quality" if r > q + 0.2 else "primary_shorter" if len(a) <= len(b) else "secondary_shorter"


def held(spark, folder):
    rows = spark.read.parquet(f"{folder}/conversations.parquet").collect()
    texts = {(r.conv_id, r.turn): r.text for r in rows}
    want = {(c, t): rule(x, texts[c, t + 1]) for (c, t), x in texts.items() if (c, t + 1) in texts}
    got = catalog.QUERIES["merge_rules_whole"](spark, str(folder)).collect()
    assert len(got) == len(want) and {(r.conv_id, r.turn): r.rule for r in got} == want
    return texts, want


def test_every_pair_of_a_fixture(spark, tmp_path):
    rows = [(1, i, "user", t) for i, t in enumerate(TURNS)] + [(2, i, "user", t) for i, t in enumerate(reversed(TURNS))] + [(3, 0, "user", "alone"), (3, 2, "user", "é after a gap")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    _, want = held(spark, tmp_path)
    assert len(want) == 2 * (len(TURNS) - 1) and len(set(want.values())) >= 7


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_every_pair_of_whole_tables(spark, size):
    texts, want = held(spark, f"/root/testdata/{size}")
    assert any(not (texts[c, t] + texts[c, t + 1]).isascii() for c, t in want)
