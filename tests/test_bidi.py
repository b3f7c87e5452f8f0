"""Display order: the standard's own examples, and random lines against a plain reading of its rules."""

from __future__ import annotations

import random
import re
import unicodedata

import pytest

from qirtas.functions import bidi

LRI, RLI, PDI, FSI, RLE, LRE, PDF, RLO, LRO = "⁦", "⁧", "⁩", "⁨", "‫", "‪", "‬", "‮", "‭"
TO = {c: chr(0x5D0 + i) for i, c in enumerate("ABCDEFGHIJKLMNOPQRSTUVWXYZ")}
BACK = {v: k for k, v in TO.items()}


def show(text):
    """Capitals stand for right-to-left letters, as in the standard."""
    return "".join(BACK.get(c, c) for c in bidi.displayed("".join(TO.get(c, c) for c in text)))


@pytest.mark.parametrize(
    ("stored", "shown"),
    [
        ("car means CAR.", "car means RAC."),
        (f"{RLI}car MEANS CAR.{PDI}", f"{RLI}.RAC SNAEM car{PDI}"),
        (f'he said "{RLI}car MEANS CAR{PDI}."', f'he said "{RLI}RAC SNAEM car{PDI}."'),
        (f"DID YOU SAY '{LRI}he said \"{RLI}car MEANS CAR{PDI}\"{PDI}'?", f"?'{PDI}he said \"{RLI}RAC SNAEM car{PDI}\"{LRI}' YAS UOY DID".replace(PDI, "\1").replace(LRI, "\1").replace(RLI, "\1")),
        ("", ""), ("abc", "abc"), ("ABC", "CBA"), ("ABC 123 DEF", "FED 123 CBA"), ("a (B) c", "a (B) c"), ("A (b) C", "C (b) A"), ("A(B)", "(B)A"), ("AB 1,234.5 %", "% 1,234.5 BA"), ("ab  ", "ab  "), ("AB  ", "  BA"),
        ("smith (fabrikam ARABIC) HEBREW", "smith (fabrikam CIBARA) WERBEH"),
        ("ARABIC (fabrikam)", "(fabrikam) CIBARA"), (f"a{RLE}b C{PDF}d", "aC bd"), (f"{RLO}abc{PDF}", "cba"), (f"A{LRO}BC{PDF}", "BCA"), (f"x{FSI}A b{PDI}y", f"x{FSI}b A{PDI}y"), (f"A{PDF}{PDI}b", f"b{PDI}A"),
    ],
)
def test_published_and_small_lines(stored, shown):
    plain = lambda x: re.sub(f"[{LRI}{RLI}{PDI}{FSI}\1]", "", x)
    assert plain(show(stored)) == plain(shown)


def plainly(line):
    """Rules W1 to L2 on the types as a string of single letters, for lines without explicit codes and brackets."""
    code = {"L": "L", "R": "R", "AL": "A", "EN": "1", "AN": "2", "ES": "+", "ET": "%", "CS": ",", "NSM": "m", "B": "_", "S": "_", "WS": "w", "ON": "o"}
    t = "".join(code[unicodedata.bidirectional(c)] for c in line)
    strong = re.search("[LRA]", t)
    base = int(bool(strong) and strong.group() != "L")
    sos = "R" if base else "L"
    t = sos + t
    while re.search("[^m]m", t):
        t = re.sub("([^m])m", r"\1\1", t)
    while (u := re.sub("(A[^LRA]*?)1", r"\g<1>2", t)) != t:
        t = u
    t = t.replace("A", "R")
    while (u := re.sub("1[+,]1", "111", t)) != t or (u := re.sub("2,2", "222", t)) != t:
        t = u
    while (u := re.sub("%1|1%", "11", t)) != t:
        t = u
    t = re.sub("[+,%]", "o", t)
    while (u := re.sub("(L[^LR1]*)1", r"\1L", t)) != t:
        t = u
    t = t + sos
    side = lambda c: "L" if c == "L" else "R"
    t = re.sub("(?<=[LR12])[ow_]+(?=[LR12])", lambda m: (side(t[m.start() - 1]) if side(t[m.start() - 1]) == side(t[m.end()]) else sos) * len(m.group()), t)[1:-1]
    levels = [{0: {"L": 0, "R": 1}.get(c, 2), 1: {"R": 1}.get(c, 2)}[base] for c in t]
    end = re.search(r"\s*\Z", line).start()
    levels[end:] = [base] * (len(line) - end)

    def turn(items, level):
        if not items or level > 2:
            return items
        out, i = [], 0
        while i < len(items):
            j = i
            while j < len(items) and items[j][1] >= level:
                j += 1
            out += turn(items[i:j], level + 1)[::-1] if j > i else [items[i]]
            i = max(j, i + 1)
        return out

    return "".join(c for c, _ in turn(list(zip(line, levels, strict=True)), 1))


def test_random_lines_against_the_plain_rules():
    rng = random.Random(4)
    for _ in range(4000):
        line = "".join(rng.choice("abאבبت12١٢+-,.:%$ !?ً́") for _ in range(rng.randrange(12)))
        assert bidi.displayed(line) == plainly(line), [hex(ord(c)) for c in line]


def test_random_codes_lose_no_letter():
    rng = random.Random(5)
    for _ in range(2000):
        line = "".join(rng.choice(f"abאب 1(){LRI}{RLI}{PDI}{FSI}{RLE}{LRE}{PDF}{RLO}{LRO}") for _ in range(rng.randrange(24)))
        letters = lambda x: sorted(c for c in x if c in "abאب 1")
        assert letters(bidi.displayed(line)) == letters(line)
    assert len(bidi.displayed(RLE * 200 + "abc" + "[" * 100)) == 103


def test_only_lines_with_arabic(spark):
    text = "abc אב\nx بت y\n"
    rows = spark.createDataFrame([(text,), (None,), ("",), ("plain",)], "t string")
    assert [r[0] for r in rows.select(bidi.display_order("t")).collect()] == ["abc אב\nx تب y\n", None, "", "plain"]
