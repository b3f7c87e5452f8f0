"""Lines without explicit codes are resolved in the string of their types; character by character they come out alike."""

import random

from qirtas.functions import bidi


def test_plain_lines_agree_with_the_rules():
    pool, r = "abcXY אבג ابج 123 ٠١٢ +-.,:/%$#€ ()[]{}<>«» \t ،؛ َُ ً̀!؟ \x1f", random.Random(5)
    for _ in range(3000):
        line = "".join(r.choice(pool) for _ in range(r.randint(0, 14)))
        kinds = bidi.kinds_of(line)
        assert "X" not in kinds
        assert bidi.turned(line, bidi.plain_levels(line, kinds)) == bidi.displayed_by_rules(line), line


def test_other_lines_go_by_the_rules():
    for line in ("אב‪ab‬ ג", "⁧אב (a)⁩ b", "a​ב"):
        assert "X" in bidi.kinds_of(line) and bidi.displayed(line) == bidi.displayed_by_rules(line)
