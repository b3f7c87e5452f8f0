"""Strings without escapes are one token."""

from qirtas.operators import streams


def test_plain_strings_are_one_token():
    assert streams.TOKEN.match(" (ab c) Tj").lastgroup == "plain" and streams.TOKEN.match("(a(b))").lastgroup == "mark"
    assert list(streams.tokens(r" (ab) (a\)b)  [(c(d)) 5] TJ ")) == [("literal", "ab"), ("literal", "a)b"), ("mark", "["), ("literal", "c(d)"), ("number", "5"), ("mark", "]"), ("operator", "TJ")]
