"""Font files made byte by byte, read back; broken ones have no map."""

from __future__ import annotations

import random
import struct

from pyspark.sql import functions as F

from qirtas.operators import fonts


def font(**tables: bytes) -> bytes:
    at, records, body = 12 + 16 * len(tables), b"", b""
    for tag, content in tables.items():
        records += struct.pack(">4sIII", tag.encode(), 0, at + len(body), len(content))
        body += content
    return struct.pack(">4sHHHH", b"\0\1\0\0", len(tables), 0, 0, 0) + records + body


def cmap(*subtables: tuple[int, int, bytes]) -> bytes:
    at, head, body = 4 + 8 * len(subtables), struct.pack(">HH", 0, len(subtables)), b""
    for platform, encoding, content in subtables:
        head += struct.pack(">HHI", platform, encoding, at + len(body))
        body += content
    return head + body


def twelve(groups) -> bytes:
    return struct.pack(">HHIII", 12, 0, 16 + 12 * len(groups), 0, len(groups)) + b"".join(struct.pack(">III", *g) for g in groups)


def four(segments) -> bytes:
    """Segments (first, glyphs): a shift where the glyphs follow one another, else a list of them behind the segments."""
    segments = [*segments, (0xFFFF, [0])]
    n, listed, shifts, places = len(segments), [], [], []
    for i, (first, glyphs) in enumerate(segments):
        if glyphs == list(range(glyphs[0], glyphs[0] + len(glyphs))):
            shifts.append((glyphs[0] - first) % 65536), places.append(0)
        else:
            shifts.append(0), places.append(2 * (n - i + len(listed)))
            listed += glyphs
    words = [*[f + len(g) - 1 for f, g in segments], 0, *[f for f, _ in segments], *shifts, *places, *listed]
    return struct.pack(">7H", 4, 14 + 2 * len(words), 0, 2 * n, 0, 0, 0) + struct.pack(f">{len(words)}H", *words)


def post(names: list[str | None]) -> bytes:
    own = [n for n in names if n is not None]
    index = [0 if n is None else 258 + own.index(n) for n in names]
    return struct.pack(">I28xH", 0x00020000, len(names)) + struct.pack(f">{len(index)}H", *index) + b"".join(bytes([len(n)]) + n.encode() for n in own)


def codes(raw):
    glyphs, _, listed = fonts.read_font(raw)
    return dict(zip(glyphs, listed, strict=True))


def test_random_maps_are_read_back():
    rng = random.Random(5)
    for _ in range(60):
        at, segments, want = 0, [], {}
        for _ in range(rng.randrange(6)):
            first, size = at + rng.randrange(1, 300), rng.randrange(1, 9)
            begin = rng.randrange(1, 500)
            glyphs = list(range(begin, begin + size)) if rng.random() < 0.5 else [rng.randrange(0, 50) for _ in range(size)]
            segments.append((first, glyphs))
            for i, g in enumerate(glyphs):
                want.setdefault(g, []).append(first + i)
            at = first + size - 1
        want.pop(0, None)
        assert codes(font(cmap=cmap((3, 1, four(segments))))) == want
        groups = [(f + i + 0x10000, f + i + 0x10000, g) for f, glyphs in segments for i, g in enumerate(glyphs)]
        assert codes(font(cmap=cmap((3, 1, four([(65, [7])])), (3, 10, twelve(groups))))) == {g: [0x10000 + c for c in cs] for g, cs in want.items()}
    assert codes(font(cmap=cmap((0, 3, twelve([(65, 90, 3)]))), maxp=struct.pack(">IH", 0x00005000, 10))) == {3 + i: [65 + i] for i in range(7)}


def test_broken_files_have_no_map(spark):
    whole = font(cmap=cmap((3, 10, twelve([(65, 70, 1), (0x628, 0x630, 9)]))), post=post([None, "uni0041", "beh.init"]))
    assert fonts.read_font(whole) is not None
    for n in range(len(whole)):
        assert fonts.read_font(whole[:n]) is None
    disordered = font(cmap=cmap((3, 10, twelve([(70, 75, 1), (60, 65, 9)]))))
    backwards = font(cmap=cmap((3, 10, twelve([(70, 60, 1)]))))
    made = spark.createDataFrame([(0, None), (1, b""), (2, b"ttcf" + whole[4:]), (3, disordered), (4, backwards), (5, whole), (6, font())], "i int, content binary")
    got = {r.i: r.m for r in made.select("i", fonts.glyph_map(fonts.font_glyphs("content")).alias("m")).collect()}
    assert [got[i] for i in range(5)] == [None] * 5 and got[6] == {}
    assert got[5] == {1: "A", **{i: chr(64 + i) for i in range(2, 7)}, **{9 + i: chr(0x628 + i) for i in range(9)}}


def test_names_count_before_characters_and_letters_before_forms(spark):
    maps = cmap((3, 1, four([(0x41, [1, 2]), (0x628, [3]), (0x6A9, [4]), (0xFE8F, [3, 5, 6]), (0xFEFF, [7])])))
    names = [None, "uni06440627.fina", None, None, None, "u1F600x", "space", None, "u01F600", "nothing"]
    made = spark.createDataFrame([(font(cmap=maps, post=post(names)),)], "content binary").select(fonts.font_glyphs("content").alias("g"))
    first = made.select(fonts.glyph_map(F.col("g")).alias("m"), fonts.glyph_map(F.col("g"), {"space": " "}).alias("k")).first()
    assert first.m == {1: "لا", 2: "B", 3: "ب", 4: "ك", 5: "ﺐ", 6: "ﺑ", 8: "😀"}
    assert first.k == first.m | {6: " "}
