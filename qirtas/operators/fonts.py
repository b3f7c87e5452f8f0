"""Characters of a font file's glyphs, from its tables: the map of characters (formats 4 and 12) and names of glyphs.

Files come as binary columns (``binaryFile``, or a page's embedded fonts); tables are read with numpy, one font at a time.
What a glyph stands for is then chosen by expressions: by its name if that says so, else by the best of its characters.

Defined results: a file that is null, empty, cut short, of another kind (collections of fonts too) or whose tables contradict
themselves has null; a font without a map of characters and without names has no glyphs; glyph 0 stands for nothing; characters
are in order of code points; names are those that a file spells out (version 2 of its table, from index 258 on), since
glyphs with standard names have characters.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .glyphs import best_code_point, name_characters

# First bytes of font files, (platform, encoding) of maps of characters from the best on, standard names,
# and forms of letters that texts write otherwise (the last is left out).
KINDS = (b"\x00\x01\x00\x00", b"OTTO", b"true")
MAPS = ((3, 10), (0, 6), (0, 4), (3, 1), (0, 3), (0, 2), (0, 1), (0, 0))
STANDARD_NAMES = 258
FORMS, WRITTEN = "کی﻿", "كي"
GLYPHS = T.ArrayType(T.StructType([T.StructField("glyph", T.IntegerType()), T.StructField("name", T.StringType()), T.StructField("codes", T.ArrayType(T.IntegerType()))]))
_CODES = pa.list_(pa.int32())


def _numbers(raw: bytes, kind: str, count: int, at: int) -> np.ndarray:
    if count < 0 or at < 0 or at + count * np.dtype(kind).itemsize > len(raw):
        raise ValueError("the file ends before its table")
    return np.frombuffer(raw, kind, count, at)


def font_tables(raw: bytes) -> dict[bytes, bytes]:
    if raw[:4] not in KINDS:
        raise ValueError("not a font file")
    count = int(_numbers(raw, ">u2", 1, 4)[0])
    found = {}
    for i in range(count):
        tag, (at, size) = raw[12 + 16 * i : 16 + 16 * i], _numbers(raw, ">u4", 2, 20 + 16 * i).tolist()
        if at + size > len(raw):
            raise ValueError("the file ends before its table")
        found[tag] = raw[at : at + size]
    return found


def _spread(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All codes of ascending ranges, and the range of each. A code that two ranges hold is the earlier one's, so there
    are never more than there are code points."""
    if (np.diff(last) <= 0).any() or (len(last) and (last[-1] > 0x10FFFF or (first > last).any())):
        raise ValueError("ranges out of order")
    begin = np.maximum(first, np.concatenate([[0], last[:-1] + 1]))
    size = np.maximum(last - begin + 1, 0)
    of = np.repeat(np.arange(len(size)), size)
    return np.arange(int(size.sum())) - (np.cumsum(size) - size)[of] + begin[of], of


def _segments(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Format 4: segments with a shift, or with places in a list of glyphs behind them."""
    n = int(_numbers(table, ">u2", 1, 6)[0]) // 2
    last, first, shift, place = (_numbers(table, ">u2", n, at).astype(np.int64) for at in (14, 16 + 2 * n, 16 + 4 * n, 16 + 6 * n))
    codes, of = _spread(first, last)
    words = np.frombuffer(table, ">u2", (len(table) - 16 - 6 * n) // 2, 16 + 6 * n).astype(np.int64)
    at = place[of] // 2 + codes - first[of] + of
    listed = place[of] > 0
    glyph = np.where(listed, np.where(at < len(words), words[np.minimum(at, len(words) - 1)], 0), codes)
    glyph = np.where(listed & (glyph == 0), 0, (glyph + shift[of]) & 0xFFFF)
    return codes[codes != 0xFFFF], glyph[codes != 0xFFFF]


def _groups(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Format 12: ranges of characters with consecutive glyphs."""
    n = int(_numbers(table, ">u4", 1, 12)[0])
    first, last, glyph = _numbers(table, ">u4", 3 * n, 16).astype(np.int64).reshape(-1, 3).T
    codes, of = _spread(first, last)
    return codes, glyph[of] + codes - first[of]


def character_map(table: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Characters and their glyphs, from the best map that is of a known format."""
    count = int(_numbers(table, ">u2", 1, 2)[0])
    places = {}
    for i in range(count):
        platform, encoding = _numbers(table, ">u2", 2, 4 + 8 * i).tolist()
        places[platform, encoding] = int(_numbers(table, ">u4", 1, 8 + 8 * i)[0])
    for key in MAPS:
        if key in places:
            own = table[places[key] :]
            read = {4: _segments, 12: _groups}.get(int(_numbers(own, ">u2", 1, 0)[0]))
            if read:
                return read(own)
    return np.zeros(0, np.int64), np.zeros(0, np.int64)


def glyph_names(table: bytes) -> dict[int, str]:
    """Names that a table of version 2 spells out."""
    if table[:4] != b"\x00\x02\x00\x00":
        return {}
    index = _numbers(table, ">u2", int(_numbers(table, ">u2", 1, 32)[0]), 34)
    at, names = 34 + 2 * len(index), []
    while at < len(table):
        names.append(table[at + 1 : at + 1 + table[at]].decode("latin-1"))
        at += 1 + table[at]
    return {g: names[i - STANDARD_NAMES] for g, i in enumerate(index.tolist()) if STANDARD_NAMES <= i < STANDARD_NAMES + len(names)}


def read_font(raw: bytes | None) -> tuple[list[int], list[str | None], list[list[int]]] | None:
    """Glyphs in order, their names and their characters; None for what is no whole font."""
    if not raw:
        return None
    try:
        tables = font_tables(raw)
        codes, glyph = character_map(tables[b"cmap"]) if b"cmap" in tables else (np.zeros(0, np.int64),) * 2
        names = glyph_names(tables[b"post"]) if b"post" in tables else {}
        most = int(_numbers(tables[b"maxp"], ">u2", 1, 4)[0]) if b"maxp" in tables else 1 << 16
    except ValueError:
        return None
    shown = (glyph > 0) & (glyph < most)
    codes, glyph = codes[shown], glyph[shown]
    order = np.lexsort((codes, glyph))
    own, first = np.unique(glyph[order], return_index=True)
    listed = dict(zip(own.tolist(), (x.tolist() for x in np.split(codes[order], first[1:])), strict=False))
    every = sorted(listed.keys() | {g for g in names if 0 < g < most})
    return every, [names.get(g) for g in every], [listed.get(g, []) for g in every]


@F.arrow_udf(GLYPHS)
def font_glyphs(content: pa.Array) -> pa.Array:
    """Each font's glyphs with name and characters; null for what is no whole font."""
    glyphs, names, codes, offsets, broken = [], [], [], [0], []
    for raw in content:
        found = read_font(raw.as_py())
        broken.append(found is None)
        for held, more in zip((glyphs, names, codes), found or ((), (), ()), strict=True):
            held.extend(more)
        offsets.append(len(glyphs))
    parts = [pa.array(glyphs, pa.int32()), pa.array(names, pa.string()), pa.array(codes, _CODES)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(parts, ["glyph", "name", "codes"]), mask=pa.array(broken))


def glyph_map(glyphs: Column, known: dict[str, str] | None = None) -> Column:
    """Glyph to text, by the glyph's name (``known`` ones, or one that spells a code) or else its best character."""

    def entry(g: Column) -> Column:
        named = name_characters(g["name"], known)
        chosen = F.when(named != "", named).otherwise(best_code_point(g["codes"]))
        return F.struct(g["glyph"].alias("key"), F.translate(chosen, FORMS, WRITTEN).alias("value"))

    return F.map_from_entries(F.filter(F.transform(glyphs, entry), lambda e: e["value"] != ""))
