"""Text shown by the content streams of pages: a small machine over operands and operators, a row a span.

A stream is read token by token: numbers, names, strings in brackets (nested ones belong to the string) or in hex digits,
arrays and operators. Operands wait on a stack until an operator takes the last ones; what an operator doesn't need is
left behind. Kept state is the font, its size, and the place and scale of the text.

Defined results: a null or empty stream shows nothing; an operator without enough operands, or with operands of another
kind, changes nothing; an unfinished string or array ends with the stream; bytes are Latin-1; other operators are passed
over; spans are numbered in the order in which they are shown. A page's stream is read in one call, in time linear in its
length. Moves with a string shown behind them, one after another, are read as one run; what they do is the same.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import accumulate, compress
from struct import unpack

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Operators of text, escapes of strings, the size and the leading where none is given, and what a font
# without a map still shows.
ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "b": "\b", "f": "\f"}
SIZE, LEADING = 12.0, 1.2
PLAIN_MARKS = "/\\()[]{}-–—.,:;!?%+*،؛؟"
INVERTED_MARK, ARABIC_COMMA = "¡", "،"

AT_ONCE = 64  # pages whose spans are made before they are handed on
SPAN = (("ord", pa.int32()), ("font", pa.string()), ("size", pa.float64()), ("x", pa.float64()), ("y", pa.float64()), ("units", pa.list_(pa.string())))
LINE = [("y", "double"), ("xs", "array<double>"), ("ends", "array<int>"), ("line", "string")]

TOKEN = re.compile(
    r"[\s\x00]*+(?:(?P<skip>%[^\r\n]*|<<|>>)"
    r"|/(?P<name>[^\s()<>\[\]{}/%\x00]*)"
    r"|<(?P<hex>[0-9A-Fa-f\s]*)>"
    r"|(?P<number>[-+]?(?:\d+\.?\d*|\.\d+))(?![^\s()<>\[\]{}/%\x00])"
    r"|\((?P<plain>[^\\()\r]*)\)"
    r"|(?P<mark>[(\[\]])"
    r"|(?P<operator>[^\s()<>\[\]{}/%\x00]+)"
    r"|(?P<other>.))",
    re.S,
)
IN_STRING = re.compile(r"[^\\()\r]+|\\([0-7]{1,3}|\r\n|.)|\\\Z|\r\n?|[()]", re.S)

# A move and the string or array shown there, without strings in strings: the tokens above in the order that is usual.
GAP, END = r"[\s\x00]*+", r"(?![^\s()<>\[\]{}/%\x00])"
NUMBER = rf"[-+]?(?:\d++\.?+\d*+|\.\d++){END}"
INSIDE = r"(?:[^\\()\r]++|\\[^\r])*+"
STRING = rf"(?:\({INSIDE}\)|<[0-9A-Fa-f\s]*+>)"
ARRAY = rf"\[(?:{GAP}(?:{STRING}|{NUMBER}))*+{GAP}\]"
MOVED, SHOWN = rf"{GAP}T[dD]{END}{GAP}", rf"{STRING}(?={GAP}Tj)|{ARRAY}(?={GAP}TJ)"
INSIDES, ESCAPED = re.compile(rf"\(({INSIDE})\)"), re.compile(r"\\([0-7]{1,3}|.)", re.S)
STEPS = re.compile(rf"{GAP}({NUMBER}){GAP}({NUMBER}){MOVED}({SHOWN}){GAP}T[jJ]{END}")
RUN = re.compile(rf"(?:{GAP}{NUMBER}{GAP}{NUMBER}{MOVED}(?:{SHOWN}){GAP}T[jJ]{END})*+")


@dataclass(frozen=True)
class Style:
    """What a reader of streams makes of them: whether strings in brackets count, whether fonts without a map show marks and
    digits, and how many sizes a new line is down."""

    literals: bool
    plain_fonts: bool
    leading: float


STYLES = {"glyphs": Style(literals=False, plain_fonts=False, leading=0.0), "marked": Style(literals=True, plain_fonts=True, leading=LEADING)}


def literal(text: str, at: int) -> tuple[str, int]:
    """The string that begins at ``at``, behind its bracket, and the place behind its end."""
    out, depth = [], 1
    while m := IN_STRING.match(text, at):
        at, part, code = m.end(), m.group(), m.group(1)
        if part == ")":
            depth -= 1
            if not depth:
                break
        elif part == "(":
            depth += 1
        elif part[0] == "\r":
            part = "\n"
        elif part[0] == "\\":
            if code is None or code in ("\n", "\r", "\r\n"):
                part = ""
            else:
                part = chr(int(code, 8) & 0xFF) if code[0] in "01234567" else ESCAPES.get(code, code)
        out.append(part)
    return "".join(out), at


def placed_tokens(text: str, at: int) -> Iterator[tuple[str, str, int]]:
    """Kind and value of each token from ``at`` on, and the place behind it."""
    while m := TOKEN.match(text, at):
        at, kind = m.end(), m.lastgroup
        if kind == "mark" and m.group(kind) == "(":
            value, at = literal(text, at)
            yield "literal", value, at
        elif kind == "plain":
            yield "literal", m.group(kind), at
        elif kind not in ("skip", "other"):
            yield kind, m.group(kind), at


def tokens(text: str) -> Iterator[tuple[str, str]]:
    for kind, value, _ in placed_tokens(text, 0):
        yield kind, value


def plain_units(text: str) -> list[str]:
    """Marks, digits and spaces; all else of a font without a map can't be told."""
    out = []
    for c in text:
        if c == INVERTED_MARK:
            out.append(ARABIC_COMMA)
        elif c.isspace():
            out.append(" ")
        elif c in PLAIN_MARKS or c.isdigit():
            out.append(c)
    return out


def shown(kind: str, value: str, glyphs: dict[int, str] | None, style: Style) -> list[str]:
    """The units that a string shows: an entry of the font's map is one, whatever its length."""
    if kind == "hex":
        digits = "".join(value.split())
        if glyphs:
            n = len(digits) // 4
            return [u for u in map(glyphs.get, unpack(f">{n}H", bytes.fromhex(digits[: 4 * n]))) if u]
        return plain_units(bytes.fromhex(digits[: len(digits) // 2 * 2]).decode("latin-1")) if style.plain_fonts else []
    if kind == "literal" and style.literals:
        return list(value) if glyphs else plain_units(value) if style.plain_fonts else []
    return []


@lru_cache(1 << 11)
def escape(part: str) -> str:
    return literal(part + ")", 0)[0]


def escaped(m: re.Match) -> str:
    return escape(m[0])


def hex_units(operands: list[str], glyphs: dict[int, str] | None, style: Style) -> list[str | list[str]]:
    """What strings in hex digits show: looked up together if every code has an entry of one character."""
    if glyphs:
        digits = [o[1:-1] if o[1:-1].isalnum() else "".join(o[1:-1].split()) for o in operands]
        ends = list(accumulate([len(d) // 4 for d in digits], initial=0))
        codes = unpack(f">{ends[-1]}H", bytes.fromhex("".join([d if len(d) % 4 == 0 else d[: len(d) // 4 * 4] for d in digits])))
        units = list(map(glyphs.get, codes))
        if None not in units and "" not in units and len(joined := "".join(units)) == len(units):
            return [joined[begin:end] for begin, end in zip(ends, ends[1:])]
    return [shown("hex", o[1:-1], glyphs, style) for o in operands]


def run_units(operands: list[str], glyphs: dict[int, str] | None, style: Style) -> list[str | list[str]]:
    """The units that each string or array of a run shows; of characters alone, one string."""
    mapped, out = bool(glyphs) and style.literals, []
    in_hex = iter(hex_units([o for o in operands if o[0] == "<"], glyphs, style))
    for operand in operands:
        kind = operand[0]
        if kind == "<":
            units = next(in_hex)
        elif not mapped or "<" in operand:
            units = [u for k, v in tokens(operand) for u in shown(k, v, glyphs, style)]
        elif kind == "(":
            units = ESCAPED.sub(escaped, operand[1:-1]) if "\\" in operand else operand[1:-1]
        elif "\\" in operand:
            units = "".join([ESCAPED.sub(escaped, inside) if "\\" in inside else inside for inside in INSIDES.findall(operand)])
        else:
            units = "".join(INSIDES.findall(operand))
        out.append(units)
    return out


def shown_runs(stream: str, fonts: dict[str, dict[int, str]], style: Style) -> Iterator[tuple[str | None, float, list[float], list[float], list[str | list[str]]]]:
    """Font, size, and x, y and units of the strings and arrays that are shown, runs of them together; units may be none."""
    stack: list[tuple[str, object]] = []
    array: list[tuple[str, str]] | None = None
    font, size, x, y, scale, at, end = None, SIZE, 0.0, 0.0, 1.0, 0, 0

    def numbers(k: int) -> list[float] | None:
        last = stack[-k:]
        return [float(v) for _, v in last] if len(last) == k and all(kind == "number" for kind, _ in last) else None

    while True:
        for kind, value, at in placed_tokens(stream, end):
            if kind == "mark":
                if value == "[":
                    array = []
                elif array is not None:
                    stack.append(("array", array))
                    array = None
                continue
            if kind != "operator":
                (stack if array is None else array).append((kind, value))
                continue
            if value == "Tf" and len(stack) > 1 and stack[-2][0] == "name" and numbers(1):
                font, size = stack[-2][1], float(stack[-1][1])
            elif value == "Tm" and (m := numbers(6)):
                x, y, scale = m[4], m[5], (m[0] * m[0] + m[2] * m[2]) ** 0.5
            elif value in ("Td", "TD") and (d := numbers(2)):
                x, y = x + d[0] * scale, y + d[1] * scale
            elif value == "T*":
                y -= size * style.leading
            elif value in ("Tj", "TJ") and stack:
                strings = [stack[-1]] if value == "Tj" else stack[-1][1] if stack[-1][0] == "array" else []
                yield font, size, [x], [y], [[u for k, v in strings for u in shown(k, v, fonts.get(font), style)]]
            stack.clear()
            array = None
            if (end := RUN.match(stream, at).end()) > at:
                break
        else:
            return
        parts = STEPS.split(stream[at:end])
        xs = list(accumulate([float(d) * scale for d in parts[1::4]], initial=x))
        ys = list(accumulate([float(d) * scale for d in parts[2::4]], initial=y))
        x, y = xs[-1], ys[-1]
        yield font, size, xs[1:], ys[1:], run_units(parts[3::4], fonts.get(font), style)


def shown_spans(stream: str, fonts: dict[str, dict[int, str]], style: Style) -> Iterator[tuple[int, str | None, float, float, float, list[str]]]:
    """Number, font, size, x, y and units of each span."""
    n = 0
    for font, size, xs, ys, shows in shown_runs(stream, fonts, style):
        for x, y, units in zip(xs, ys, shows, strict=True):
            if units:
                yield n, font, size, x, y, list(units)
                n += 1


def streams_of(batch: pa.RecordBatch, keys: int) -> Iterator[tuple[int, str, dict[str, dict[int, str]]]]:
    """Place, stream and maps of the pages that have a stream; these are the columns behind the keys."""
    for i, (stream, fonts) in enumerate(zip(batch.column(keys), batch.column(keys + 1), strict=True)):
        if stream := stream.as_py():
            yield i, stream.decode("latin-1"), {name: dict(glyphs) if glyphs is not None else None for name, glyphs in fonts.as_py() or ()}


def span_rows(batch: pa.RecordBatch, style: Style) -> pa.RecordBatch:
    """A row a span of the streams of some pages: their other columns, then those of the span."""
    names, keys = batch.schema.names, batch.num_columns - 2
    at, rows = [], []
    for i, stream, maps in streams_of(batch, keys):
        rows += shown_spans(stream, maps, style)
        at += [i] * (len(rows) - len(at))
    own = batch.select(names[:keys]).take(pa.array(at, pa.int32()))
    spans = [pa.array(values, kind) for values, (_, kind) in zip(zip(*rows) if rows else [()] * len(SPAN), SPAN, strict=True)]
    return pa.RecordBatch.from_arrays([*own.columns, *spans], names=[*names[:keys], *(name for name, _ in SPAN)])


def line_rows(batch: pa.RecordBatch, style: Style) -> pa.RecordBatch:
    """A row for spans of a page that follow each other at one height: the page's other columns, then those of LINE."""
    names, keys = batch.schema.names, batch.num_columns - 2
    xs, ys, words, pages, ends = [], [], [], [], [0]
    for i, stream, maps in streams_of(batch, keys):
        for _, _, across, down, shows in shown_runs(stream, maps, style):
            found = [units if type(units) is str else "".join(units) for units in shows]
            if "" in found:
                across, down, found = (compress(values, found) for values in (across, down, list(found)))
            xs += across
            ys += down
            words += found
        pages.append(i)
        ends.append(len(words))
    page, height = np.repeat(np.array(pages, np.int32), np.diff(ends)), np.array(ys, np.float64)
    first = np.flatnonzero(np.concatenate([np.ones(min(len(ys), 1), bool), (page[1:] != page[:-1]) | (height[1:] != height[:-1])]))
    stops = np.append(first, len(words))
    rising = np.ones(len(words), bool)
    rising[1:] = np.array(xs[1:], np.float64) > np.array(xs[:-1], np.float64)
    rising[first] = True
    for line in np.unique(np.searchsorted(first, np.flatnonzero(~rising), side="right") - 1).tolist():
        begin, end = stops[line : line + 2].tolist()
        xs[begin:end], words[begin:end] = zip(*sorted(zip(xs[begin:end], words[begin:end], strict=True), key=lambda w: (w[0] != w[0], *w)), strict=True)
    behind = np.cumsum(np.array(list(map(len, words)), np.int64) + 1)
    ends = behind - 1 - np.repeat(np.append(0, behind)[first], np.diff(stops))
    offsets, bounds = pa.array(stops, pa.int32()), stops.tolist()
    columns = {
        "y": pa.array(height[first]), "xs": pa.ListArray.from_arrays(offsets, pa.array(xs, pa.float64())), "ends": pa.ListArray.from_arrays(offsets, pa.array(ends, pa.int32())),
        "line": pa.array([" ".join(words[begin:end]) for begin, end in zip(bounds, bounds[1:])], pa.string()),
    }
    own = batch.select(names[:keys]).take(pa.array(page[first]))
    return pa.RecordBatch.from_arrays([*own.columns, *columns.values()], names=[*names[:keys], *columns])


def read_streams(pages: DataFrame, keys: list[str], stream: str, fonts: str, style: str, make: Callable, columns: list[tuple[str, str]]) -> DataFrame:
    rows = pages.select(*keys, F.col(stream).alias("_stream"), F.col(fonts).cast("map<string,map<int,string>>").alias("_fonts"))
    how = STYLES[style]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, AT_ONCE):
                yield make(batch.slice(begin, AT_ONCE), how)

    return rows.mapInArrow(read, rows.select(*keys, *[F.lit(None).cast(kind).alias(name) for name, kind in columns]).schema)


def stream_spans(pages: DataFrame, keys: list[str], stream: str = "stream", fonts: str = "fonts", style: str = "glyphs") -> DataFrame:
    """Spans (ord, font, size, x, y, units) of pages with a binary ``stream`` and ``fonts``, the maps of the page's fonts by
    name. Pages stay where they are: nothing is shuffled, and a page without spans gives no row."""
    kinds = ("int", "string", "double", "double", "double", "array<string>")
    return read_streams(pages, keys, stream, fonts, style, span_rows, [(name, kind) for (name, _), kind in zip(SPAN, kinds, strict=True)])


def stream_rows(pages: DataFrame, keys: list[str], stream: str = "stream", fonts: str = "fonts", style: str = "glyphs") -> DataFrame:
    """As ``stream_spans``, but a row (y, xs, ends, line) for spans of a page that follow each other at one height: by x (then
    by text), their units joined, a space between two, and where in the line each ends. A height that comes again gives another row."""
    return read_streams(pages, keys, stream, fonts, style, line_rows, LINE)


def placed_words(row: Column) -> Column:
    """The spans (x, word) of a row (xs, ends, line)."""

    def word(x: Column, i: Column) -> Column:
        begin = F.when(i == 0, 0).otherwise(row["ends"][i - 1] + 1)
        return F.struct(x.alias("x"), F.substring(row["line"], begin + 1, row["ends"][i] - begin).alias("word"))

    return F.transform(row["xs"], word)
