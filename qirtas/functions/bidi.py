"""Display order of mixed lines by the Unicode bidirectional algorithm: embedding levels, their resolution, reversal by level.

A line is a paragraph. Its explicit codes give levels (embeddings, overrides, isolates), runs of equal level that isolates
don't separate are resolved together (weak types, paired brackets, neutrals), and characters are turned round from the
highest level down, mirrored where their level is odd. Rules are named as in the standard. Lines without explicit codes,
isolates and other removed characters are one run of their base level: their rules are replacements in the string of their types.

Defined results: null stays null; lines without Arabic stay as they are; explicit codes and other invisible controls that the
standard removes do not come out; paired and mirrored marks are those of ``FACING``; time is linear in a line's length, but
for nested brackets and levels."""

from __future__ import annotations

import re
import unicodedata
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from qirtas.functions.text import ARABIC as ARABIC_PATTERN

# The deepest level, codes of direction, and marks that face the other way.
ARABIC = re.compile(ARABIC_PATTERN)
DEEPEST = 125
EMBEDDINGS = {"LRE": (0, None), "RLE": (1, None), "LRO": (0, "L"), "RLO": (1, "R")}
ISOLATES, NEUTRAL = ("LRI", "RLI", "FSI"), ("B", "S", "WS", "ON", "LRI", "RLI", "FSI", "PDI")
REMOVED = (*EMBEDDINGS, "PDF", "BN")
BRACKETS = {"(": ")", "[": "]", "{": "}", "⁅": "⁆", "⁽": "⁾", "₍": "₎", "〈": "〉", "〈": "〉", "《": "》", "「": "」", "『": "』", "【": "】"}
FACING = BRACKETS | {"<": ">", "«": "»", "‹": "›", "≤": "≥", "≪": "≫", "∈": "∋"}
FACING |= {b: a for a, b in FACING.items()}
CLOSING = {b: a for a, b in BRACKETS.items()}

# Letters of types, and levels of resolved types by the base level.
KINDS = {"L": "L", "R": "R", "AL": "A", "EN": "E", "ES": "+", "ET": "%", "AN": "N", "CS": ",", "NSM": "M", "B": "B", "S": "S", "WS": "W", "ON": "O"}
NAMES = {b: a for a, b in KINDS.items()}
LEVELS = {"0": str.maketrans("LREN", "0122"), "1": str.maketrans("LREN", "2122")}
MIRRORED = str.maketrans(FACING)
STRONG, WEAK, HAS_BRACKET = re.compile("[LRA]"), re.compile("[+,%]"), re.compile("[" + re.escape("".join((*BRACKETS, *CLOSING))) + "]")


def matching_isolates(kinds: list[str]) -> dict[int, int]:
    """Isolate initiators and their ends (BD9)."""
    open_, out = [], {}
    for i, k in enumerate(kinds):
        if k in ISOLATES:
            open_.append(i)
        elif k == "PDI" and open_:
            out[open_.pop()] = i
    return out


def first_strong(kinds: list[str], begin: int, end: int, ends: dict[int, int]) -> int:
    """Level of the first strong character that is in no isolate (P2, P3)."""
    i = begin
    while i < end:
        if kinds[i] in ISOLATES:
            i = ends.get(i, end)
        elif kinds[i] in ("L", "R", "AL"):
            return int(kinds[i] != "L")
        i += 1
    return 0


def explicit_levels(kinds: list[str], base: int, ends: dict[int, int]) -> tuple[list[int], list[str]]:
    """Levels and types after explicit codes (X1 to X8)."""
    levels, types = [base] * len(kinds), list(kinds)
    stack: list[tuple[int, str | None, bool]] = [(base, None, False)]
    lost_isolates = lost_embeddings = isolates = 0
    for i, k in enumerate(kinds):
        level, forced, _ = stack[-1]
        if k in EMBEDDINGS or k in ISOLATES:
            levels[i] = level
            if k in EMBEDDINGS:
                odd, own = EMBEDDINGS[k]
            else:
                odd, own = (first_strong(kinds, i + 1, ends.get(i, len(kinds)), ends) if k == "FSI" else int(k == "RLI")), None
                types[i] = forced or k
            deeper = level + 1 + (level % 2 == odd)
            if deeper <= DEEPEST and not lost_isolates and not lost_embeddings:
                stack.append((deeper, own, k in ISOLATES))
                isolates += k in ISOLATES
            elif k in ISOLATES:
                lost_isolates += 1
            elif not lost_isolates:
                lost_embeddings += 1
        elif k == "PDI":
            if lost_isolates:
                lost_isolates -= 1
            elif isolates:
                lost_embeddings = 0
                while not stack[-1][2]:
                    stack.pop()
                stack.pop()
                isolates -= 1
            levels[i], types[i] = stack[-1][0], stack[-1][1] or k
        elif k == "PDF":
            levels[i] = level
            if lost_isolates:
                pass
            elif lost_embeddings:
                lost_embeddings -= 1
            elif not stack[-1][2] and len(stack) > 1:
                stack.pop()
        elif k != "B":
            levels[i] = level
            if forced and k != "BN":
                types[i] = forced
    return levels, types


def run_sequences(kept: list[int], levels: list[int], kinds: list[str], ends: dict[int, int]) -> list[list[int]]:
    """Runs of equal level, joined from an isolate's start to its end (BD13)."""
    runs: list[list[int]] = []
    for i in kept:
        if runs and levels[runs[-1][-1]] == levels[i]:
            runs[-1].append(i)
        else:
            runs.append([i])
    by_start = {r[0]: r for r in runs}
    closed = set(ends.values())
    out = []
    for run in runs:
        if kinds[run[0]] == "PDI" and run[0] in closed:
            continue
        sequence = list(run)
        while kinds[sequence[-1]] in ISOLATES and (end := ends.get(sequence[-1])) is not None and end in by_start:
            sequence += by_start[end]
        out.append(sequence)
    return out


def weak_types(t: list[str], sos: str) -> None:
    """W1 to W7, in place."""
    before = sos
    for i, k in enumerate(t):
        if k == "NSM":
            t[i] = "ON" if before in (*ISOLATES, "PDI") else before
        before = t[i]
    strong = sos
    for i, k in enumerate(t):
        if k in ("L", "R", "AL"):
            strong = k
        elif k == "EN" and strong == "AL":
            t[i] = "AN"
    t[:] = ["R" if k == "AL" else k for k in t]
    for i in range(1, len(t) - 1):
        around = t[i - 1] if t[i - 1] == t[i + 1] else None
        if t[i] in ("ES", "CS") and around == "EN" or t[i] == "CS" and around == "AN":
            t[i] = around
    i = 0
    while i < len(t):
        j = i
        while j < len(t) and t[j] == "ET":
            j += 1
        if j > i and ("EN" in t[j : j + 1] or i and t[i - 1] == "EN"):
            t[i:j] = ["EN"] * (j - i)
        i = max(j, i + 1)
    strong = sos
    for i, k in enumerate(t):
        if k in ("ES", "CS", "ET"):
            t[i] = "ON"
        elif k in ("L", "R"):
            strong = k
        elif k == "EN" and strong == "L":
            t[i] = "L"


def _direction(k: str) -> str | None:
    return k if k in ("L", "R") else "R" if k in ("EN", "AN") else None


def bracket_pairs(chars: list[str], t: list[str]) -> list[tuple[int, int]]:
    """BD16: pairs in the order of their openings; none from the 64th open bracket on."""
    open_: list[tuple[str, int]] = []
    out = []
    for i, c in enumerate(chars):
        if t[i] != "ON":
            continue
        if c in BRACKETS:
            if len(open_) == 63:
                return []
            open_.append((c, i))
        elif c in CLOSING:
            for d in range(len(open_) - 1, -1, -1):
                if open_[d][0] == CLOSING[c]:
                    out.append((open_[d][1], i))
                    del open_[d:]
                    break
    return sorted(out)


def neutral_types(chars: list[str], kinds: list[str], t: list[str], sos: str, eos: str, embedding: str) -> None:
    """N0 to N2, in place."""
    for a, b in bracket_pairs(chars, t):
        inside = {d for k in t[a + 1 : b] if (d := _direction(k))}
        if embedding in inside:
            own = embedding
        elif inside:
            before = next((d for k in reversed(t[:a]) if (d := _direction(k))), sos)
            own = before if before != embedding else embedding
        else:
            continue
        for p in (a, b):
            t[p] = own
            p += 1
            while p < len(t) and kinds[p] == "NSM":
                t[p] = own
                p += 1
    i = 0
    while i < len(t):
        j = i
        while j < len(t) and t[j] in NEUTRAL:
            j += 1
        if j > i:
            before = _direction(t[i - 1]) if i else sos
            after = _direction(t[j]) if j < len(t) else eos
            t[i:j] = [before if before == after else embedding] * (j - i)
        i = max(j, i + 1)


def resolved_levels(line: str) -> tuple[list[int], list[int]]:
    """Places of the characters that are kept and their levels."""
    kinds = [unicodedata.bidirectional(c) or "L" for c in line]
    ends = matching_isolates(kinds)
    base = first_strong(kinds, 0, len(kinds), ends)
    levels, types = explicit_levels(kinds, base, ends)
    kept = [i for i, k in enumerate(kinds) if k not in REMOVED]
    place = {i: p for p, i in enumerate(kept)}
    side = lambda a, b: "R" if max(a, b) % 2 else "L"
    found = list(levels)
    for sequence in run_sequences(kept, levels, kinds, ends):
        level, first, last = levels[sequence[0]], place[sequence[0]], place[sequence[-1]]
        open_end = kinds[sequence[-1]] in ISOLATES and sequence[-1] not in ends
        sos = side(level, levels[kept[first - 1]] if first else base)
        eos = side(level, base if open_end or last + 1 == len(kept) else levels[kept[last + 1]])
        t = [types[i] for i in sequence]
        weak_types(t, sos)
        neutral_types([line[i] for i in sequence], [kinds[i] for i in sequence], t, sos, eos, "R" if level % 2 else "L")
        for i, k in zip(sequence, t, strict=True):
            found[i] = level + (int(k == "R") + 2 * int(k in ("AN", "EN")) if level % 2 == 0 else int(k != "R"))
    blank = True
    for i in reversed(kept):  # L1
        if kinds[i] in ("B", "S"):
            blank = True
        elif kinds[i] not in ("WS", *ISOLATES, "PDI"):
            blank = False
        if blank:
            found[i] = base
    return kept, [found[i] for i in kept]


@cache
def kind_table() -> np.ndarray:
    """By code point the letter of its type, ``X`` for those that make a line no plain one."""
    return np.array([ord(KINDS.get(unicodedata.bidirectional(chr(i)) or "L", "X")) for i in range(0x110000)], np.uint8)


def kinds_of(text: str) -> str:
    return kind_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)].tobytes().decode("ascii")


def plain_levels(line: str, kinds: str) -> str:
    """A digit for the level of each character of a line that is one run; ``kinds`` are the letters of its types."""
    strong = STRONG.search(kinds)
    base = "1" if strong and strong.group() != "L" else "0"
    e = "R" if base == "1" else "L"
    t = kinds
    if "M" in t:  # W1
        t = re.sub(r"\AM+", lambda m: e * len(m[0]), t)
        t = re.sub(r"(.)M+", lambda m: m[1] * len(m[0]), t)
    if "E" in t and "A" in t:  # W2
        t = re.sub(r"A[^LR]*", lambda m: m[0].replace("E", "N"), t)
    t = t.replace("A", "R")  # W3
    if WEAK.search(t):
        t = re.sub(r"(?<=N),(?=N)", "N", re.sub(r"(?<=E)[+,](?=E)", "E", t))  # W4
        t = re.sub(r"(?<=E)%+|%+(?=E)", lambda m: "E" * len(m[0]), t)  # W5
        t = re.sub(r"[+,%]", "O", t)  # W6
    if "E" in t:  # W7
        t = re.sub(r"(?:\A|L)[^R]*" if e == "L" else r"L[^R]*", lambda m: m[0].replace("E", "L"), t)
    if HAS_BRACKET.search(line):  # N0 to N2
        names = [NAMES[k] for k in t]
        neutral_types(list(line), [NAMES[k] for k in kinds], names, e, e, e)
        t = "".join(KINDS[k] for k in names)
    else:
        between = lambda m: m[1] + ("L" if m[1] == m[3] == "L" else "R" if "L" not in (m[1], m[3]) else e) * len(m[2])
        t = re.sub(r"([LREN])([BSWO]+)(?=([LREN]))", between, e + t + e)[1:-1]
    found = t.translate(LEVELS[base])
    if "B" in kinds or "S" in kinds:  # L1
        out, blank = list(found), True
        for i in range(len(kinds) - 1, -1, -1):
            blank = kinds[i] in "BS" or blank and kinds[i] == "W"
            if blank:
                out[i] = base
        return "".join(out)
    full = len(kinds.rstrip("W"))
    return found[:full] + base * (len(kinds) - full)


def turned(line: str, levels: str) -> str:
    """Runs of levels from 1 on turned round, runs of level 2 in them back again (L2); marks at level 1 mirrored (L4)."""
    out, at = [], 0
    for m in re.finditer("[12]+", levels):
        out.append(line[at : m.start()])
        at = m.end()
        runs = [(p.group()[0], line[m.start() + p.start() : m.start() + p.end()]) for p in re.finditer("1+|2+", m.group())]
        out += [part if level == "2" else part[::-1].translate(MIRRORED) for level, part in reversed(runs)]
    return "".join(out) + line[at:]


def displayed(line: str, kinds: str | None = None) -> str:
    """A line from left to right (L2, L4)."""
    kinds = kinds_of(line) if kinds is None else kinds
    return displayed_by_rules(line) if "X" in kinds else turned(line, plain_levels(line, kinds))


def displayed_by_rules(line: str) -> str:
    """The same for any line, character by character."""
    kept, levels = resolved_levels(line)
    out = [FACING.get(line[i], line[i]) if level % 2 else line[i] for i, level in zip(kept, levels, strict=True)]
    for level in range(max(levels, default=0), 0, -1):
        i = 0
        while i < len(levels):
            j = i
            while j < len(levels) and levels[j] >= level:
                j += 1
            if j > i:
                out[i:j] = reversed(out[i:j])
                levels[i:j] = reversed(levels[i:j])
            i = max(j, i + 1)
    return "".join(out)


@F.pandas_udf(T.StringType())
def display_order(text: pd.Series) -> pd.Series:
    """Texts with the lines that hold Arabic in display order."""
    return text.map(lambda t: t if t is None or t.isascii() or not ARABIC.search(t) else displayed_lines(t))


def displayed_lines(text: str) -> str:
    kinds, out, at = kinds_of(text), [], 0
    for line in text.split("\n"):
        end = at + len(line)
        out.append(displayed(line, kinds[at:end]) if ARABIC.search(line) else line)
        at = end + 1
    return "\n".join(out)
