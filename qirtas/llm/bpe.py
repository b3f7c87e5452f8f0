"""Byte-level BPE with the tokenizers library, for whole columns.

The pre-tokenizer of such a vocabulary never joins a non-space with the space after it, so a text falls
into chunks (a word with the space before it, or a piece of white space) that are encoded one by one.
Each distinct chunk of a slice is looked up once; chunks not met before go to the library's model. Texts with white space beyond ASCII, or without this kind of pre-tokenizer, go to the library whole.
So do texts that hold an added token's text, such as the end of a text, which the library matches before it splits.
"""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa

from .text import _B, U, _SPACE, byte_sums, flat, give_back, mix, moved, ranges, slices

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
CACHE = 300_000  # chunks of a generation; a worker keeps the present one and the one before
ENCODE_BYTES = 1 << 22  # text looked up together: the more, the fewer lookups of the same chunk
_ODD = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80")
#: Characters of which Python's classes and the library's may differ, or that the model's alphabet shifts.
_RARE = re.compile(r"[\x00-\x08\x0e-\x1f\x7f\xb2\xb3\xb9\xbc-\xbe\u0250-\U0010ffff]")
_MARKS = frozenset(b".,;:!?")  # a word of ASCII letters and one of these are two pre-tokens
_PARTS = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+").findall


def _alphabet() -> dict[int, int]:
    """Bytes as the visible characters that byte-level vocabularies are written in."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {b: b for b in own} | {b: 256 + i for i, b in enumerate(rest)}


_SHOWN = _alphabet()
_open: dict[str, "Encoder"] = {}


def encoder(path: str) -> "Encoder":
    """The worker's own encoder for a vocabulary file."""
    if path not in _open:
        _open[path] = Encoder(path)
    return _open[path]


def forget() -> None:
    """Drop the worker's encoders and tables, where it goes on to other work."""
    _open.clear()
    give_back()


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin, for rows of ASCII white space."""
    space = _SPACE[data]
    begin = np.zeros(len(data), bool)
    begin[0] = True
    begin[1:] |= space[1:] & ~space[:-1]  # a run of white space
    word = np.flatnonzero(~space[1:] & space[:-1]) + 1  # words after white space: with it if it is a space
    blank = data[word - 1] == 32
    begin[word - 1] = True
    begin[word[~blank]] = True
    edge = offsets[:-1][np.diff(offsets) > 0]
    begin[edge] = True
    # a row's first word has no space before it, and a row's last run is one piece
    first = edge[(edge > 0)]
    first = first[~space[first] & space[first - 1]]
    begin[first - 1] = space[first - 1] & (~space[np.maximum(first - 2, 0)] | np.isin(first - 1, edge))
    return np.flatnonzero(begin)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        self.added = [t.content.encode() for t in self.library.get_added_tokens_decoder().values() if t.content]
        self.size = self.library.get_vocab_size()
        self.store = np.dtype("<u2") if self.size <= 1 << 16 else np.dtype("<u4")
        self.cache: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        pre = repr(self.library.pre_tokenizer)
        self.chunks = pre.startswith("ByteLevel") and "use_regex=True" in pre and "add_prefix_space=False" in pre and self.library.normalizer is None

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(self.library.encode(t, add_special_tokens=False).ids, self.store) for t in texts]

    def learn(self, chunks: list[bytes]) -> None:
        """Encode chunks that the cache lacks: the library's model on each pre-token, the whole library where
        this module's split of a chunk might differ from its own. Chunks of the generation before are taken over, so that
        those that come again and again are not encoded anew when the cache is full."""
        known = {c: ids for c in chunks if (ids := self.before.get(c)) is not None}
        if len(self.cache) + len(chunks) > CACHE:
            self.before, self.cache = self.cache, {}
        self.cache.update(known)
        model, cache, before, kind = self.library.model.tokenize, self.cache, self.before, "H" if self.store.itemsize == 2 else "I"
        for c in chunks:
            if c in known:
                continue
            word = c[1:] if c[0] == 32 else c
            if word.isalpha():  # ASCII letters: one pre-token
                shown = word.decode() if word is c else "\u0120" + word.decode()
                cache[c] = array(kind, [x.id for x in model(shown)]).tobytes()
                continue
            t = c.decode()
            if c[-1:].isspace() or _RARE.search(t):
                cache[c] = self.whole([t])[0].tobytes()
                continue
            if t.isalpha() or t[0] == " " and t[1:].isalpha():  # other letters: one pre-token
                cache[c] = array(kind, [x.id for x in model(c.decode("latin-1").translate(_SHOWN))]).tobytes()
                continue
            found = []
            # a pre-token is a chunk too, and many chunks share it
            for part in (c[:-1], c[-1:]) if c[-1] in _MARKS and word[:-1].isalpha() else map(str.encode, _PARTS(t)):
                ids = cache.get(part) or before.get(part)
                if ids is None:
                    ids = cache[part] = array(kind, [x.id for x in model(part.decode("latin-1").translate(_SHOWN))]).tobytes()
                found.append(ids)
            cache[c] = b"".join(found)

    def column(self, texts: pa.Array):
        """Yield for each slice of rows: first row, ids of all its rows, ids a row. Null counts as empty."""
        data, offsets = flat(texts)
        for a, b in slices(offsets, ENCODE_BYTES):
            part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            raw = part.tobytes()
            if self.chunks and not ((part < 32) & (part > 27) | (part == 0xC2) | (part >= 0xE1) & (part <= 0xE3)).any() or self.chunks and not _ODD.search(raw):
                yield a, *self._rows(part, raw, off)
            else:
                ids = self.whole([raw[x:y].decode() for x, y in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])
                yield a, np.concatenate(ids) if ids else np.zeros(0, self.store), np.array([len(x) for x in ids], np.int64)

    def _rows(self, data: np.ndarray, raw: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``_slice``; rows with an added token's text go to the library whole."""
        own = self.with_added(raw, off)
        if not own.any():
            return self._slice(data, raw, off)
        size = np.diff(off)
        rest = data[ranges(off[:-1][~own], size[~own])]
        ids, n = self._slice(rest, rest.tobytes(), np.concatenate([[0], np.cumsum(size[~own])]))
        others = self.whole([raw[off[i] : off[i + 1]].decode() for i in np.flatnonzero(own)])
        each = np.zeros(len(size), np.int64)
        each[~own], each[own] = n, [len(x) for x in others]
        first, out = np.cumsum(each) - each, np.empty(int(each.sum()), self.store)
        out[ranges(first[~own], n)] = ids
        out[ranges(first[own], each[own])] = np.concatenate(others)
        return out, each

    def with_added(self, raw: bytes, off: np.ndarray) -> np.ndarray:
        """Which rows hold an added token's text (also those where one begins that ends in the next row)."""
        out = np.zeros(len(off) - 1, bool)
        for token in self.added:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(off, at, "right")) - 1
                out[row] = True
                at = raw.find(token, max(at + 1, int(off[row + 1]) - len(token) + 1))
        return out

    def _slice(self, data: np.ndarray, raw: bytes, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(data):
            return np.zeros(0, self.store), np.zeros(len(off) - 1, np.int64)
        start = chunk_starts(data, off)
        end = np.append(start[1:], len(data))
        total = byte_sums(data)
        h = mix(moved(total[end] - total[start], start, _B) + (end - start).astype(U))
        del total
        _, at, inverse = np.unique(h, return_index=True, return_inverse=True)
        keys = [raw[x:y] for x, y in zip(start[at].tolist(), end[at].tolist(), strict=True)]
        found = list(map(self.cache.get, keys))
        if None in found:
            self.learn([k for k, x in zip(keys, found, strict=True) if x is None])
            get = self.cache.get
            found = [x or get(k) for k, x in zip(keys, found, strict=True)]
        ids = np.frombuffer(b"".join(found), self.store)
        n = np.fromiter(map(len, found), np.int64, len(found)) // self.store.itemsize
        first = np.cumsum(n) - n
        each = n[inverse]
        out = ids[ranges(first[inverse], each)]
        upto = np.zeros(len(each) + 1, np.int64)
        np.cumsum(each, out=upto[1:])
        return out, np.diff(upto[np.searchsorted(start, off)])
