"""SentencePiece encoding with the n best segmentations, and decoding.

A text is written with U+2581 for spaces and one before it. Its lattice has an edge for every piece of
the model at every place, with the piece's score, and for a character without a piece one edge of byte
pieces. A forward Viterbi pass gives each node the best score of any path to it; a backward A* search from
the end takes partial paths by their score plus that, which is exact, so finished paths come best first.

No piece but runs of U+2581 holds one after another character, so the lattice is a chain of small ones,
cut before each run of spaces. Each distinct small lattice gets the Viterbi pass in both directions once, which
gives its best path and the loss of its second; the n - 1 lattices of a text whose second costs least are
searched for their n best, and the n best of the text are the smallest sums of losses over those.

Defined results: a null or empty text has no pieces and the score 0; repeated rows are encoded each; other columns,
whatever their names, are not read; an empty table gives no rows. Of best paths with equal scores the one whose first
piece is shorter is taken, then the second, and so on, whatever the length of the word; among the others the search
follows the path it met last, so that a long word of many equal paths ends it no later. Decoding gives the text back,
but for U+2581 itself, which becomes a space. A model with a piece that holds a blank after another character is refused.
"""

from __future__ import annotations

import hashlib
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .text import _B, SLICE_BYTES, U, byte_sums, flat, mix, moved, ranges, slices

BLANK, CACHE, NBEST, TOGETHER = "▁", 150_000, 3, 24
_open: dict[str, "Pieces"] = {}


def pieces_of(path: str) -> "Pieces":
    if path not in _open:
        _open[path] = Pieces(path)
    return _open[path]


class Pieces:
    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.score, self.id, self.byte, shown = {}, {}, {}, []
        for i in range(model.get_piece_size()):
            text = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(text[3:5], 16)] = i
                shown.append(bytes([int(text[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                shown.append(b"")
            else:
                self.id[text], self.score[text] = i, model.get_score(i)
                shown.append(text.replace(BLANK, " ").encode())
        if any(BLANK in t.lstrip(BLANK) for t in self.id):
            raise ValueError("a piece holds a blank after another character, so words are no lattices of their own")
        self.unknown = model.unk_id()
        self.longest = max(map(len, self.id), default=1)
        self.floor = min(self.score.values(), default=0.0) - 10
        usual = [s for s in self.score.values() if s > -1e8]
        self.byte_score = min(usual, default=0.0) - 10
        self.shown = np.frombuffer(b"".join(shown), np.uint8)
        self.shown_size = np.array([len(x) for x in shown], np.int64)
        self.shown_at = np.cumsum(self.shown_size) - self.shown_size
        self.cache: dict[bytes, tuple] = {}
        self.more: dict[tuple[bytes, int], tuple] = {}
        self.byte_ids = np.array([self.byte.get(i, self.unknown) for i in range(256)], np.int32)
        raw = {t.replace(BLANK, " ").encode(): t for t in self.id}
        self.longest_bytes = max(map(len, raw), default=1)
        hashes = np.array([self._hash(r) for r in raw], U)
        order = np.argsort(hashes)
        self.hashes = hashes[order]
        self.hash_ids = np.array([self.id[t] for t in raw.values()], np.int32)[order]
        self.hash_scores = np.array([self.score[t] for t in raw.values()], float)[order]
        self.filter = np.zeros(1 << 22, bool)
        self.filter[(self.hashes >> U(42)).astype(np.int64)] = True

    @staticmethod
    def _hash(raw: bytes) -> int:
        h = 0
        for x in raw:
            h = (h * _B + x + 1) & 0xFFFFFFFFFFFFFFFF
        return h

    def edges(self, text: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """For each end its edges: start, score, ids."""
        score, ids, n = self.score, self.id, len(text)
        into: list[list] = [[] for _ in range(n + 1)]
        for a in range(n):
            for b in range(a + 1, min(n, a + self.longest) + 1):
                piece = text[a:b]
                if piece in score:
                    into[b].append((a, score[piece], (ids[piece],)))
            if text[a] not in score:
                raw = text[a].encode("utf-8", "surrogatepass")
                known = tuple(self.byte[x] for x in raw) if self.byte else (self.unknown,)
                into[a + 1].append((a, self.byte_score * len(known), known))
        return into

    def nbest(self, text: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The n best paths, best first."""
        into, size = self.edges(text), len(text)
        best = [0.0] * (size + 1)
        for b in range(1, size + 1):
            best[b] = max(best[a] + s for a, s, _ in into[b])
        heap, met, found = [(-best[size], 0, size, 0.0, None)], 0, []
        while heap and len(found) < n:
            _, _, b, done, path = heapq.heappop(heap)
            if b == 0:
                out = []
                while path:
                    out += path[0]
                    path = path[1]
                found.append((done, tuple(out)))
                continue
            for a, s, ids in into[b]:
                met += 1
                heapq.heappush(heap, (-(best[a] + s + done), -met, a, s + done, (ids, path)))
        return found

    def best_path(self, text: str) -> tuple[int, ...]:
        """The best path; of equal ones that with the shortest first piece, then second, and so on."""
        into, size = self.edges(text), len(text)
        ahead, step = [float("-inf")] * size + [0.0], [(size, ())] * size
        for b in range(size, 0, -1):
            for a, s, ids in into[b]:
                through = ahead[b]
                if len(ids) > 1 or b == a + 1 and text[a] not in self.score:  # as many edges of bytes
                    for _ in ids:
                        through = self.byte_score + through
                else:
                    through = s + through
                if through >= ahead[a]:
                    ahead[a], step[a] = through, (b, ids)
        out, a = [], 0
        while a < size:
            a, ids = step[a]
            out += ids
        return tuple(out)

    def others(self, chunk: bytes, best: bytes, n: int) -> tuple[tuple, tuple]:
        """Losses and ids of the best paths but ``best``, by the search."""
        key = (chunk, n)
        if (got := self.more.get(key)) is None:
            paths = self.nbest(chunk.decode("utf-8", "surrogatepass").replace(" ", BLANK), n)
            own, top = tuple(np.frombuffer(best, "<u4").tolist()), paths[0][0]
            rest = [p for p in paths if p[1] != own][: n - 1]
            got = tuple(top - s for s, _ in rest), tuple(p for _, p in rest)
            if len(self.more) >= CACHE:
                self.more.clear()
            if len(chunk) <= 64:
                self.more[key] = got
        return got

    def solve(self, chunks: list[bytes]) -> list[tuple[bytes, float, float]]:
        """Best ids, best score and the loss of the second best path (infinite if none) of each chunk: the
        Viterbi pass forwards and backwards, for all chunks of one length together."""
        out: list = [None] * len(chunks)
        groups: dict[int, list[int]] = {}
        for i, c in enumerate(chunks):
            groups.setdefault(len(c) if len(c) <= TOGETHER and b"\xe2\x96\x81" not in c else 0, []).append(i)
        for size, rows in groups.items():
            if size:
                for i in range(0, len(rows), 4096):
                    part = rows[i : i + 4096]
                    for j, x in zip(part, self._together(np.frombuffer(b"".join(chunks[j] for j in part), np.uint8).reshape(-1, size)), strict=True):
                        out[j] = x
            else:
                for j in rows:
                    text = chunks[j].decode("utf-8", "surrogatepass").replace(" ", BLANK)
                    paths = self.nbest(text, 2)
                    out[j] = (np.array(self.best_path(text), "<u4").tobytes(), paths[0][0], paths[0][0] - paths[1][0] if len(paths) > 1 else np.inf)
        return out

    def _together(self, text: np.ndarray) -> list[tuple[bytes, float, float]]:
        n, size = text.shape
        ids = np.full((size, size + 1, n), -1, np.int32)
        cost = np.full((size, size + 1, n), -np.inf)
        up = text.astype(U) + U(1)
        for a in range(size):
            h = np.zeros(n, U)
            for b in range(a + 1, min(size, a + self.longest_bytes) + 1):
                h = h * U(_B) + up[:, b - 1]
                maybe = np.flatnonzero(self.filter[(h >> U(42)).astype(np.int64)])
                if len(maybe):
                    at = np.minimum(np.searchsorted(self.hashes, h[maybe]), len(self.hashes) - 1)
                    good = self.hashes[at] == h[maybe]
                    ids[a, b, maybe[good]] = self.hash_ids[at[good]]
                    cost[a, b, maybe[good]] = self.hash_scores[at[good]]
        # the bytes of a character without a piece
        unknown, width = np.zeros(n, bool), np.zeros(n, np.int64)
        long = 1 + (text >= 0xC0) + (text >= 0xE0) + (text >= 0xF0)
        every = np.arange(n)
        for a in range(size):
            lead = width == 0
            end = np.minimum(a + long[:, a], size)
            unknown = np.where(lead, ids[a, end, every] < 0, unknown)
            width = np.where(lead, long[:, a], width) - 1
            at = np.flatnonzero(unknown)
            ids[a, a + 1, at] = self.byte_ids[text[at, a]]
            cost[a, a + 1, at] = self.byte_score
        ahead = np.full((size + 1, n), -np.inf)
        ahead[size] = 0
        step = np.zeros((size, n), np.int64)
        for a in range(size - 1, -1, -1):
            through = cost[a] + ahead
            step[a] = through.argmax(axis=0)
            ahead[a] = through[step[a], every]
        behind = np.full((size + 1, n), -np.inf)
        behind[0] = 0
        for b in range(1, size + 1):
            behind[b] = (behind[:size] + cost[:, b]).max(axis=0)
        found, node = np.full((n, size), -1, np.int32), np.zeros(n, np.int64)
        whole = behind[:size, None, :] + cost + ahead[None, :, :]
        for k in range(size):
            on = np.flatnonzero(node < size)
            a, b = node[on], step[node[on], on]
            found[on, k] = ids[a, b, on]
            whole[a, b, on] = -np.inf
            node[on] = b
        second = whole.max(axis=(0, 1))
        keep = found >= 0
        flat_ids, count = found[keep].astype("<u4").tobytes(), np.cumsum(keep.sum(axis=1)) * 4
        return list(zip((flat_ids[x:y] for x, y in zip([0, *count[:-1].tolist()], count.tolist(), strict=True)), ahead[0].tolist(), (ahead[0] - second).tolist(), strict=True))

    def column(self, texts: pa.Array, n: int):
        """Yield for slices of rows: first row, ids of all best paths, their number a row, scores of the n
        best a row, and for each row the other paths as [(chunk's first id, its ids, other ids), ...]."""
        data, offsets = flat(texts)
        for a, b in slices(offsets, SLICE_BYTES):
            part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            full = off[:-1][np.diff(off) > 0]
            part = np.insert(part, full, 32)
            off = off + np.concatenate([[0], np.cumsum(np.diff(off) > 0)])
            yield a, *self._slice(part, off, n)

    def _slice(self, data: np.ndarray, off: np.ndarray, n: int):
        rows = len(off) - 1
        if not len(data):
            return np.zeros(0, "<u4"), np.zeros(rows, np.int64), [[0.0]] * rows, [[]] * rows
        space = data == 32
        begin = space.copy()
        begin[1:] &= ~space[:-1]
        begin[off[:-1][np.diff(off) > 0]] = True
        start = np.flatnonzero(begin)
        end = np.append(start[1:], len(data))
        total = byte_sums(data)
        _, at, inverse = np.unique(mix(moved(total[end] - total[start], start, _B) + (end - start).astype(U)), return_index=True, return_inverse=True)
        raw, cache, found = data.tobytes(), self.cache, []
        keys = [raw[x:y] for x, y in zip(start[at].tolist(), end[at].tolist(), strict=True)]
        found = list(map(cache.get, keys))
        new = [i for i, x in enumerate(found) if x is None]
        if new:
            if len(cache) + len(new) > CACHE:
                cache.clear()
            for i, got in zip(new, self.solve([keys[i] for i in new]), strict=True):
                found[i] = got
                if len(keys[i]) <= 64:
                    cache[keys[i]] = got
        ids = np.frombuffer(b"".join(f[0] for f in found), "<u4")
        count = np.fromiter((len(f[0]) // 4 for f in found), np.int64, len(found))
        best = np.fromiter((f[1] for f in found), float, len(found))
        loss = np.fromiter((f[2] for f in found), float, len(found))
        each = count[inverse]
        out = ids[ranges((np.cumsum(count) - count)[inverse], each)]
        upto = np.concatenate([[0], np.cumsum(each)])
        cut = np.searchsorted(start, off)
        scores, others = [], []
        for r in range(rows):
            own = inverse[cut[r] : cut[r + 1]]
            top, lists = float(best[own].sum()), []
            if n > 1 and len(own):
                close = np.argpartition(loss[own], n - 2)[: n - 1] if len(own) > n - 1 else np.arange(len(own))
                close = close[np.lexsort((close, loss[own][close]))]
                lists = [(int(i), self.others(keys[own[i]], found[own[i]][0], n)) for i in close if np.isfinite(loss[own[i]])]
            more = smallest_sums([f[0] for _, f in lists], n)[1:]
            scores.append([top] + [top - s for s, _ in more])
            first = upto[cut[r] : cut[r + 1]] - upto[cut[r]] if len(own) else None
            others.append([[(int(first[lists[j][0]]), int(count[own[lists[j][0]]]), lists[j][1][1][k - 1]) for j, k in enumerate(pick) if k] for _, pick in more])
        return out, np.diff(upto[cut]), scores, others

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of all rows, the first space of each left out, and their sizes."""
        size = self.shown_size[ids]
        out = self.shown[ranges(self.shown_at[ids], size)]
        upto = np.concatenate([[0], np.cumsum(size)])
        cut = np.concatenate([[0], np.cumsum(counts)])
        n = np.diff(upto[cut])
        drop = upto[cut[:-1]][n > 0]
        drop = drop[out[drop] == 32]
        n = n - np.isin(upto[cut[:-1]], drop) * (n > 0)
        return np.delete(out, drop), n


def smallest_sums(losses: list[tuple], n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n smallest sums that take from each list one loss (choice 1, 2, ...) or none (choice 0)."""
    heap, seen, out = [(0.0, (0,) * len(losses))], set(), []
    while heap and len(out) < n:
        total, pick = heapq.heappop(heap)
        if pick in seen:
            continue
        seen.add(pick)
        out.append((total, pick))
        for j, own in enumerate(losses):
            k = pick[j]
            if k < len(own):
                heapq.heappush(heap, (total - (own[k - 1] if k else 0.0) + own[k], pick[:j] + (k + 1,) + pick[j + 1 :]))
    return out


def replaced(ids: np.ndarray, changes: list[tuple]) -> np.ndarray:
    """A text's other path, from its best one."""
    out, at = [], 0
    for first, size, other in sorted(changes):
        out += [ids[at:first], np.array(other, "<u4")]
        at = first + size
    return np.concatenate([*out, ids[at:]])


def segmentations(docs: DataFrame, model: str, nbest: int = NBEST) -> DataFrame:
    """``doc_id, rank, score, ids``: the n best segmentations of every whole text, best first."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            names = batch.column(0).to_pylist()
            for a, ids, n, scores, others in pieces.column(batch.column(1), nbest):
                cut, rows = np.concatenate([[0], np.cumsum(n)]), []
                for r in range(len(n)):
                    own = ids[cut[r] : cut[r + 1]]
                    for k, s in enumerate(scores[r]):
                        rows.append((names[a + r], k + 1, s, (own if k == 0 else replaced(own, others[r][k - 1])).tolist()))
                kinds = (pa.int64(), pa.int32(), pa.float64(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "rank", "score", "ids"])

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, rank int, score double, ids array<int>")


def piece_summary(docs: DataFrame, model: str, nbest: int = NBEST) -> DataFrame:
    """A row a document: number of pieces and checksum of the best path, scores and checksums of the n
    best, and the hash of the text that the best path decodes to."""
    schema = "doc_id long, n_pieces long, ids_crc32 long, scores array<double>, other_crc32 array<long>, decoded_sha256 string"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pieces_of(model)
        for batch in batches:
            for a, ids, n, scores, others in pieces.column(batch.column(1), nbest):
                cut = np.concatenate([[0], np.cumsum(n)])
                text, size = pieces.decode(ids, n)
                raw, at = text.tobytes(), np.concatenate([[0], np.cumsum(size)]).tolist()
                own = [ids[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(a, len(n)), pa.array(n), pa.array([zlib.crc32(x.tobytes()) for x in own], pa.int64()), pa.array(scores, pa.list_(pa.float64())),
                        pa.array([[zlib.crc32(replaced(x, c).tobytes()) for c in o] for x, o in zip(own, others, strict=True)], pa.list_(pa.int64())),
                        pa.array([hashlib.sha256(raw[x:y]).hexdigest() for x, y in zip(at[:-1], at[1:], strict=True)]),
                    ],
                    [c.split()[0] for c in schema.split(", ")],
                )

    return docs.select("doc_id", "text").mapInArrow(encode, schema)
