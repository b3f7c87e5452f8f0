"""Substring dedup by De Bruijn compaction.

A run of ``length`` consecutive words is an edge of a De Bruijn graph (its nodes are the runs one word
shorter). A word goes if an edge that covers it also occurs in a document with a smaller doc_id.

1. Anchors: of the ``gram``-word hashes in each edge the smallest. Equal edges have equal anchors, so only
   edges whose anchor occurs in two different texts can be repeated. Anchors are summed up batch by batch
   before they are shuffled, and each batch gets back those of its own that are repeated.
2. Edges with such an anchor, with the places (document, position) where they begin. Edges found once fall out.
3. Compaction: each repeated edge has a source, the smallest document that has it, and a place there. Edges
   at successive places of one source form its paths. An occurrence in another document follows a path as
   long as the edges before and after it are the source's; the join of edges with occurrences keeps only
   those where an occurrence enters a path or leaves it, where the graph branches (the words on either side
   differ, by a 63-bit hash of both).
4. Between entering and leaving lies a span of the document, which is a piece of the source: its ends have
   coordinates in both, and the edges next to them are compared with the source's (64 bits) when it is cut. A
   span whose ends are not equally far apart in both would be cut to its own edges.

Exact copies of a text are told by their hash first: all but the first of them go whole if they have an edge. A text that
holds a large part of all rows is joined without a shuffle of its copies.

Defined results: a null text has no words; texts shorter than an edge stay; rows with the same doc_id do
not count against each other; a row with a null doc_id is neither smaller nor larger than another, so it
stays whole; other columns, whatever their names, are not read; an empty table gives no rows. Hashes of edges have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import drop_table, join_split, partitions, release, sifted, write_table
from .text import U, flat, mix, ranges, row_windows, sliding_min, slices, window_hashes, word_bounds, word_hashes

LENGTH, GRAM = 50, 16
NTH = 40  # bits of a place below the number of the text among those with its doc_id
NOTHING = hashlib.sha256(b"").hexdigest()


def text_id(sha: str) -> int:
    return int.from_bytes(bytes.fromhex(sha[:16]), "little", signed=True)


def joined_words(part: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[bytes, np.ndarray]:
    """All words, each followed by one space, and where each begins (with the end)."""
    size = ends - starts + 1
    at = np.zeros(len(size) + 1, np.int64)
    np.cumsum(size, out=at[1:])
    if not len(size):
        return b"", at
    out = part[np.minimum(ranges(starts, size), len(part) - 1)]
    out[at[1:] - 1] = 32
    return out.tobytes(), at


def cut_words(texts: pa.Array):
    """Slices of rows: first row, rows, words as bytes, their places, first word of each row, word hashes."""
    data, offsets = flat(texts)
    for a, b in slices(offsets):
        part, off = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
        starts, ends, first = word_bounds(part, off)
        raw, at = joined_words(part, starts, ends)
        yield a, b - a, raw, at, first, word_hashes(part, starts, ends)


def anchors(words: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The anchor of the edge at each word."""
    return sliding_min(mix(window_hashes(words, gram), 9), length - gram + 1)[0]


def edge_runs(words: np.ndarray, lo: int, hi: int, length: int, wanted: np.ndarray) -> tuple[np.ndarray, ...] | None:
    """The edges of a row (words lo to hi) whose anchor is wanted: first position, hash, and a hash of the words on either
    side. That is 0 where a side has none or the edge there, or this one, occurs again in the row: such an edge comes once
    and is told apart when the row is cut."""
    n = hi - lo - length + 1
    if n <= 0 or not len(wanted):
        return None
    own = words[lo:hi]
    a = anchors(own, length, GRAM)
    at = np.minimum(np.searchsorted(wanted, a), len(wanted) - 1)
    good = wanted[at] == a
    if not good.any():
        return None
    h = window_hashes(own, length)
    _, first, back, count = np.unique(h, return_index=True, return_inverse=True, return_counts=True)
    often = count[back] > 1
    link = np.zeros(n, U)
    link[1:-1] = mix(mix(own[length + 1 :], 3) + own[: max(n - 2, 0)], 4) | U(1)
    link[often] = 0
    link[:-1][often[1:]] = 0
    link[1:][often[:-1]] = 0
    keep = np.sort(first)
    keep = keep[good[keep]]
    return keep.astype(np.int32), h[keep], link[keep]


def _anchor_table(docs: DataFrame, length: int, buckets: int) -> DataFrame:
    """Rows of documents (batch, doc_id, n_words, sha, text, anchors) and of batches (batch, bucket, block)."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["batch", "doc_id", "n_words", "sha", "anchors", "bucket", "block"]
        task = TaskContext.get().partitionId() << 32
        for number, batch in enumerate(batches):
            n_words, shas, own = [], [], []
            for _, rows, raw, at, first, words in cut_words(batch.column(1)):
                a = anchors(words, length, GRAM)
                start, count = row_windows(first, length)
                for r in range(rows):
                    shas.append(hashlib.sha256(raw[at[first[r]] : max(at[first[r]], at[first[r + 1]] - 1)]).hexdigest())
                    n_words.append(int(first[r + 1] - first[r]))
                    own.append(np.unique(a[start[r] : start[r] + count[r]]))
            m, here = len(shas), task | number
            yield pa.RecordBatch.from_arrays([pa.array([here] * m, pa.int64()), batch.column(0).cast(pa.int64()), pa.array(n_words, pa.int64()), pa.array(shas, pa.string()), pa.array([x.tobytes() for x in own], pa.binary()), pa.nulls(m, pa.int32()), pa.nulls(m, pa.binary())], names)
            if not m:
                continue
            h, who = np.concatenate(own), np.repeat(np.array([text_id(s) for s in shas]), [len(x) for x in own])
            order = np.lexsort((who, h))
            h, who = h[order], who[order]
            begin = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
            last = np.append(begin[1:], len(h))[: len(begin)] - 1
            keys, low, high = h[begin], who[begin], who[last]
            place = keys % U(buckets)
            order = np.argsort(place, kind="stable")
            cut = np.searchsorted(place[order], np.arange(buckets + 1, dtype=U))
            blocks = [(b, np.stack([keys[x].view(np.int64), low[x], high[x]]).tobytes()) for b in range(buckets) if len(x := order[cut[b] : cut[b + 1]])]
            k = len(blocks)
            if k:
                yield pa.RecordBatch.from_arrays([pa.array([here] * k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()), pa.nulls(k, pa.string()), pa.nulls(k, pa.binary()), pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())], names)

    return docs.mapInArrow(describe, "batch long, doc_id long, n_words long, sha string, anchors binary, bucket int, block binary")


def _repeated_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each batch those of its anchors, of this partition's, that two different texts have."""
    here, parts = [], []
    for batch in batches:
        here += batch.column(0).to_pylist()
        parts += [np.frombuffer(x.as_py(), np.int64).reshape(3, -1) for x in batch.column(1)]
    if not parts:
        return
    whole = np.concatenate(parts, axis=1)
    keys, back = np.unique(whole[0], return_inverse=True)
    low, high = np.full(len(keys), np.iinfo(np.int64).max), np.full(len(keys), np.iinfo(np.int64).min)
    np.minimum.at(low, back, whole[1])
    np.maximum.at(high, back, whole[2])
    again = (low < high)[back]
    at = 0
    for b, p in zip(here, parts, strict=True):
        n = p.shape[1]
        if (own := whole[0, at : at + n][again[at : at + n]]).size:
            yield pa.RecordBatch.from_arrays([pa.array([b]), pa.array([own.tobytes()])], ["batch", "keys"])
        at += n


def _flag(rows: pa.Table, keys: pa.Table) -> pa.Table:
    """A batch's documents with those of their anchors that are repeated."""
    again = np.unique(np.concatenate([np.frombuffer(x.as_py(), U) for x in keys["keys"]] or [np.zeros(0, U)]))
    doc, sha, found = [], [], []
    for d, s, a in zip(rows["doc_id"].to_pylist(), rows["sha"].to_pylist(), rows["anchors"], strict=True):
        own = np.frombuffer(a.as_py(), U)
        if len(again) and len(own) and d is not None:
            at = np.minimum(np.searchsorted(again, own), len(again) - 1)
            own = own[again[at] == own]
            if len(own):
                doc.append(d)
                sha.append(s)
                found.append(own.tobytes())
    return pa.table({"doc_id": pa.array(doc, pa.int64()), "sha": pa.array(sha, pa.string()), "wanted": pa.array(found, pa.binary())})


def _edges(length: int):
    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of documents that have edges in question: doc_id, sha, text, and the edges packed."""
        for batch in batches:
            wanted, shas, nth = batch.column(3), batch.column(2).to_pylist(), batch.column(4)
            keep, packed = [], []
            for a, rows, raw, at, first, words in cut_words(batch.column(1)):
                for r in range(rows):
                    if hashlib.sha256(raw[at[first[r]] : max(at[first[r]], at[first[r + 1]] - 1)]).hexdigest() != shas[a + r]:
                        continue
                    got = edge_runs(words, first[r], first[r + 1], length, np.frombuffer(wanted[a + r].as_py(), U))
                    if got:
                        keep.append(a + r)
                        packed.append([x.tobytes() for x in got])
            if keep:
                take = pa.array(keep)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(2).take(take), batch.column(1).take(take), nth.take(take), *(pa.array([p[i] for p in packed], pa.binary()) for i in range(3))], ["doc_id", "sha", "text", "nth", "pos", "h", "link"])

    return find


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, nth, columns = batch.column(0).to_numpy(), batch.column(1).to_numpy().astype(np.int64), [batch.column(i).to_pylist() for i in range(2, 5)]
        a, size = 0, [len(x) // 4 for x in columns[0]]
        while a < len(docs):
            b, total = a, 0
            while b < len(docs) and (b == a or total + size[b] <= 1 << 17):
                total += size[b]
                b += 1
            pos, h, link = (np.frombuffer(b"".join(c[a:b]), t) for c, t in zip(columns, (np.int32, np.int64, np.int64), strict=True))
            place = np.repeat(nth[a:b] << NTH, size[a:b]) + pos
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(docs[a:b], size[a:b])), pa.array(place), pa.array(h), pa.array(link)], ["doc_id", "place", "h", "link"])
            a = b


def _cut_out(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The words that stay, joined by one space, of documents with spans."""
        for batch in batches:
            spans, n_removed, kept = batch.column(3), [], []
            for a, rows, raw, at, first, words in cut_words(batch.column(2)):
                for r in range(rows):
                    own = (x.to_numpy(zero_copy_only=False) for x in spans[a + r].values.flatten())
                    gone = covered(words[first[r] : first[r + 1]], length, *own)
                    n_removed.append(int(gone.sum()))
                    edge = np.flatnonzero(np.diff(np.concatenate([[True], gone, [True]]).astype(np.int8)))
                    pieces = [raw[at[first[r] + x] : at[first[r] + y]] for x, y in zip(edge[0::2].tolist(), edge[1::2].tolist(), strict=True)]
                    kept.append(b"".join(pieces)[:-1].decode("utf-8", "surrogatepass"))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "sha", "n_removed", "kept"])

    return cut


def covered(words: np.ndarray, length: int, pos: np.ndarray, at: np.ndarray, ahead: np.ndarray, behind: np.ndarray, flags: np.ndarray) -> np.ndarray:
    """Which words go. Of each edge where the row may enter or leave a path: its position, its place in the source, the
    edges after and before it there, and whether there are such (bits 0 and 1). Spans go from an entering edge to the next
    leaving one; an edge that the row has more than once goes wherever it is."""
    h = window_hashes(words, length)
    _, back, count = np.unique(h, return_inverse=True, return_counts=True)
    often = count[back] > 1
    cover = np.zeros(len(words) + 1, np.int64)
    many = often[pos]
    if many.any():
        each = np.flatnonzero(np.isin(h, h[pos[many]]))
        np.add.at(cover, each, 1)
        np.add.at(cover, each + length, -1)
    order = np.argsort(pos[~many], kind="stable")
    pos, at, ahead, behind, flags = (x[~many][order] for x in (pos, at, ahead, behind, flags))
    beyond, before = np.minimum(pos + 1, len(h) - 1), np.maximum(pos - 1, 0)
    leaves = (flags & 1 == 0) | (pos + 1 >= len(h)) | often[beyond] | (h[beyond] != ahead.view(U))
    enters = (flags & 2 == 0) | (pos == 0) | often[before] | (h[before] != behind.view(U))
    begin, stop, shift = pos[enters], pos[leaves], at - pos
    same = np.zeros(0, bool)
    if len(begin) == len(stop):
        same = (begin <= stop) & (shift[enters] == shift[leaves])
    if not len(same) or not same.all():  # ends that do not belong together: only their own edges
        lone = pos if len(begin) != len(stop) else np.concatenate([begin[~same], stop[~same]])
        begin, stop = (begin[same], stop[same]) if len(same) else (begin[:0], stop[:0])
        begin, stop = np.concatenate([begin, lone]), np.concatenate([stop, lone])
    np.add.at(cover, begin, 1)
    np.add.at(cover, stop + length, -1)
    return np.cumsum(cover)[:-1] > 0


def paths(edges: DataFrame) -> DataFrame:
    """``h, source, at, link, path, ahead, behind``: every repeated edge, its source and place there, the path that it is
    part of (the place where that begins), and the edges after and before it on the path, null at its ends."""
    seen = edges.groupBy("h").agg(F.min("doc_id").alias("source"), F.min_by("place", "doc_id").alias("at"), F.min_by("link", "doc_id").alias("link"), F.count("*").alias("n"))
    again = seen.filter("n >= 2").drop("n")
    along = Window.partitionBy("source").orderBy("at")
    ahead, behind = F.lead("at").over(along) == F.col("at") + 1, F.lag("at").over(along) == F.col("at") - 1
    rows = again.withColumns({"ahead": F.when(ahead, F.lead("h").over(along)), "behind": F.when(behind, F.lag("h").over(along))})
    return rows.withColumn("path", F.max(F.when(F.col("behind").isNull(), F.col("at"))).over(along))


def compacted(on: DataFrame, length: int = LENGTH) -> DataFrame:
    """``source, path, edges, words``: the nonbranching repeated paths, one row each."""
    return on.groupBy("source", "path").agg(F.count("*").alias("edges"), (F.count("*") + length - 1).alias("words"))


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256, words_sha256, kept``: one row a row of ``docs``. ``kept`` is
    the text of the words that stay, null where none go; ``words_sha256`` is the hash of all words."""
    spark = docs.sparkSession
    docs = docs.select("doc_id", "text")
    buckets = partitions(spark)
    described = write_table(_anchor_table(docs, length, buckets), "repeat-docs")
    base = described.filter("bucket is null").select("doc_id", "n_words", "sha")
    again = described.filter("bucket is not null").select("bucket", "batch", "block").repartition(buckets, "bucket").select("batch", "block")
    again = again.mapInArrow(_repeated_anchors, "batch long, keys binary")
    rows = described.filter("bucket is null and length(anchors) > 0").select("batch", "doc_id", "sha", "anchors")
    flagged = rows.groupBy("batch").cogroup(again.groupBy("batch")).applyInArrow(_flag, "doc_id long, sha string, wanted binary")
    first = write_table(base.groupBy("sha").agg(F.min("doc_id").alias("first"), F.count("*").alias("rows")), "repeat-first")
    flagged = write_table(flagged, "repeat-flagged")
    release(spark)
    once = join_split(flagged, first, "sha").filter("doc_id = first").dropDuplicates(["doc_id", "sha"])
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy("sha"))  # of different texts with one doc_id
    once = write_table(once.select("doc_id", "sha", "wanted", nth.alias("nth")), "repeat-anchors")
    drop_table(flagged)
    release(spark)

    edges = sifted(docs, once.select("doc_id"), "doc_id").join(once, "doc_id").select("doc_id", "text", "sha", "wanted", "nth")
    edges = edges.mapInArrow(_edges(length), "doc_id long, sha string, text string, nth int, pos binary, h binary, link binary")
    edges = write_table(edges, "repeat-texts")
    drop_table(once)
    release(spark)

    each = edges.select("doc_id", "nth", "pos", "h", "link").mapInArrow(_unpack, "doc_id long, place long, h long, link long")
    on = write_table(paths(each).withColumnRenamed("link", "own_link"), "repeat-paths")
    release(spark)
    inside = (F.col("link") != 0) & (F.col("link") == F.col("own_link")) & F.col("ahead").isNotNull() & F.col("behind").isNotNull()
    occurs = each.select(F.col("h").alias("key"), "doc_id", "place", "link")
    spans = occurs.join(on, (F.col("key") == F.col("h")) & (F.col("doc_id") > F.col("source")) & ~inside)
    low = (1 << NTH) - 1
    flags = F.col("ahead").isNotNull().cast("int") + F.col("behind").isNotNull().cast("int") * 2
    none = F.lit(0).cast("long")
    event = F.struct(F.col("place").bitwiseAND(low).alias("pos"), F.col("at").bitwiseAND(low).alias("at"), F.coalesce("ahead", none).alias("ahead"), F.coalesce("behind", none).alias("behind"), flags.alias("flags"))
    spans = spans.select("doc_id", F.shiftright("place", NTH).cast("int").alias("nth"), event.alias("span"))
    spans = spans.groupBy("doc_id", "nth").agg(F.collect_list("span").alias("spans"))
    changed = edges.select("doc_id", "sha", "text", "nth").join(spans, ["doc_id", "nth"]).select("doc_id", "sha", "text", "spans")
    changed = write_table(changed.mapInArrow(_cut_out(length), "doc_id long, sha string, n_removed long, kept string"), "repeat-kept")
    drop_table(edges)
    release(spark)

    copy = (F.col("doc_id") > F.col("first")) & (F.col("n_words") >= length)
    out = join_split(base, first, "sha").join(changed, ["doc_id", "sha"], "left")
    kept = F.when(copy, F.lit("")).otherwise(F.col("kept"))
    return out.select(
        "doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(NOTHING)).when(F.col("kept").isNotNull(), F.sha2("kept", 256)).otherwise(F.col("sha")).alias("kept_sha256"),
        F.col("sha").alias("words_sha256"), kept.alias("kept"),
    )
