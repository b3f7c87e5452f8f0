"""Spelling variants: frequent words that differ by one code point, and the form that a rare one stands for.

Runs of letters are counted a slice of texts at a time (the sums are Spark's); those whose checksum with the doc_id says so
lose a code point first. Near words are found by an even partition: a word of L code points is cut into two segments at
half its length, and one edit leaves one of the two whole. So each word is indexed under what is left of it without either
half, and words of the same length, or of one code point more, are probed: the segment behind the edit is then shifted by
one. Candidates are verified by the edit distance of the whole words, and found once however many segments they share.

A segment that many words share (``GROUP``) isn't paired within: the half that may differ is cut evenly again, and again,
each time keyed by all the rest of the word, until the groups are small or only one code point is open, where an alphabet
bounds them. No pair is lost by this: an edit lies in one of the two parts. Groups are split by Spark, level after level.

Defined results: null and empty texts have no runs; a null doc_id counts as an empty one in the checksum; repeated rows
count each; a run of any length is one word; ties of n go to the smaller word in code-point order; without words there are
no rows. Columns other than doc_id and text, whatever their names, are not read. Counts are exact up to 64-bit hashes of
the words within a slice of texts.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .ngrams import lowered
from .shared import FEW, HOT_KEYS, join_split, write_table
from .text import byte_sums, flat, give_back, moved, mix, ranges, slices, _B, U

LEAST_LENGTH, LEAST_COUNT, TIMES, EVERY = 6, 5, 5, 199
GROUP = 64  # a group of more rows is cut further
SLICE, LONG_RUN = 4 << 20, 64
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[0xC3] = True


def _crc_table() -> np.ndarray:
    """What a byte does to the checksum, by the checksum's polynomial."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> np.uint32(1)) ^ np.uint32(0xEDB88320), table >> np.uint32(1))
    return table


_CRC = _crc_table()


def letter_runs(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all maximal runs of letters, in bytes, and their lengths in code points. U+00C0 to U+00FF are the
    two-byte sequences that begin with C3."""
    if not len(data):
        return (np.zeros(0, np.int64),) * 3
    lead = data == 0xC3
    solid = _LETTER[data]
    solid[1:] |= lead[:-1]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    edge = off[1:-1]
    edge = edge[(edge > 0) & (edge < len(data))]
    first[edge], last[edge - 1] = solid[edge], solid[edge - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    leads = np.concatenate([[0], np.cumsum(lead)])
    return starts, ends, ends - starts - (leads[ends] - leads[starts])


def checksums(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """crc32 of each run of bytes, carried on from ``before``; one step a byte position for all runs at once."""
    order = np.argsort(-sizes, kind="stable")
    at, size, state = starts[order], sizes[order], ~before[order]
    long = int(np.searchsorted(-size, -LONG_RUN, side="left"))
    for i in range(long):
        state[i] = ~np.uint32(zlib.crc32(data[at[i] : at[i] + size[i]].tobytes(), int(~state[i])))
    for j in range(int(size[long]) if long < len(size) else 0):
        n = int(np.searchsorted(-size, -j, side="left"))
        part = state[long:n]
        state[long:n] = _CRC[(part ^ data[at[long:n] + j]) & np.uint32(255)] ^ (part >> np.uint32(8))
    out = np.empty_like(state)
    out[order] = ~state
    return out


def strings(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> pa.Array:
    off = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(sizes, out=off[1:])
    return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(off), pa.py_buffer(np.ascontiguousarray(data[ranges(starts, sizes)]))).cast(pa.string())


def count_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``word, n`` of rows of doc_id and text: partial counts, a slice of texts at a time."""
    for batch in batches:
        ids, (data, offsets) = batch.column(0).to_pylist(), flat(batch.column(1))
        for a, b in slices(offsets, SLICE):
            low, off = lowered(data[offsets[a] : offsets[b]]), offsets[a : b + 1] - offsets[a]
            starts, ends, length = letter_runs(low, off)
            keep = length >= LEAST_LENGTH
            starts, sizes, length = starts[keep], (ends - starts)[keep], length[keep]
            if not len(starts):
                continue
            before = np.array([zlib.crc32(b"%s:" % (b"" if i is None else str(i).encode())) for i in ids[a:b]], np.uint32)
            sums = checksums(low, starts, sizes, before[np.searchsorted(off, starts, side="right") - 1])
            hit = sums % np.uint32(EVERY) == 0
            cut = Counter()
            for s, n, size, h in zip(starts[hit].tolist(), length[hit].tolist(), sizes[hit].tolist(), sums[hit].tolist(), strict=True):
                run = low[s : s + size].tobytes().decode()
                if n > LEAST_LENGTH:
                    cut[run[: h % n] + run[h % n + 1 :]] += 1
            starts, sizes = starts[~hit], sizes[~hit]
            total = byte_sums(low)
            key = mix(moved(total[starts + sizes] - total[starts], starts, _B) + sizes.astype(U))
            del total
            _, one, n = np.unique(key, return_index=True, return_counts=True)
            yield pa.RecordBatch.from_arrays([strings(low, starts[one], sizes[one]), pa.array(n.astype(np.int64))], ["word", "n"])
            if cut:
                yield pa.RecordBatch.from_arrays([pa.array(list(cut), pa.string()), pa.array(list(cut.values()), pa.int64())], ["word", "n"])
    give_back()


def frequent_words(docs: DataFrame, least: int = LEAST_COUNT) -> DataFrame:
    """``word, n`` of the words that occur often enough."""
    counts = docs.select("doc_id", "text").filter("text is not null").mapInArrow(count_runs, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def _open(longer: Column, a: Column, b: Column) -> Column:
    """A place in the index: the open range of an indexed word, and whether this row is a word of one code point more."""
    return F.struct(longer.cast("int").alias("longer"), a.cast("int").alias("a"), b.cast("int").alias("b"))


def _rest() -> Column:
    """Hash of all of a word but its open range; a word of one code point more has its range longer by one."""
    size = F.length("word") - F.col("longer")
    tail = F.expr("substring(word, b + longer + 1, length(word))")
    return F.xxhash64(size, "a", "b", F.expr("substring(word, 1, a)"), tail)


def segment_index(words: DataFrame) -> DataFrame:
    """Four rows a word: as indexed word and as one of one code point more, each without either half."""
    size = F.length("word")
    own, less = F.floor(size / 2), F.floor((size - 1) / 2)
    zero, one = F.lit(0), F.lit(1)
    places = [_open(zero, zero, own), _open(zero, own, size), _open(one, zero, less), _open(one, less, size - 1)]
    rows = words.select("word", "n", F.explode(F.array(*places)).alias("p")).select("word", "n", "p.*")
    return rows.filter(size - F.col("longer") >= LEAST_LENGTH).withColumn("key", _rest())


def _halves(rows: DataFrame) -> DataFrame:
    middle = F.floor((F.col("a") + F.col("b")) / 2)
    places = F.array(_open(F.col("longer"), F.col("a"), middle), _open(F.col("longer"), middle, F.col("b")))
    return rows.select("word", "n", F.explode(places).alias("p")).select("word", "n", "p.*").withColumn("key", _rest())


def _without(rows: DataFrame, keyed: DataFrame) -> DataFrame:
    """Rows of other keys than those of ``keyed``; the most frequent of these go to every task, as in ``join_split``."""
    total = keyed.agg(F.sum("rows")).first()[0] or 0
    most = max(FEW, total // HOT_KEYS)
    hot, cold = keyed.filter(F.col("rows") > most).select("key"), keyed.filter(F.col("rows") <= most).select("key")
    return rows.join(F.broadcast(hot), "key", "left_anti").join(cold, "key", "left_anti")


def one_edit() -> Column:
    """Is ``other`` one edit from ``word``, another one of equal length or one code point less? Spark's edit distance looks at
    all pairs of places, whatever its threshold, so long words are compared behind the first place where they differ."""
    same = F.zip_with(F.split("word", ""), F.split("other", ""), lambda x, y: x == y)
    at = F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)), F.length("word") + 1)
    equal = F.length("word") == F.length("other")
    behind = F.substr(F.col("word"), F.when(equal, at + 1).otherwise(at).cast("int")) == F.substr(F.col("other"), (at + 1).cast("int"))
    return F.when(F.length("other") <= LONG_RUN, F.levenshtein("word", "other", 1) == 1).otherwise(behind)


def near_words(words: DataFrame, group: int = GROUP) -> DataFrame:
    """``word, n, other, other_n`` of all pairs that one inserted, deleted or replaced code point tells apart, both ways
    round, each once. ``words`` (word, n) has a row a word and should be a table."""
    rows, pairs = write_table(segment_index(words), "segments"), None
    while True:
        sizes = rows.groupBy("key").agg(F.count("*").alias("rows"), F.min("longer").alias("longer"), F.max(F.col("b") - F.col("a")).alias("open"))
        large = write_table(sizes.filter((F.col("rows") > group) & (F.col("open") > 1) & (F.col("longer") == 0)).select("key", "rows"), "segments-large")
        end = large.isEmpty()
        small = rows if end else _without(rows, large)
        left = small.filter("longer = 0").select("key", "word", "n")
        right = small.select("key", F.col("word").alias("other"), F.col("n").alias("other_n"), "longer")
        once = (F.col("longer") == 1) | (F.col("word") < F.col("other"))
        found = left.join(right, "key").filter(once & one_edit()).select("word", "n", "other", "other_n")
        pairs = found if pairs is None else pairs.unionByName(found)
        if end:
            break
        rows = write_table(_halves(join_split(rows, large, "key")), "segments")
    both = F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    turned = pairs.select(F.explode(both).alias("p")).select("p.*")
    return turned.repartition("word").dropDuplicates(["word", "other"])


def followed(links: DataFrame) -> DataFrame:
    """``word, root``: where each word's forms end, of ``word, form``. n grows by ``TIMES`` a step, so paths are short and end;
    each round doubles what is followed."""
    rows = write_table(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        on = rows.select(F.col("word").alias("root"), F.col("root").alias("further"))
        rows = rows.select("word", "root").join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        rows = write_table(rows, "roots")
        if rows.filter("moved").isEmpty():
            return rows.select("word", "root")


def spelling_variants(docs: DataFrame, least: int = LEAST_COUNT, times: int = TIMES, group: int = GROUP) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every frequent word."""
    words = write_table(frequent_words(docs, least), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("form")))
    near = near_words(words, group).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    near = near.select("word", "n_near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n"))
    joined = words.join(near, "word", "left")
    taken = F.col("form_n") >= times * F.col("n")
    linked = write_table(joined.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.when(taken, F.col("form")).alias("form"), F.when(taken, F.col("form_n")).alias("form_n")), "variants")
    roots = followed(linked.filter("form is not null"))
    return linked.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
