"""Token ids in binary files: frequency-ranked, byte-aligned variable-length codes, control bytes apart.

An id is replaced by its rank in the corpus (the most frequent is 0), so that most ids take one byte.
A file holds, after a header, the documents' ids and lengths, then the control bytes (two bits an id:
its bytes less one, four ids a byte, each document from a byte of its own on) and then all data bytes. So a
document's code is the same in any file, and a file is its documents' codes one after another. The decoder looks
the control bytes up in a table of 256 rows of four lengths; a running sum gives each id's place, whatever the
lengths. Files are read in steps of about ``STEP_IDS`` ids.

Texts are put in order before they are encoded, and their ids kept as a table in that order, so that counting and
writing are scans of it: at no time are there more than two of texts, table and files on disk. What was written
is listed in a table, one row a file; where a file's ids begin comes from a running sum within each task's files and
one row a task.

Defined results: a null or empty text has only the end id; repeated doc_ids follow in an order that their texts
decide; a null doc_id comes first; other columns, whatever their names, are not read; an empty table
gives no files and no rows. A file holds at most ``FILE_IDS`` ids or one document.
"""

from __future__ import annotations

import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import encoder, forget
from .shared import drop_table, new_path, partitions, release, write_table
from .store import read_file, write_file
from .text import binary, give_back, ranges

MAGIC, HEAD = b"QTOK2\0\0\0", "<8sQQQQ"
FILE_COLUMNS = ["task", "file", "start", "part", "path", "docs", "ids"]
FILES = "task long, file long, start long, part long, path string, docs long, ids long"
FILE_IDS, STEP_IDS = 1 << 21, 1 << 18
LENGTHS = ((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) % 4 + 1).astype(np.uint8)


def pack(ranks: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Control bytes and data bytes of documents' non-negative 32-bit numbers, and how many of either a document has."""
    r = ranks.astype("<u4", copy=False)
    n = 1 + (r > 0xFF).view(np.uint8) + (r > 0xFFFF).view(np.uint8) + (r > 0xFFFFFF).view(np.uint8)
    quads = -(-lengths // 4)
    code = np.zeros(int(quads.sum()) * 4, np.uint8)
    code[ranges(np.cumsum(quads * 4) - quads * 4, lengths)] = n - 1
    four = code.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    upto = np.concatenate([[0], np.cumsum(n, dtype=np.int64)])
    data = r.view(np.uint8).reshape(-1, 4)[np.arange(4, dtype=np.uint8) < n[:, None]]
    return control, data, quads, np.diff(upto[np.concatenate([[0], np.cumsum(lengths)])])


def unpack(control: np.ndarray, data: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, int]:
    """The documents' numbers again, by table lookup, and the data bytes that they took."""
    quads = -(-lengths // 4)
    size = LENGTHS[control].reshape(-1)
    own = ranges(np.cumsum(quads * 4) - quads * 4, lengths)
    if len(own) < len(size):
        size = size[own]
    end = np.cumsum(size, dtype=np.int64)
    at = end - size
    out = data[at].astype(np.uint32)
    for i in (1, 2, 3):
        more = np.flatnonzero(size > i)
        if not len(more):
            break
        out[more] |= data[at[more] + i].astype(np.uint32) << np.uint32(8 * i)
    return out, int(end[-1]) if len(end) else 0


def file_bytes(doc_ids: list, lengths: list, control: list, data: list) -> bytes:
    known = np.array([d is not None for d in doc_ids], np.uint8)
    ids = np.array([d or 0 for d in doc_ids], "<i8")
    control, data = b"".join(control), b"".join(data)
    head = struct.pack(HEAD, MAGIC, len(doc_ids), sum(lengths), len(control), len(data))
    return head + known.tobytes() + ids.tobytes() + np.array(lengths, "<u4").tobytes() + control + data


def read_steps(raw: bytes) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """Documents, their lengths and numbers, some documents at a time."""
    magic, docs, _, n_control, n_data = struct.unpack_from(HEAD, raw)
    if magic != MAGIC:
        raise ValueError("not a token file")
    at, out = struct.calcsize(HEAD), []
    for kind, count in (("u1", docs), ("<i8", docs), ("<u4", docs), ("u1", n_control), ("u1", n_data)):
        out.append(np.frombuffer(raw, kind, count, at))
        at += out[-1].nbytes
    known, ids, lengths, control, data = out
    lengths = lengths.astype(np.int64)
    upto, quads = np.cumsum(lengths), np.concatenate([[0], np.cumsum(-(-lengths // 4))])
    a, taken = 0, 0
    while a < docs:
        b = max(a + 1, int(np.searchsorted(upto, (upto[a - 1] if a else 0) + STEP_IDS, "right")))
        values, used = unpack(control[quads[a] : quads[b]], data[taken:], lengths[a:b])
        yield [int(d) if k else None for k, d in zip(known[a:b], ids[a:b], strict=True)], lengths[a:b], values
        a, taken = b, taken + used


def token_table(docs: DataFrame, vocabulary: str, end_id: int | None) -> DataFrame:
    """``doc_id, n, ids``: each text's ids as little-endian numbers of the vocabulary's width, the end id last."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(vocabulary)
        for batch in batches:
            for a, ids, n in enc.column(batch.column(1)):
                if end_id is not None:
                    ids = np.insert(ids, np.cumsum(n), end_id).astype(enc.store)
                    n = n + 1
                rows = batch.column(0).slice(a, len(n))
                yield pa.RecordBatch.from_arrays([rows, pa.array(n), binary(ids, n)], ["doc_id", "n", "ids"])
        give_back()

    return docs.select("doc_id", "text").mapInArrow(encode, "doc_id long, n long, ids binary")


def frequency_ranks(tokens: DataFrame, size: int) -> np.ndarray:
    """Ids by falling count in the whole corpus, ties by id; one row an id of the vocabulary reaches the driver."""
    store = "<u2" if size <= 1 << 16 else "<u4"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for x in batch.column(0):
                total += np.bincount(np.frombuffer(x.as_py(), store), minlength=size)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["id", "n"])

    counts = np.zeros(size, np.int64)
    for r in tokens.select("ids").mapInArrow(count, "id long, n long").groupBy("id").agg({"n": "sum"}).collect():
        counts[r[0]] = r[1]
    return np.lexsort((np.arange(size), -counts))


def write_token_files(docs: DataFrame, vocabulary: str, end_id: int | None = None) -> tuple[DataFrame, str]:
    """Encode, rank and write. Returns a table of the files (path, ids before it, documents, ids) and the path of the ranks."""
    spark = docs.sparkSession
    folder, size = new_path(spark, "tokens"), encoder(vocabulary).size
    order = ["doc_id", F.xxhash64("text"), "text"]
    ordered = docs.select("doc_id", "text").repartitionByRange(partitions(spark), *order[:2]).sortWithinPartitions(*order)
    tokens = write_table(token_table(ordered, vocabulary, end_id), "token-ids", "zstd")
    release(spark)
    by_rank = frequency_ranks(tokens, size)
    rank = np.empty(size, np.uint32)
    rank[by_rank] = np.arange(size, dtype=np.uint32)
    write_file(f"{folder}/ranks", by_rank.astype("<u4").tobytes())
    store = encoder(vocabulary).store.str

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A run of rows is what the scan reads of one file from one place on; its files are named after that."""
        forget()
        run, part, held, docs_, lengths, control, data = None, 0, 0, [], [], [], []

        def flush():
            path = f"{folder}/part-{run[0]:06d}-{run[1]:03d}-{run[2]:012d}-{part:06d}"
            write_file(path, file_bytes(docs_, lengths, control, data))
            return pa.RecordBatch.from_arrays([pa.array([x]) for x in (*run, part, path, len(docs_), held)], FILE_COLUMNS)

        for batch in batches:
            n, raw = batch.column(1).to_numpy(), batch.column(2)
            names, starts = batch.column(3).to_pylist(), batch.column(4).to_pylist()
            first, upto = 0, np.cumsum(n)
            while first < len(n):
                last = max(first + 1, int(np.searchsorted(upto, (upto[first - 1] if first else 0) + STEP_IDS, "right")))
                ids = np.frombuffer(b"".join(x.as_py() for x in raw.slice(first, last - first)), store)
                c, d, sizes, counts = pack(rank[ids], n[first:last])
                c, d, c_at, d_at = c.tobytes(), d.tobytes(), np.concatenate([[0], np.cumsum(sizes)]).tolist(), np.concatenate([[0], np.cumsum(counts)]).tolist()
                for i, doc in enumerate(batch.column(0).slice(first, last - first).to_pylist()):
                    here, size_ = (*_place(names[first + i]), starts[first + i]), int(n[first + i])
                    if docs_ and (here != run or held + size_ > FILE_IDS):
                        yield flush()
                        part, held, docs_, lengths, control, data = part + 1 if here == run else 0, 0, [], [], [], []
                    run = here
                    docs_.append(doc)
                    lengths.append(size_)
                    control.append(c[c_at[i] : c_at[i + 1]])
                    data.append(d[d_at[i] : d_at[i + 1]])
                    held += size_
                first = last
        if docs_:
            yield flush()
        give_back()

    rows = tokens.select("doc_id", "n", "ids", F.col("_metadata.file_name"), F.col("_metadata.file_block_start"))
    files = write_table(rows.mapInArrow(write, FILES), "token-files")
    drop_table(tokens)
    return with_places(files), f"{folder}/ranks"


def with_places(files: DataFrame) -> DataFrame:
    """``path, before, docs, ids``: the ids of all files before each. Tasks, of which there are as many as partitions of
    the texts in order, are summed first; a task's own files follow one another."""
    tasks = files.groupBy("task").agg(F.sum("ids").alias("_all"))
    tasks = tasks.select("task", (F.sum("_all").over(Window.orderBy("task")) - F.col("_all")).alias("_base"))
    own = F.sum("ids").over(Window.partitionBy("task").orderBy("file", "start", "part")) - F.col("ids")
    placed = files.withColumn("_own", own).join(tasks, "task")
    return placed.select("path", (F.col("_base") + F.col("_own")).alias("before"), "docs", "ids")


def _place(name: str) -> tuple[int, int]:
    """The task that wrote a file of a table, and which of its files that is."""
    found = re.match(r"part-(\d+)-.*?(?:-c(\d+))?[.]", name)
    return int(found[1]), int(found[2] or 0)


def read_token_files(spark: SparkSession, files: DataFrame, ranks: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (unsigned 32-bit little-endian) of every document, from the files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        by_rank = np.frombuffer(read_file(ranks), "<u4")
        for batch in batches:
            for path, before in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for doc_ids, n, values in read_steps(read_file(path)):
                    start = before + np.cumsum(n) - n
                    yield pa.RecordBatch.from_arrays([pa.array(doc_ids, pa.int64()), pa.array(start), pa.array(n), binary(by_rank[values], n)], ["doc_id", "start", "n_tokens", "ids"])
                    before += int(n.sum())
        give_back()

    dealt = files.select("path", "before").repartition(4 * spark.sparkContext.defaultParallelism)
    return dealt.mapInArrow(read, "doc_id long, start long, n_tokens long, ids binary")


def crc_column(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        crc = pa.array([zlib.crc32(x.as_py()) for x in batch.column(3)], pa.int64())
        yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(3)), crc], ["doc_id", "start", "n_tokens", "ids_crc32"])
