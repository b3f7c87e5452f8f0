"""N-gram Jaccard join by T-occurrence search.

A document's set holds the hashes of its distinct k-word shingles. Documents with equal sets are one node.
Two nodes are linked when their sets reach the similarity; a link needs T common shingles, so under any
one order of shingles the first n - T + l of each set hold at least l in common. The order puts shingles
that are frequent everywhere last (a bounded list, from counts over all documents) and is else by hash.

1. Inverted lists over those first parts: a posting is 32 bits of the shingle (more are in its bucket), 40 of the
   node, its l and the class of its size, 11 bytes whatever the number of buckets. Lists of up to ``SHORT`` nodes
   give pairs with the number of shared shingles; pairs below l are dropped. Longer lists give a group. A node stays
   in one only if it could share l shingles with another of about its size there: with all its long lists, and the
   most that it shares with any node in short ones. So what many documents quote makes no groups of those that
   have nothing else in common.
2. Pairs and long lists become groups of nodes. A large group is cut into blocks of nodes of like size; only
   blocks whose sizes can reach the similarity are paired.
3. In each group every node searches its inverted lists as DivideSkip does: of n lists the T - 1 longest are set
   aside, the short ones are merged (as sorted runs) and counted, and a candidate is probed in the long ones by
   binary search. A candidate already connected to the node within the group is not probed again.
4. Connected components of the links found; the smallest doc_id names a component.

Every pair that could reach the similarity meets in at least one group, so no connection is lost. Where two
shingles of one set share their posting's bits, l is less by one; nodes that share theirs are taken together until
their whole sets are compared. Keys
that many rows share (a node of many exact copies, the centre of a large component) are summed up before they are
shuffled and, where they are joined, sent to every task (``join_split``).

Defined results: fewer words than k make one shingle; no word or no text makes an empty set, linked with
nothing; repeated rows and equal texts share a node, so they are linked; a null doc_id counts in sizes but
names no component if another is there; other columns, whatever their names, are not read; an empty table
gives no rows. Shingles have 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import drop_table, join_split, partitions, release, sifted, write_table
from .text import U, flat, give_back, mix, ranges, row_windows, slices, window_hashes, word_bounds, word_hashes

SHORT, BLOCK, BLOCK_SHINGLES, HOT_IN_BATCH, HOT_MOST = 32, 1024, 1 << 20, 4, 1 << 18
STEPS, BLOCKS_A_CLASS = 3, 1 << 20  # size classes in a step of the similarity; numbers of blocks kept apart by class
HELD_PAIRS, HELD_SHINGLES, COUNTED_SHINGLES = 1 << 19, 1 << 20, 1 << 22
PLUS = 8  # l is one in so many shingles


def shingle_sets(texts: pa.Array, k: int) -> Iterator[tuple[int, np.ndarray]]:
    """Row and its sorted distinct shingle hashes; A-Z count as a-z."""
    data, offsets = flat(texts)
    for a, b in slices(offsets):
        part, off = data[offsets[a] : offsets[b]].copy(), offsets[a : b + 1] - offsets[a]
        part[(part >= 65) & (part <= 90)] |= 32
        starts, ends, first = word_bounds(part, off)
        words = word_hashes(part, starts, ends)
        windows = window_hashes(words, k)
        at, count = row_windows(first, k)
        for r in range(b - a):
            if count[r]:
                yield a + r, np.unique(windows[at[r] : at[r] + count[r]])
            else:
                yield a + r, window_hashes(words[first[r] : first[r + 1]], max(1, int(first[r + 1] - first[r])))


def set_id(s: np.ndarray) -> int:
    return int.from_bytes(hashlib.blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(n, percent: int):
    """Shingles that a set of n shares at least with any linked to it."""
    return -(-percent * n // 100)


def overlap_needed(n, m, percent: int):
    """The smallest c with 100 c >= percent (n + m - c)."""
    return -(-percent * (n + m) // (100 + percent))


def first_part(s: np.ndarray, hot: np.ndarray, percent: int) -> tuple[np.ndarray, int]:
    """The set's first shingles in the common order and the l that they warrant."""
    n = len(s)
    spare = n - int(least_overlap(n, percent))
    if len(hot):
        at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
        common = hot[at] == s
        s = np.concatenate([s[~common], s[common]])
        rare = n - int(common.sum())
    else:
        rare = n
    more = min(1 + n // PLUS, n - spare)
    if spare + more > rare:
        more = max(1, rare - spare)
    return s[: spare + more], more


def described(docs: DataFrame, k: int) -> DataFrame:
    """Rows of documents (doc_id, key, n, node), and counts of shingles (h, times) that occur in at least ``HOT_IN_BATCH``
    of some ``COUNTED_SHINGLES`` shingles' sets."""
    names = ["doc_id", "key", "n", "node", "h", "times"]

    def often(sets):
        h = np.concatenate(sets)
        h.sort()
        start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
        times = np.diff(np.append(start, len(h)))
        keep = times >= HOT_IN_BATCH
        none = pa.nulls(int(keep.sum()), pa.int64())
        return pa.RecordBatch.from_arrays([none] * 4 + [pa.array(h[start[keep]].view(np.int64)), pa.array(times[keep])], names)

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, node, seen, sets, held = [], [], set(), [], 0
            for _, s in shingle_sets(batch.column(1), k):
                i = set_id(s) if len(s) else None
                n.append(len(s))
                node.append(i)
                if i is not None and i not in seen:
                    seen.add(i)
                    sets.append(s)
                    held += len(s)
                if held > COUNTED_SHINGLES:
                    yield often(sets)
                    sets, held = [], 0
            if sets:
                yield often(sets)
            none = pa.nulls(len(n), pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(2), pa.array(n, pa.int64()), pa.array(node, pa.int64()), none, none], names)
        give_back()

    return docs.mapInArrow(describe, ", ".join(f"{c} long" for c in names))


def frequent(counts: DataFrame) -> np.ndarray:
    """The ``HOT_MOST`` most frequent of the counted shingles. They only shape the common order; any list gives the same links."""
    total = counts.groupBy("h").agg(F.sum("times").alias("times"))
    top = total.orderBy(F.desc("times"), "h").limit(HOT_MOST).select("h").toArrow().column(0).to_numpy()
    return np.sort(top.astype(np.int64).view(U))


def class_width(percent: int) -> float:
    return float(np.log(max(100 / percent, 1.05) * (1 + 1e-9)))


def size_class(n, percent: int):
    """Sizes that can reach the similarity are at most ``STEPS`` classes apart."""
    return np.minimum(np.floor(np.log(np.maximum(n, 1)) * STEPS / class_width(percent)), 255).astype(np.uint8)


def _postings(sets: list[tuple[int, int, int, np.ndarray]], buckets: int, percent: int) -> Iterator[tuple[int, bytes]]:
    """Postings of a batch's sets, packed by bucket."""
    ids, size, more = (np.array([x[i] for x in sets], np.int64) for i in range(3))
    h = np.concatenate([x[3] for x in sets])
    who = np.repeat(np.arange(len(sets)), [len(x[3]) for x in sets])
    bucket, short = (h & U(0xFFFFFFFF)) % U(buckets), (h >> U(32)).astype("<u4")
    same = mix(who.astype(U), 5) ^ (short.astype(U) * U(buckets) + bucket)
    if (np.diff(np.sort(same)) == 0).any():  # two shingles of a set (or of two sets, which costs no link) look alike
        order = np.argsort(same, kind="stable")
        np.subtract.at(more, who[order[1:][same[order[1:]] == same[order[:-1]]]], 1)
    of_node = np.empty((len(sets), 7), np.uint8)  # 40 bits of the node, l, class
    of_node[:, :5] = ids.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :5]
    of_node[:, 5], of_node[:, 6] = np.clip(more, 1, 255), size_class(size, percent)
    order = np.argsort(bucket, kind="stable")
    cut = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=U))
    for b in range(buckets):
        at = order[cut[b] : cut[b + 1]]
        if len(at):
            yield b, short[at].tobytes() + of_node[who[at]].tobytes()


def _unpacked(blocks: list[bytes]) -> tuple[np.ndarray, ...]:
    """Shingles, nodes, l and classes."""
    short, of_node = [], []
    for raw in blocks:
        n = len(raw) // 11
        short.append(np.frombuffer(raw, "<u4", n))
        of_node.append(np.frombuffer(raw, np.uint8, 7 * n, 4 * n).reshape(n, 7))
    of_node = np.concatenate(of_node)
    ids = np.zeros((len(of_node), 8), np.uint8)
    ids[:, :5] = of_node[:, :5]
    return np.concatenate(short), ids.view("<i8").reshape(-1).astype(np.int64), of_node[:, 5].copy(), of_node[:, 6].copy()


def candidates(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """From the lists of a partition: pairs with their shared shingles and l, packed by bucket, and rows of nodes a in
    the group b of long lists: how many of its lists they are in, and their l."""
    blocks = [x.as_py() for batch in batches for x in batch.column(0)]
    if not blocks:
        return
    h, ids, own_l, own_kind = _unpacked(blocks)
    del blocks
    nodes, node = np.unique(ids, return_inverse=True)
    node = node.astype(np.int32)
    l, small, large = np.full(len(nodes), 255, np.int16), np.full(len(nodes), 255, np.int16), np.zeros(len(nodes), np.int16)
    for held, take, values in ((l, np.minimum, own_l), (small, np.minimum, own_kind), (large, np.maximum, own_kind)):
        take.at(held, node, values.astype(np.int16))
    l = l.astype(np.int64)
    del ids, own_l, own_kind
    order = np.lexsort((node, h))
    h, node = h[order], node[order]
    keep = np.ones(len(h), bool)
    keep[1:] = (h[1:] != h[:-1]) | (node[1:] != node[:-1])
    h, node = h[keep], node[keep]
    start = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    count = np.diff(np.append(start, len(h)))
    pairs, shared = np.zeros(0, np.int64), np.zeros(0, np.int64)
    held, heap = 0, []

    for f in range(2, SHORT + 1):
        at = start[count == f]
        i, j = np.triu_indices(f, 1)
        for c in range(0, len(at), max(1, HELD_PAIRS // len(i))):
            block = node[at[c : c + max(1, HELD_PAIRS // len(i)), None] + np.arange(f)]
            a, b = block[:, i].reshape(-1), block[:, j].reshape(-1)
            near = (small[a] - large[b] <= STEPS) & (small[b] - large[a] <= STEPS)
            key, c_ = np.unique(a[near].astype(np.int64) * len(nodes) + b[near], return_counts=True)
            heap.append((key, c_))
            held += len(key)
            if held > HELD_PAIRS:
                heap, held = _folded(heap), 0
    if heap:
        pairs, shared = _folded(heap)[0]
    names = ["a", "b", "n", "l", "bucket", "block"]
    if len(pairs):
        a, b = pairs // len(nodes), pairs % len(nodes)
        x, y = nodes[a], nodes[b]
        whole = np.stack([np.minimum(x, y), np.maximum(x, y), shared, np.minimum(l[a], l[b])])
        place = mix(whole[0].astype(U) * U(3) + whole[1].astype(U), 1) % U(buckets)
        order = np.argsort(place, kind="stable")
        cut = np.searchsorted(place[order], np.arange(buckets + 1, dtype=U))
        blocks = [(k, whole[:, own].tobytes()) for k in range(buckets) if len(own := order[cut[k] : cut[k + 1]])]
        none = pa.nulls(len(blocks), pa.int64())
        yield pa.RecordBatch.from_arrays([none] * 4 + [pa.array([k for k, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())], names)
    long = np.flatnonzero(count > SHORT)
    if len(long):
        own = np.repeat(node[start[long]].astype(np.int64), count[long]) * len(nodes) + node[ranges(start[long], count[long])]
        own, times = np.unique(own, return_counts=True)
        group, member = own // len(nodes), own % len(nodes)
        none = len(own)
        yield pa.RecordBatch.from_arrays([pa.array(nodes[member]), pa.array(nodes[group]), pa.array(times), pa.array(l[member]), pa.nulls(none, pa.int32()), pa.nulls(none, pa.binary())], names)
    del h, node, pairs, shared, heap
    give_back()


def close_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose shared shingles over all lists reach their l; and for every node, without b, the most that it shares
    with another here."""
    blocks = [np.frombuffer(x.as_py(), np.int64).reshape(4, -1) for batch in batches for x in batch.column(0)]
    if not blocks:
        return
    a, b, n, l = np.concatenate(blocks, axis=1)
    order = np.lexsort((b, a))
    a, b, n, l = a[order], b[order], n[order], l[order]
    start = np.flatnonzero(np.concatenate([[True], (a[1:] != a[:-1]) | (b[1:] != b[:-1])]))
    a, b, n, l = a[start], b[start], np.add.reduceat(n, start), np.maximum.reduceat(l, start)
    keep = np.flatnonzero(n >= l)
    for i in range(0, len(keep), 1 << 17):
        own = keep[i : i + (1 << 17)]
        yield pa.RecordBatch.from_arrays([pa.array(a[own]), pa.array(b[own]), pa.nulls(len(own), pa.int64())], ["a", "b", "most"])
    nodes, back = np.unique(np.concatenate([a, b]), return_inverse=True)
    most = np.zeros(len(nodes), np.int64)
    np.maximum.at(most, back, np.concatenate([n, n]))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.nulls(len(nodes), pa.int64()), pa.array(most)], ["a", "b", "most"])


def _folded(heap: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    key, back = np.unique(np.concatenate([x for x, _ in heap]), return_inverse=True)
    return [(key, np.bincount(back, np.concatenate([y for _, y in heap]), minlength=len(key)).astype(np.int64))]


def search_links(sets: list[np.ndarray], percent: int, split: int | None = None) -> list[tuple[int, int]]:
    """Links that connect the sets of a group as all its links do. With ``split``, only links between the
    first ``split`` sets and the others."""
    m = len(sets)
    sizes = np.array([len(s) for s in sets])
    flat_, owner = np.concatenate(sets), np.repeat(np.arange(m), sizes)
    indexed = np.arange(len(flat_)) if split is None else np.flatnonzero(owner < split)
    order = indexed[np.argsort(flat_[indexed], kind="stable")]
    keys, start, length = np.unique(flat_[order], return_index=True, return_counts=True)
    lists = owner[order].astype(np.int32)  # each list ascending
    place = np.repeat(np.arange(len(keys)), length) * m + lists  # ascending over all lists
    root = np.arange(m)

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x in range(split or 0, m):
        own = sets[x]
        at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        at = at[keys[at] == own]
        need = int(least_overlap(len(own), percent))
        if len(at) < need:
            continue
        by = at[np.argsort(length[at], kind="stable")]
        short, aside = by[: len(by) - need + 1], by[len(by) - need + 1 :]  # at most T - 1 lists set aside
        merged = np.sort(np.concatenate([lists[start[i] : start[i] + length[i]] for i in short]), kind="stable")
        if split is None:
            merged = merged[: np.searchsorted(merged, x)]
        if not len(merged):
            continue
        begin = np.flatnonzero(np.concatenate([[True], merged[1:] != merged[:-1]]))
        close, count = merged[begin].astype(np.int64), np.diff(np.append(begin, len(merged)))
        wanted = overlap_needed(sizes[close], len(own), percent)
        ok = (count + len(aside) >= wanted) & (100 * np.minimum(sizes[close], len(own)) >= percent * np.maximum(sizes[close], len(own)))
        close, count, wanted = close[ok], count[ok], wanted[ok]
        for i in np.argsort(-count, kind="stable"):
            y = int(close[i])
            if find(y) == find(x):
                continue
            probe = aside * m + y
            found = np.minimum(np.searchsorted(place, probe), len(place) - 1)
            if count[i] + int((place[found] == probe).sum()) >= wanted[i]:
                a, b = find(x), find(y)
                root[max(a, b)] = min(a, b)
                out.append((y, x))
    return out


def _in_long_lists(found: DataFrame, told: DataFrame) -> DataFrame:
    """``bits, g, l, could``: nodes in groups of long lists, their l, and the most shingles that they could share: all their
    long lists, and the most that they share with one node in short lists."""
    rows = found.filter("bucket is null").select(F.col("a").alias("bits"), F.col("b").alias("g"), "n", "l")
    long = rows.groupBy("bits").agg(F.sum("n").alias("long"), F.min("l").alias("l"))
    short = told.filter("b is null").groupBy(F.col("a").alias("bits")).agg(F.max("most").alias("most"))
    could = long.join(short, "bits", "left").select("bits", "l", (F.col("long") + F.coalesce("most", F.lit(0))).alias("could"))
    return rows.select("bits", "g").distinct().join(could, "bits")


def _able(rows: DataFrame) -> DataFrame:
    """Those that could share as many shingles as the least l, their own or that of any node of about their size in the group."""
    least = rows.groupBy("g", "class").agg(F.min("l").alias("l")).groupBy("g").agg(F.collect_list(F.struct("class", "l")).alias("parts"))
    there = F.array_min(F.transform(F.filter("parts", lambda p: F.abs(p["class"] - F.col("class")) <= STEPS), lambda p: p["l"]))
    return rows.join(least, "g").filter(F.col("could") >= there).drop("parts", "could", "l")


def _tasks(member: DataFrame) -> DataFrame:
    """``node, key, tasks`` of members (g, node, key, n, class): a group of at most ``BLOCK`` nodes is one task, a larger one
    a task for each two blocks of it whose size classes can meet."""
    kinds = member.groupBy("g", "class").agg(F.count("*").alias("nodes"), F.sum("n").alias("shingles"))
    blocks = F.greatest(F.ceil(F.col("nodes") / BLOCK), F.ceil(F.col("shingles") / BLOCK_SHINGLES)).cast("long")
    part = F.struct(F.col("class").alias("c"), blocks.alias("blocks"))
    group = kinds.groupBy("g").agg((F.sum("nodes") > BLOCK).alias("many"), (F.sum("shingles") > BLOCK_SHINGLES).alias("long"), F.collect_list(part).alias("parts"))
    group = group.select("g", F.when(F.col("many") | F.col("long"), F.col("parts")).alias("parts"))
    near = F.filter("parts", lambda p: F.abs(p["c"] - F.col("class")) <= STEPS)
    others = F.flatten(F.transform(near, lambda p: F.transform(F.sequence(F.lit(0).cast("long"), p["blocks"] - 1), lambda i: p["c"] * BLOCKS_A_CLASS + i)))
    mine = F.filter("parts", lambda p: p["c"] == F.col("class"))[0]["blocks"]
    own = F.when(F.col("parts").isNull(), F.lit(0)).otherwise(F.col("class") * BLOCKS_A_CLASS + F.pmod(F.xxhash64("node"), mine)).cast("long")
    cut = member.join(group, "g").select("g", "node", "key", own.alias("own"), F.explode(F.when(F.col("parts").isNull(), F.array(F.lit(0).cast("long"))).otherwise(others)).alias("other"))
    task = F.struct("g", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own")
    return cut.groupBy("node", "key").agg(F.collect_list(task).alias("tasks"))


def similar_components(docs: DataFrame, percent: int = 75, k: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row a row of ``docs``."""
    spark = docs.sparkSession
    buckets = 2 * partitions(spark)
    docs = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("key"))
    seen = write_table(described(docs, k), "similar-docs")
    base = seen.filter("key is not null").select("doc_id", "key", "n", "node")
    hot = spark.sparkContext.broadcast(frequent(seen.filter("h is not null").select("h", "times")))

    def postings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Packed postings of each batch's distinct sets."""

        def packed(sets):
            blocks = list(_postings(sets, buckets, percent))
            return pa.RecordBatch.from_arrays([pa.array([b for b, _ in blocks], pa.int32()), pa.array([x for _, x in blocks], pa.binary())], ["bucket", "block"])

        for batch in batches:
            done, sets, held = set(), [], 0
            for _, s in shingle_sets(batch.column(0), k):
                if len(s) and (i := set_id(s)) not in done:
                    done.add(i)
                    part, more = first_part(s, hot.value, percent)
                    sets.append((i, len(s), more, part.copy()))
                    held += len(part)
                if held > HELD_SHINGLES:
                    yield packed(sets)
                    sets, held = [], 0
            if sets:
                yield packed(sets)
        give_back()

    lists = docs.select("text").mapInArrow(postings, "bucket int, block binary").repartition(buckets, "bucket").select("block")
    found = write_table(lists.mapInArrow(lambda it: candidates(it, buckets), "a long, b long, n long, l long, bucket int, block binary"), "similar-found")
    release(spark)

    pairs = found.filter("bucket is not null").select("bucket", "block").repartition(buckets, "bucket").select("block")
    told = write_table(pairs.mapInArrow(close_pairs, "a long, b long, most long"), "similar-pairs")
    pairs = told.filter("b is not null").select("a", "b")
    least = pairs.groupBy("b").agg(F.min("a").alias("m")).select(F.col("b").alias("x"), "m")
    led = pairs.join(least.withColumnRenamed("x", "a").withColumnRenamed("m", "ma"), "a", "left").join(least.withColumnRenamed("x", "b").withColumnRenamed("m", "mb"), "b")
    group = F.least(F.coalesce("ma", "a"), "mb")
    close = led.select(F.col("a").alias("bits"), group.alias("g")).unionByName(led.select(F.col("b").alias("bits"), group.alias("g"))).distinct()
    # A node is named by its smallest doc_id, or after all those by its own hash.
    name = F.struct(F.col("doc_id").isNull().alias("unnamed"), F.coalesce("doc_id", "node").alias("id"))
    first = base.filter("node is not null").groupBy("node").agg(F.min(name).alias("name"), F.min("key").alias("key"), F.min("n").alias("n"), F.count("*").alias("rows"))
    kind = F.floor(F.log(F.greatest("n", F.lit(1))) * STEPS / class_width(percent)).cast("long")
    # nodes that are alike in 40 bits are told apart again here
    nodes = first.select("node", "name", "key", "n", kind.alias("class"), F.col("node").bitwiseAND((1 << 40) - 1).alias("bits"))
    member = close.join(nodes, "bits").unionByName(_in_long_lists(found, told).join(nodes, "bits").transform(_able)).drop("bits").distinct()
    member = write_table(member, "similar-groups")
    drop_table(found)
    drop_table(told)
    # distinct groups of equal members but another name cost a search more, no link
    wanted = _tasks(member)

    members = sifted(docs, wanted.select("key"), "key").join(wanted.hint("merge"), "key").select("node", "text", F.explode("tasks").alias("t"))
    members = members.select("t.g", "t.i", "t.j", "t.own", "node", "text").repartition(buckets, "g", "i", "j").sortWithinPartitions("g", "i", "j", "own", "node")
    links = write_table(members.mapInArrow(lambda it: group_links(it, percent, k), "u long, v long"), "similar-links")
    release(spark)

    names = member.select("node", "name").distinct()
    links = links.join(names.toDF("u", "un"), "u").join(names.toDF("v", "vn"), "v").select(F.col("un").alias("u"), F.col("vn").alias("v"))
    joined = components(links, "similar-components").toDF("name", "root")
    drop_table(member)
    named = write_table(first.join(joined, "name", "left").select("node", F.coalesce("root", "name").alias("root"), "rows"), "similar-named")
    full = join_split(base.filter("node is not null").select("doc_id", "n", "node", "key"), named, "node")
    component = F.when(~F.col("root.unnamed"), F.col("root.id"))
    full = full.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("key").alias("text_key"))
    return full.unionByName(base.filter("node is null").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), F.col("key").alias("text_key")))


def group_links(batches: Iterator[pa.RecordBatch], percent: int, k: int) -> Iterator[pa.RecordBatch]:
    """Links of each task (group and pair of blocks), whose rows come one after another."""
    now, nodes, own, sets, u, v = None, [], [], [], [], []

    def close() -> None:
        if len(sets) < 2:
            return
        split = None
        if now[1] != now[2]:
            split = own.count(now[1])
            if split in (0, len(own)):
                return
        for a, b in search_links(sets, percent, split):
            u.append(nodes[a])
            v.append(nodes[b])

    for batch in batches:
        tasks = list(zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True))
        for r, s in shingle_sets(batch.column(5), k):
            g, i, j, o, node = tasks[r]
            if (g, i, j) != now:
                close()
                now, nodes, own, sets = (g, i, j), [], [], []
            if nodes and nodes[-1] == node or set_id(s) != node:
                continue
            nodes.append(node)
            own.append(o)
            sets.append(s)
        if len(u) > 10_000:
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
            u.clear()
            v.clear()
    close()
    sets.clear()
    give_back()
    yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])
