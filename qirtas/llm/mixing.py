"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

Sources get targets by weight, filled up like vessels: none above ``cap`` times its own size. Each
source is cut into blocks by a hash. A source's target is so many whole passes over its blocks plus a
part of one more pass; that gives an exact number of block draws. A binary tree over the output shards
splits the vector of these numbers: at each node the left half gets a multivariate-hypergeometric draw
of what the node holds, so every shard gets an exact quota of every source, as if all draws had been
shuffled at once. Within a source the shards then take disjoint runs of the permuted blocks of each
pass, and each shard orders its documents by a keyed hash.

Defined results: a null text has size 0; a null source is a source of its own, sorted last; repeated
rows are documents of their own; an empty table gives no rows. Sizes of 0 are never drawn. Other columns, whatever
their names, are passed on as they are. Only the table of sources (one row each) and quotas (sources x shards) reach the driver.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import whole_row, write_table

WORD = r"[^\x20\x09-\x0D]+"
BLOCKS = 4096  # of each source
EDGE_DOCS = 64  # documents at least among which the last, partial block of a pass is chosen
SCHEMA_SOURCE = "src string, weight double, source_size long, target double, passes int, rest double"


def word_count(text) -> F.Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def fill_targets(sizes: list[float], weights: list[float], cap: float) -> list[float]:
    """Share the sum of sizes by weight; what exceeds ``cap`` times a size goes to the others by weight."""
    left, free = float(sum(sizes)), set(range(len(sizes)))
    out = [0.0] * len(sizes)
    while free:
        total = sum(weights[i] for i in free)
        over = [i for i in free if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in free:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(cap * sizes[i])
        left -= sum(out[i] for i in over)
        free.difference_update(over)
    return out


def hypergeometric(rng: np.random.Generator, good: int, bad: int, n: int) -> int:
    """How many of ``n`` drawn without replacement are good: by the distribution function, whose terms follow from one
    another outwards from the most likely value. One rule for populations of any size; terms beyond 12 deviations, which
    double precision does not hold, are left out."""
    low, high, all_ = max(0, n - bad), min(n, good), good + bad
    if low == high:
        return low
    middle = min(max((n + 1) * (good + 1) // (all_ + 2), low), high)
    width = int(12 * (n / all_ * good * (bad / all_) * ((all_ - n) / max(all_ - 1, 1))) ** 0.5) + 64
    a, b = max(low, middle - width), min(high, middle + width)
    k = np.arange(b - a, dtype=float)
    step = np.log((good - a - k) * (n - a - k)) - np.log((a + 1 + k) * (bad - n + a + 1 + k))
    weight = np.concatenate([[0.0], np.cumsum(step)])
    upto = np.cumsum(np.exp(weight - weight.max()))
    return a + min(int(np.searchsorted(upto, rng.random() * upto[-1], "right")), b - a)


def split_quotas(draws: list[int], shards: int, seed: int) -> np.ndarray:
    """Quotas, sources x shards: exact in both directions, by the splitting tree."""
    rng = np.random.default_rng(seed)
    out = np.zeros((len(draws), shards), dtype=np.int64)
    todo = [(0, shards, np.asarray(draws, dtype=np.int64))]
    while todo:
        lo, hi, have = todo.pop()
        if hi - lo == 1:
            out[:, lo] = have
            continue
        mid = (lo + hi) // 2
        n = int(have.sum()) * (mid - lo) // (hi - lo)
        left = np.zeros_like(have)
        remaining, need = int(have.sum()), n
        for i, h in enumerate(have):  # the marginals one after another
            if need and h:
                left[i] = hypergeometric(rng, int(h), remaining - int(h), need)
                need -= int(left[i])
            remaining -= int(h)
        todo += [(mid, hi, have - left), (lo, mid, left)]
    return out


def mix_sources(docs: DataFrame, weights=(5.0, 2.0, 1.0), cap: float = 3.0, shards: int = 64, seed: int = 7, blocks: int = BLOCKS) -> DataFrame:
    """One row a document: ``doc_id, size, source_size, target, taken, draws``.

    ``draws`` lists the shard of each time that the mix takes the document; ``taken`` is the words."""
    spark = docs.sparkSession
    key = F.xxhash64(F.lit(seed), "doc_id", "source", "text")
    rows = docs.select(
        "doc_id",
        F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source")).alias("src"),
        word_count(F.col("text")).alias("size"),
        key.alias("key"),
        F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int").alias("block"),
    )
    rows = write_table(rows, "mix-rows")
    block = rows.groupBy("src", "block").agg(F.sum("size").alias("words"), F.count("*").alias("n"))
    block = write_table(block, "mix-blocks")
    total = sorted(block.groupBy("src").agg(F.sum("words").alias("words"), F.sum((F.col("words") > 0).cast("long")).alias("blocks")).collect(), key=lambda r: (r["src"] == "n", r["src"]))
    sizes = [r["words"] for r in total]
    w = [float(weights[i % len(weights)]) for i in range(len(total))]
    target = fill_targets(sizes, w, cap)
    passes = [min(int(cap), int(t // s)) if s else 0 for t, s in zip(target, sizes, strict=True)]
    source = spark.createDataFrame(
        [(r["src"], x, s, t, p, float(max(0.0, t - p * s))) for r, x, s, t, p in zip(total, w, sizes, target, passes, strict=True)], SCHEMA_SOURCE
    )
    # The blocks of the partial pass: whole while they fit; the one that doesn't, and so many after it
    # that EDGE_DOCS documents stand to choose from, are the edge.
    order = Window.partitionBy("src").orderBy(F.xxhash64(F.lit(seed + 1), "src", "block"), "block")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    b = block.filter("words > 0").join(source, "src")
    b = b.withColumns({"before": F.coalesce(F.sum("words").over(before), F.lit(0)), "rank": F.row_number().over(order)})
    b = b.withColumn("over", (F.col("before") + F.col("words") > F.col("rest")).cast("int"))
    b = b.withColumn("edge_docs", F.coalesce(F.sum(F.col("n") * F.col("over")).over(before), F.lit(0)))
    b = b.withColumn("first_over", F.min(F.when(F.col("over") == 1, F.col("before"))).over(Window.partitionBy("src")))
    state = F.when(F.col("rest") <= 0, 0).when(F.col("over") == 0, 1).when(F.col("edge_docs") < EDGE_DOCS, 2).otherwise(0)
    b = write_table(b.select("src", "block", "rank", "passes", state.alias("state"), (F.col("rest") - F.col("first_over")).alias("limit")), "mix-plan")
    drawn = {r["src"]: r["n"] for r in b.filter("state > 0").groupBy("src").agg(F.count("*").alias("n")).collect()}
    quotas = split_quotas([p * r["blocks"] + drawn.get(r["src"], 0) for p, r in zip(passes, total, strict=True)], shards, seed)
    quota = spark.createDataFrame([(r["src"], [int(x) for x in np.cumsum(q)], r["blocks"]) for r, q in zip(total, quotas, strict=True)], "src string, upto array<long>, blocks long")

    # Each pass permutes the blocks anew; draw number pass * blocks + rank falls into the shard whose run holds it.
    each = b.select("src", "block", "state", "limit", F.explode(F.sequence(F.lit(0), F.col("passes"))).alias("round"), "passes").filter("round < passes or state > 0")
    again = Window.partitionBy("src", "round").orderBy(F.xxhash64(F.lit(seed + 2), "src", "block", "round"), "block")
    each = each.withColumn("at", F.row_number().over(again)).join(quota, "src")
    each = each.withColumn("at", F.col("round") * F.col("blocks") + F.col("at") - 1)
    shard = F.size(F.filter("upto", lambda c: c <= F.col("at")))
    plan = each.groupBy("src", "block").agg(
        F.first("state").alias("state"), F.first("limit").alias("limit"),
        F.array_sort(F.collect_list(F.struct("round", F.least(shard, F.lit(shards - 1)).alias("shard")))).alias("all"), F.first("passes").alias("passes"),
    )
    full = rows.join(plan.hint("shuffle_hash"), ["src", "block"], "left").withColumn("state", F.coalesce("state", F.lit(0)))
    small = Window.partitionBy("src").orderBy("size", "key")
    edge = full.filter("state = 2 and size > 0").withColumn("cum", F.sum("size").over(small.rowsBetween(Window.unboundedPreceding, 0)))
    edge = edge.withColumn("more", F.col("cum") - F.col("size") / 2 <= F.col("limit")).drop("cum")
    rest = full.filter("not (state = 2 and size > 0)").withColumn("more", F.col("state") == 1)
    got = rest.unionByName(edge)
    draws = F.when(F.col("size") > 0, F.coalesce(F.filter("all", lambda x: (x["round"] < F.col("passes")) | F.col("more")), F.array().cast("array<struct<round:int,shard:int>>"))).otherwise(F.array().cast("array<struct<round:int,shard:int>>"))
    out = got.withColumn("draws", draws).join(source.select("src", "source_size", "target"), "src")
    return out.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.size("draws")).alias("taken"), F.transform("draws", lambda x: x["shard"]).alias("draws"), "key", "src"
    )


def mixed_documents(docs: DataFrame, seed: int = 7, shards: int | None = None, **options) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as it is drawn, dealt to its shards and
    shuffled within each. There are as many shards as shuffle partitions, 64 at least. Rows that are equal in every
    column of the key share their draws. The columns travel as one struct, so their names clash with nothing."""
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    shards = shards or max(64, parts)
    chosen = mix_sources(docs, seed=seed, shards=shards, **options)
    once = chosen.groupBy("key").agg(F.max("draws").alias("draws"))
    key = F.xxhash64(F.lit(seed), "doc_id", "source", "text")
    rows = docs.select(key.alias("key"), whole_row(docs).alias("row")).join(once, "key")
    rows = rows.select("key", "row", F.explode("draws").alias("shard"))
    rows = rows.withColumn("order", F.xxhash64(F.lit(seed + 3), "shard", "key")).repartition(shards, "shard").sortWithinPartitions("shard", "order")
    return rows.select("row.*")
