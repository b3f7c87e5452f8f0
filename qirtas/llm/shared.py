"""Working tables in the folder that all executors share, and the release of finished shuffles."""

from __future__ import annotations

import gc
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SIEVE = 26  # a filter of 8 MB
HOT_KEYS, FEW = 10_000, 100  # a key with more rows than the HOT_KEYSth part of all (and than FEW) is hot


def shared_dir(spark: SparkSession) -> str:
    """The cluster's ``spark.checkpoint.dir``. Where it is unset, a folder of our own if everything runs on this machine
    (tests), else an error: executors elsewhere would not see it."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        base = getattr(spark, "_qirtas_shared", None)
        if base is None:
            if not spark.sparkContext.master.startswith("local["):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = "file://" + tempfile.mkdtemp(prefix="qirtas-")
            spark.sparkContext.setCheckpointDir(base)
            spark._qirtas_shared = base
    return base.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def write_table(df: DataFrame, name: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again: cuts the lineage, so a lost
    executor costs a read and not the work before it."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path, compression=codec)
    out = spark.read.schema(df.schema).parquet(path)
    out._qirtas_path = path
    return out


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct, under which their names clash with nothing."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns])


def drop_table(df: DataFrame) -> None:
    """Delete a table of ``write_table`` that no later step reads."""
    path = getattr(df, "_qirtas_path", None)
    if path:
        delete(df.sparkSession, path)


def delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def release(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of DataFrames that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_split(rows: DataFrame, keyed: DataFrame, key: str, count: str = "rows") -> DataFrame:
    """Inner join of many rows with one row a key, whatever share of the rows one key holds. ``keyed`` says how many rows
    each key has (``count``). Keys with more than the ``HOT_KEYS``-th part of all rows, of which there are at most
    ``HOT_KEYS``, go to every task; only the others are shuffled. ``rows`` and ``keyed`` should be tables, as both are
    read twice."""
    total = keyed.agg(F.sum(count)).first()[0] or 0
    most = max(FEW, total // HOT_KEYS)
    hot, cold = F.broadcast(keyed.filter(F.col(count) > most).drop(count)), keyed.filter(F.col(count) <= most).drop(count)
    return rows.join(hot, key).unionByName(rows.join(F.broadcast(keyed.filter(F.col(count) > most).select(key)), key, "left_anti").join(cold, key))


def in_sieve(keys: DataFrame, key: str) -> Column:
    """Whether a row's ``key`` may be among ``keys``, by a filter of fixed size on every task; some others get through, the
    more the more keys there are. For use before a join that shuffles."""
    spark, bits = keys.sparkSession, np.zeros(1 << (SIEVE - 6), np.uint64)
    at = keys.select(F.xxhash64(key).bitwiseAND((1 << SIEVE) - 1).alias("b")).select(F.shiftright("b", 6).alias("w"), F.expr("shiftleft(1L, cast(b & 63 as int))").alias("v"))
    got = at.groupBy("w").agg(F.bit_or("v").alias("v")).toArrow()  # 64 keys and more a row, 2**20 rows at most
    bits[got.column("w").to_numpy()] = got.column("v").to_numpy().view(np.uint64)
    sent = spark.sparkContext.broadcast(bits)
    del got, bits

    @F.pandas_udf("boolean")
    def there(hashed: pd.Series) -> pd.Series:
        b = hashed.to_numpy().astype(np.int64)
        return pd.Series((sent.value[b >> 6] >> (b & 63).astype(np.uint64)) & np.uint64(1) == 1)

    return there(F.xxhash64(key).bitwiseAND((1 << SIEVE) - 1))


def sifted(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return rows.filter(in_sieve(keys, key))


def smallest(rows: DataFrame, group: str, key: str, n: int) -> DataFrame:
    """At most ``n`` keys of each group (``group, key``, one row each), those of the smallest hash, whatever the number of rows
    of a key. Each task keeps its n smallest of a group, so no more than these are shuffled; the final choice keeps n a
    partition before it brings a group together. ``key`` is a whole number."""
    kind, names = rows.schema[group].dataType.simpleString(), [group, key, "_hash"]

    def least(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict = {}
        for batch in batches:
            groups = batch.column(0).dictionary_encode()
            at, keys, hashed = groups.indices.to_numpy(), batch.column(1).to_numpy(), batch.column(2).to_numpy()
            for i, name in enumerate(groups.dictionary):
                own = at == i
                h, k = hashed[own], keys[own]
                if name in held:
                    h, k = np.concatenate([held[name][0], h]), np.concatenate([held[name][1], k])
                one = np.unique(np.stack([h, k]), axis=1)[:, :n]
                held[name] = (one[0], one[1])
        for name, (h, k) in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(h), name.type), pa.array(k), pa.array(h)], names)

    hashed = F.xxhash64(key).bitwiseAND((1 << 62) - 1).alias("_hash")
    known = rows.filter(F.col(group).isNotNull() & F.col(key).isNotNull()).select(group, F.col(key).cast("long").alias(key), hashed)
    few = known.mapInArrow(least, f"`{group}` {kind}, `{key}` long, _hash long").distinct()
    first = Window.partitionBy(group).orderBy("_hash", key)
    return few.withColumn("_n", F.row_number().over(first)).filter(F.col("_n") <= n).select(group, key)
