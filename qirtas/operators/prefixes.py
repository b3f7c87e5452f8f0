"""Names matched by their beginnings: by equal prefixes of the lengths that occur, not by comparing every name with every
prefix. A name is looked up once for each length (there are no more than the longest prefix has characters), an equi-join
that Spark broadcasts or shuffles by size and splits where one prefix has very many names.

Defined results: null names and prefixes match nothing; the empty prefix matches every name; a prefix may stand for several
keys; equal names are rows of their own where rows have a key, and one in ``select_targets``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefix_lengths(prefixes: DataFrame, prefix: str) -> list[int]:
    """Lengths that occur, the only thing that the driver learns of the prefixes."""
    found = prefixes.filter(F.col(prefix).isNotNull()).agg(F.collect_set(F.length(prefix)).alias("n")).first()["n"]
    return sorted(found)


def prefix_matches(names: DataFrame, name: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """Rows of ``names`` with each row of ``prefixes`` whose prefix they begin with."""
    lengths = prefix_lengths(prefixes, prefix)
    if not lengths:
        return names.join(prefixes, F.lit(False))
    cut = F.transform(F.filter(F.array(*map(F.lit, lengths)), lambda n: n <= F.length(name)), lambda n: F.substring(F.col(name), F.lit(1), n))
    return names.withColumn("_cut", F.explode(cut)).join(prefixes, F.col("_cut") == F.col(prefix)).drop("_cut")


def longest_prefix(names: DataFrame, key: str, name: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """``key``, and the longest prefix of its name; null where there is none. ``key`` tells rows apart."""
    found = prefix_matches(names.select(key, name), name, prefixes.select(prefix).distinct(), prefix)
    best = found.groupBy(key).agg(F.max_by(prefix, F.length(prefix)).alias(prefix)).select(F.col(key).alias("_key"), prefix)
    return names.select(key).join(best, F.col(key) == F.col("_key"), "left").select(key, prefix)


def same_keys(found: DataFrame, expected: DataFrame, key: str, what: str = "key") -> DataFrame:
    """The rows of ``found``, or an error at run time that names a key of one side which the other lacks. Keys are compared
    on the executors."""
    a, b = found.select(F.col(key).alias("_f")).distinct(), expected.select(F.col(key).alias("_e")).distinct()
    wrong = F.when(F.col("_e").isNull(), F.concat(F.lit(f"surplus {what}: "), F.col("_f").cast("string"))).when(F.col("_f").isNull(), F.concat(F.lit(f"missing {what}: "), F.col("_e").cast("string")))
    checked = a.join(b, F.col("_f") == F.col("_e"), "full").select("_f", "_e", wrong.alias("_wrong"))
    checked = checked.select(F.when(F.col("_wrong").isNotNull(), F.raise_error(F.col("_wrong")).cast(found.schema[key].dataType)).otherwise(F.col("_f")).alias("_key"))
    missing = checked.filter(F.col("_key").isNull()).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in found.schema.fields])
    return found.join(checked, F.col(key) == F.col("_key")).drop("_key").unionByName(missing)


def select_targets(files: DataFrame, name: str, prefixes: DataFrame, prefix: str, key: str) -> DataFrame:
    """``key`` and ``name``: of the files that begin with a key's prefix the last by name without regard to case. An error
    unless every key has one."""
    matches = prefix_matches(files.select(name), name, prefixes.select(prefix, key), prefix)
    last = matches.groupBy(key).agg(F.max(F.struct(F.lower(name).alias("lower"), F.col(name).alias("name"))).alias("f")).select(key, F.col("f.name").alias(name))
    return same_keys(last, prefixes.filter(F.col(key).isNotNull()), key, "target")


def folder_inventory(pages: DataFrame, files: DataFrame, name: str, text: Column, least: int = 1) -> DataFrame:
    """What a folder's files hold: pages, pages with embedded text of at least ``least`` characters, and its characters; files
    without pages count none. ``pages`` has a row a page, ``files`` a row a file."""
    size = F.length(F.btrim(F.coalesce(text, F.lit(""))))
    totals = pages.groupBy(F.col(name).alias("_name")).agg(F.count("*").alias("page_count"), F.sum((size >= least).cast("long")).alias("embedded_pages"), F.sum(size.cast("long")).alias("embedded_chars"))
    none = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return files.join(totals, F.col(name) == F.col("_name"), "left").select(*files.columns, none("page_count"), none("embedded_pages"), none("embedded_chars"))
