"""Exact length histogram: documents by encoded length, and suffix sums for every context limit.

One row a length that occurs: how many documents have it, how many are at least as long and their
tokens, the share of documents no longer than it (the length is every quantile up to that share), and
the corpus total if each document were cut to it. The table has at most as many rows as the longest
document has tokens; the running sums go over those rows only, never over documents.

Defined results: a null or empty text has length 0; repeated rows count each; other columns, whatever their names, are not
read; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import encoder


def length_histogram(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``n_tokens, n_docs``; each task adds up its own documents first."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, total = encoder(vocabulary), Counter()
        for batch in batches:
            for _, _, n in enc.column(batch.column(0)):
                total.update(dict(zip(*(x.tolist() for x in np.unique(n, return_counts=True)), strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], ["n_tokens", "n"])

    return docs.select("text").mapInArrow(count, "n_tokens long, n long").groupBy("n_tokens").agg(F.sum("n").alias("n_docs"))


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``n_tokens, n_docs, docs_at_least, tokens_at_least, share_up_to, truncated_total``."""
    hist = length_histogram(docs, vocabulary)
    longer = Window.orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, 0)
    all_rows = Window.orderBy(F.col("n_tokens").desc()).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    tokens = F.col("n_tokens") * F.col("n_docs")
    sums = hist.select(
        "n_tokens", "n_docs", F.sum("n_docs").over(longer).alias("docs_at_least"), F.sum(tokens).over(longer).alias("tokens_at_least"),
        F.sum("n_docs").over(all_rows).alias("docs"), F.sum(tokens).over(all_rows).alias("tokens"),
    )
    return sums.select(
        "n_tokens", "n_docs", "docs_at_least", "tokens_at_least",
        ((F.col("docs") - F.col("docs_at_least") + F.col("n_docs")) / F.col("docs")).alias("share_up_to"),
        (F.col("tokens") - F.col("tokens_at_least") + F.col("n_tokens") * F.col("docs_at_least")).alias("truncated_total"),
    )
