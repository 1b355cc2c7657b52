"""Token counts from an exact length histogram.

Documents are aggregated by encoded length, so what is moved are lengths and counts, never texts. Suffix sums over the
lengths then answer, for every context limit: how many documents fit, how many tokens there are, how many remain when
longer documents are cut to the limit, and which share of documents is no longer than it (quantiles).
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.bpe import read_vocabulary
from eventloom.llm.common import slices, store, text_first

#: Lengths are summed in ranges of this width first, so no task sees all lengths.
RANGE = 1024


@lru_cache(maxsize=2)
def _encoding(key: tuple[bytes, str]) -> tiktoken.Encoding:
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, key[0].splitlines())}
    return tiktoken.Encoding("counts", pat_str=key[1], mergeable_ranks=ranks, special_tokens={})


def token_lengths(df: DataFrame, vocabulary_path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep`` and ``n_tokens`` of every whole text; null counts as empty and has 0 tokens."""
    shared = df.sparkSession.sparkContext.broadcast((read_vocabulary(vocabulary_path), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(shared.value)
        for whole in batches:
            for batch in slices(whole, 0):
                counts = [len(encoding.encode_ordinary(t)) if t else 0 for t in batch.column(0).to_pylist()]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(counts, pa.int64())], names=[*keep, "n_tokens"])

    source = text_first(df, text, keep)
    return source.mapInArrow(run, df.select(*keep, F.lit(0).cast("long").alias("n_tokens")).schema)


def length_histogram(lengths: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """``keys``, n_tokens, n_docs: counted before the shuffle, so a hot key or length costs one row per task."""
    return lengths.groupBy(*keys, "n_tokens").agg(F.count("*").alias("n_docs"))


def context_table(histogram: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """For each key and each length that occurs, read as a context limit, exact answers from suffix sums.

    docs_longer and tokens_longer: of the documents above the limit; docs_total, tokens_total: of all;
    tokens_truncated: tokens kept when every document is cut to the limit; quantile: share of documents not above it.
    Between two lengths that occur the suffix sums are those of the next lower one, so every limit is answered.
    An empty table gives no rows. Null keys form a group of their own.
    """
    tokens = F.col("n_tokens") * F.col("n_docs")
    ranged = histogram.withColumn("_range", F.floor(F.col("n_tokens") / RANGE))
    totals = ranged.groupBy(*keys, "_range").agg(F.sum("n_docs").alias("_d"), F.sum(tokens).alias("_t"))
    # One row per key and range of lengths: at most (longest text / RANGE) rows for a key.
    over = Window.partitionBy(*keys, F.lit(0)).orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys, F.lit(0))
    above = totals.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], F.col("_range").alias("_r"),
        F.coalesce(F.sum("_d").over(over), F.lit(0)).alias("_docs_above"), F.coalesce(F.sum("_t").over(over), F.lit(0)).alias("_tokens_above"),
        F.sum("_d").over(whole).alias("docs_total"), F.sum("_t").over(whole).alias("tokens_total"),
    )
    match = F.col("_range") == F.col("_r")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = Window.partitionBy(*keys, "_range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    longer_d = F.col("_docs_above") + F.coalesce(F.sum("n_docs").over(inside), F.lit(0))
    longer_t = F.col("_tokens_above") + F.coalesce(F.sum(tokens).over(inside), F.lit(0))
    return ranged.join(above, match).select(
        *keys, F.col("n_tokens").alias("context_limit"), "n_docs", longer_d.alias("docs_longer"), longer_t.alias("tokens_longer"),
        "docs_total", "tokens_total",
    ).select(
        *keys, "context_limit", "n_docs", "docs_longer", "tokens_longer", "docs_total", "tokens_total",
        (F.col("tokens_total") - F.col("tokens_longer") + F.col("context_limit") * F.col("docs_longer")).alias("tokens_truncated"),
        ((F.col("docs_total") - F.col("docs_longer")) / F.col("docs_total")).alias("quantile"),
    )


def token_counts(df: DataFrame, vocabulary_path: str, pattern: str, text: str = "text", keys: tuple[str, ...] = ()) -> DataFrame:
    """``context_table`` over the texts of ``df``. The histogram is stored, since two sums read it."""
    histogram = length_histogram(token_lengths(df, vocabulary_path, pattern, text, keys), keys)
    return context_table(store(histogram, "token-lengths"), keys)


def quantiles(contexts: DataFrame, shares: list[float], keys: tuple[str, ...] = ()) -> DataFrame:
    """For each key and share, the smallest length that at least this share of the documents does not exceed."""
    asked = F.explode(F.array(*[F.lit(s) for s in shares])).alias("share")
    return contexts.select(*keys, "context_limit", "quantile", asked).where("quantile >= share").groupBy(*keys, "share").agg(
        F.min("context_limit").alias("length")
    )
