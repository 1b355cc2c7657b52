"""From raw documents to token ids: five filtering and encoding stages over the whole table.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents. The
runner writes each stage's rows as Parquet and reads them again for the next one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import bpe, decontaminate, jaccard_join, suffix_dedup, toxicity
from eventloom.llm.common import store
from eventloom.llm.queries import PATTERN, VOCABULARY

#: Runs of over 50 words that stand in several documents of these corpora have 290 bytes or more in 95 of 100 cases, so
#: this stage looks for shorter strings than the 400 bytes of ``op4``.
REPEAT_BYTES = 250


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below 0.3, by a model learned from the labels that are not held out."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    return toxicity.kept_documents(docs, toxicity.train(docs, labels))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group connected by a similarity of 0.8 or more on runs of five words."""
    return jaccard_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of ``REPEAT_BYTES`` bytes that also start elsewhere; a text of which nothing is left goes."""
    return suffix_dedup.rewrite(docs, REPEAT_BYTES)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no ten-word string of the benchmark occurs."""
    return decontaminate.kept_documents(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of the kept texts, packed as little-endian unsigned 32-bit integers, with the other columns."""
    return bpe.encode(docs, VOCABULARY, PATTERN)


STAGES = [
    ("toxicity", drop_toxic), ("ngram_jaccard_join", drop_near_copies), ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_benchmark), ("byte_bpe", encode),
]

#: Learned scores and merges of byte pairs can't be put into SQL; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents, storing the rows between them."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = store(docs, f"pipeline-{name}")
    return docs
