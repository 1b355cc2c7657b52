"""Registered queries of this package: each dealt operator over its whole table, and the SQL where it can be expressed."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from eventloom.llm import bpe, chunk_bpe, collocations, decontaminate, divergence, imatch, jaccard_join, licenses, paragraph_dedup, suffix_dedup, token_counts, toxicity, warc
from eventloom.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
VOCABULARY = public_tokenizers.path("byte_bpe_50k.tiktoken")
PATTERN = public_tokenizers.PATTERN
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    """Every document searched for every ten-word string of the benchmark."""
    found = decontaminate.decontaminate(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))
    return decontaminate.digests(found)


def op2_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded and decoded again."""
    coded = bpe.encode(_table(spark, folder, "documents"), VOCABULARY, PATTERN, keep=["doc_id"])
    return bpe.digests(bpe.decode(coded, VOCABULARY, PATTERN))


def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """One row for each encoded length that occurs, with exact answers for it as a context limit."""
    return token_counts.token_counts(_table(spark, folder, "documents"), VOCABULARY, PATTERN)


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every text without the 400-byte strings that also start anywhere else."""
    return suffix_dedup.digests(suffix_dedup.remove_repeats(_table(spark, folder, "documents")))


def op5_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scored by a model learned from the labels that are not held out."""
    documents = _table(spark, folder, "documents")
    scored = toxicity.score_toxicity(documents, toxicity.train(documents, _table(spark, folder, "labels")))
    return scored.selectExpr(
        "doc_id", "coalesce(crc32(cast(doc_id as string)) % 4 = 2, false) AS held_out", "score",
        "cast(score >= 0.3D as int) AS predicted", "expected AS expected_toxic_words", "cast(size(spans) as long) AS n_spans",
    )


def op6_warc(spark: SparkSession, folder: str) -> DataFrame:
    """Every page written to archives, normalised to one member per record, and read back by offset."""
    planned = warc.plan_records(_table(spark, folder, "pages"))
    return warc.round_trip(planned, scratch_path(spark, "warc"))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    """Class and number of links of every document, at five words and similarity 0.8."""
    return jaccard_join.jaccard_join(_table(spark, folder, "documents"))


def op8_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """Every document scanned for licence phrases and templates."""
    return licenses.digests(licenses.scan_licenses(_table(spark, folder, "documents")))


def op9_imatch(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    return imatch.fingerprints(_table(spark, folder, "documents"))


def op10_paragraph_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every document without the paragraphs and passages that a smaller one has."""
    return paragraph_dedup.digests(paragraph_dedup.remove_repeats(_table(spark, folder, "documents")))


def op11_chunk_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Every text encoded with shared chunks encoded once, and decoded again."""
    coded = chunk_bpe.encode(_table(spark, folder, "documents"), TOKENIZER, keep=["doc_id"])
    return bpe.digests(chunk_bpe.decode(coded, TOKENIZER))


def op12_collocations(spark: SparkSession, folder: str) -> DataFrame:
    """The best phrases of two to four words of every language."""
    return collocations.collocations(_table(spark, folder, "documents"))


def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    """Every source of every language beside the other sources and the whole language."""
    return divergence.divergence(_table(spark, folder, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_decontaminate, op2_byte_bpe, op3_token_counts, op4_suffix_dedup, op5_toxicity, op6_warc, op7_jaccard_join, op8_licenses,
        op9_imatch, op10_paragraph_dedup, op11_chunk_bpe, op12_collocations, op13_source_divergence,
    )
}
SQL: dict[str, str] = {
    "op1_decontaminate": decontaminate.ORACLE, "op6_warc": warc.ORACLE, "op12_collocations": collocations.ORACLE,
    "op13_source_divergence": divergence.ORACLE,
}
