"""N-gram Jaccard self-join of documents with Bayesian candidate pruning.

Documents with equal sets of word runs form one class from the start. Classes that share a band of MinHash values are
candidates; inside a unit of candidates MinHash values are compared step by step, and a pair is dropped as soon as the
posterior probability of reaching the similarity falls below the tolerance. What is left is verified exactly.

With 24 bands of 4 values a pair of similarity 0.8 shares no band with probability 3e-6, one of 0.9 with 2e-11. The
tolerance of 1e-7 keeps pairs that are ever so unlikely to reach the similarity.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import halves, packed_texts, raw_texts, slices, store
from eventloom.llm.near import (
    SIMILAR, UNIT_TYPE, WORDS, MinHash, Shingler, band_keys, candidate_units, components, solve_units, unit_batch,
)

BANDS, ROWS = 24, 4
TOLERANCE = 1e-7


def set_table(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",), words: int = WORDS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``keep``, t1, t2 (key of the text), k (key of the set of word runs, null without words), n, bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, minhash = Shingler(words), MinHash(bands * rows)
        for whole in batches:
            for batch in slices(whole, "_text"):
                t1, t2, keys, sizes, found = [], [], [], [], []
                for raw in raw_texts(batch.column("_text")):
                    a, b = halves(xxhash.xxh3_128_digest(raw or b""))
                    hashes = shingler.of_text(raw)
                    t1.append(a), t2.append(b), sizes.append(len(hashes))
                    keys.append(xxhash.xxh3_128_digest(hashes.tobytes()) if len(hashes) else None)
                    found.append(band_keys(minhash.signature(hashes), rows) if len(hashes) else [])
                columns = [pa.array(t1, pa.int64()), pa.array(t2, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[*keep, "t1", "t2", "k", "n", "bands"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema]
    return docs.select(F.col(text).alias("_text"), *keep).mapInArrow(run, ", ".join([*kinds, "t1 long, t2 long, k binary, n long, bands array<long>"]))


def _unit_rows(texts: DataFrame, words: int, size: int) -> DataFrame:
    """Signature and hashes of every wanted set, once for each of its units."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, shingler, minhash = zstandard.ZstdDecompressor(), Shingler(words), MinHash(size)
        for batch in batches:
            out, held = [], 0
            for z, k, units in zip(*[batch.column(c).to_pylist() for c in ("z", "k", "units")], strict=True):
                hashes = shingler.of_text(open_.decompress(z))
                sig, raw = minhash.signature(hashes).tobytes(), hashes.tobytes()
                for u in units:
                    out.append((u["uid"], u["side"], u["alone"], k, sig, raw))
                    held += len(raw) + len(sig)
                    if held > 4 << 20:
                        yield unit_batch(out)
                        out, held = [], 0
            if out:
                yield unit_batch(out)

    return texts.select("z", "k", "units").mapInArrow(run, UNIT_TYPE)


def link_classes(
    docs: DataFrame, similar: float = SIMILAR, words: int = WORDS, text: str = "text", bands: int = BANDS, rows: int = ROWS,
    tolerance: float = TOLERANCE,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(table of documents as in ``set_table``, counts: k, n_links, roots: k, root of linked sets)."""
    table = store(set_table(docs, text, ("doc_id",), words, bands, rows), "word-sets")
    known = table.where("k IS NOT NULL")
    sets = store(known.groupBy("k").agg(F.max("n").alias("n"), F.min(F.struct("t1", "t2")).alias("at")), "distinct-sets")
    units = candidate_units(known.select("k", F.explode("bands").alias("b")).distinct(), sets.select("k", "n"))
    wanted = units.join(sets.select("k", "at.t1", "at.t2"), "k")
    texts = packed_texts(docs, text, []).where("z IS NOT NULL").dropDuplicates(["t1", "t2"])
    found = store(solve_units(_unit_rows(texts.join(wanted, ["t1", "t2"]), words, bands * rows), similar, tolerance), "set-links")
    return table, found.groupBy("k").agg(F.sum("n_links").alias("n_links")), components(found.select("k", "root"))


def jaccard_join(
    docs: DataFrame, similar: float = SIMILAR, words: int = WORDS, text: str = "text", bands: int = BANDS, rows: int = ROWS,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """One row per document: doc_id, class_id, n_links, n_same, n_shingles.

    ``class_id`` is the smallest doc_id of the documents connected by links (null if all of them are null); ``n_links``
    counts the other different sets of word runs that are linked to the document's, ``n_same`` the documents with an
    equal set. A text of fewer words than a run counts as one run. Texts without words (null, empty) have no links and
    are alone: their class is their own id. Repeated rows stay and share a class.
    """
    table, counts, roots = link_classes(docs, similar, words, text, bands, rows, tolerance)
    known = table.where("k IS NOT NULL").groupBy("k").agg(F.count("*").alias("n_same"), F.min("doc_id").alias("first"))
    classed = known.join(counts, "k", "left").join(roots, "k", "left").withColumn("class", F.coalesce("root", "k"))
    classes = classed.groupBy("class").agg(F.min("first").alias("class_id"))
    facts = classed.join(classes, "class").select("k", "class_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), "n_same")
    return table.select("doc_id", "k", "n").join(facts, "k", "left").select(
        "doc_id", F.when(F.col("k").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("n_same", F.lit(1)).cast("long").alias("n_same"),
        F.col("n").alias("n_shingles"),
    )


def one_of_each(docs: DataFrame, similar: float = SIMILAR, words: int = WORDS) -> DataFrame:
    """``docs`` with one row of each class: the smallest doc_id (null last), of equal ids the smallest text key.

    Rows without words are in no class and all stay. Of rows alike in id and text one stays.
    """
    table, _, roots = link_classes(docs, similar, words)
    rank = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "t1", "t2")
    best = table.where("k IS NOT NULL").groupBy("k").agg(F.min(rank).alias("r")).join(roots, "k", "left").groupBy(F.coalesce("root", "k").alias("class")).agg(F.min("r").alias("r"))
    keep = best.select(F.col("r.t1").alias("_1"), F.col("r.t2").alias("_2"), F.col("r.doc_id").alias("_3"))
    every = docs.columns
    names = [c for c in every if c != "text"]
    packed = packed_texts(docs, "text", names)
    at = names.index("doc_id")
    chosen = packed.join(keep, (packed.t1 == keep._1) & (packed.t2 == keep._2) & packed[f"_k{at}"].eqNullSafe(keep._3)).drop("_1", "_2", "_3")
    chosen = chosen.dropDuplicates(["t1", "t2", f"_k{at}"])

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for whole in batches:
            for batch in slices(whole, "z", 1 << 20):
                texts = pa.array([open_.decompress(z).decode() for z in batch.column("z").to_pylist()], pa.string())
                columns = {n: batch.column(f"_k{i}") for i, n in enumerate(names)} | {"text": texts}
                yield pa.RecordBatch.from_arrays([columns[c] for c in every], names=every)

    bare = docs.where(F.col("text").isNull() | ~F.col("text").rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"))
    return chosen.mapInArrow(unpack, docs.schema).unionByName(bare)
