"""I-Match fingerprints with randomised lexicons.

Terms are kept when their document frequency lies in a chosen band. A fingerprint holds one hash for each of several
lexicon subsets: the distinct kept terms that fall into a randomised subset are sorted and hashed together. Subsets are
drawn at several densities, so that short and long texts both have subsets with few of their terms; a change of some
terms then leaves the hashes of the other subsets alone.

The lexicon of kept terms is bounded whatever the size of the corpus: a term in at least a share ``low`` of the
documents, and documents of d distinct terms on average, give at most d / low terms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import mixed, raw_texts, slices, words_of

#: Document-frequency band of the lexicon, as shares of all documents: idf between log(1/high) and log(1/low).
LOW, HIGH = 0.0005, 0.2
#: Densities 2**-1 .. 2**-LEVELS with SUBSETS lexicon subsets each; a text with more terms has more levels.
LEVELS, SUBSETS = 10, 16
#: A subset with more members than this on average says nothing after an edit and is left out.
DENSEST = 2
#: Levels that every text has beyond its densest one in use, so that texts of similar length share some.
SPARSER = 3


class WordHashes(dict[bytes, int]):
    """Word to hash; a word not met before is hashed and remembered."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value


class Hasher:
    """Word hashes of a worker, remembered for words met before."""

    def __init__(self, most: int = 300_000) -> None:
        self.known = WordHashes()
        self.most = most

    def distinct(self, text: bytes | None) -> np.ndarray:
        """Sorted hashes of the distinct words of a text."""
        if len(self.known) > self.most:
            self.known.clear()
        words = set(words_of(text))
        hashes = np.fromiter(map(self.known.__getitem__, words), np.uint64, len(words))
        hashes.sort()
        return hashes[np.append(True, hashes[1:] != hashes[:-1])] if len(hashes) else hashes


def document_frequencies(docs: DataFrame, text: str = "text") -> DataFrame:
    """term (64-bit hash) and the number of documents that hold it; every task adds up its own counts first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        waiting: list[np.ndarray] = []
        size = 0

        def flush() -> pa.RecordBatch:
            terms, counts = np.unique(np.concatenate(waiting), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array(terms.view(np.int64)), pa.array(counts.astype(np.int64))], names=["term", "n"])

        for batch in batches:
            for t in raw_texts(batch.column("_text")):
                waiting.append(hasher.distinct(t))
                size += len(waiting[-1])
                if size > 2_000_000:
                    yield flush()
                    waiting, size = [], 0
        if size:
            yield flush()

    counted = docs.select(F.col(text).alias("_text")).mapInArrow(run, "term long, n long")
    return counted.groupBy("term").agg(F.sum("n").alias("n_docs"))


def lexicon(docs: DataFrame, low: float = LOW, high: float = HIGH, text: str = "text") -> np.ndarray:
    """Sorted hashes of the terms within the band, from all documents.

    No term of the band is left out; the band bounds the lexicon (8 bytes a term). The band always holds terms of at least one document, so tiny corpora keep theirs.
    """
    total = docs.count()
    counts = document_frequencies(docs, text).where((F.col("n_docs") <= max(1.0, high * total)) & (F.col("n_docs") >= low * total))
    got = counts.select("term").toArrow().column(0)
    return np.sort(got.to_numpy().astype(np.int64).view(np.uint64))


class Fingerprinter:
    """Fingerprints of texts for one lexicon."""

    def __init__(self, terms: np.ndarray, levels: int = LEVELS, subsets: int = SUBSETS) -> None:
        self.terms, self.levels, self.subsets = terms, levels, subsets
        self.salts = mixed(np.arange(1, subsets + 1, dtype=np.uint64))
        self.hasher = Hasher()

    def fingerprint(self, text: bytes | None) -> np.ndarray:
        """levels x subsets 32-bit hashes, 0 for a subset without terms, after 32 bits of a hash of the whole text.

        A text without lexicon terms uses all its distinct words. The first value is of the text as it stands, so that
        different texts without words differ too. The number of levels follows the number of terms.
        """
        kept = self.hasher.distinct(text)
        if len(self.terms):
            at = np.searchsorted(self.terms, kept).clip(max=len(self.terms) - 1)
            inside = kept[self.terms[at] == kept]
            kept = inside if len(inside) else kept
        densest = 1
        while len(kept) >> densest > DENSEST:
            densest += 1
        levels = max(self.levels, densest + SPARSER)
        out = np.zeros(1 + levels * self.subsets, np.uint32)
        out[0] = int.from_bytes(hashlib.blake2b(text or b"", digest_size=4).digest(), "little")
        if not len(kept):
            return out
        drawn = mixed(kept[None, :] ^ self.salts[:, None])
        # A term with z trailing zero bits lies in the subsets of density 2**-1 .. 2**-z. Members of the densest level
        # in use hold those of all sparser ones, so the matrix is searched once.
        rows, columns = np.nonzero((drawn & np.uint64((1 << densest) - 1)) == 0)
        members: dict[int, list[bytes]] = {}
        # The kept hashes are sorted, so each subset's members are joined and hashed in that order.
        for row, bits, term in zip(rows.tolist(), drawn[rows, columns].tolist(), kept[columns].tolist(), strict=True):
            zeros = min(levels, (bits & -bits).bit_length() - 1 if bits else 64)
            packed = term.to_bytes(8, "little")
            for level in range(densest, zeros + 1):
                members.setdefault(1 + (level - 1) * self.subsets + row, []).append(packed)
        for place, terms in members.items():
            out[place] = int.from_bytes(hashlib.blake2b(b"".join(terms), digest_size=4).digest(), "little") or 1
        return out

    def likeness(self, a: np.ndarray, b: np.ndarray) -> float:
        """1 for equal fingerprints; else the share of equal hashes among the subsets in use, at densities that leave some unused.

        Only levels that both have are compared.
        """
        if np.array_equal(a, b):
            return 1.0
        upto = min(len(a), len(b))
        x, y = a[1:upto].reshape(-1, self.subsets), b[1:upto].reshape(-1, self.subsets)
        used = ((x > 0) | (y > 0)).sum(1)
        same = ((x > 0) & (x == y)).sum(1)
        fit = (used > 0) & (used <= 0.7 * self.subsets)
        if not fit.any():
            fit = used > 0
        return float(same[fit].sum() / max(1, used[fit].sum()))


def _in_order(docs: DataFrame, text: str, pieces: int) -> DataFrame:
    """``_piece``, doc_id, text in tasks by descending id, each with one more row: the first of the next piece.

    Pieces are ranges of ids between approximate quantiles, and ranges of a text hash among null ids. After the last
    row the first of all follows.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text")).withColumn("_h", F.xxhash64(F.coalesce("_text", F.lit(""))))
    cuts = sorted(set(base.stat.approxQuantile("doc_id", [i / pieces for i in range(1, pieces)], 0.25 / pieces))) if pieces > 1 else []
    # Ids above a cut belong to earlier pieces; null ids come last.
    above = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cuts]), lambda c: c >= F.col("doc_id"))) if cuts else F.lit(0)
    piece = F.when(F.col("doc_id").isNull(), F.lit(len(cuts) + 33) + F.shiftright("_h", 58)).otherwise(above)
    placed = base.withColumn("_piece", piece.cast("int"))
    rank = F.struct(F.col("doc_id").isNull().alias("none"), (-F.col("doc_id")).alias("down"), "_h")
    firsts = placed.groupBy("_piece").agg(F.min(rank).alias("r"))
    # One row for each piece, so both windows and the broadcast are bounded by the number of pieces.
    before = F.lag("_piece").over(Window.orderBy("_piece"))
    last = F.max("_piece").over(Window.partitionBy(F.lit(0)))
    firsts = firsts.select(F.coalesce(before, last).alias("_to"), (-F.col("r.down")).alias("_id"), F.col("r._h").alias("_hash"))
    rows = placed.join(F.broadcast(firsts), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_h") == F.col("_hash")))
    halo = rows.select(F.col("_to").alias("_piece"), "doc_id", "_text", "_h", F.lit(True).alias("_halo")).dropDuplicates(["_piece"])
    both = placed.select("_piece", "doc_id", "_text", "_h", F.lit(False).alias("_halo")).unionByName(halo)
    return both.repartition("_piece").sortWithinPartitions("_piece", "_halo", F.desc_nulls_last("doc_id"), "_h", "_text")


def fingerprints(
    docs: DataFrame, low: float = LOW, high: float = HIGH, text: str = "text", pieces: int | None = None
) -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text replaces the last third of the code points by the first as many (or all) of the next document, in
    descending order of doc_id; equal ids are ordered by a hash of the text, null ids come last, and after the last the first
    follows. Null counts as empty. A single document is its own next one. An empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(lexicon(docs, low, high, text))
    if pieces is None:
        pieces = min(10_000, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    ordered = _in_order(docs, text, pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker = Fingerprinter(shared.value)
        before: tuple | None = None
        rows: list[tuple] = []
        for whole in batches:
            for batch in slices(whole, "_text"):
                for piece, doc, raw, halo in zip(batch.column("_piece").to_pylist(), batch.column("doc_id").to_pylist(), raw_texts(batch.column("_text")), batch.column("_halo").to_pylist(), strict=True):
                    value = raw or b""
                    print_ = maker.fingerprint(value)
                    if before and before[0] == piece:
                        rows.append(_row(maker, before, value, print_))
                    before = None if halo else (piece, doc, value, print_)
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows, strict=True)], schema=_SCHEMA)
                    rows = []

    return ordered.mapInArrow(run, _TYPE)


_TYPE = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)
_SCHEMA = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
])


def _row(maker: Fingerprinter, own: tuple, follower: bytes, next_print: np.ndarray) -> tuple:
    _, doc, raw, print_ = own
    chars = raw.decode()
    cut = len(chars) // 3
    edited = (chars[: len(chars) - cut] + follower.decode()[:cut]).encode()
    changed = maker.fingerprint(edited)
    return (
        doc, len(chars), hashlib.sha256(edited).hexdigest(), print_.tobytes().hex(), changed.tobytes().hex(),
        maker.likeness(print_, changed), maker.likeness(print_, next_print),
    )
