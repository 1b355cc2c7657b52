"""Helpers shared by the operators of this package: words, Arrow columns, stored intermediate tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.session import scratch_path

#: Lower-cases A-Z and turns every byte outside a word into a space. Bytes from 0x80 up belong to words, so the words
#: of a text are those that the pattern ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` finds after lower-casing A-Z.
_WORD_BYTES = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes | None) -> list[bytes]:
    """The lower-cased words of a UTF-8 text in order; none for null."""
    return text.translate(_WORD_BYTES).split() if text else []


def word_places(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of the begins and ends of the words that ``words_of`` gives."""
    inside = np.frombuffer(b" " + text.translate(_WORD_BYTES) + b" ", np.uint8) != 32
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    return edges[::2], edges[1::2]


def raw_texts(column: pa.Array | pa.ChunkedArray) -> list[bytes | None]:
    """A string column as UTF-8 bytes, without decoding."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


def text_first(df: DataFrame, text: str, keep: list[str] | tuple[str, ...]) -> DataFrame:
    """The text as the first column, under a name none of the kept columns has, then ``keep``."""
    name, taken = "_text", {c.lower() for c in keep}
    while name in taken:
        name += "_"
    return df.select(F.col(text).alias(name), *[F.col(f"`{c}`") for c in keep])


def slices(batch: pa.RecordBatch, column: str | int, most_bytes: int = 2 << 20) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch whose ``column`` holds about ``most_bytes`` at most, so that memory follows the text and not the row count."""
    lengths = batch.column(column).cast(pa.large_binary())
    sizes = np.diff(np.frombuffer(lengths.buffers()[1], np.int64)[lengths.offset : lengths.offset + len(lengths) + 1])
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > begin and total + size > most_bytes:
            yield batch.slice(begin, i - begin)
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield batch.slice(begin)


#: Bytes in one Arrow batch on its way to a Python worker, for tables of long texts; Spark's default is 64 MB.
BATCH_BYTES = 4 << 20
#: Shuffle files go when the rows are written, not when the driver happens to collect its garbage.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def small_batches(spark: SparkSession) -> None:
    """From now on Arrow batches of this session hold ``BATCH_BYTES`` at most, so that memory does not follow the row count."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new folder in the shared working folder and continue from the written table."""
    spark: SparkSession = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEAN)
    spark.conf.set(_CLEAN, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(_CLEAN, before)
    return spark.read.schema(df.schema).parquet(path)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit integers (the finaliser of splitmix64)."""
    with np.errstate(over="ignore"):
        x = values ^ (values >> np.uint64(30))
        x = x * np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x = x * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def halves(digest: bytes) -> tuple[int, int]:
    """A 128-bit digest as two signed 64-bit integers."""
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def row_key(doc: object, text: bytes | None) -> tuple[int, int]:
    """128 bits that tell rows apart by id and text."""
    return halves(xxhash.xxh3_128_digest(b"%s|%s" % (str(doc).encode(), text or b"")))


def packed_texts(docs: DataFrame, text: str, keep: list[str], by: str | None = None) -> DataFrame:
    """``keep`` (as _k0, _k1, ...), a key (t1, t2) and the text squeezed (null stays null), so that less is moved.

    The key is of the text alone, or of the kept column ``by`` and the text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=1)
        for whole in batches:
            for batch in slices(whole, "_text"):
                texts = raw_texts(batch.column("_text"))
                if by is None:
                    keys = [halves(xxhash.xxh3_128_digest(t or b"")) for t in texts]
                else:
                    keys = [row_key(d, t) for d, t in zip(batch.column(f"_k{keep.index(by)}").to_pylist(), texts, strict=True)]
                columns = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([None if t is None else squeeze.compress(t) for t in texts], pa.binary())]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[*[f"_k{i}" for i in range(len(keep))], "t1", "t2", "z"])

    source = docs.select(F.col(text).alias("_text"), *[F.col(f"`{c}`").alias(f"_k{i}") for i, c in enumerate(keep)])
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in source.schema.fields[1:]]
    return source.mapInArrow(run, ", ".join([*kinds, "t1 long, t2 long, z binary"]))
