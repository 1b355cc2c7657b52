"""Byte-level BPE encoding and decoding.

A text is split by a pattern; every match is encoded on its own. Matches that are not themselves tokens are merged in
length-bucketed, padded numpy matrices: in each round every row merges its leftmost pair of minimum rank, pairs are
looked up in a hash table, and the row is compacted by one place. Rows without a pair left leave the matrix.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventloom.llm.common import slices, text_first

NO_PAIR = np.int32(2**31 - 1)
#: Matches longer than this many bytes merge with a heap over the same pair table, because one merge per round would
#: cost the square of their length. The ids are the same.
LONGEST_ROW = 512
#: Encoded matches remembered by a Python worker; cleared when full.
REMEMBERED = 100_000


class PairTable:
    """Open-addressed hash table from a pair of token ids to the rank of their concatenation."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        keys, values = [], []
        get = ranks.get
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = get(token[:cut]), get(token[cut:])
                if left is not None and right is not None:
                    keys.append(left << 32 | right)
                    values.append(rank)
        bits = max(4, (2 * len(keys)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), np.uint64((1 << bits) - 1)
        self.keys = np.full(1 << bits, np.uint64(2**64 - 1))
        self.values = np.full(1 << bits, NO_PAIR)
        waiting = np.array(keys, np.uint64)
        found = np.array(values, np.int32)
        place, self.probes = self._home(waiting), 0
        while len(waiting):
            self.probes += 1
            free = self.keys[place] == np.uint64(2**64 - 1)
            self.keys[place[free]] = waiting[free]
            won = self.keys[place] == waiting
            self.values[place[won]] = found[won]
            waiting, found, place = waiting[~won], found[~won], (place[~won] + np.uint64(1)) & self.mask

    def _home(self, keys: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (keys * np.uint64(0x9E3779B97F4A7C15)) >> self.shift

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each concatenated pair; ``NO_PAIR`` where the pair is no token or a side is padding (negative)."""
        keys = (left.astype(np.int64) << 32 | right.astype(np.int64)).view(np.uint64).ravel()
        out = np.full(keys.shape, NO_PAIR)
        open_at = np.flatnonzero((left.ravel() >= 0) & (right.ravel() >= 0))
        place = self._home(keys[open_at])
        for _ in range(self.probes):
            if not len(open_at):
                break
            seen = self.keys[place]
            hit = seen == keys[open_at]
            out[open_at[hit]] = self.values[place[hit]]
            more = ~hit & (seen != np.uint64(2**64 - 1))
            open_at, place = open_at[more], (place[more] + np.uint64(1)) & self.mask
        return out.reshape(left.shape)


class ByteBpe:
    """Encoder and decoder for one vocabulary of byte strings with ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks, self.pattern = ranks, regex.compile(pattern)
        self.pairs = PairTable(ranks)
        self.first = np.array([ranks.get(bytes([b]), -1) for b in range(256)], np.int32)
        if (self.first < 0).any():
            raise ValueError("the vocabulary must hold every single byte")
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.known: dict[str, tuple[int, ...]] = {}

    @classmethod
    def load(cls, lines: Iterable[bytes], pattern: str) -> ByteBpe:
        return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}, pattern)

    def merge_rows(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """Merge byte strings of similar length together in one padded matrix."""
        width = max(map(len, pieces))
        ids = np.full((len(pieces), width), -1, np.int32)
        for i, piece in enumerate(pieces):
            ids[i, : len(piece)] = self.first[np.frombuffer(piece, np.uint8)]
        out: list[tuple[int, ...]] = [()] * len(pieces)
        rows = np.arange(len(pieces))
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:]) if width > 1 else np.full((len(pieces), 0), NO_PAIR)
        while len(rows):
            if ranks.shape[1]:
                at = ranks.argmin(axis=1)  # the leftmost of the smallest
                best = ranks[np.arange(len(rows)), at]
            else:
                at, best = np.zeros(len(rows), np.int64), np.full(len(rows), NO_PAIR)
            done = best == NO_PAIR
            for i in np.flatnonzero(done).tolist():
                row = ids[i]
                out[rows[i]] = tuple(row[row >= 0].tolist())
            if done.any():
                rows, ids, ranks, at, best = rows[~done], ids[~done], ranks[~done], at[~done], best[~done]
                if not len(rows):
                    break
            line = np.arange(len(rows))
            ids[line, at] = best
            keep = np.ones(ids.shape, bool)
            keep[line, at + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            keep = np.ones(ranks.shape, bool)
            keep[line, at] = False
            ranks = ranks[keep].reshape(len(rows), -1)
            if ranks.shape[1]:
                for near in (at - 1, at):  # only the two pairs beside the merged token changed
                    on = np.flatnonzero((near >= 0) & (near < ranks.shape[1]))
                    ranks[on, near[on]] = self.pairs.ranks(ids[on, near[on]], ids[on, near[on] + 1])
        return out

    def merge_long(self, piece: bytes) -> tuple[int, ...]:
        """The same merges for one very long match, in n log n."""
        ids = self.first[np.frombuffer(piece, np.uint8)]
        ranks = self.pairs.ranks(ids[:-1], ids[1:]).tolist()
        ids = ids.tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i) for i, r in enumerate(ranks) if r != NO_PAIR]
        heapq.heapify(heap)
        ranks.append(int(NO_PAIR))
        get, tokens, none = self.ranks.get, self.tokens, int(NO_PAIR)

        def again(i: int) -> None:
            j = after[i]
            ranks[i] = get(tokens[ids[i]] + tokens[ids[j]], none) if j < n else none
            if ranks[i] != none:
                heapq.heappush(heap, (ranks[i], i))

        while heap:
            rank, i = heapq.heappop(heap)
            if ids[i] < 0 or ranks[i] != rank:
                continue
            j = after[i]
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            again(i)
            if before[i] >= 0:
                again(before[i])
        return tuple(t for t in ids if t >= 0)

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the matches not yet remembered, bucketed by length."""
        buckets: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces:
            raw = piece.encode()
            rank = self.ranks.get(raw)
            if rank is not None:
                self.known[piece] = (rank,)
            elif len(raw) > LONGEST_ROW:
                self.known[piece] = self.merge_long(raw)
            else:
                buckets.setdefault((len(raw) + 3) // 4, []).append((piece, raw))
        for rows in buckets.values():
            for i in range(0, len(rows), 8192):
                part = rows[i : i + 8192]
                self.known.update(zip((p for p, _ in part), self.merge_rows([r for _, r in part]), strict=True))

    def encode_batch(self, texts: list[str]) -> list[np.ndarray]:
        split = [self.pattern.findall(t) for t in texts]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh = set()
        for pieces in split:
            fresh.update(pieces)
        self.learn(fresh.difference(self.known))
        known = self.known
        return [np.array([t for p in pieces for t in known[p]], "<u4") for pieces in split]

    def decode(self, ids: np.ndarray) -> bytes:
        tokens = self.tokens
        return b"".join([tokens[i] for i in ids.tolist()])


@lru_cache(maxsize=2)
def _loaded(key: tuple[bytes, str]) -> ByteBpe:
    return ByteBpe.load(key[0].splitlines(), key[1])


def read_vocabulary(path: str) -> bytes:
    """A rank file (base64 token, blank, rank on each line), read once on the driver; vocabularies are a few MB."""
    with open(path, "rb") as file:
        return file.read()


def _share(spark: SparkSession, vocabulary_path: str, pattern: str):
    # Bounded: a vocabulary file is under some MB whatever the size of the corpus.
    return spark.sparkContext.broadcast((read_vocabulary(vocabulary_path), pattern))


def encode(
    df: DataFrame, vocabulary_path: str, pattern: str, text: str = "text", keep: list[str] | None = None,
    into: str = "token_ids",
) -> DataFrame:
    """The columns ``keep`` (default: all but ``text``) and ``into``: the ids as little-endian unsigned 32-bit integers.

    Null counts as the empty text and gives no ids. Repeated rows stay repeated. Other columns pass through untouched;
    one already named ``into`` is replaced.
    """
    keep = [c for c in (keep if keep is not None else df.columns) if c not in (text, into)]
    shared = _share(df.sparkSession, vocabulary_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(shared.value)
        for whole in batches:
            for batch in slices(whole, 0):
                coded = bpe.encode_batch([t or "" for t in batch.column(0).to_pylist()])
                column = pa.array([c.tobytes() for c in coded], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], column], names=[*keep, into])

    source = text_first(df, text, keep)
    schema = df.select(*[f"`{c}`" for c in keep], F.lit(b"").alias(into)).schema
    return source.mapInArrow(run, schema)


def decode(
    df: DataFrame, vocabulary_path: str, pattern: str, ids: str = "token_ids", into: str = "decoded"
) -> DataFrame:
    """All columns and ``into``: the bytes that the packed ids stand for; null ids stand for none."""
    keep = [c for c in df.columns if c != into]
    shared = _share(df.sparkSession, vocabulary_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _loaded(shared.value)
        for whole in batches:
            for batch in slices(whole, ids):
                packed = batch.column(ids).to_pylist()
                column = pa.array([bpe.decode(np.frombuffer(p or b"", "<u4")) for p in packed], pa.binary())
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*keep, into])

    return df.select(*[f"`{c}`" for c in keep]).mapInArrow(run, df.select(*[f"`{c}`" for c in keep], F.lit(b"").alias(into)).schema)


def digests(coded: DataFrame, ids: str = "token_ids", decoded: str = "decoded") -> DataFrame:
    """doc_id, number of tokens, and the digests of the packed ids and of the decoded bytes."""
    return coded.select(
        "doc_id", (F.octet_length(ids) / 4).cast("long").alias("n_tokens"), F.sha2(F.col(ids), 256).alias("ids_sha256"),
        F.sha2(F.col(decoded), 256).alias("decoded_sha256"),
    )
