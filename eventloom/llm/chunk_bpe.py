"""Byte-level BPE in which passages that documents share are encoded once.

A rolling hash of the last 32 bytes cuts every text where its high bits are zero, so equal passages are cut alike
wherever they stand. Chunks that occur more than once are encoded in one home and their ids handed to all the others;
the rest of a text is encoded where it is. Only keys, offsets and ids of shared chunks are grouped and joined.

The ids of two neighbours do not simply follow each other, since the pattern that splits a text into matches may match
across the join. So every join is repaired: the text around it is encoded again from the last match of the left side that
no later text can change, until a match begins at a place where one begins in the right side's own encoding too. From
there on both agree. While they do not, the window doubles, at the end over the rest of the text.

The strings of added tokens are found first; chunks do not cross them.

Ids are those of the tokenizers library. Where it is shown to give the same, a faster encoder for the same merges is
used: on load it is checked that merges come in the order of their ids and that every token is merged to itself. Then a
pair of neighbours whose bytes are a token is always one of the merges (otherwise that token alone would end as the
pair), so merging by the rank of the bytes is merging by the list. The way texts are split is compared for every
character below U+0540; texts with others, and vocabularies that fail a check, are encoded by the library itself.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from eventloom.llm.bpe import read_vocabulary
from eventloom.llm.common import halves, mixed, packed_texts, raw_texts, row_key, slices, store
from eventloom.operators.skew import attach_per_key, broadcast_if_small

#: A cut needs this many zero bits; chunks have at least LEAST and at most MOST bytes (but for the end of a text).
CUT_BITS, LEAST, MOST = 10, 256, 8192
#: Characters that a match of the pattern may look at before it is settled: a contraction has three.
LOOK = 3
#: Characters beyond a join that the first repair encodes.
WINDOW = 48
#: Text in one call of the library; its encodings take some hundred bytes a token.
CALL_BYTES = 512 << 10
#: Fixed value: how byte-level tokenizers split a text into matches.
_MATCHES = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters below this one are compared on load; its first byte in UTF-8 and those after it tell others apart.
_COMPARED, _OTHER_BYTE = 0x540, 0xD5
_GEAR = (mixed(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
_REF = "t1 long, t2 long, place int, size int, h1 long, h2 long"


def chunk_ends(raw: bytes, cut_bits: int = CUT_BITS, least: int = LEAST, most: int = MOST) -> list[int]:
    """Where the chunks of a UTF-8 text end; never inside a character."""
    n = len(raw)
    if n <= least:
        return [n] if n else []
    data = np.frombuffer(raw, np.uint8)
    rolled = _GEAR[data]
    for step in (1, 2, 4, 8, 16):
        rolled[step:] = rolled[step:] + (rolled[:-step] << np.uint32(step))
    begins = np.append(np.flatnonzero((data & 0xC0) != 0x80), n)  # where characters begin
    whole = lambda at: int(begins[np.searchsorted(begins, at)])
    ends, last = [], 0
    for cut in [*(np.flatnonzero(rolled >> np.uint32(32 - cut_bits) == 0) + 1).tolist(), n]:
        cut = whole(cut)
        while cut - last > most:
            last = whole(last + most)
            ends.append(last)
        if cut > last and (cut - last >= least or cut == n):
            ends.append(cut)
            last = cut
    return ends


class ChunkCoder:
    """The library's encoder for one vocabulary file, and the repair of joins."""

    def __init__(self, vocabulary: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_str(vocabulary.decode())
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        added = self.tokenizer.get_added_tokens_decoder()
        if any(t.lstrip or t.rstrip or t.single_word or t.normalized for t in added.values()):
            raise ValueError("added tokens that take in their surroundings are not supported")
        self.added = {t.content: i for i, t in added.items()}
        names = sorted(self.added, key=len, reverse=True)
        self.cuts = re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else None
        self.bytes_of = self._token_bytes() if json.loads(vocabulary)["decoder"]["type"] == "ByteLevel" else None
        self.matches = regex.compile(_MATCHES)
        self.quick = self._quick_encoder(json.loads(vocabulary))
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"

    def _token_bytes(self) -> list[bytes]:
        """What each id stands for: a byte-level token has one character for each byte; other tokens are their own text."""
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        letters = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in plain)}
        out = [b""] * (max(self.tokenizer.get_vocab().values()) + 1)
        for token, i in self.tokenizer.get_vocab().items():
            out[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        return out

    def _quick_encoder(self, made: dict) -> tiktoken.Encoding | None:
        """An encoder that ranks merges by their bytes, if it is shown to give the library's ids."""
        model, split = made["model"], made["pre_tokenizer"] or {}
        if self.bytes_of is None or made["normalizer"] or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or not split.get("use_regex", True):
            return None
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")):
            return None
        vocabulary = model["vocab"]
        merged = [vocabulary["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        if any(a >= b for a, b in zip(merged, merged[1:])):
            return None
        ranks = {self.bytes_of[i]: i for token, i in vocabulary.items() if token not in self.added}
        tokenize = self.tokenizer.model.tokenize
        if any(bytes([b]) not in ranks for b in range(256)) or any([t.id for t in tokenize(token)] != [i] for token, i in vocabulary.items() if token not in self.added):
            return None
        quick = tiktoken.Encoding("chunks", pat_str=_MATCHES, mergeable_ranks=ranks, special_tokens={})
        for c in map(chr, range(_COMPARED)):
            text = f"a{c}1{c} {c}{c}\n{c}'s {c}"
            ids = quick.encode_ordinary(text)
            if ids != self.tokenizer.encode(text, add_special_tokens=False).ids or ids != [i for m in self.matches.findall(text) for i in quick.encode_ordinary(m)]:
                return None
        return quick

    def _is_quick(self, text: str) -> bool:
        return self.quick is not None and (text.isascii() or int(np.frombuffer(text.encode(), np.uint8).max()) < _OTHER_BYTE)

    def decode(self, packed: list[np.ndarray]) -> list[str]:
        """The library's text of ids, added tokens included; ids that stand for nothing are left out."""
        if self.bytes_of is None:
            return self.tokenizer.decode_batch([p.tolist() for p in packed], skip_special_tokens=False)
        known, get = len(self.bytes_of), self.bytes_of.__getitem__
        return [b"".join(map(get, p[p < known].tolist())).decode("utf-8", "replace") for p in packed]

    def segments(self, text: str) -> list[str]:
        """The text between added tokens, and these, in turn."""
        return self.cuts.split(text) if self.cuts else [text]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of whole texts without added tokens."""
        quick = [self._is_quick(t) for t in texts]
        others = iter(self.tokenizer.encode_batch_fast([t for t, q in zip(texts, quick, strict=True) if not q], add_special_tokens=False))
        return [np.array(self.quick.encode_ordinary(t) if q else next(others).ids, "<u4") for t, q in zip(texts, quick, strict=True)]

    def _settled(self, begins: np.ndarray, length: int) -> int:
        """How many of the matches that begin there no text behind can change."""
        # The last match touches the end; those that begin within LOOK of it may still become another alternative.
        settled = (np.append(begins[1:], length) < length) & (begins <= length - LOOK)
        return int(np.argmin(np.append(settled, False)))

    def _matches(self, encoding, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Characters and tokens at which matches begin that no text behind can change."""
        if not encoding.ids:
            return np.zeros(1, np.int64), np.zeros(1, np.int64)
        words, offsets = np.array(encoding.word_ids), encoding.offsets
        tokens = np.flatnonzero(np.append(True, words[1:] != words[:-1]))
        begins = np.array([offsets[t][0] for t in tokens.tolist()])
        count = self._settled(begins, length)
        return begins[: count + 1], tokens[: count + 1]

    def _encode(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids of a text, and where its settled matches and the one after them begin, in characters and in tokens."""
        if self._is_quick(text):
            parts = [(m.start(), self.quick.encode_ordinary(m.group())) for m in self.matches.finditer(text)]
            begins = np.array([b for b, _ in parts])
            tokens = np.cumsum([0, *[len(i) for _, i in parts]])
            count = self._settled(begins, len(text))
            return np.array([i for _, ids in parts for i in ids], "<u4"), begins[: count + 1], tokens[: count + 1]
        encoding = self.tokenizer.encode(text, add_special_tokens=False)
        return np.array(encoding.ids, "<u4"), *self._matches(encoding, len(text))

    def coded(self, texts: list[str]) -> list[tuple[np.ndarray, int, int]]:
        """For each chunk its ids, the last settled begin of a match, and the tokens before it."""
        quick = [self._is_quick(t) for t in texts]
        others = iter(self.tokenizer.encode_batch([t for t, q in zip(texts, quick, strict=True) if not q], add_special_tokens=False))
        return [self._quickly_coded(t) if q else (np.array((e := next(others)).ids, "<u4"), *self._last_settled(e, len(t))) for t, q in zip(texts, quick, strict=True)]

    def _quickly_coded(self, text: str) -> tuple[np.ndarray, int, int]:
        begins = np.array([m.start() for m in self.matches.finditer(text)])
        sure = int(begins[self._settled(begins, len(text))])
        ids = self.quick.encode_ordinary(text)
        # A match begins there, and no alternative looks back, so the rest is split as it is here.
        return np.array(ids, "<u4"), sure, len(ids) - len(self.quick.encode_ordinary(text[sure:]))

    @staticmethod
    def _last_settled(encoding, length: int) -> tuple[int, int]:
        """The end of ``_matches``, found from behind: only some matches at the end of a text are not settled."""
        match = encoding.token_to_word(len(encoding) - 1)
        while match:
            begin, end = encoding.word_to_chars(match - 1)
            if end < length and begin <= length - LOOK:
                break
            match -= 1
        return encoding.word_to_chars(match)[0], encoding.word_to_tokens(match)[0]

    def join(self, parts: list[str], coded: list[tuple[np.ndarray, int, int]]) -> np.ndarray:
        """The ids of the joined parts from the ids of each."""
        text, begins = "".join(parts), np.cumsum([0, *map(len, parts)]).tolist()
        out, k, at, token = [], 0, 0, 0
        while k < len(parts) - 1:
            ids, sure, n_sure = coded[k]
            begin = at
            if at <= begins[k] + sure:
                out.append(ids[token:n_sure])
                begin = begins[k] + sure
            reach, agreed = WINDOW, False
            while not agreed:
                end = begins[k + 1] + reach
                if end >= len(text):
                    return np.concatenate([*out, self._encode(text[begin:])[0]])
                right = int(np.searchsorted(begins, end)) - 1
                both, ours, our_tokens = self._encode(text[begin:end])
                _, theirs, their_tokens = self._encode(text[begins[right] : end])
                _, i, j = np.intersect1d(ours + begin, theirs + begins[right], return_indices=True)
                agreed = len(i) > 0
                reach *= 2
            out.append(both[: our_tokens[i[0]]])
            k, at, token = right, begin + int(ours[i[0]]), int(their_tokens[j[0]])
        return np.concatenate([*out, coded[k][0][token:]]) if parts else np.zeros(0, "<u4")


@lru_cache(maxsize=2)
def _coder(vocabulary: bytes) -> ChunkCoder:
    return ChunkCoder(vocabulary)


def _share(spark: SparkSession, path: str):
    # Bounded: a vocabulary file is some MB whatever the size of the corpus.
    return spark.sparkContext.broadcast(read_vocabulary(path))


def chunk_refs(docs: DataFrame, shared, text: str, by: str, sizes: tuple[int, int, int]) -> DataFrame:
    """One row for each chunk of each text: the row's key, place and size in bytes, and 128 bits of the chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for whole in batches:
            for batch in slices(whole, 0):
                rows = []
                for doc, raw in zip(batch.column(1).to_pylist(), raw_texts(batch.column(0)), strict=True):
                    key, at = row_key(doc, raw), 0
                    for segment in coder.segments(raw.decode()) if raw else []:
                        part = segment.encode()
                        begin = 0
                        for end in chunk_ends(part, *sizes) if segment not in coder.added else []:
                            rows.append((*key, at + begin, end - begin, *halves(xxhash.xxh3_128_digest(part[begin:end]))))
                            begin = end
                        at += len(part)
                columns = list(zip(*rows, strict=True)) or [()] * 6
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["t1", "t2", "place", "size", "h1", "h2"])

    return docs.select(F.col(text).alias("_text"), F.col(by).alias("_by")).mapInArrow(run, _REF)


def _home_codes(docs: DataFrame, shared_chunks: DataFrame, shared, text: str, by: str) -> DataFrame:
    """h1, h2, n, ids, sure, n_sure: each shared chunk encoded in its home, the smallest place that has it."""
    homes = shared_chunks.groupBy("home.t1", "home.t2").agg(F.collect_list(F.struct("home.place", "home.size", "h1", "h2", "n")).alias("chunks"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, open_, squeeze = _coder(shared.value), zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)
        names = ["h1", "h2", "n", "ids", "sure", "n_sure"]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int32()]
        for whole in batches:
            for batch in slices(whole, "z", CALL_BYTES // 2):
                chunks, texts = [], []
                for z, own in zip(batch.column("z").to_pylist(), batch.column("chunks").to_pylist(), strict=True):
                    raw = open_.decompress(z)
                    chunks += own
                    texts += [raw[c["place"] : c["place"] + c["size"]].decode() for c in own]
                rows = [(c["h1"], c["h2"], c["n"], squeeze.compress(i.astype(coder.kind).tobytes()), s, n) for c, (i, s, n) in zip(chunks, coder.coded(texts), strict=True)]
                columns = list(zip(*rows, strict=True)) or [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    # The homes are few rows of keys and offsets; they are broadcast only if measured small.
    rows = packed_texts(docs, text, [by], by).drop("_k0").join(broadcast_if_small(store(homes, "homes")), ["t1", "t2"]).select("z", "chunks")
    coded = rows.mapInArrow(run, "h1 long, h2 long, n long, ids binary, sure int, n_sure int")
    # Rows equal in id and text are one home, met as often as they occur.
    return coded.groupBy("h1", "h2").agg(*[F.first(c).alias(c) for c in ("n", "ids", "sure", "n_sure")])


def shared_codes(docs: DataFrame, shared, text: str, by: str, sizes: tuple[int, int, int]) -> DataFrame:
    """t1, t2, pieces: for every row that has shared chunks, their places and ids."""
    refs = store(chunk_refs(docs, shared, text, by, sizes).groupBy("t1", "t2", "place", "size", "h1", "h2").agg(F.count("*").alias("m")), "chunk-refs")
    counted = refs.groupBy("h1", "h2").agg(F.sum("m").alias("n"), F.min(F.struct("t1", "t2", "place", "size")).alias("home")).where("n > 1")
    codes = store(_home_codes(docs, store(counted, "shared-chunks"), shared, text, by), "chunk-codes")
    placed = attach_per_key(refs.drop("m"), codes, ["h1", "h2"], "n", ["ids", "sure", "n_sure"]).where("ids IS NOT NULL")
    return placed.groupBy("t1", "t2").agg(F.collect_list(F.struct("place", "size", "ids", "sure", "n_sure")).alias("pieces"))


def _assembled(coder: ChunkCoder, open_: zstandard.ZstdDecompressor, raws: list[bytes], pieces: list[list[dict] | None]) -> list[np.ndarray]:
    """The ids of texts, some with encoded chunks. All text without ids goes to the library together."""
    plain = [i for i, p in enumerate(pieces) if not p]
    out: list = [None] * len(raws)
    whole = {i: coder.segments(raws[i].decode()) for i in plain}
    ids = iter(coder.ids([s for i in plain for s in whole[i] if s not in coder.added]))
    for i in plain:
        parts = [np.array([coder.added[s]], "<u4") if s in coder.added else next(ids) for s in whole[i]]
        out[i] = parts[0] if len(parts) == 1 else np.concatenate(parts)
    jobs, fresh = [], []
    for i in set(range(len(raws))).difference(plain):
        at, known, segments = 0, {p["place"]: p for p in pieces[i]}, []
        places = np.array(sorted(known))
        for segment in coder.segments(raws[i].decode()):
            part = segment.encode()
            parts: list[tuple[str, dict | int]] = []
            inner = places[np.searchsorted(places, at) : np.searchsorted(places, at + len(part))].tolist()
            begin = at
            for place in [*inner, at + len(part)]:
                if place > begin and segment not in coder.added:
                    parts.append((part[begin - at : place - at].decode(), len(fresh)))
                    fresh.append(parts[-1][0])
                if place in known and place < at + len(part):
                    begin = place + known[place]["size"]
                    parts.append((part[place - at : begin - at].decode(), known[place]))
            segments.append((segment, parts))
            at += len(part)
        jobs.append((i, segments))
    coded = coder.coded(fresh)
    for i, segments in jobs:
        ids = []
        for segment, parts in segments:
            if segment in coder.added:
                ids.append(np.array([coder.added[segment]], "<u4"))
                continue
            own = [coded[c] if isinstance(c, int) else (np.frombuffer(open_.decompress(c["ids"]), coder.kind).astype("<u4"), c["sure"], c["n_sure"]) for _, c in parts]
            ids.append(coder.join([t for t, _ in parts], own))
        out[i] = np.concatenate(ids)
    return out


def encode(
    df: DataFrame, vocabulary_path: str, text: str = "text", by: str = "doc_id", keep: list[str] | None = None, into: str = "token_ids",
    cut_bits: int = CUT_BITS, least: int = LEAST, most: int = MOST,
) -> DataFrame:
    """The columns ``keep`` (default: all but ``text``) and ``into``: the library's ids as little-endian unsigned 32-bit integers.

    Null and empty texts have no ids. Repeated rows stay repeated. Rows are told apart by ``by`` and the text. Other
    columns pass through; one already named ``into`` is replaced.
    """
    names = [c for c in (keep if keep is not None else df.columns) if c not in (text, into)]
    carried = names if by in names else [*names, by]
    shared = _share(df.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, open_ = _coder(shared.value), zstandard.ZstdDecompressor()
        for whole in batches:
            for batch in slices(whole, "z", CALL_BYTES // 2):
                raws = [open_.decompress(z) if z is not None else b"" for z in batch.column("z").to_pylist()]
                coded = _assembled(coder, open_, raws, batch.column("pieces").to_pylist())
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array([c.tobytes() for c in coded], pa.binary())], names=[*names, into])

    found = shared_codes(df, shared, text, by, (cut_bits, least, most))
    joined = packed_texts(df, text, carried, by).join(found, ["t1", "t2"], "left").select(*[f"_k{i}" for i in range(len(names))], "z", "pieces")
    return joined.mapInArrow(run, df.select(*[f"`{c}`" for c in names], F.lit(b"").alias(into)).schema)


def decode(df: DataFrame, vocabulary_path: str, ids: str = "token_ids", into: str = "decoded") -> DataFrame:
    """All columns and ``into``: the library's text of the packed ids, added tokens included; null ids give the empty text."""
    keep = [c for c in df.columns if c != into]
    shared = _share(df.sparkSession, vocabulary_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(shared.value)
        for whole in batches:
            for batch in slices(whole, ids):
                column = pa.array(coder.decode([np.frombuffer(p or b"", "<u4") for p in batch.column(ids).to_pylist()]), pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, column], names=[*keep, into])

    return df.select(*[f"`{c}`" for c in keep]).mapInArrow(run, df.select(*[f"`{c}`" for c in keep], F.lit("").alias(into)).schema)
