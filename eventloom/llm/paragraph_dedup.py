"""Substring dedup on paragraphs: MinHash banding, exact verification, removal by components.

Paragraphs are the lines of a text. Their sets of word runs are banded for high recall, colliding paragraphs are joined
and verified by exact Jaccard similarity, and of each connected component one paragraph stays: that of the smallest
document. Passages that stand inside longer paragraphs, or run over several short ones, are met word by word: every run
of ``least`` words that also begins elsewhere goes, except at its smallest place, so of a longer common run all goes.

Not every run of words is sent through the cluster. Of the shorter runs inside each passage the one with the smallest
hash is its seed, so equal passages hold equal seeds, and only passages around a seed that occurs again are compared,
by 96 bits of their hashes. Band keys, seeds and passages are sent as packed arrays dealt by hash; of equal ones each task sends one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import mixed, packed_texts, raw_texts, row_key, slices, small_batches, store, word_places, words_of
from eventloom.llm.near import (
    SIMILAR, UNIT_TYPE, WORDS, MinHash, Shingler, components, member_units, run_hashes, solve_units, tune_bands, unit_batch,
)

#: Shortest passage, in words. Paragraphs need the words of one shingle only.
LEAST_WORDS = 25
#: Bands and values a band: of the pairs at just the similarity all but 3e-6 meet, as in the n-gram Jaccard join.
BANDS, ROWS = tune_bands(SIMILAR, 1 - 1e-5, 96)
#: Bytes of text for one part of the packed seeds or passages, and of the packed band keys.
PART_BYTES = 8 << 20
BAND_BYTES = 4 << 20
#: Band keys, seeds or passages that a task holds before it sends them.
HELD = 200_000
#: Hashes in one block of signatures.
SIGN_BLOCK = 2048
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: As the bytes of words, with line feeds kept.
_LINE_BYTES = bytes(10 if c == 10 else c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_SEED = np.dtype([("h", "<u8"), ("t1", "<i8"), ("t2", "<i8"), ("p", "<i8")])
_BAND = np.dtype([("h", "<u8"), ("k", "<i8")])
_LINE = np.dtype([("g", "<u8"), ("h", "<u8"), ("n", "<i8"), ("known", "u1"), ("doc", "<i8"), ("t1", "<i8"), ("t2", "<i8"), ("a", "<i8"), ("b", "<i8")])
_MEMBER = np.dtype([("k", "<i8"), ("b", "<i8"), ("leader", "<i8")])
_PASSAGE = np.dtype([("h", "<u8"), ("g", "<u4"), ("s", "<u4"), ("known", "u1"), ("doc", "<i8"), ("t1", "<i8"), ("t2", "<i8"), ("a", "<i8"), ("b", "<i8")])


def paragraphs(text: bytes, least: int, shingle: int = WORDS) -> Iterator[tuple[int, int, list[bytes]]]:
    """(begin, end, words) of the lines of ``least`` words or one shingle; byte offsets, without the line break."""
    least = min(least, shingle)
    begin = 0
    for line in text.split(b"\n"):
        words = words_of(line)
        if len(words) >= least:
            yield begin, begin + len(line), words
        begin += len(line) + 1


class WordHashes:
    """64-bit hashes of words."""

    def ids(self, words: np.ndarray) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))

    def of_text(self, lines: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begins, ends and hashes of the words of a text translated by ``_LINE_BYTES``; equal words are hashed once."""
        inside = np.frombuffer(b" " + lines + b" ", np.uint8) > 32
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        begins, ends = edges[::2], edges[1::2]
        offsets = np.zeros(len(begins) + 1, np.int32)
        np.cumsum(ends - begins, out=offsets[1:])
        coded = pa.Array.from_buffers(pa.binary(), len(begins), [None, pa.py_buffer(offsets), pa.py_buffer(lines.translate(None, b" \n"))]).dictionary_encode()
        return begins, ends, self.ids(coded.dictionary.to_numpy(zero_copy_only=False))[coded.indices.to_numpy()]


class LineSets:
    """The paragraphs of some texts and their sets of hashed word runs, for all of them at once.

    ``text``, ``begin``, ``end``: where each paragraph is; ``hashes`` from ``at[i]`` to ``at[i + 1]``: its sorted set.
    The same paragraphs and sets as ``paragraphs`` and ``Shingler.shingles`` give one by one. ``ids``: the hashes of
    all words of the texts, also of shorter lines, those of text ``i`` from ``words_at[i]`` to ``words_at[i + 1]``.
    """

    def __init__(self, texts: list[bytes | None], least: int, size: int, known: WordHashes) -> None:
        least = min(least, size)
        joined = b"\n".join([t or b"" for t in texts]).translate(_LINE_BYTES)
        text_at = np.cumsum([0, *[len(t or b"") + 1 for t in texts]])
        breaks = np.flatnonzero(np.frombuffer(joined, np.uint8) == 10)
        line_at, line_end = np.append(0, breaks + 1), np.append(breaks, len(joined))
        begins, _, ids = known.of_text(joined)
        line_of = np.searchsorted(line_at, begins, "right") - 1
        per_line = np.bincount(line_of, minlength=len(line_at))
        rows = np.flatnonzero(per_line >= least)
        self.text = np.searchsorted(text_at, line_at[rows], "right") - 1
        self.begin, self.end = line_at[rows] - text_at[self.text], line_end[rows] - text_at[self.text]
        self.ids, self.words_at = ids, np.searchsorted(begins, text_at)
        counts, first = per_line[rows], (np.cumsum(per_line) - per_line)[rows]
        # The number of the paragraph that each word is of; shorter lines have none.
        number = np.full(len(line_at), -1)
        number[rows] = np.arange(len(rows))
        line = number[line_of]
        hashes, lines = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        if len(ids) >= size:
            begins = np.flatnonzero((line[: len(ids) - size + 1] == line[size - 1 :]) & (line[: len(ids) - size + 1] >= 0))
            hashes.append(_run_of(ids, size, begins))
            lines.append(line[begins])
        for short in range(least, size):
            some = np.flatnonzero(counts == short)
            hashes.append(_run_of(ids, short, first[some]))
            lines.append(some)
        every, owner = np.concatenate(hashes), np.concatenate(lines)
        order = _by_owner(every, owner)
        every, owner = every[order], owner[order]
        new = np.ones(len(every), bool)
        new[1:] = (every[1:] != every[:-1]) | (owner[1:] != owner[:-1])
        self.hashes = every[new]
        self.at = np.searchsorted(owner[new], np.arange(len(rows) + 1))

    def keys(self) -> list[bytes]:
        """128 bits of each set."""
        raw, at = self.hashes.tobytes(), (8 * self.at).tolist()
        return [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]

    def signatures(self, chosen: np.ndarray, minhash: MinHash) -> np.ndarray:
        """The signature of each of the chosen sets."""
        out = np.zeros((len(chosen), len(minhash.flip)), np.uint32)
        sizes = (self.at[1:] - self.at[:-1])[chosen]
        upto = np.cumsum(sizes)
        first = 0
        while first < len(chosen):
            before = upto[first] - sizes[first]
            last = max(first + 1, int(np.searchsorted(upto, before + SIGN_BLOCK, side="right")))
            if last == first + 1:
                out[first] = minhash.signature(self.hashes[self.at[chosen[first]] : self.at[chosen[first] + 1]])
            else:
                places = np.arange(int(sizes[first:last].sum())) + np.repeat(self.at[chosen[first:last]] - (upto[first:last] - sizes[first:last] - before), sizes[first:last])
                part = ((self.hashes[places] >> np.uint64(32)).astype(np.uint32)[:, None] ^ minhash.flip) * minhash.factor
                part ^= part >> np.uint32(15)
                out[first:last] = np.minimum.reduceat(part, upto[first:last] - sizes[first:last] - before, axis=0)
            first = last
        return out


def _by_owner(hashes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """The order by owner and hash. One sort of the owner with the high bits of the hash; ties of these are rare."""
    if len(owner) and owner[-1] < 1 << 20 and owner.max() < 1 << 20:
        key = owner.astype(np.uint64) << np.uint64(44) | hashes >> np.uint64(20)
        order = np.argsort(key)
        key, sorted_ = key[order], hashes[order]
        if not ((key[1:] == key[:-1]) & (sorted_[1:] != sorted_[:-1])).any():
            return order
    return np.lexsort((hashes, owner))


def _run_of(ids: np.ndarray, size: int, begins: np.ndarray) -> np.ndarray:
    """The hash of the ``size`` words from each begin, as ``Shingler`` has it."""
    with np.errstate(over="ignore"):
        out = np.full(len(begins), np.uint64(size))
        for k in range(size):
            out = out * _STEP + ids[begins + k]
    return mixed(out)


def band_matrix(signatures: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each set and band of ``rows`` values."""
    bands = signatures.shape[1] // rows
    values = signatures[:, : bands * rows].reshape(-1, bands, rows).astype(np.uint64)
    with np.errstate(over="ignore"):
        out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), values.shape[:2])
        for k in range(rows):
            out = mixed(out * _STEP + values[:, :, k])
    return out


def passages(text: bytes, least: int, shingler: Shingler | None = None) -> list[tuple[int, int, bytes]]:
    """(begin, end, digest) of every run of ``least`` words."""
    begins, ends = word_places(text)
    if len(begins) < least:
        return []
    h, g = _run_digests((shingler or Shingler()).ids(words_of(text)), least)
    return [(a, b, x.tobytes() + y.tobytes()) for a, b, x, y in zip(begins.tolist(), ends[least - 1 :].tolist(), h, g)]


def _run_digests(ids: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """64 and 32 bits for every run of ``least`` words."""
    first, second = mixed(run_hashes(ids, least, 0x9E3779B97F4A7C15)), mixed(run_hashes(ids, least, 0xD6E8FEB86659FD93))
    return first, (second >> np.uint64(32)).astype(np.uint32)


def _sliding(best: np.ufunc, values: np.ndarray, span: int) -> np.ndarray:
    """``best`` (minimum or maximum) of every ``span`` neighbouring values."""
    length = 1
    while 2 * length <= span:
        values, length = best(values[:-length], values[length:]), 2 * length
    rest = span - length
    return best(values[:-rest], values[rest:]) if rest else values


def _seed_words(least: int) -> int:
    return least // 2 + 1


def _seed_hashes(ids: np.ndarray, least: int) -> np.ndarray:
    return mixed(run_hashes(ids, _seed_words(least), 0x9E3779B97F4A7C15))


def _seeds(ids: np.ndarray, least: int, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the shorter runs that are the smallest of some run of ``least`` words of one owner."""
    size = _seed_words(least)
    hashes = _seed_hashes(ids, least)
    # A seed is the smallest of some neighbourhood when the largest of its neighbourhoods' minima is its own hash.
    span = least - size + 1
    none = np.zeros(span - 1, np.uint64)
    inside = owner[: len(ids) - least + 1] == owner[least - 1 :]
    minima = np.concatenate([none, np.where(inside, _sliding(np.minimum, hashes, span), np.uint64(0)), none])
    chosen = np.flatnonzero(_sliding(np.maximum, minima, span) == hashes)
    return chosen, hashes[chosen]


def _groups(entries: np.ndarray, names: tuple[str, ...]) -> np.ndarray:
    """Whether each entry, sorted by ``names``, begins a group of equal ones."""
    new = np.zeros(len(entries), bool)
    new[:1] = True
    for name in names:
        new[1:] |= entries[name][1:] != entries[name][:-1]
    return new


def _again(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The seeds whose hash occurs again, and one seed of each hash."""
    entries = entries[np.argsort(entries["h"], kind="stable")]
    new = _groups(entries, ("h",))
    return entries[~(new & np.append(new[1:], True))], entries[new]


def _later(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The passages that also stand at a smaller place, and each passage at its smallest place, null ids first."""
    entries = entries[np.argsort(entries["h"], kind="stable")]
    new = _groups(entries, ("h",))
    alone = new & np.append(new[1:], True)
    single, entries = entries[alone], entries[~alone]
    # Only passages with equal hashes need an order among them.
    entries = entries[np.lexsort([entries[c] for c in ("a", "t2", "t1", "doc", "known", "g", "h")])]
    new = _groups(entries, ("h", "g"))
    # The same row may stand in the table twice.
    return entries[~new & _groups(entries, ("h", "g", "known", "doc", "t1", "t2", "a"))], np.concatenate([single, entries[new]])


def _joined(entries: np.ndarray) -> np.ndarray:
    """Passages of one text that overlap or touch, as one."""
    entries = entries[np.lexsort([entries["a"], entries["t2"], entries["t1"]])]
    if not len(entries):
        return entries
    # All are of the same number of words, so they end in the order in which they begin.
    new = _groups(entries, ("t1", "t2"))
    new[1:] |= entries["a"][1:] > entries["b"][:-1]
    begins = np.flatnonzero(new)
    out = entries[begins]
    out["b"] = entries["b"][np.append(begins[1:], len(entries)) - 1]
    return out


def _all_left(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return entries[:0], entries


def _members(entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets of the band keys that several sets have, with the smallest of them as leader."""
    entries = entries[np.argsort(entries["h"])]
    new = _groups(entries, ("h",))
    entries = entries[~(new & np.append(new[1:], True))]
    # Most keys are of one set only; what is left is put in order, and a set sent twice counts once.
    entries = entries[np.lexsort([entries["k"], entries["h"]])]
    entries = entries[_groups(entries, ("h", "k"))]
    new = _groups(entries, ("h",))
    begins = np.flatnonzero(new)
    sizes = np.diff(np.append(begins, len(entries)))
    out = np.zeros(len(entries), _MEMBER)
    out["k"], out["b"] = entries["k"], np.ascontiguousarray(entries["h"]).view(np.int64)
    out["leader"] = np.repeat(entries["k"][begins], sizes)
    return out[np.repeat(sizes > 1, sizes)], entries[:0]


_DEALT = pa.schema([("part", pa.int32()), ("ready", pa.bool_()), ("packed", pa.binary())])


#: Bytes of a packed band key and its set.
_BAND_WIDTH = 13


def _pack(entries: np.ndarray) -> bytes:
    """Entries column by column; the rows they are of are written once, offsets in four bytes, band keys in five.

    The entries of one part have at most some hundred thousand band keys, so 40 of their bits tell them apart but for
    a candidate too many now and then; ``_unpack`` puts the number of the part before them.
    """
    owner = [n for n in ("t1", "t2", "doc", "known") if n in entries.dtype.names]
    if not owner:
        out = np.empty((len(entries), _BAND_WIDTH), np.uint8)
        out[:, :5] = mixed(entries["h"]).astype("<u8").view(np.uint8).reshape(-1, 8)[:, :5]
        out[:, 5:] = entries["k"].astype("<i8").view(np.uint8).reshape(-1, 8)
        return out.tobytes()
    order = np.lexsort([entries[n] for n in reversed(owner)])
    new = np.zeros(len(entries), bool)
    for name in owner:
        new[1:] |= entries[name][order][1:] != entries[name][order][:-1]
    new[:1] = True
    number = np.zeros(len(entries), "<u4")
    number[order] = np.cumsum(new) - 1
    table = entries[order[new]]
    columns = [np.array([len(entries), len(table)], "<u4"), *[np.ascontiguousarray(table[n]) for n in owner], number]
    for name in entries.dtype.names:
        if name not in owner:
            values = entries[name] - entries["a"] if name == "b" else entries[name]
            columns.append(np.ascontiguousarray(values.astype("<u4") if values.dtype == np.int64 else values))
    return zstandard.ZstdCompressor(level=1).compress(b"".join([c.tobytes() for c in columns]))


def _unpack(packed: bytes, kind: np.dtype, part: int) -> np.ndarray:
    owner = [n for n in ("t1", "t2", "doc", "known") if n in kind.names]
    if not owner:
        rows = np.frombuffer(packed, np.uint8).reshape(-1, _BAND_WIDTH)
        keys = np.zeros((len(rows), 8), np.uint8)
        keys[:, :5] = rows[:, :5]
        out = np.zeros(len(rows), kind)
        out["h"] = keys.view("<u8").ravel() | np.uint64(part << 40)
        out["k"] = np.ascontiguousarray(rows[:, 5:]).view("<i8").ravel()
        return out
    raw, at = zstandard.ZstdDecompressor().decompress(packed), 0

    def take(form: str | np.dtype, n: int) -> np.ndarray:
        nonlocal at
        values = np.frombuffer(raw, form, n, at)
        at += values.nbytes
        return values

    size, rows = take("<u4", 2).tolist()
    table = {n: take(kind[n], rows) for n in owner}
    number = take("<u4", size)
    out = np.zeros(size, kind)
    for name in kind.names:
        if name in owner:
            out[name] = table[name][number]
        else:
            out[name] = take("<u4" if kind[name] == np.int64 else kind[name], size)
    if "b" in kind.names:
        out["b"] += out["a"]
    return out


def _deal(held: list[np.ndarray], parts: int, meet, first: int = 0) -> pa.RecordBatch:
    """``meet`` inside the task: what it says of these entries is ready, what is left goes to the parts from ``first`` on."""
    ready, left = meet(np.concatenate(held))
    held.clear()
    rows = []
    # Passages go by their seeds, so that neighbours mostly go together.
    by = "s" if "s" in left.dtype.names else "h"
    for entries, done in ((ready, True), (left, False)):
        part = (entries[by] % np.uint64(parts)).astype(np.int32) + np.int32(first)
        # Numbers of two bytes are put in order without comparisons.
        order = np.argsort(part.astype(np.uint16) if first + parts < 1 << 16 else part, kind="stable")
        entries, part = entries[order], part[order]
        if not len(part):
            continue
        begins = np.flatnonzero(np.append(True, part[1:] != part[:-1]))
        if entries.dtype == _BAND:
            # Packed at once: what is done for each part alone grows with the number of parts.
            raw, edges = _pack(entries), (_BAND_WIDTH * np.append(begins, len(part))).tolist()
            packs = [raw[x:y] for x, y in zip(edges[:-1], edges[1:], strict=True)]
        else:
            packs = map(_pack, np.split(entries, begins[1:]))
        rows += [(p, done, z) for p, z in zip(part[begins].tolist(), packs, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _DEALT, strict=True)], schema=_DEALT)


def _meet(dealt: DataFrame, parts: int, kind: np.dtype, meet, shorten, columns: tuple[str, ...]) -> DataFrame:
    """``columns`` of what ``shorten`` makes of the entries that ``meet`` gives for each part, and of those that were ready."""

    def batch_of(entries: np.ndarray) -> Iterator[pa.RecordBatch]:
        entries = shorten(entries)
        for i in range(0, len(entries), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(entries[i : i + 100_000][c])) for c in columns], names=list(columns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for batch in batches:
            for part, ready, packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if ready:
                    yield from batch_of(_unpack(packed, kind, part))
                    continue
                if part != now and held:
                    yield from batch_of(meet(np.concatenate(held))[0])
                    held = []
                now = part
                held.append(_unpack(packed, kind, part))
        if held:
            yield from batch_of(meet(np.concatenate(held))[0])

    return dealt.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(run, ", ".join(f"{c} long" for c in columns))


def _lines(sets: LineSets, keys: np.ndarray, docs: list[int | None], digests: list[bytes]) -> np.ndarray:
    """One entry for each paragraph; ``keys``: those of the texts."""
    out = np.zeros(len(sets.text), _LINE)
    halves_ = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    out["g"], out["h"], out["n"] = halves_[:, 0], halves_[:, 1], np.diff(sets.at)
    out["known"] = np.array([d is not None for d in docs], np.uint8)[sets.text]
    out["doc"] = np.array([d or 0 for d in docs], np.int64)[sets.text]
    out["t1"], out["t2"], out["a"], out["b"] = keys[sets.text, 0], keys[sets.text, 1], sets.begin, sets.end
    return out


_PASS = "kind int, doc_id long, t1 long, t2 long, a long, b long, k binary, n long, tag long, band long, leader long, p long"
_PASS_KINDS = [pa.int32(), *[pa.int64()] * 5, pa.binary(), *[pa.int64()] * 5]
_PASS_NAMES = [f.split()[0] for f in _PASS.split(", ")]


def _pass_batches(kind: int, entries: np.ndarray) -> Iterator[pa.RecordBatch]:
    for i in range(0, len(entries), 50_000):
        some = entries[i : i + 50_000]
        if kind == 0:
            keys = np.ascontiguousarray(np.stack([some["g"], some["h"]], 1))
            columns = {"doc_id": pa.array(some["doc"], mask=some["known"] == 0), "k": pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(some), [None, pa.py_buffer(keys)]).cast(pa.binary())}
            names = {"t1": "t1", "t2": "t2", "a": "a", "b": "b", "n": "n"}
        else:
            columns, names = {}, {"tag": "k", "band": "b", "leader": "leader"} if kind == 1 else {"t1": "t1", "t2": "t2", "p": "p"}
        columns |= {"kind": pa.array(np.full(len(some), kind, np.int32))} | {to: pa.array(np.ascontiguousarray(some[c])) for to, c in names.items()}
        yield pa.RecordBatch.from_arrays([columns[c] if c in columns else pa.nulls(len(some), t) for c, t in zip(_PASS_NAMES, _PASS_KINDS, strict=True)], names=_PASS_NAMES)


def _one_pass(docs: DataFrame, text: str, least: int, words: int, bands: int, rows: int, similar: float, band_parts: int, seed_parts: int) -> DataFrame:
    """What is asked of every word, with each text split once; ``kind`` tells the rows apart.

    0: doc_id, t1, t2, a, b, k, n of every paragraph.
    1: tag, band, leader of the paragraphs that share a band key with a different one; see ``member_units``. A set goes
    by 64 bits of its key here (``xxhash64`` of it in SQL). Sets equal in these are candidates together.
    2: t1, t2, p (number of its first word) of the seeds that occur again.

    Parts are numbered through: those of the band keys, those of the seeds, and as many for the paragraphs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, minhash = WordHashes(), MinHash(bands * rows)
        held: list[list[np.ndarray]] = [[], [], []]
        sizes_held = [0, 0, 0]
        seen: set[bytes] = set()
        turn = 0

        def send(kind: int) -> pa.RecordBatch:
            nonlocal turn
            sizes_held[kind] = 0
            if kind == 1:
                return _deal(held[1], band_parts, _all_left)
            if kind == 2:
                return _deal(held[2], seed_parts, _again, band_parts)
            entries = np.concatenate(held[0])
            held[0].clear()
            turn += 1
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(([band_parts + seed_parts + (int(entries["h"][0]) + turn) % seed_parts], [True], [_pack(entries)]), _DEALT, strict=True)], schema=_DEALT)

        def add(kind: int, entries: np.ndarray) -> Iterator[pa.RecordBatch]:
            if len(entries):
                held[kind].append(entries)
                sizes_held[kind] += len(entries)
                if sizes_held[kind] > HELD:
                    yield send(kind)

        for whole in batches:
            for batch in slices(whole, "_text", 1 << 20):
                ids, texts = batch.column("doc_id").to_pylist(), raw_texts(batch.column("_text"))
                sets = LineSets(texts, least, words, known)
                keys = np.array([row_key(d, t) for d, t in zip(ids, texts, strict=True)], np.int64).reshape(-1, 2)
                digests_ = sets.keys()
                if len(sets.text):
                    yield from add(0, _lines(sets, keys, ids, digests_))
                if len(sets.ids) >= least:
                    owner = np.repeat(np.arange(len(texts)), np.diff(sets.words_at))
                    places, hashes = _seeds(sets.ids, least, owner)
                    entries = np.zeros(len(places), _SEED)
                    of = owner[places]
                    entries["h"], entries["p"], entries["t1"], entries["t2"] = hashes, places - sets.words_at[of], keys[of, 0], keys[of, 1]
                    yield from add(2, entries)
                # Another set has at best one hash more or less.
                sizes = np.diff(sets.at)
                able = (sizes >= similar * (sizes + 1) - 1e-9).tolist()
                fresh = {}
                for i, k in enumerate(digests_):
                    if able[i] and k not in seen and k not in fresh:
                        fresh[k] = i
                seen.update(fresh)
                chosen, new = np.array(list(fresh.values()), np.int64), list(fresh)
                # At most HELD entries at a time, whatever the texts of the slice.
                for i in range(0, len(chosen), HELD // bands):
                    some = chosen[i : i + HELD // bands]
                    tags = np.array([xxhash.xxh64_intdigest(k, 42) for k in new[i : i + HELD // bands]], np.uint64)
                    out = np.zeros((len(some), bands), _BAND)
                    out["h"] = band_matrix(sets.signatures(some, minhash), rows)
                    out["k"] = tags.view(np.int64)[:, None]
                    yield from add(1, out.ravel())
                if len(seen) > HELD:
                    seen.clear()
        for kind in range(3):
            if held[kind]:
                yield send(kind)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []

        def met() -> Iterator[pa.RecordBatch]:
            if held:
                yield from _pass_batches(1, _members(np.concatenate(held))[0]) if now < band_parts else _pass_batches(2, _again(np.concatenate(held))[0])

        for batch in batches:
            for part, ready, packed in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if part != now:
                    yield from met()
                    now, held = part, []
                if part >= band_parts + seed_parts:
                    yield from _pass_batches(0, _unpack(packed, _LINE, part))
                elif ready:
                    yield from _pass_batches(2, _unpack(packed, _SEED, part))
                else:
                    held.append(_unpack(packed, _BAND if part < band_parts else _SEED, part))
        yield from met()

    dealt = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("_text")).mapInArrow(run, "part int, ready boolean, packed binary")
    return dealt.repartition(seed_parts, "part").sortWithinPartitions("part").mapInArrow(gather, _PASS)


def _later_passages(texts: DataFrame, least: int, parts: int) -> DataFrame:
    """t1, t2, a, b of the passages that also stand at a smaller place, some of one text joined. ``texts``: _k0 (id), t1, t2, z, ``seeds``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, known, span = zstandard.ZstdDecompressor(), WordHashes(), least - _seed_words(least) + 1
        held, size = [], 0
        for whole in batches:
            for batch in slices(whole, "z", 1 << 18):
                docs, t1, t2, z, seeds = (batch.column(c).to_pylist() for c in ("_k0", "t1", "t2", "z", "seeds"))
                raws = [open_.decompress(x) for x in z]
                text_at = np.cumsum([0, *[len(r) + 1 for r in raws]])[:-1]
                begins, ends, ids = known.of_text(b"\n".join(raws).translate(_LINE_BYTES))
                owner = np.searchsorted(text_at, begins, "right") - 1
                words_at = np.searchsorted(begins, text_at)
                h, g = _run_digests(ids, least)
                # The seed of every passage, the same in equal ones.
                seed = _sliding(np.minimum, _seed_hashes(ids, least), span).astype(np.uint32)
                at = np.concatenate([np.array(s, np.int64) + w for s, w in zip(seeds, words_at.tolist(), strict=True)])
                change = np.zeros(len(h) + 1, np.int64)
                np.add.at(change, np.maximum(at - span + 1, 0), 1)
                np.add.at(change, np.minimum(at + 1, len(h)), -1)
                # Passages around a seed; those that run on into the next text are none.
                near = np.flatnonzero((np.cumsum(change[:-1]) > 0) & (owner[: len(h)] == owner[least - 1 :]))
                of = owner[near]
                entries = np.zeros(len(near), _PASSAGE)
                entries["h"], entries["g"], entries["s"], entries["a"], entries["b"] = h[near], g[near], seed[near], begins[near] - text_at[of], ends[near + least - 1] - text_at[of]
                entries["known"], entries["doc"] = np.array([d is not None for d in docs])[of], np.array([d or 0 for d in docs], np.int64)[of]
                entries["t1"], entries["t2"] = np.array(t1, np.int64)[of], np.array(t2, np.int64)[of]
                held.append(entries)
                size += len(entries)
                if size > HELD:
                    yield _deal(held, parts, _later)
                    held, size = [], 0
        if held:
            yield _deal(held, parts, _later)

    dealt = texts.select("_k0", "t1", "t2", "z", "seeds").mapInArrow(run, "part int, ready boolean, packed binary")
    return _meet(dealt, parts, _PASSAGE, _later, _joined, ("t1", "t2", "a", "b"))


def _merged(pieces: DataFrame) -> DataFrame:
    """t1, t2, n_paragraphs, n_runs, spans of ``pieces`` (t1, t2, cut: arrays of a, b, run)."""
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def union(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(a, kind="stable")
        a, b = a[order], np.maximum.accumulate(b[order])
        new = np.append(True, a[1:] > b[:-1])
        return a[new], b[np.append(np.flatnonzero(new)[1:] - 1, len(b) - 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column("cut")
            edges, flat = cuts.offsets.to_numpy(), cuts.values
            a, b, runs = flat.field(0).to_numpy(), flat.field(1).to_numpy(), flat.field(2).to_numpy(zero_copy_only=False)
            lines, met, spans = [], [], []
            for x, y in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                inside = runs[x:y]
                lines.append(int((~inside).sum()))
                met.append(len(union(a[x:y][inside], b[x:y][inside])[0]) if inside.any() else 0)
                spans.append([{"a": i, "b": j} for i, j in zip(*[v.tolist() for v in union(a[x:y], b[x:y])], strict=True)])
            yield pa.RecordBatch.from_arrays([batch.column("t1"), batch.column("t2"), pa.array(lines, pa.int64()), pa.array(met, pa.int64()), pa.array(spans, kind)], names=["t1", "t2", "n_paragraphs", "n_runs", "spans"])

    return pieces.select("t1", "t2", "cut").mapInArrow(run, "t1 long, t2 long, n_paragraphs long, n_runs long, spans array<struct<a:bigint,b:bigint>>")


def _unit_rows(texts: DataFrame, words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_, shingler = zstandard.ZstdDecompressor(), Shingler(words)
        for batch in batches:
            out, held = [], 0
            for z, wanted in zip(batch.column("z").to_pylist(), batch.column("wanted").to_pylist(), strict=True):
                raw = open_.decompress(z)
                for w in wanted:
                    hashes = shingler.of_text(raw[w["a"] : w["b"]]).tobytes()
                    for u in w["units"]:
                        out.append((u["uid"], u["side"], u["alone"], w["k"], b"", hashes))
                        held += len(hashes)
                        if held > 4 << 20:
                            yield unit_batch(out)
                            out, held = [], 0
            if out:
                yield unit_batch(out)

    return texts.select("z", "wanted").mapInArrow(run, UNIT_TYPE)


def find_repeats(
    docs: DataFrame, similar: float = SIMILAR, words: int = WORDS, least: int = LEAST_WORDS, text: str = "text",
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """t1, t2 (key of a row by id and text), n_paragraphs and n_runs (of passages) removed, and their sorted, merged ``spans``."""
    here = F.struct("doc_id", "t1", "t2", "a")
    small_batches(docs.sparkSession)
    least_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = docs.select(F.sum(F.octet_length(F.col(text)))).first()[0] or 0
    parts = max(least_parts, -(-size // PART_BYTES))
    found = store(_one_pass(docs, text, least, words, bands, rows, similar, max(parts, -(-size // BAND_BYTES)), parts), "paragraphs-bands-seeds")
    table = found.where("kind = 0").select("doc_id", "t1", "t2", "a", "b", "k", "n")
    members = found.where("kind = 1").select(F.col("tag").alias("k"), F.col("band").alias("b"), "leader")
    seeds = found.where("kind = 2").groupBy("t1", "t2").agg(F.collect_set("p").alias("seeds"))
    # Equal paragraphs are one from here on; a line in a third of all documents costs one row per task.
    sets = store(table.groupBy("k").agg(F.max("n").alias("n"), F.min(F.struct("doc_id", "t1", "t2", "a", "b")).alias("first"), F.count("*").alias("times")), "paragraph-sets")
    tag = F.xxhash64("k").alias("tag")
    sizes = sets.groupBy(tag).agg(F.sum("n").alias("n")).withColumnRenamed("tag", "k")
    units = member_units(members, sizes).withColumnRenamed("k", "tag")
    wanted = units.join(sets.select(tag, "k", "first"), "tag").groupBy("first.t1", "first.t2").agg(F.collect_list(F.struct("k", "first.a", "first.b", "units")).alias("wanted"))
    texts = packed_texts(docs.select("doc_id", F.col(text).alias("_t")), "_t", ["doc_id"], by="doc_id").where("z IS NOT NULL").dropDuplicates(["t1", "t2"])
    linked = store(solve_units(_unit_rows(texts.join(wanted, ["t1", "t2"]), words), similar, None), "paragraph-links")
    roots = components(linked.select("k", "root"))
    classed = sets.join(roots, "k", "left").withColumn("class", F.coalesce("root", "k"))
    owners = classed.groupBy("class").agg(F.min("first").alias("o"), F.sum("times").alias("times")).where("times > 1")
    owner = classed.select("k", "class").join(owners, "class").select("k", F.struct("o.doc_id", "o.t1", "o.t2", "o.a").alias("o"))
    gone = table.join(owner, "k").where(~here.eqNullSafe(F.col("o"))).select("t1", "t2", "a", "b")
    inside = store(_later_passages(texts.join(seeds, ["t1", "t2"]), least, parts), "later-passages")
    cut = gone.distinct().withColumn("run", F.lit(False)).unionByName(inside.withColumn("run", F.lit(True)))
    return _merged(cut.groupBy("t1", "t2").agg(F.collect_list(F.struct("a", "b", "run")).alias("cut")))


def remove_repeats(
    docs: DataFrame, similar: float = SIMILAR, words: int = WORDS, least: int = LEAST_WORDS, text: str = "text",
    bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_paragraphs and n_runs removed, ``spans`` (byte offsets, end exclusive) and ``kept`` bytes.

    n_paragraphs is what banding, verification and components removed, n_runs the runs of passages met word by word,
    n_removed both.

    A repeated paragraph or passage stays where it stands in the smallest (doc_id, text key, place), null ids first.
    Paragraphs of fewer words than a shingle (or ``least``, if smaller) and passages of fewer than ``least`` words are
    never removed, so null and empty texts stay as they are.
    Rows equal in id and text count as one document and keep the same parts.
    """
    found = find_repeats(docs, similar, words, least, text, bands, rows)
    packed = packed_texts(docs.select("doc_id", F.col(text).alias("_t")), "_t", ["doc_id"], by="doc_id")
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for whole in batches:
            for batch in slices(whole, "z", 1 << 20):
                raws = [open_.decompress(z) if z is not None else b"" for z in batch.column("z").to_pylist()]
                spans = [s or [] for s in batch.column("spans").to_pylist()]
                kept = []
                for raw, cut in zip(raws, spans, strict=True):
                    edges = [0, *[e for s in cut for e in (s["a"], s["b"])], len(raw)]
                    kept.append(b"".join([raw[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)]))
                yield pa.RecordBatch.from_arrays([batch.column("_k0"), pa.array([len(r) for r in raws], pa.int64()), batch.column("n_paragraphs"), batch.column("n_runs"), pa.array(spans, kind), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_paragraphs", "n_runs", "spans", "kept"])

    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_paragraphs", "n_runs")]
    joined = packed.join(found, ["t1", "t2"], "left").select("_k0", "z", *numbers, "spans")
    out = joined.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_paragraphs long, n_runs long, spans array<struct<a:bigint,b:bigint>>, kept binary")
    return out.withColumn("n_removed", F.col("n_paragraphs") + F.col("n_runs"))


def digests(removed: DataFrame) -> DataFrame:
    """doc_id, sizes, what went, and the digest of what remains."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["b"] - s["a"]))
    return removed.select(
        "doc_id", "n_bytes", F.col("n_removed").alias("n_passages_removed"),
        F.col("n_paragraphs").alias("n_paragraphs_removed"), F.col("n_runs").alias("n_runs_removed"), gone.alias("n_bytes_removed"), F.size("spans").cast("long").alias("n_spans"),
        "spans", F.sha2("kept", 256).alias("kept_sha256"),
    )
