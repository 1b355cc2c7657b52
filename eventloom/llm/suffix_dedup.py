"""Removal of long repeated byte strings, decided by suffix arrays.

A byte goes when it lies in a string of ``length`` bytes that also starts anywhere else. Equal strings must meet in one
task, so every window of ``length`` bytes is sent by its smallest k-gram hash (its anchor): equal windows have equal
anchors. Neighbouring windows with one anchor travel together as one stretch of text. Stretches whose anchor occurs
only once are dropped before any text moves; equal stretches are counted, so that a passage shared by a third of all
documents is looked at once; what is left is sorted.

Sorting has two stages: suffixes smaller than their successors are sorted directly, the others are induced by scanning
the buckets of their first byte. Common prefixes of neighbours in the suffix array then tell which windows repeat.
Anchors whose distinct stretches are together too long for one task take another exact way: their windows are hashed
one by one (128 bits) and counted.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import halves, mixed, packed_texts, raw_texts, slices, small_batches, store
from eventloom.operators.skew import attach_per_key

LENGTH = 400
#: Bytes of the k-grams that serve as anchors.
GRAM = 24
#: Text in one suffix array; groups of one anchor beyond HOT_BYTES are counted by hash instead.
CHUNK_BYTES = 256 << 10
HOT_BYTES = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of the ``size`` bytes from every place on, by doubling."""
    with np.errstate(over="ignore"):
        grown, have = mixed(data.astype(np.uint64) + np.uint64(1)), 1
        whole, done, power = None, 0, _BASE
        rest = size
        while rest:
            if rest & 1:
                if whole is None:
                    whole = grown.copy()
                else:
                    n = len(data) - done - have + 1
                    whole = whole[:n] * power + grown[done : done + n]
                done += have
            rest >>= 1
            if rest:
                grown = grown[: len(grown) - have] * power + grown[have:]
                power = power * power
                have *= 2
    return mixed(whole)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while 2 * have <= width:
        values = np.minimum(values[: len(values) - have], values[have:])
        have *= 2
    return np.minimum(values[: len(values) - (width - have)], values[width - have :]) if width > have else values


def stretches(texts: list[bytes], length: int, gram: int) -> list[list[tuple[int, int, int, bool]]]:
    """For every text: its runs of windows with one anchor, as (first window, number of windows, anchor, anchor met again).

    Two equal windows of one run hold the anchor at two places, so only runs that meet it again can repeat themselves.
    """
    out: list[list[tuple[int, int, int, bool]]] = [[] for _ in texts]
    long = [i for i, t in enumerate(texts) if len(t) >= length]
    if not long:
        return out
    sizes = np.array([len(texts[i]) for i in long])
    begins = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join([texts[i] for i in long]), np.uint8)
    width = length - gram + 1
    grams = gram_hashes(data, gram)
    anchors = _sliding_min(grams, width)
    inside = np.zeros(len(anchors), bool)
    breaks = np.ones(len(anchors), bool)
    breaks[1:] = anchors[1:] != anchors[:-1]
    for begin, size in zip(begins.tolist(), sizes.tolist(), strict=True):
        inside[begin : begin + size - length + 1] = True
        breaks[begin] = True
    starts = np.flatnonzero(breaks & inside)
    owner = np.searchsorted(begins, starts, "right") - 1
    ends = np.minimum(np.append(starts[1:], len(anchors)), (begins + sizes - length + 1)[owner])
    again = [end - start > width or np.count_nonzero(grams[start : end + width - 1] == anchors[start]) > 1 for start, end in zip(starts.tolist(), ends.tolist(), strict=True)]
    for o, start, end, anchor, more in zip(owner.tolist(), (starts - begins[owner]).tolist(), (ends - begins[owner]).tolist(), anchors[starts].view(np.int64).tolist(), again, strict=True):
        out[long[o]].append((start, end - start, anchor, bool(more)))
    return out


def suffix_array(text: bytes, depth: int) -> np.ndarray:
    """Starts of all suffixes in the order of their first ``depth`` bytes (at least), by two-stage sorting."""
    data = np.frombuffer(text, np.uint8)
    n = len(data)
    # A suffix is larger than its successor if the first byte that differs from the next one is larger; the last is.
    change = np.flatnonzero(data[1:] != data[:-1])
    larger = np.ones(n, bool)
    if len(change):
        following = np.searchsorted(change, np.arange(change[-1] + 1))
        at = change[following]
        larger[: change[-1] + 1] = data[at] > data[at + 1]
    smaller = np.flatnonzero(~larger)
    direct = _direct(text, smaller, depth)
    lists: list[list[np.ndarray]] = [[] for _ in range(256)]
    lists[data[n - 1]].append(np.array([n - 1]))
    heads = data[direct]
    out: list[np.ndarray] = []

    def induce(found: np.ndarray) -> None:
        before = found[found > 0] - 1
        before = before[larger[before]]
        if not len(before):
            return
        first = data[before]
        order = np.argsort(first, kind="stable")
        before, first = before[order], first[order]
        cuts = np.flatnonzero(np.diff(first)) + 1
        for part, byte in zip(np.split(before, cuts), first[np.concatenate([[0], cuts])].tolist(), strict=True):
            lists[byte].append(part)

    edges = np.searchsorted(heads, np.arange(257))
    for byte in range(256):
        while lists[byte]:  # a run of one byte induces into the bucket that is being scanned
            wave = np.concatenate(lists[byte])
            lists[byte] = []
            out.append(wave)
            induce(wave)
        own = direct[edges[byte] : edges[byte + 1]]
        if len(own):
            out.append(own)
            induce(own)
    return np.concatenate(out)


def _direct(text: bytes, starts: np.ndarray, depth: int) -> np.ndarray:
    """Sort suffixes by comparing bytes: eight at once to part them, then whole strings where those are equal."""
    padded = np.frombuffer(text + bytes(8), np.uint8)
    first = np.lib.stride_tricks.sliding_window_view(padded, 8)[starts].copy().view(">u8").ravel()
    order = np.argsort(first, kind="stable")
    starts, first = starts[order], first[order]
    cuts = np.flatnonzero(np.diff(first)) + 1
    begins, ends = np.append(0, cuts), np.append(cuts, len(starts))
    out = starts.copy()
    for a, b in zip(begins[ends - begins > 1].tolist(), ends[ends - begins > 1].tolist(), strict=True):
        out[a:b] = sorted(starts[a:b].tolist(), key=lambda p: text[p : p + depth])
    return out


def repeated_windows(text: bytes, starts: np.ndarray, length: int) -> np.ndarray:
    """Which of the windows of ``length`` bytes at ``starts`` occur at two or more of these places."""
    if len(starts) < 2:
        return np.zeros(len(starts), bool)
    rank = np.full(len(text), -1)
    order = suffix_array(text, length)
    wanted = np.zeros(len(text), bool)
    wanted[starts] = True
    order = order[wanted[order]]
    # Common prefixes of neighbours, eight bytes at a time, as far as the length asked for.
    padded = np.frombuffer(text + bytes(16), np.uint8)
    words = np.lib.stride_tricks.sliding_window_view(padded, 8)
    alive = np.arange(len(order) - 1)
    for offset in [*range(0, length - 7, 8), *([length - 8] if length % 8 else [])] if length >= 8 else []:
        same = (words[order[alive] + offset] == words[order[alive + 1] + offset]).all(1)
        alive = alive[same]
        if not len(alive):
            break
    if length < 8:
        alive = np.array([i for i in range(len(order) - 1) if text[order[i] : order[i] + length] == text[order[i + 1] : order[i + 1] + length]], int)
    hit = np.zeros(len(order), bool)
    hit[alive] = True
    hit[alive + 1] = True
    rank[order] = hit
    return rank[starts] == 1


def _runs(places: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Covered bytes of the windows at sorted ``places``, as (begin, end)."""
    if not len(places):
        return []
    cuts = np.flatnonzero(np.diff(places) > length)
    return list(zip(places[np.concatenate([[0], cuts + 1])].tolist(), (places[np.append(cuts, len(places) - 1)] + length).tolist(), strict=True))


_STRETCH = "t1 long, t2 long, pos int, n int, m long, r boolean, s1 long, s2 long"


def _stretch_table(docs: DataFrame, text: str, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for whole in batches:
            for batch in slices(whole, "_text", 1 << 18):
                texts = [t or b"" for t in raw_texts(batch.column("_text"))]
                out: list[tuple] = []
                for raw, found in zip(texts, stretches(texts, length, gram), strict=True):
                    if found:
                        key = halves(digest(raw))
                        out += [(*key, at, n, anchor, more, *halves(digest(raw[at : at + n + length - 1]))) for at, n, anchor, more in found]
                if out:
                    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=["t1", "t2", "pos", "n", "m", "r", "s1", "s2"])

    return docs.select(F.col(text).alias("_text")).mapInArrow(run, _STRETCH)


def _cut_out(joined: DataFrame, length: int) -> DataFrame:
    """The bytes of every wanted stretch: m, c, t1, t2, pos, hot, data."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            rows: list[tuple] = []
            for t1, t2, z, wanted in zip(*[batch.column(c).to_pylist() for c in ("t1", "t2", "z", "wanted")], strict=True):
                raw = open_.decompress(z)
                for w in wanted:
                    rows.append((w["m"], w["c"], t1, t2, w["pos"], w["hot"], raw[w["pos"] : w["pos"] + w["n"] + length - 1]))
                if len(rows) > 4000:
                    yield _stretch_batch(rows)
                    rows = []
            if rows:
                yield _stretch_batch(rows)

    return joined.select("t1", "t2", "z", "wanted").mapInArrow(run, "m long, c long, t1 long, t2 long, pos int, hot boolean, data binary")


def _stretch_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["m", "c", "t1", "t2", "pos", "hot", "data"])


_SPAN_SCHEMA = pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])


def _sorted_spans(content: DataFrame, length: int) -> DataFrame:
    """Covered spans of single stretches, from suffix arrays over whole groups of one anchor."""

    def solve(rows: list[tuple]) -> list[tuple]:
        begins, at, windows = [], 0, []
        for _, _, _, data in rows:
            begins.append(at)
            windows.append(np.arange(at, at + len(data) - length + 1))
            at += len(data)
        hit = repeated_windows(b"".join([r[3] for r in rows]), np.concatenate(windows), length)
        out, seen = [], 0
        for (c, (t1, t2), pos, data), places in zip(rows, windows, strict=True):
            own = np.flatnonzero(hit[seen : seen + len(places)])
            seen += len(places)
            if c == 1:
                out += [(t1, t2, pos + a, pos + b) for a, b in _runs(own, length)]
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group: list[tuple] = []
        chunk: list[tuple] = []
        size, group_size, anchor = 0, 0, None
        for batch in batches:
            for m, c, t1, t2, pos, data in zip(*[batch.column(x).to_pylist() for x in ("m", "c", "t1", "t2", "pos", "data")], strict=True):
                if m != anchor:
                    if size and size + group_size > CHUNK_BYTES:
                        if out := solve(chunk):
                            yield _span_batch(out)
                        chunk, size = [], 0
                    chunk += group
                    size += group_size
                    group, group_size, anchor = [], 0, m
                group.append((c, (t1, t2), pos, data))
                group_size += len(data)
        chunk += group
        if chunk and (out := solve(chunk)):
            yield _span_batch(out)

    return content.select("m", "c", "t1", "t2", "pos", "data").repartition("m").sortWithinPartitions("m").mapInArrow(run, "t1 long, t2 long, a long, b long")


def _span_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], schema=_SPAN_SCHEMA)


def _counted_spans(content: DataFrame, length: int) -> DataFrame:
    """The same for anchors with very many distinct stretches: windows are hashed and counted, before and after the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_128_digest
        for whole in batches:
            for batch in slices(whole, "data", 1 << 17):
                parts = []
                for c, t1, t2, pos, data in zip(*[batch.column(x).to_pylist() for x in ("c", "t1", "t2", "pos", "data")], strict=True):
                    count = len(data) - length + 1
                    keys = np.frombuffer(b"".join([digest(data[i : i + length]) for i in range(count)]), np.int64).reshape(-1, 2)
                    parts.append((keys, np.full(count, min(c, 2)), np.full(count, t1), np.full(count, t2), pos + np.arange(count)))
                keys = np.concatenate([p[0] for p in parts])
                yield pa.RecordBatch.from_arrays([pa.array(keys[:, 0]), pa.array(keys[:, 1]), *[pa.array(np.concatenate([p[k] for p in parts]), pa.int64()) for k in range(1, 5)]], names=["h1", "h2", "c", "t1", "t2", "p"])

    windows = content.select("c", "t1", "t2", "pos", "data").mapInArrow(run, "h1 long, h2 long, c long, t1 long, t2 long, p long")
    windows = store(windows, "hot-windows")
    # The counts of the commonest windows go to the rows, so that one window's rows never meet in a task.
    times = windows.groupBy("h1", "h2").agg(F.sum("c").alias("all"), F.count("*").alias("rows"))
    return attach_per_key(windows.where("c = 1"), times, ["h1", "h2"], "rows", ["all"]).where(F.col("all") > 1).groupBy("t1", "t2", (F.col("p") / 4096).cast("int").alias("part")).agg(
        F.array_sort(F.collect_set("p")).alias("ps")
    ).select("t1", "t2", F.explode(F.expr(f"transform(filter(sequence(0, size(ps) - 1), i -> i = 0 OR ps[i] > ps[i - 1] + 1), i -> ps[i])")).alias("a"), "ps").select(
        "t1", "t2", "a", F.expr(f"a + {length} + aggregate(ps, 0L, (n, p) -> CASE WHEN p = a + n THEN n + 1 ELSE n END) - 1").alias("b")
    )


def find_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", hot_bytes: int = HOT_BYTES) -> DataFrame:
    """t1, t2 (key of a text) and its sorted, merged ``spans`` of bytes that go; texts without such bytes have no row."""
    gram = min(gram, length)
    small_batches(docs.sparkSession)
    table = store(_stretch_table(docs, text, length, gram), "stretches")
    shared = table.groupBy("m").agg(F.count("*").alias("_n"), F.max("r").alias("_r")).where("_n > 1 OR _r").select(F.col("m").alias("_m"))
    left = store(table.join(shared, table.m == shared._m).drop("_m"), "shared-stretches")
    distinct = store(left.groupBy("m", "s1", "s2").agg(F.count("*").alias("c"), F.min(F.struct("t1", "t2", "pos")).alias("at"), F.max("n").alias("n"), F.max("r").alias("r")), "distinct-stretches")
    groups = distinct.groupBy("m").agg(F.count("*").alias("d"), F.sum(F.col("n") + (length - 1)).alias("bytes"), F.max("r").alias("_r")).where("d > 1 OR _r").select(F.col("m").alias("_m"), (F.col("bytes") > hot_bytes).alias("hot"))
    wanted = distinct.join(groups, distinct.m == groups._m).groupBy("at.t1", "at.t2").agg(F.collect_list(F.struct("m", "c", F.col("at.pos").alias("pos"), "n", "hot")).alias("wanted"))
    texts = packed_texts(docs, text, []).where("z IS NOT NULL").dropDuplicates(["t1", "t2"])
    content = store(_cut_out(texts.join(wanted, ["t1", "t2"]), length), "stretch-bytes")
    several = distinct.where("c > 1").select("s1", "s2", F.col("m").alias("_m"))
    whole = left.join(several, ["s1", "s2"]).select("t1", "t2", F.col("pos").cast("long").alias("a"), (F.col("pos") + F.col("n") + (length - 1)).cast("long").alias("b")).distinct()
    spans = whole.unionByName(_sorted_spans(content.where("NOT hot"), length))
    if not content.where("hot").isEmpty():
        spans = spans.unionByName(_counted_spans(content.where("hot"), length))
    merged = F.expr(
        "aggregate(array_sort(collect_list(struct(a, b))), cast(array() as array<struct<a:bigint,b:bigint>>), (x, r) -> CASE"
        " WHEN size(x) > 0 AND r.a <= element_at(x, -1).b THEN concat(slice(x, 1, size(x) - 1), array(named_struct("
        "'a', element_at(x, -1).a, 'b', greatest(element_at(x, -1).b, r.b)))) ELSE concat(x, array(r)) END)"
    )
    return spans.groupBy("t1", "t2").agg(merged.alias("spans"))


def _remove(raw: bytes, spans: list[dict]) -> bytes:
    kept, at = [], 0
    for span in spans:
        kept.append(raw[at : span["a"]])
        at = span["b"]
    return b"".join([*kept, raw[at:]])


def _with_spans(docs: DataFrame, text: str, keep: list[str], length: int, gram: int, hot_bytes: int) -> DataFrame:
    found = find_repeats(docs, length, gram, text, hot_bytes)
    return packed_texts(docs, text, keep).join(found, ["t1", "t2"], "left")


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", keep: tuple[str, ...] = ("doc_id",),
    hot_bytes: int = HOT_BYTES,
) -> DataFrame:
    """``keep``, n_bytes, ``spans`` removed (byte offsets, end exclusive) and ``kept``, the bytes that remain.

    Judged on the input: all places of a repeated string go. Null and empty texts, and texts below ``length`` bytes,
    stay as they are. Equal texts of at least that length vanish wholly. Strings never cross documents.
    """
    names = list(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
        for whole in batches:
            for batch in slices(whole, "z", 1 << 20):
                raws = [open_.decompress(z) if z is not None else b"" for z in batch.column("z").to_pylist()]
                spans = [s or [] for s in batch.column("spans").to_pylist()]
                kept = [_remove(r, s) for r, s in zip(raws, spans, strict=True)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array([len(r) for r in raws], pa.int64()), pa.array(spans, kind), pa.array(kept, pa.binary())], names=[*names, "n_bytes", "spans", "kept"])

    joined = _with_spans(docs, text, names, length, gram, hot_bytes).select(*[f"_k{i}" for i in range(len(names))], "z", "spans")
    kinds = [f"`{n}` {docs.schema[n].dataType.simpleString()}" for n in names]
    return joined.mapInArrow(run, ", ".join([*kinds, "n_bytes long, spans array<struct<a:bigint,b:bigint>>, kept binary"]))


def digests(removed: DataFrame) -> DataFrame:
    """doc_id, sizes, number of removed spans, the digest of what remains, and that as text (cut characters become U+FFFD)."""
    gone = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["b"] - s["a"]))
    return removed.select(
        "doc_id", "n_bytes", gone.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"), F.make_valid_utf8(F.col("kept").cast("string")).alias("text"),
    )


def rewrite(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, hot_bytes: int = HOT_BYTES) -> DataFrame:
    """``docs`` with the repeated strings taken out of ``text`` and ``n_chars`` set to what is left.

    A character that a span cuts in two goes wholly. Rows whose text vanishes are left out; null texts stay.
    """
    every = docs.columns
    names = [c for c in every if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_ = zstandard.ZstdDecompressor()
        for whole in batches:
            for batch in slices(whole, "z", 1 << 20):
                texts, stays = [], []
                for z, spans in zip(batch.column("z").to_pylist(), batch.column("spans").to_pylist(), strict=True):
                    texts.append(None if z is None else _remove(open_.decompress(z), spans or []).decode("utf-8", "ignore"))
                    stays.append(texts[-1] != "" or not spans)
                columns = {n: batch.column(f"_k{i}") for i, n in enumerate(names)} | {"text": pa.array(texts, pa.string())}
                if "n_chars" in columns:
                    columns["n_chars"] = pa.array([None if t is None else len(t) for t in texts], pa.int64())
                yield pa.RecordBatch.from_arrays([columns[c] for c in every], names=every).filter(pa.array(stays, pa.bool_()))

    joined = _with_spans(docs, "text", names, length, gram, hot_bytes)
    return joined.select(*[f"_k{i}" for i in range(len(names))], "z", "spans").mapInArrow(run, docs.schema)
