"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Test strings are the runs of ``window`` consecutive words of a benchmark item (a shorter item is one string). Texts and
strings become word numbers. A shift table over blocks of two words tells how far the search may jump without missing
a string; only blocks that end a string's leading part stop it. There a hashed suffix bucket gives the few strings to
compare word by word.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import raw_texts, slices, store, text_first, words_of

BLOCK = 2
#: Text bytes of the benchmark rows searched for at a time. A larger benchmark is searched in several such blocks.
BLOCK_BYTES = 16 << 20


class WuManber:
    """Search for strings of words, all of one length."""

    def __init__(self, strings: dict[tuple[int, ...], list[int]], length: int) -> None:
        self.length = length
        self.block = min(BLOCK, length)
        self.jump = length - self.block + 1
        self.shift: dict[tuple[int, ...], int] = {}
        self.buckets: dict[tuple[int, ...], list[tuple[tuple[int, ...], list[int]]]] = {}
        for words, owners in strings.items():
            for end in range(self.block, length + 1):
                part = words[end - self.block : end]
                left = length - end
                if left < self.shift.get(part, self.jump):
                    self.shift[part] = left
            self.buckets.setdefault(words[length - self.block :], []).append((words, owners))

    def search(self, text: list[int]) -> Iterator[tuple[int, list[int]]]:
        """(start, owners) of every occurrence; 0 stands for a word of no string."""
        n, block, jump, length = len(text), self.block, self.jump, self.length
        shift, buckets = self.shift.get, self.buckets
        at = length  # the end of the place looked at
        while at <= n:
            if not text[at - 1]:  # a word of no string: every place that holds it is impossible
                at += length
                continue
            part = tuple(text[at - block : at])
            step = shift(part, jump)
            if step:
                at += step
                continue
            for words, owners in buckets.get(part, ()):
                if tuple(text[at - length : at]) == words:
                    yield at - length, owners
            at += 1


class Matcher:
    """Strings of several items, grouped by length."""

    def __init__(self, items: list[tuple[object, bytes | None]], window: int) -> None:
        self.numbers: dict[bytes, int] = {}
        by_length: dict[int, dict[tuple[int, ...], list[int]]] = {}
        self.items = [item for item, _ in items]
        for k, (_, text) in enumerate(items):
            words = tuple(self.numbers.setdefault(w, len(self.numbers) + 1) for w in words_of(text))
            if not words:
                continue
            length = min(window, len(words))
            strings = by_length.setdefault(length, {})
            for i in range(len(words) - length + 1):
                owners = strings.setdefault(words[i : i + length], [])
                if not owners or owners[-1] != k:
                    owners.append(k)
        self.searches = [WuManber(s, n) for n, s in sorted(by_length.items())]

    def scan(self, text: bytes | None) -> tuple[int, list[tuple[int, int]], set[int]]:
        """Number of words, maximal runs of hit words as (start, end), and the items found."""
        get = self.numbers.get
        words = [get(w, 0) for w in words_of(text)]
        runs, found = [], set()
        for search in self.searches:
            for start, owners in search.search(words):
                runs.append((start, start + search.length))
                found.update(owners)
        merged: list[tuple[int, int]] = []
        for start, end in sorted(runs):
            if merged and start <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(end, merged[-1][1]))
            else:
                merged.append((start, end))
        return len(words), merged, found


def _blocks(benchmark: DataFrame, item: str, text: str, most_bytes: int) -> Iterator[list[tuple[object, bytes | None]]]:
    """The benchmark in blocks of bounded size, one at a time on the driver. An item with null or no text gives no string."""
    rows = benchmark.select(F.col(item).cast("string").alias("i"), F.col(text).alias("t")).where("t IS NOT NULL").distinct()
    block, size = [], 0
    for row in rows.toLocalIterator():
        raw = row.t.encode()
        if block and size + len(raw) > most_bytes:
            yield block
            block, size = [], 0
        block.append((row.i, raw))
        size += len(raw)
    yield block


SCAN_TYPE = "n_words long, runs array<struct<first:int,end:int>>, items array<string>"
_RUNS = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))


def scan(docs: DataFrame, matcher, text: str = "text", keep: tuple[str, ...] = ("doc_id",), number: int = 0) -> DataFrame:
    """``keep``, n_words, hit runs and sorted items of every document for one block of strings (a broadcast Matcher)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = matcher.value
        for whole in batches:
            for batch in slices(whole, 0):
                found = [search.scan(t) for t in raw_texts(batch.column(0))]
                items = [sorted({search.items[k] for k in f} - {None}) + [None] * (None in {search.items[k] for k in f}) for _, _, f in found]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[1:], pa.array([n for n, _, _ in found], pa.int64()),
                     pa.array([[{"first": a, "end": b} for a, b in runs] for _, runs, _ in found], _RUNS), pa.array(items, pa.list_(pa.string()))],
                    names=[*keep, "n_words", "runs", "items"],
                )

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema] + [SCAN_TYPE])
    return text_first(docs, text, keep).mapInArrow(run, schema)


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", item: str = "item_id",
    item_text: str = "text", keep: tuple[str, ...] = ("doc_id",), block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """For every document: n_words, hit ``runs`` of words (from 0, end exclusive, maximal), and the ``items`` found in it.

    Null texts have no words and no hits; a null item id is kept as null in ``items``; equal item ids count once; a
    benchmark without words finds nothing. Repeated documents give repeated rows. Each block of strings is broadcast: its size is bounded by
    ``block_bytes``. For several blocks every document is scanned once per block and the answers are united by its key
    and text, first within tasks.
    """
    spark, blocks = docs.sparkSession, _blocks(benchmark, item, item_text, block_bytes)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        return scan(docs, spark.sparkContext.broadcast(Matcher(block, window)), text, keep)
    # Copies of a row meet in one group and are put out again as often as they came in.
    marked = docs.select(*keep, text, F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("_digest"), F.col(text).isNull().alias("_none"))
    key = [*keep, "_digest", "_none"]
    parts = []
    for block in chain([block, following], blocks):
        # The hits of a block are written before the next one is built, so the driver holds one matcher at a time.
        matcher = spark.sparkContext.broadcast(Matcher(block, window))
        parts.append(store(scan(marked, matcher, text, tuple(key)), "hits"))
        matcher.destroy()
    copies = marked.groupBy(*key).agg(F.count("*").alias("_copies"))
    every = reduce(DataFrame.unionByName, parts).groupBy(*key).agg(
        F.max("n_words").alias("n_words"), F.array_distinct(F.flatten(F.collect_set("runs"))).alias("runs"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    same = reduce(lambda a, b: a & b, [copies[k].eqNullSafe(every[k]) for k in key])
    merged = F.expr(
        "aggregate(array_sort(runs), cast(array() as array<struct<first:int,end:int>>), (a, r) -> CASE"
        " WHEN size(a) > 0 AND r.first <= element_at(a, -1).end THEN concat(slice(a, 1, size(a) - 1),"
        " array(named_struct('first', element_at(a, -1).first, 'end', greatest(element_at(a, -1).end, r.end))))"
        " ELSE concat(a, array(r)) END)"
    )
    united = copies.join(every, same).select(*[copies[k] for k in keep], "n_words", merged.alias("runs"), "items", "_copies")
    return united.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies")))).drop("_copies", "_copy")


def digests(scanned: DataFrame) -> DataFrame:
    """The counts and digests of the search result: one row per document."""
    n_hit = F.aggregate("runs", F.lit(0).cast("long"), lambda a, r: a + (r["end"] - r["first"]))
    return scanned.select("doc_id", "n_words", n_hit.alias("n_hit"), "items").select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def kept_documents(
    docs: DataFrame, benchmark: DataFrame, window: int = 10, text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """The rows of ``docs`` in which no test string occurs, unchanged.

    Each block of strings takes one pass; what a pass keeps is written before the next block is built. Null texts and
    rows that repeat stay as they are.
    """
    out, spark, blocks = docs, docs.sparkSession, _blocks(benchmark, "item_id", "text", block_bytes)
    following = next(blocks)
    while following is not None:
        block, following = following, next(blocks, None)
        matcher = spark.sparkContext.broadcast(Matcher(block, window))

        def run(batches: Iterator[pa.RecordBatch], matcher=matcher) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in slices(whole, text):
                    clean = [not matcher.value.scan(t)[1] for t in raw_texts(batch.column(text))]
                    yield batch.filter(pa.array(clean, pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
        if following is not None:
            out = store(out, "clean")
            matcher.destroy()
    return out


ORACLE = r"""
WITH alphabet AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM documents, alphabet),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
      FROM benchmark, alphabet),
windows AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
            FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
                  FROM (SELECT *, least(10, len(w)) AS n FROM b WHERE len(w) > 0))),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS gram
           FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths)),
hits AS (SELECT p.doc_id, p.n, p.i, x.item_id FROM places p JOIN windows x ON p.n = x.n AND p.gram = x.gram),
words AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS items_sha256
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""
