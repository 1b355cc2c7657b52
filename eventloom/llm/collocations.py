"""Phrases of two to four words that stand together far more often than their parts: the best of every language.

The score of a phrase is the lowest ``2000000 * a / (l + r)`` over its cuts. All phrases that begin with a prefix p have
a <= f(p), and cutting after the first word gives l = f(first word), so none of them scores above
``2000000 * f(p) / (f(first word) + f(p))``: the counts of prefixes give a bound that holds for everything below them.

Words and pairs of frequent words are counted first. Longer phrases grow best first: in each round the prefixes with the
highest bounds of every language are expanded, and one scan of the corpus counts the phrases that begin with them. The
same scan counts what still has to be known of the best phrases: the phrases that contain them by one more word on the
left (a phrase is dropped when a longer one has 80 % of its count), and parts whose counts a cut needs. A longer phrase
by two words has at least one between that is as frequent, so one word more on either side decides. The search ends
when no open bound or score of a language reaches the score of its 2000th settled survivor, ties included.

Scans get bitmaps of hashed phrases: 16 bits an entry and 32 MB at most. A wrong hit costs a needless count and nothing
else, since whether a phrase is counted depends on the phrase alone; counts are taken by the phrase itself.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from eventloom.llm.common import mixed, raw_texts, slices, store

LEAST = 30
LISTED = 2000
#: Prefixes expanded per language in the first round; each later round takes ``GROWTH`` times as many.
FIRST, GROWTH = 20_000, 8
#: Words in one counting batch, different words that a task remembers, and phrases in one batch that it hands on.
BATCH_WORDS, HELD, HANDED = 1_000_000, 400_000, 100_000
BITS_PER_ENTRY, MOST_BITS = 16, 28
_PAGE = 1 << 15
#: A-Z lower-cased; the characters that end a piece become line feeds, tabs become spaces.
_PIECES = bytes(c + 32 if 65 <= c <= 90 else 10 if c in b".,;:!?\n\x0b\x0c\r" else 32 if c == 9 else c for c in range(256))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_COUNTED = "lang string, m int, phrase string, n long"


#: Stands between pieces; no UTF-8 text has this byte.
_BORDER = b"\xff"


def words_of_pieces(raw: bytes) -> list[bytes]:
    """The words of a text, with a border wherever a piece ends."""
    return raw.translate(_PIECES).replace(b"\n", b" " + _BORDER + b" ").split()


def _word_hash(lang: str, word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(lang.encode() + b"\n" + word)


def _follow(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase from the hash of all but its last word and that of the last word."""
    with np.errstate(over="ignore"):
        return mixed(before * _STEP + word)


class Bitmap:
    """Which hashes may be in a set."""

    def __init__(self, bits: int, pages: dict[int, bytes]) -> None:
        self.shift = np.uint64(64 - bits)
        self.cells = np.zeros(max(1 << bits, _PAGE) // 8, np.uint8)
        for page, cells in pages.items():
            self.cells[page * _PAGE // 8 : (page + 1) * _PAGE // 8] = np.frombuffer(cells, np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = hashes >> self.shift
        return (self.cells[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def has_one(self, value: int) -> bool:
        at = value >> int(self.shift)
        return bool(self.cells[at >> 3] >> (at & 7) & 1)


def phrase_hashes(phrases: DataFrame) -> DataFrame:
    """The hash of every (lang, phrase), as the scans compute it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, phrase in zip(batch.column(0).to_pylist(), raw_texts(batch.column(1)), strict=True):
                hashes = np.array([_word_hash(lang, w) for w in phrase.split(b" ")], np.uint64)
                out.append(reduce(_follow, [hashes[i : i + 1] for i in range(len(hashes))])[0])
            yield pa.RecordBatch.from_arrays([pa.array(np.array(out, np.uint64).view(np.int64))], names=["h"])

    return phrases.select("lang", "phrase").mapInArrow(run, "h long")


def bitmap(phrases: DataFrame, most_bits: int = MOST_BITS) -> Bitmap:
    """A bitmap of a stored table of phrases; its bound of ``2 ** most_bits`` bits does not depend on the table."""
    bits = min(most_bits, max(16, (BITS_PER_ENTRY * phrases.count()).bit_length()))
    place = F.shiftrightunsigned("h", 64 - bits)
    pages = phrase_hashes(phrases).select(place.alias("p")).groupBy(F.expr(f"p div {_PAGE}").alias("page")).agg(
        F.bitmap_construct_agg(F.expr(f"p % {_PAGE}")).alias("cells")
    )
    return Bitmap(bits, {r.page: bytes(r.cells) for r in pages.collect()})


def _source(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("text"), F.lit("")).alias("text"), F.coalesce(F.col("lang"), F.lit("und")).alias("lang"))


def word_counts(docs: DataFrame) -> DataFrame:
    """lang, phrase (one word), f."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for lang, words in seen.items():
                every = list(words.items())
                for i in range(0, len(every), HANDED):
                    names, n = zip(*every[i : i + HANDED], strict=True)
                    yield pa.RecordBatch.from_arrays([pa.array([lang] * len(n), pa.string()), pa.array(names, pa.binary()).cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "n"])
            seen.clear()

        for whole in batches:
            for batch in slices(whole, "text"):
                for lang, raw in zip(batch.column("lang").to_pylist(), raw_texts(batch.column("text")), strict=True):
                    seen.setdefault(lang, Counter()).update(raw.translate(_PIECES).split())
                if sum(map(len, seen.values())) > HELD:
                    yield from counted()
        yield from counted()

    return _source(docs).mapInArrow(run, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("f"))


class _Words(dict):
    """Numbers of the frequent words of one language in a task; 0 for all others."""

    def __init__(self, lang: str, frequent: Bitmap, names: list[bytes], langs: list[str], hashes: list[int]) -> None:
        super().__init__({_BORDER: 0})
        self.lang, self.frequent, self.names, self.langs, self.hashes = lang, frequent, names, langs, hashes

    def __missing__(self, word: bytes) -> int:
        value, number = _word_hash(self.lang, word), 0
        if self.frequent.has_one(value):
            number = len(self.names)
            self.names.append(word)
            self.langs.append(self.lang)
            self.hashes.append(value)
        self[word] = number
        return number


def _counted_rows(ids: np.ndarray, at: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The different runs of ``m`` numbers from the given places, and how often each occurs."""
    if m == 2:
        codes, times = np.unique(ids[at] << 32 | ids[at + 1], return_counts=True)  # a plain sort of one column
        return np.stack([codes >> 32, codes & 0xFFFFFFFF], 1), times
    rows = np.stack([ids[at + k] for k in range(m)], 1)
    order = np.lexsort(rows.T[::-1])
    rows = rows[order]
    begins = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(1))) if len(rows) else np.zeros(0, np.int64)
    return rows[begins], np.diff(np.append(begins, len(rows)))


def _wanted_places(ids: np.ndarray, hashes: np.ndarray, sets: dict[str, Bitmap]) -> Iterator[tuple[int, np.ndarray]]:
    """Lengths and begins of the phrases to count in a row of word numbers."""
    word = hashes[ids]
    known = ids > 0
    two = known[:-1] & known[1:]
    if "pairs" not in sets:
        yield 2, np.flatnonzero(two)
        return
    pair = _follow(word[:-1], word[1:])
    two &= sets["pairs"].has(pair)
    at = np.flatnonzero(two[:-1] & two[1:])
    three = _follow(pair[at], word[at + 2])
    yield 3, at[sets["expand"].has(pair[at]) | sets["precede"].has(pair[at + 1]) | sets["count"].has(three)]
    inner = np.flatnonzero((at[1:] == at[:-1] + 1)) if len(at) > 1 else np.zeros(0, np.int64)
    yield 4, at[inner[sets["expand"].has(three[inner]) | sets["precede"].has(three[inner + 1])]]


def phrase_counts(docs: DataFrame, sets: dict[str, Bitmap], batch_words: int = BATCH_WORDS) -> DataFrame:
    """lang, m, phrase, f: all pairs of frequent words (``sets`` has only words), or the phrases that ``sets`` ask for.

    ``expand``: what begins with these; ``precede``: what has one word before these; ``count``: these themselves.
    """
    shared = docs.sparkSession.sparkContext.broadcast(sets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = shared.value
        words: dict[str, _Words] = {}
        names: list[bytes] = [b""]
        langs: list[str] = [""]
        hashes: list[int] = [0]
        row: list[int] = []

        def counted() -> Iterator[pa.RecordBatch]:
            ids = np.array([0, *row, 0, 0, 0], np.int64)
            row.clear()
            words_, langs_ = pa.array(names, pa.binary()).cast(pa.string()), pa.array(langs, pa.string())
            for m, at in _wanted_places(ids, np.array(hashes, np.uint64), asked):
                every, times = _counted_rows(ids, at, m)
                for i in range(0, len(every), HANDED):
                    some, n = every[i : i + HANDED], times[i : i + HANDED]
                    phrases = pc.binary_join_element_wise(*[words_.take(pa.array(some[:, k])) for k in range(m)], " ")
                    yield pa.RecordBatch.from_arrays([langs_.take(pa.array(some[:, 0])), pa.array(np.full(len(n), m, np.int32)), phrases, pa.array(n, pa.int64())], names=["lang", "m", "phrase", "n"])

        for whole in batches:
            for batch in slices(whole, "text"):
                for lang, raw in zip(batch.column("lang").to_pylist(), raw_texts(batch.column("text")), strict=True):
                    if lang not in words:
                        words[lang] = _Words(lang, asked["words"], names, langs, hashes)
                    row.extend(map(words[lang].__getitem__, words_of_pieces(raw)))
                    row.append(0)
                full = sum(map(len, words.values())) > HELD
                if full or len(row) > batch_words:
                    yield from counted()
                if full:
                    words.clear()
                    del names[1:], langs[1:], hashes[1:]
        yield from counted()

    return _source(docs).mapInArrow(run, _COUNTED).groupBy("lang", "m", "phrase").agg(F.sum("n").alias("f"))


def _part(first: int, last: int) -> Column:
    """Words ``first`` to ``last`` (from 1) of a phrase."""
    return F.array_join(F.slice(F.split("phrase", " "), first, last - first + 1), " ")


def _with_count(rows: DataFrame, counts: DataFrame, part: Column, into: str) -> DataFrame:
    """``rows`` with the count of a part of their phrase; null where it is not known."""
    side = counts.select(F.col("lang").alias("_lang"), F.col("phrase").alias("_part"), F.col("f").alias(into))
    return rows.withColumn("_at", part).join(side, (F.col("lang") == F.col("_lang")) & (F.col("_at") == F.col("_part")), "left").drop("_lang", "_part", "_at")


def _scored(rows: DataFrame, cuts: list[tuple[str, str]]) -> DataFrame:
    """``rows`` with score, l, r of the lowest cut, ``bound`` for all that begins with them, and ``sure``: no count is missing.

    A cut with a missing count is left out, so the score can only fall when the count comes in.
    """
    value = lambda l, r: F.expr(f"CASE WHEN {l} IS NOT NULL AND {r} IS NOT NULL THEN 2000000 * cast(f AS decimal(20,0)) div ({l} + {r}) END")
    made = [F.struct(value(l, r).alias("score"), F.lit(k).alias("k"), F.col(l).alias("l"), F.col(r).alias("r")) for k, (l, r) in enumerate(cuts)]
    usable = F.filter(F.array(*made), lambda c: c["score"].isNotNull())
    sure = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in dict.fromkeys(x for cut in cuts for x in cut)])
    best = rows.withColumn("_best", F.array_min(usable))
    return best.select(
        "lang", "m", "phrase", "f", F.col("_best.score").alias("score"), F.col("_best.l").alias("l"), F.col("_best.r").alias("r"),
        F.expr("2000000 * cast(f AS decimal(20,0)) div (f1 + f)").alias("bound"), sure.alias("sure"),
    )


def _highest(rows: DataFrame, value: str, most: int) -> DataFrame:
    """lang and the ``most``-th highest value of it (``cut``), -1 where there are fewer; sorts distinct values only, a million at most."""
    down = Window.partitionBy("lang").orderBy(F.desc(value))
    counted = rows.groupBy("lang", value).agg(F.count("*").alias("_n")).withColumn("_upto", F.sum("_n").over(down))
    return counted.groupBy("lang").agg(F.coalesce(F.max(F.when(F.col("_upto") >= most, F.col(value))), F.lit(-1)).alias("cut"))


def _at_least(rows: DataFrame, value: str, cuts: DataFrame) -> DataFrame:
    """Rows whose value reaches the cut of their language; all rows of languages without one."""
    side = cuts.select(F.col("lang").alias("_lang"), "cut")
    return rows.join(side, F.col("lang") == F.col("_lang"), "left").where(F.col("cut").isNull() | (F.col(value) >= F.col("cut"))).drop("_lang", "cut")


def _first_rows(rows: DataFrame, most: int) -> DataFrame:
    """The first ``most`` rows of each language with their rank; taken in parts first, so that no task sees a whole language."""
    order = [F.desc("score"), F.desc("f"), F.col("phrase")]
    part = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order)
    some = rows.withColumn("_place", F.row_number().over(part)).where(F.col("_place") <= most)
    return some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= most).drop("_place")


class _Search:
    """The tables of one search: counts known so far, and what has been expanded, preceded and asked for."""

    def __init__(self, docs: DataFrame, least: int, listed: int, batch_words: int) -> None:
        self.docs, self.least, self.listed, self.batch_words = docs, least, listed, batch_words
        every = store(word_counts(docs), "words")
        self.totals = every.groupBy("lang").agg(F.sum("f").alias("n"))
        self.words = store(every.where(F.col("f") >= least), "frequent-words")
        self.sets = {"words": bitmap(self.words)}
        pairs = self._counted()
        pairs = _with_count(_with_count(pairs, self.words, _part(1, 1), "f1"), self.words, _part(2, 2), "f2")
        self.two = store(_scored(pairs, [("f1", "f2")]), "pairs")
        self.sets["pairs"] = bitmap(self.two)
        spark: SparkSession = docs.sparkSession
        self.three = self.four = spark.createDataFrame([], "lang string, m int, phrase string, f long")
        self.done = {k: spark.createDataFrame([], "lang string, phrase string") for k in ("expand", "precede", "count")}

    def _counted(self) -> DataFrame:
        return phrase_counts(self.docs, self.sets, self.batch_words).where(F.col("f") >= self.least)

    def candidates(self) -> DataFrame:
        """All phrases known so far, with what is known of their scores and whether a longer one drops them."""
        three = self.three
        for part, counts, into in ((_part(1, 1), self.words, "f1"), (_part(3, 3), self.words, "f3"), (_part(1, 2), self.two, "f12"), (_part(2, 3), self.two, "f23")):
            three = _with_count(three, counts, part, into)
        four = self.four
        for part, counts, into in (
            (_part(1, 1), self.words, "f1"), (_part(4, 4), self.words, "f4"), (_part(1, 2), self.two, "f12"), (_part(3, 4), self.two, "f34"),
            (_part(1, 3), self.three, "f123"), (_part(2, 4), self.three, "f234"),
        ):
            four = _with_count(four, counts, part, into)
        rows = self.two.unionByName(_scored(three, [("f1", "f23"), ("f12", "f3")])).unionByName(
            _scored(four, [("f1", "f234"), ("f12", "f34"), ("f123", "f4")])
        )
        longer = self.three.select("lang", "f", _part(1, 2).alias("p"), _part(2, 3).alias("s")).unionAll(self.four.select("lang", "f", _part(1, 3), _part(2, 4)))
        around = longer.select("lang", F.explode(F.array("p", "s")).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("f"))
        rows = _with_count(rows, around, F.col("phrase"), "around")
        for kind in ("expand", "precede"):
            rows = _with_count(rows, self.done[kind].withColumn("f", F.lit(True)), F.col("phrase"), kind)
        dropped = F.coalesce(5 * F.col("around") >= 4 * F.col("f"), F.lit(False))
        settled = F.col("sure") & ((F.col("m") == 4) | (F.col("expand").isNotNull() & F.col("precede").isNotNull()))
        return rows.withColumn("dropped", dropped).withColumn("settled", settled)

    def round(self, most: int) -> DataFrame | None:
        """Expand the best open prefixes; the settled survivors that lead when nothing is open any more."""
        rows = store(self.candidates(), "candidates")
        survivors = rows.where("settled AND NOT dropped")
        bar = store(_highest(survivors, "score", self.listed), "bar")
        open_ = {
            "expand": _at_least(rows.where("m < 4 AND expand IS NULL"), "bound", bar).withColumnRenamed("bound", "height"),
            "precede": _at_least(rows.where("m < 4 AND precede IS NULL AND NOT dropped"), "score", bar).withColumnRenamed("score", "height"),
            "count": _at_least(rows.where("m = 4 AND NOT sure"), "score", bar).withColumnRenamed("score", "height").withColumn(
                "phrase", F.explode(F.array(_part(1, 3), _part(2, 4)))
            ),
        }
        asked = {}
        for kind, wanted in open_.items():
            wanted = wanted.select("lang", "phrase", "height").join(self.done[kind], ["lang", "phrase"], "left_anti")
            wanted = store(wanted.groupBy("lang", "phrase").agg(F.max("height").alias("height")), f"open-{kind}")
            asked[kind] = store(_at_least(wanted, "height", _highest(wanted, "height", most)).select("lang", "phrase"), f"asked-{kind}")
        if not any(t.head(1) for t in asked.values()):
            return _at_least(survivors, "score", bar)
        self.sets |= {kind: bitmap(t) for kind, t in asked.items()}
        found = store(self._counted(), "phrases")
        for name, m in (("three", 3), ("four", 4)):
            both = getattr(self, name).unionByName(found.where(F.col("m") == m))
            setattr(self, name, store(both.groupBy("lang", "m", "phrase").agg(F.max("f").alias("f")), name))
        self.done = {kind: store(self.done[kind].unionByName(t), f"done-{kind}") for kind, t in asked.items()}
        return None


def collocations(
    docs: DataFrame, least: int = LEAST, listed: int = LISTED, first: int = FIRST, growth: int = GROWTH, batch_words: int = BATCH_WORDS
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``listed`` surviving phrases of each language.

    Null texts are empty, a null lang is ``und``. Repeated rows count again. Languages without a candidate give no row.
    """
    search, most, best = _Search(docs, least, listed, batch_words), first, None
    while best is None:
        best, most = search.round(most), most * growth
    ranked = _first_rows(best, listed)
    return ranked.join(search.totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n", "score")


ORACLE = r"""
WITH alphabet AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece
      FROM (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), up, low) AS t FROM documents, alphabet)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
grams AS (SELECT lang, m, array_to_string(list_slice(words, i, i + m - 1), ' ') AS phrase
          FROM (SELECT lang, words, m, unnest(range(1, len(words) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS sizes(m))),
f AS (SELECT lang, m, phrase, count(*) AS f, string_split(phrase, ' ') AS words FROM grams GROUP BY lang, m, phrase HAVING count(*) >= 30),
totals AS (SELECT lang, sum(len(words)) AS n FROM w GROUP BY lang),
cuts AS (SELECT c.lang, c.m, c.phrase, c.f, k, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * c.f) // (x.f + y.f) AS score
         FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1) c
         JOIN f x ON x.lang = c.lang AND x.m = c.k AND x.phrase = array_to_string(list_slice(c.words, 1, k), ' ')
         JOIN f y ON y.lang = c.lang AND y.m = c.m - c.k AND y.phrase = array_to_string(list_slice(c.words, k + 1, c.m), ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (SELECT DISTINCT lang, f, array_to_string(list_slice(words, i, i + s - 1), ' ') AS phrase
                FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT f.*, unnest(range(2, m)) AS s FROM f WHERE m > 2))),
longest AS (SELECT lang, phrase, max(f) AS most FROM inner_parts GROUP BY lang, phrase),
kept AS (SELECT a.* FROM lowest a LEFT JOIN longest b ON a.lang = b.lang AND a.phrase = b.phrase WHERE b.most IS NULL OR 100 * b.most < 80 * a.f)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS BIGINT) AS rank, phrase,
       CAST(f AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept JOIN totals USING (lang)
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) <= 2000
"""
