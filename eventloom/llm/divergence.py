"""How far the term shares of every (lang, source) group lie from those of the other sources and of the whole language.

The dense cube (group, group, term) of a language is cut along its three axes. A task owns one cell: a block of groups,
a second block of groups and a block of terms. The counts of a block of groups are copied to every cell that has the
block on one of its two group axes; a cell adds up its share of each divergence, and the shares are summed along the
term axis. A cell holds at most ``2 * group_block`` rows of about ``term_block`` terms, whatever the corpus. Terms that
neither of two blocks has are not laid out: they all add the same value, so a cell only says how many it did lay out.

Null texts, langs and sources count as ''. Repeated rows are documents of their own. Groups without terms take part
with a count of 0 for every kept term; a language without kept terms gives pairs of value 0 and no term rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventloom.llm.common import raw_texts, slices, store
from eventloom.operators.skew import attach_groups

SCALE = 1_000_000_000
LEAST_DOCS = 3
LISTED = 200
GROUP_BLOCK = 32
TERM_BLOCK = 4096
#: Counted (group, term) entries that a task holds before it hands them on.
HELD = 300_000
#: Terms are runs of A-Z, a-z and bytes from 0x80 up, A-Z lower-cased.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
_CELL = "lang string, source string, item string, value long, laid long, zero long, n_terms long"


def term_counts(docs: DataFrame) -> DataFrame:
    """lang, source, term, n (occurrences), d (documents): added up in the tasks before they are moved."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        occurrences: dict[tuple, Counter] = {}
        documents: dict[tuple, Counter] = {}

        def counted() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in occurrences.items():
                names = list(terms)
                own = documents[lang, source]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), pa.array([source] * len(names), pa.string()),
                     pa.array(names, pa.binary()).cast(pa.string()), pa.array([terms[t] for t in names], pa.int64()),
                     pa.array([own[t] for t in names], pa.int64())],
                    names=["lang", "source", "term", "n", "d"],
                )
            occurrences.clear()
            documents.clear()

        for whole in batches:
            for batch in slices(whole, "text"):
                for lang, source, raw in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), raw_texts(batch.column("text")), strict=True):
                    words = raw.translate(_TERM_BYTES).split()
                    occurrences.setdefault((lang, source), Counter()).update(words)
                    documents.setdefault((lang, source), Counter()).update(set(words))
                if sum(map(len, occurrences.values())) > HELD:
                    yield from counted()
        yield from counted()

    columns = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    partial = docs.select(*columns).mapInArrow(run, "lang string, source string, term string, n long, d long")
    return partial.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d"))


def kept_counts(counts: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """The counts of terms in ``least_docs`` documents of their language, with ``ln``, the count in the language.

    ``first`` marks one row of each kept term. A window holds one row for each source that has the term.
    """
    same = Window.partitionBy("lang", "term")
    place = F.row_number().over(same.orderBy("source"))
    return counts.select(
        "lang", "source", "term", "n", F.sum("n").over(same).alias("ln"), F.sum("d").over(same).alias("_docs"), (place == 1).alias("first")
    ).where(F.col("_docs") >= least_docs).drop("_docs")


def group_facts(docs: DataFrame, kept: DataFrame, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK) -> DataFrame:
    """One row for every group that occurs: its size, the sizes of its language, and where its cells lie."""
    groups = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("n").alias("own"), F.sum(F.col("first").cast("long")).alias("firsts"))
    every = Window.partitionBy("lang")
    nothing = F.lit(0).cast("long")
    sized = groups.join(own, ["lang", "source"], "left").select(
        "lang", "source", F.coalesce("own", nothing).alias("own"), F.sum(F.coalesce("own", nothing)).over(every).alias("whole"),
        F.sum(F.coalesce("firsts", nothing)).over(every).alias("n_terms"), F.count("*").over(every).alias("n_groups"),
        F.row_number().over(every.orderBy("source")).alias("place"),
    )
    return sized.select(
        "lang", "source", "own", "whole", "n_terms", F.expr(f"(place - 1) div {group_block}").alias("block"),
        F.expr(f"(n_groups + {group_block - 1}) div {group_block}").alias("n_blocks"),
        F.expr(f"greatest(1L, (n_terms + {term_block - 1}) div {term_block})").alias("term_blocks"),
    )


def shares(counts: np.ndarray, total: int) -> np.ndarray:
    """1 + floor(SCALE * (count + 1) / total), by long division in steps of 1000, so that no product passes 64 bits."""
    whole, rest = np.divmod(counts + 1, total)
    for _ in range(3):
        step, rest = np.divmod(rest * 1000, total)
        whole = whole * 1000 + step
    return whole + 1


def _share_sql(count: str, total: str) -> str:
    """The same as an SQL expression."""
    whole, rest = f"(({count} + 1) div ({total}))", f"(({count} + 1) % ({total}))"
    for _ in range(3):
        whole, rest = f"({whole} * 1000 + ({rest} * 1000) div ({total}))", f"(({rest} * 1000) % ({total}))"
    return f"(1 + {whole})"


def _cell(table: pa.Table) -> pa.Table:
    """The divergences of one cell: every ordered pair of its two group blocks over the terms it has."""
    lang, first, second = (table.column(c)[0].as_py() for c in ("lang", "a", "b"))
    n_terms = table.column("n_terms")[0].as_py()
    heads = table.filter(pa.compute.is_null(table.column("term"))).sort_by([("block", "ascending"), ("source", "ascending")])
    names, blocks = heads.column("source").to_pylist(), heads.column("block").to_numpy()
    place = {s: i for i, s in enumerate(names)}
    totals = heads.column("own").to_numpy() + n_terms
    body = table.filter(pa.compute.is_valid(table.column("term")))
    coded = pa.compute.dictionary_encode(body.column("term").combine_chunks())
    width = len(coded.dictionary)
    at_group = np.array([place[s] for s in body.column("source").to_pylist()], np.int64)
    laid = np.zeros((len(names), width), np.int64)
    laid[at_group, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)] = body.column("n").to_numpy()
    none = np.zeros(1, np.int64)
    for i, total in enumerate(totals.tolist()):
        laid[i] = shares(laid[i], total) if total else 1
    missing = np.array([shares(none, t)[0] if t else 1 for t in totals.tolist()], np.int64)
    out: dict[str, list] = {c: [] for c in ("lang", "source", "item", "value", "laid", "zero", "n_terms")}
    for i in range(len(names)):
        others = np.flatnonzero((blocks == (second if blocks[i] == first else first)) & (np.arange(len(names)) != i))
        if not len(others):
            continue
        apart = laid[i] - laid[others]
        value = (apart * apart // laid[others]).sum(axis=1)
        zero = (missing[i] - missing[others]) ** 2 // missing[others]
        out["source"] += [names[i]] * len(others)
        out["item"] += [names[j] for j in others.tolist()]
        out["value"] += value.tolist()
        out["zero"] += zero.tolist()
    n = len(out["source"])
    out |= {"lang": [lang] * n, "laid": [width] * n, "n_terms": [n_terms] * n}
    text, number = pa.string(), pa.int64()
    return pa.table(out, schema=pa.schema([("lang", text), ("source", text), ("item", text), ("value", number), ("laid", number), ("zero", number), ("n_terms", number)]))


def pair_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every ordered pair of sources of a language."""
    # One head for each group and cell, so that a cell knows the groups that have none of its terms.
    heads = groups.withColumn("t", F.explode(F.expr("sequence(0L, term_blocks - 1)")))
    heads = heads.select("lang", "source", "own", "n_terms", "block", "n_blocks", "t", F.lit(None).cast("string").alias("term"), F.lit(0).cast("long").alias("n"))
    facts = attach_groups(kept, groups, ["lang", "source"], "own", ["own", "n_terms", "block", "n_blocks", "term_blocks"])
    body = facts.select("lang", "source", "own", "n_terms", "block", "n_blocks", F.expr("pmod(xxhash64(term), term_blocks)").alias("t"), "term", "n")
    dealt = heads.unionByName(body).withColumn("_other", F.explode(F.expr("sequence(0L, n_blocks - 1)"))).select(
        "lang", F.least("block", "_other").alias("a"), F.greatest("block", "_other").alias("b"), "t", "source", "own", "n_terms", "block", "term", "n"
    )
    cells = dealt.groupBy("lang", "a", "b", "t").applyInArrow(_cell, _CELL)
    summed = cells.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"), F.sum("laid").alias("laid"), F.first("zero").alias("zero"), F.first("n_terms").alias("n_terms"))
    return summed.select("lang", "source", "item", (F.col("value") + (F.col("n_terms") - F.col("laid")) * F.col("zero")).alias("value"))


def term_divergence(kept: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for the terms of a group whose share is above that in the language."""
    rows = attach_groups(kept, groups, ["lang", "source"], "own", ["own", "whole", "n_terms"]).where("n > 0")
    shared = rows.select("lang", "source", F.col("term").alias("item"), F.expr(_share_sql("n", "own + n_terms")).alias("p"), F.expr(_share_sql("ln", "whole + n_terms")).alias("q"))
    return shared.where("p > q").select("lang", "source", "item", F.expr("((p - q) * (p - q)) div q").alias("value"))


def divergence(
    docs: DataFrame, least_docs: int = LEAST_DOCS, listed: int = LISTED, group_block: int = GROUP_BLOCK, term_block: int = TERM_BLOCK
) -> DataFrame:
    """lang, source, part (pair or term), item, value and rank: all pairs, and the ``listed`` highest terms of a group.

    Ranks go by value, equal values by the item's bytes. The limit on terms is part of the report; partial limits are
    taken before the shuffle. Counts are stored once, since sizes, pairs and terms all read them.
    """
    kept = store(kept_counts(store(term_counts(docs), "term-counts"), least_docs), "kept-terms")
    groups = store(group_facts(docs, kept, group_block, term_block), "term-groups")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pairs = pair_divergence(kept, groups).withColumn("rank", F.row_number().over(order))
    terms = term_divergence(kept, groups).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= listed)
    return pairs.withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term"))).select(
        "lang", "source", "part", "item", "value", F.col("rank").cast("int").alias("rank")
    )


ORACLE = r"""
WITH alphabet AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
d AS (SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words
      FROM documents, alphabet),
t AS (SELECT id, lang, source, unnest(words) AS term FROM d),
kept AS (SELECT lang, term, count(*) AS ln FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT g.lang, coalesce(any_value(k.v), 0) AS v, coalesce(any_value(k.whole), 0) AS whole
          FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN (SELECT lang, count(*) AS v, sum(ln) AS whole FROM kept GROUP BY lang) k USING (lang)
          GROUP BY g.lang),
g AS (SELECT x.lang, x.source, coalesce(y.own, 0) AS own, v, whole
      FROM (SELECT DISTINCT lang, source FROM d) x JOIN langs USING (lang)
      LEFT JOIN (SELECT lang, source, sum(n) AS own FROM c GROUP BY ALL) y ON x.lang = y.lang AND x.source = y.source),
p AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
             CAST(1 + (CAST(1000000000 AS HUGEINT) * (coalesce(c.n, 0) + 1)) // (own + v) AS HUGEINT) AS p,
             CAST(1 + (CAST(1000000000 AS HUGEINT) * (ln + 1)) // (whole + v) AS HUGEINT) AS q
      FROM g JOIN kept k ON g.lang = k.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // b.p) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
          FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // q AS value FROM p WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 200
"""
