"""Divergence of groups: against brute force in plain integers, on odd rows, and with many cells."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventloom.llm import divergence

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def brute(rows, least_docs=3, listed=200):
    groups, docs, counts = set(), defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = TERM.findall((text or "").encode().translate(LOWER))
        counts[lang, source].update(terms)
        docs[lang].update(set(terms))
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for t, n in docs[lang].items() if n >= least_docs)
        sources = sorted(s for x, s in groups if x == lang)
        total = {t: sum(counts[lang, s][t] for s in sources) for t in kept}
        share = lambda count: {t: 1 + 10**9 * (count[t] + 1) // (sum(count[x] for x in kept) + len(kept)) for t in kept}
        whole, own = share(total), {s: share(counts[lang, s]) for s in sources}
        for s in sources:
            far = {o: sum((own[s][t] - own[o][t]) ** 2 // own[o][t] for t in kept) for o in sources if o != s}
            high = {t.decode(): (own[s][t] - whole[t]) ** 2 // whole[t] for t in kept if counts[lang, s][t] and own[s][t] > whole[t]}
            for part, values in (("pair", far), ("term", high)):
                order = sorted(values.items(), key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, i, v, n) for n, (i, v) in enumerate(order, 1) if part == "pair" or n <= listed}
    return out


def made(seed, n):
    draw = random.Random(seed)
    words = ["Alpha", "beta2x", "été", "Éa", "o'neil", "zz", "q", "日本", "a_b", "mm"]
    return [
        (None if draw.random() < 0.1 else " ".join(draw.choices(words, range(1, 11), k=draw.randrange(30))), draw.choice(["en", "fr", None, "lone"]), draw.choice(["s1", "s2", "s3", "S", None, "é"]))
        for _ in range(n)
    ] + [("", "only", "x"), ("unique words here", "only", "y"), (None, "one", "x")]


@pytest.mark.parametrize("blocks", [(32, 4096), (2, 3), (1, 1)])
def test_equals_brute_force(spark, blocks):
    rows = made(sum(blocks), 60)
    frame = spark.createDataFrame([(*r, 1, "t", 2) for r in rows], "text string, lang string, source string, n int, term string, own int")
    out = divergence.divergence(frame, listed=3, group_block=blocks[0], term_block=blocks[1]).collect()
    got = [(r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in out]
    assert len(got) == len(set(got)) and set(got) == brute(rows, listed=3)
    assert {("only", "x", "pair", "y", 0, 1), ("only", "y", "pair", "x", 0, 1)} <= set(got)  # no kept term


def test_hot_group_and_repeated_rows(spark):
    rows = [("the same words the same", "en", "hot")] * 300 + [(f"word{'x' * (i % 7)} the end", "en", f"s{i % 5}") for i in range(50)]
    out = divergence.divergence(spark.createDataFrame(rows, "text string, lang string, source string")).collect()
    assert {(r.lang, r.source, r.part, r["item"], r.value, r["rank"]) for r in out} == brute(rows)


def test_long_division_is_exact(spark):
    draw = random.Random(1)
    counts = [0, 1, 10**10, 10**15 - 1] + [draw.randrange(10**15) for _ in range(50)]
    for total in (10**15 + 7, 8 * 10**15):
        expected = [1 + 10**9 * (n + 1) // total for n in counts]
        assert divergence.shares(np.array(counts, np.int64), total).tolist() == expected
        sql = spark.createDataFrame([(n,) for n in counts], "n long").selectExpr(divergence._share_sql("n", f"{total}L") + " AS p").collect()
        assert [r.p for r in sql] == expected
