"""Phrases against brute force, with bounds that prune, ties at the last place, and odd rows."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from eventloom.llm import collocations

PIECE, WORD = re.compile(rb"[.,;:!?\x0A-\x0D]"), re.compile(rb"[^\x20\x09]+")
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def brute(rows, least, listed):
    counts, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        for piece in PIECE.split((text or "").encode().translate(LOWER)):
            words = WORD.findall(piece)
            total[lang or "und"] += len(words)
            for m in range(1, 5):
                counts[lang or "und"].update(tuple(words[i : i + m]) for i in range(len(words) - m + 1))
    out = set()
    for lang, f in counts.items():
        found = [p for p, a in f.items() if len(p) > 1 and a >= least]
        longest = Counter()
        for p in found:
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    longest[p[i : i + m]] = max(longest[p[i : i + m]], f[p])
        scored = []
        for p in found:
            if not longest[p] or 100 * longest[p] < 80 * f[p]:
                score, k = min((2000000 * f[p] // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -f[p], b" ".join(p), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:listed], 1):  # noqa: E741
            out.add((lang, rank, phrase.decode(), -a, l, r, total[lang], -score))
    return out


def made(seed, n):
    draw = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Été", "x\x01y", "日本"]
    sayings = [" ".join(draw.choices(words, k=k)) for k in (2, 3, 4, 5, 7) for _ in range(4)]
    rows = []
    for _ in range(n):
        parts = [draw.choice(sayings) if draw.random() < 0.4 else draw.choice(words).upper() for _ in range(draw.randrange(25))]
        rows.append(("".join(p + draw.choice([" ", "\t ", " ", ". ", "\n"]) for p in parts), draw.choice(["en", "en", "en", "fr", None])))
    return rows + [(None, "en"), ("", None), ("...\n\t", "zz"), ("lonely", "zz")]


def result(spark, rows, **settings):
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], "text string, lang string, n int, phrase string")
    out = collocations.collocations(frame, **settings).collect()
    got = [(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in out]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("listed, first, growth, batch", [(1000, 20_000, 8, 4_000_000), (5, 2, 2, 50), (15, 4, 3, 300)])
def test_equals_brute_force(spark, listed, first, growth, batch):
    rows = made(listed, 150)
    expected = brute(rows, 5, listed)
    assert len(expected) > 10 and result(spark, rows, least=5, listed=listed, first=first, growth=growth, batch_words=batch) == expected


def test_ties_at_the_last_place(spark):
    rows = [(f"a{i} b{i} c{i}", "en") for i in range(12) for _ in range(6)]
    expected = brute(rows, 5, 4)
    assert {e[-1] for e in expected} == {1000000} and result(spark, rows, least=5, listed=4, first=1, growth=2) == expected


def test_many_wrong_hits_change_nothing(spark, monkeypatch):
    """Bitmaps that are full count more phrases and give the same rows."""
    rows = made(3, 120)
    monkeypatch.setattr(collocations.Bitmap, "has", lambda self, hashes: np.ones(len(hashes), bool))
    frame = spark.createDataFrame([("en", "w1 w2"), ("en", "w3")], "lang string, phrase string")
    full = collocations.bitmap(frame)
    assert full.has(np.zeros(3, np.uint64)).all()
    assert result(spark, rows, least=5, listed=10, first=5, growth=4) == brute(rows, 5, 10)


def test_bitmap_holds_its_phrases(spark):
    phrases = [("en", f"word{i} café {i}") for i in range(500)] + [("fr", "x")]
    frame = spark.createDataFrame(phrases, "lang string, phrase string")
    held = collocations.bitmap(frame)
    hashes = np.array([r.h for r in collocations.phrase_hashes(frame).collect()], np.int64).view(np.uint64)
    assert held.has(hashes).all() and all(held.has_one(int(h)) for h in hashes)
    others = np.random.default_rng(0).integers(0, 2**63, 10_000, np.uint64) * np.uint64(2)
    assert held.has(others).mean() < 0.1


def test_no_rows(spark):
    assert result(spark, [], least=5) == set() == result(spark, [(None, None), ("", "en")], least=1)
