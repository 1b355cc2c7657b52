"""Ids and decoded texts equal the library's, however texts are cut and whatever they share."""

import random
from collections import Counter

import hashlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from eventloom.llm import chunk_bpe
from eventloom.llm.queries import QUERIES, TOKENIZER
from tests.llm.test_llm import SMALL, odd, tables, texts  # noqa: F401

PARTS = ["the ", "it's ", "we'll", "'", "'r", "e", "<|endoftext|>", "<|endof", "text|>", " ", "  ", "\n", "\n\n ", "123", "é", "日本語", "x" * 40, "?!", " word", "\t", " ", "’s", "A", "ß"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(TOKENIZER)


@pytest.fixture(scope="module")
def made():
    return chunk_bpe.ChunkCoder(open(TOKENIZER, "rb").read())


@pytest.fixture(params=["quick", "library"])
def coder(request, made, monkeypatch):
    assert made.quick is not None
    if request.param == "library":
        monkeypatch.setattr(made, "quick", None)
    return made


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)


def test_joins_are_repaired_exactly(coder, library):
    draw = random.Random(1)
    plain = [p for p in PARTS if "|" not in p]
    for _ in range(3000):
        parts = ["".join(draw.choices(plain, k=draw.randrange(1, 12))) for _ in range(draw.randrange(1, 7))]
        if draw.random() < 0.1:
            parts[draw.randrange(len(parts))] = draw.choice(["y", " ", "7"]) * draw.randrange(1, 400)
        for text, (ids, sure, n_sure) in zip(parts, coder.coded(parts), strict=True):
            begins, tokens = coder._matches(coder.tokenizer.encode(text, add_special_tokens=False), len(text))
            assert (sure, n_sure) == (begins[-1], tokens[-1]) and len(ids)
            every, places, numbers = coder._encode(text)
            assert every.tolist() == ids.tolist() and places.tolist() == begins.tolist() and numbers.tolist() == tokens.tolist()
        got = coder.join(parts, coder.coded(parts)).tolist()
        assert got == library.encode("".join(parts), add_special_tokens=False).ids, parts


def test_ids_of_random_characters(coder, library):
    draw = random.Random(6)
    low, high = [chr(c) for c in range(0x540)], [chr(c) for c in (*range(0x540, 0xD800, 7), *range(0xE000, 0x1FFFF, 37))]
    for letters in (low, low[:128], high, low + high):
        rows = ["".join(draw.choices(letters, k=draw.randrange(80))) for _ in range(400)]
        assert [i.tolist() for i in coder.ids(rows)] == [e.ids for e in library.encode_batch(rows, add_special_tokens=False)]


def test_a_vocabulary_that_differs_is_left_to_the_library(made):
    import json

    plain = json.load(open(TOKENIZER))
    changed = json.loads(json.dumps(plain))
    changed["model"]["merges"][0], changed["model"]["merges"][9] = changed["model"]["merges"][9], changed["model"]["merges"][0]
    assert made._quick_encoder(plain) is not None and made._quick_encoder(changed) is None
    assert made._quick_encoder({**plain, "normalizer": {"type": "NFC"}}) is None


def test_decoding_equals_the_library(coder, library):
    draw = np.random.default_rng(3)
    rows = [draw.integers(0, 50_400, n) for n in (0, 1, 5, 300, 3000)] + [draw.integers(0, 300, 2000), np.array([50256, 50256]), np.array([60_000])]
    texts = [library.decode(r.tolist(), skip_special_tokens=False) for r in rows]
    assert coder.decode([r.astype("<u4") for r in rows]) == texts and any("\ufffd" in t for t in texts)


def test_chunks_follow_the_content():
    draw = random.Random(2)
    text = "".join(draw.choice("abcdefgh é日") for _ in range(40_000)).encode()
    for raw in (text, "aé".encode() + text[:0] + text, b"x" * 30_000, "日".encode() * 9000, b"", b"ab"):
        ends = chunk_bpe.chunk_ends(raw, 8, 64, 1000)
        assert (ends[-1:] or [0]) == [len(raw)] and ends == sorted(set(ends))
        sizes = np.diff([0, *ends])
        assert (sizes <= 1003).all() and (sizes[:-1] >= 64).all()
        [raw[a:b].decode() for a, b in zip([0, *ends], ends)]
    cuts = lambda raw: {raw[a:b] for a, b in zip([0, *e], e)} if (e := chunk_bpe.chunk_ends(raw, 8, 64, 1000)) else set()
    assert len(cuts(text) - cuts(b"another beginning" + text)) <= 5


@pytest.mark.parametrize("sizes", [(10, 256, 8192), (4, 8, 64), (2, 1, 9)])
def test_ids_equal_the_library(spark, library, sizes):
    draw = random.Random(sizes[0])
    shared = ["".join(draw.choices(PARTS, k=60)) for _ in range(4)]
    rows = [(i, "".join(draw.choice(shared) if draw.random() < 0.4 else "".join(draw.choices(PARTS, k=draw.randrange(9))) for _ in range(draw.randrange(9)))) for i in range(60)]
    rows += [(70, None), (None, ""), (None, None), (71, rows[3][1]), (71, rows[3][1]), (72, shared[0] * 30), (73, "<|endoftext|>"), (74, "z" * 20_000)]
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, t1 int, pieces string")
    coded = chunk_bpe.encode(frame, TOKENIZER, cut_bits=sizes[0], least=sizes[1], most=sizes[2])
    out = chunk_bpe.decode(coded, TOKENIZER).collect()
    assert Counter((r.doc_id, bytes(r.token_ids), r.decoded) for r in out) == Counter((i, *expected(library, t)) for i, t in rows)


def test_shared_chunks_are_encoded_once(spark):
    long = " ".join(f"word{i}" for i in range(900))
    frame = spark.createDataFrame([(i, f"head {i} {long} tail {i}") for i in range(20)], "doc_id long, text string")
    shared = frame.sparkSession.sparkContext.broadcast(open(TOKENIZER, "rb").read())
    refs = chunk_bpe.chunk_refs(frame, shared, "text", "doc_id", (8, 64, 1000))
    counted = refs.groupBy("h1", "h2").count().where("count > 1")
    found = chunk_bpe.shared_codes(frame, shared, "text", "doc_id", (8, 64, 1000)).collect()
    assert len(found) == 20 and counted.count() > 5
    assert len({bytes(p.ids) for r in found for p in r.pieces}) == counted.count()


def test_odd_rows(spark, odd, library):  # noqa: F811
    coded = chunk_bpe.encode(odd, TOKENIZER)
    assert coded.columns == [c for c in odd.columns if c not in ("text", "token_ids")] + ["token_ids"]
    assert Counter((r.doc_id, bytes(r.token_ids)) for r in coded.collect()) == Counter((r.doc_id, expected(library, r.text)[0]) for r in odd.collect())


def test_query(spark, texts, library):  # noqa: F811
    out = {r.doc_id: r for r in QUERIES["op11_chunk_bpe"](spark, SMALL).collect()}
    assert out.keys() == texts.keys()
    for i, t in texts.items():
        raw, decoded = expected(library, t)
        assert (out[i].n_tokens, out[i].ids_sha256, out[i].decoded_sha256) == (len(raw) // 4, hashlib.sha256(raw).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
