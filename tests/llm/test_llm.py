"""Operators on training data: against brute force on small tables, and on rows that are null, empty, long or repeated."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken

import corpus_pipeline
import verify
from eventloom.llm import bpe, decontaminate, imatch, jaccard_join, licenses, near, paragraph_dedup, suffix_dedup, token_counts, toxicity, warc
from eventloom.llm.common import row_key, words_of
from eventloom.llm.queries import PATTERN, QUERIES, SQL, VOCABULARY

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns with names that operators use themselves.
CLASHING = SCHEMA + ", t1 string, k int, n_words int, score double, spans string, z int, _text int, token_ids int"


@pytest.fixture(scope="module")
def tables():
    db = duckdb.connect()
    for name in ("documents", "labels", "pages", "benchmark"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    return lambda sql: db.execute(sql).fetchall()


@pytest.fixture(scope="module")
def texts(tables):
    return dict(tables("SELECT doc_id, text FROM documents"))


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids and texts, empty and very long texts, repeated rows, and columns with clashing names."""
    draw = random.Random(5)
    long = " ".join(draw.choice(["alpha", "beta", "gamma", "delté", "eps"]) for _ in range(30_000))
    rows = [(1, None), (2, ""), (None, "a b c"), (None, None), (3, long), (4, long + " end"), (5, "x" * 3000), (6, "?!\n\n"), (6, "?!\n\n"), (7, "a b c"), (7, "a b c")]
    return spark.createDataFrame([(i, t, None, "s", None, "t", 1, 2, 0.5, "x", 3, 4, 5) for i, t in rows], CLASHING)


def by_id(frame):
    return {r.doc_id: r for r in frame.collect()}


@pytest.fixture(scope="module")
def encoding():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("test", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    assert verify.compare(spark, SMALL, [name]) == []


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_accepts_empty_tables(spark, name, tmp_path):
    for table in ("documents", "labels", "pages", "benchmark"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


# Decontamination


def windows_found(text, items, window):
    words = words_of(text)
    hit, found = set(), set()
    for item, body in items:
        own = words_of(body)
        n = min(window, len(own))
        strings = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if n else set()
        for i in range(len(words) - n + 1):
            if tuple(words[i : i + n]) in strings:
                hit.update(range(i, i + n))
                found.add(item)
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("block_bytes", [1 << 20, 12])
def test_kept_documents_have_no_window(spark, odd, block_bytes):
    bench = spark.createDataFrame([(1, "alpha beta gamma delté eps alpha"), (2, None), (None, "a b c"), (3, ""), (4, "zz zz")], "item_id long, text string")
    kept = decontaminate.kept_documents(odd, bench, window=3, block_bytes=block_bytes)
    found = decontaminate.decontaminate(odd, bench, window=3, keep=("doc_id", "text"), block_bytes=block_bytes)
    expected = Counter((r.doc_id, r.text) for r in found.collect() if not r.runs)
    assert kept.columns == odd.columns and Counter((r.doc_id, r.text) for r in kept.collect()) == expected and 0 < sum(expected.values()) < 11


@pytest.mark.parametrize("block_bytes", [1 << 20, 12])
def test_search_finds_every_window(spark, block_bytes):
    draw = random.Random(1)
    make = lambda n: " ".join(draw.choice("abc") for _ in range(n))
    docs = [(i, make(draw.randrange(40))) for i in range(40)] + [(41, None), (None, "a b a"), (42, "A, b; A")]
    items = [(i, make(draw.randrange(1, 7))) for i in range(6)] + [(7, ""), (8, None), (None, "a b a")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    named = [(None if i is None else str(i), (t or "").encode()) for i, t in items]
    out = {r.doc_id: r for r in decontaminate.decontaminate(frame, bench, window=4, block_bytes=block_bytes).collect()}
    assert len(out) == len(docs)
    for i, t in docs:
        n, hit, found = windows_found((t or "").encode(), [(k or "", b) for k, b in named], 4)
        row = out[i]
        assert (row.n_words, sum(r.end - r.first for r in row.runs), sorted(x or "" for x in row["items"])) == (n, hit, found)


# Byte pairs


def test_ids_equal_the_library(spark, odd, texts, encoding):
    rows = bpe.decode(bpe.encode(odd, VOCABULARY, PATTERN, keep=["doc_id", "k"]), VOCABULARY, PATTERN).collect()
    expected = Counter((r.doc_id, np.array(encoding.encode_ordinary(r.text or ""), "<u4").tobytes(), (r.text or "").encode()) for r in odd.collect())
    assert Counter((r.doc_id, bytes(r.token_ids), bytes(r.decoded)) for r in rows) == expected
    out = by_id(QUERIES["op2_byte_bpe"](spark, SMALL))
    for i, t in texts.items():
        ids = np.array(encoding.encode_ordinary(t), "<u4")
        assert (out[i].n_tokens, out[i].ids_sha256, out[i].decoded_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())


def test_long_and_short_matches_merge_alike(encoding):
    coder = bpe.ByteBpe.load(open(VOCABULARY, "rb"), PATTERN)
    draw = random.Random(2)
    for size in (1, 2, 30, 300, 511, 600, 2000):
        piece = "".join(draw.choice("abcdeiournst") for _ in range(size))
        expected = tuple(encoding.encode_ordinary(piece))
        assert coder.merge_long(piece.encode()) == expected
        assert coder.merge_rows([piece.encode(), b"th", b"e"])[0] == expected


# Token counts


def test_counts_for_every_limit(spark, texts, encoding):
    lengths = np.array([len(encoding.encode_ordinary(t)) for t in texts.values()])
    rows = QUERIES["op3_token_counts"](spark, SMALL)
    got = rows.collect()
    assert {r.context_limit: r.n_docs for r in got} == dict(Counter(lengths.tolist()))
    for r in got:
        assert (r.docs_longer, r.tokens_longer) == ((lengths > r.context_limit).sum(), lengths[lengths > r.context_limit].sum())
        assert (r.tokens_total, r.tokens_truncated) == (lengths.sum(), np.minimum(lengths, r.context_limit).sum())
    half = token_counts.quantiles(rows, [0.5]).first()
    assert half.length == np.sort(lengths)[(len(lengths) + 1) // 2 - 1]


def test_counts_by_key_with_nulls(spark, odd):
    rows = token_counts.token_counts(odd, VOCABULARY, PATTERN, keys=("lang",)).collect()
    assert sum(r.n_docs for r in rows) == 11 and {r.lang for r in rows} == {None} and rows[0].docs_total == 11


# Suffix arrays


def test_suffix_array_and_repeats():
    draw = random.Random(3)
    for trial in range(150):
        n = draw.randint(1, 90)
        text = b"a" * n if trial % 7 == 0 else bytes(draw.choice(b"ab\x00\xff") for _ in range(n))
        assert suffix_dedup.suffix_array(text, 200).tolist() == sorted(range(n), key=lambda i: text[i:])
        length = draw.randint(1, 20)
        starts = np.arange(max(0, n - length + 1))
        counts = Counter(text[i : i + length] for i in starts.tolist())
        assert suffix_dedup.repeated_windows(text, starts, length).tolist() == [counts[text[i : i + length]] > 1 for i in starts.tolist()]


def covered(raws, length):
    counts = Counter(r[p : p + length] for r in raws for p in range(len(r) - length + 1))
    out = []
    for r in raws:
        mask = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if counts[r[p : p + length]] > 1:
                mask[p : p + length] = b"\1" * length
        out.append(bytes(mask))
    return out


@pytest.mark.parametrize("hot_bytes", [1 << 20, 1])
def test_removal_equals_brute_force(spark, hot_bytes):
    draw = random.Random(4)
    word = lambda: draw.choice(["ab", "cd", "é", "x"])
    shared = "".join(word() for _ in range(60))
    rows = [(i, "".join(word() for _ in range(draw.randrange(40))) + (shared if i % 3 == 0 else "") + "".join(word() for _ in range(draw.randrange(30)))) for i in range(60)]
    rows += [(61, "ab" * 50), (62, None), (63, ""), (64, rows[1][1]), (64, rows[1][1]), (None, rows[3][1])]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    raws = [(t or "").encode() for _, t in rows]
    expected = Counter((i, bytes(c for c, m in zip(r, mask, strict=True) if not m)) for (i, _), r, mask in zip(rows, raws, covered(raws, 24), strict=True))
    out = suffix_dedup.remove_repeats(frame, length=24, gram=6, hot_bytes=hot_bytes).collect()
    assert Counter((r.doc_id, bytes(r.kept)) for r in out) == expected


def test_removal_on_odd_rows(odd):
    out = suffix_dedup.remove_repeats(odd, keep=("doc_id", "t1", "z")).collect()
    assert len(out) == 11 and {r.t1 for r in out} == {"t"}
    # The run of one letter repeats within itself; the two long texts share all but the last word.
    assert {(r.doc_id, len(r.kept)) for r in out if r.doc_id in (3, 4, 5)} == {(3, 0), (4, 4), (5, 0)}
    assert suffix_dedup.rewrite(odd).columns == odd.columns


# Toxicity


def test_held_out_documents_are_told_apart(spark, tmp_path):
    draw = random.Random(6)
    rows, labels = [], []
    for i in range(400):
        words = [draw.choice(["stone", "river", "cloud", "field", "house", "light", "paper", "glass"]) for _ in range(60)]
        bad = i % 4 == 0
        if bad:
            for _ in range(4):
                words[draw.randrange(60)] = "grumb" + draw.choice(["le", "ler", "ling", "les", "led"])
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = by_id(QUERIES["op5_toxicity"](spark, str(tmp_path)))
    for i, (_, _, toxic) in enumerate(labels):
        assert out[i].predicted == toxic and out[i].held_out == (zlib.crc32(str(i).encode()) % 4 == 2) and 0 <= out[i].score <= 1
    docs, marks = (spark.read.parquet(f"{tmp_path}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, marks)
    spans = toxicity.score_toxicity(spark.createDataFrame([(1, "Ein café. A grumbler, the house"), (2, None)], "doc_id long, text string"), model).collect()
    raw = "Ein café. A grumbler, the house".encode()
    assert [raw[s.first : s.end] for s in spans[0].spans] == [b"grumbler"] and spans[1].spans == [] and spans[1].score < 0.3


def test_marginals_equal_enumeration():
    draw = np.random.default_rng(0)
    gain, move = draw.normal(size=(2, 5)), draw.normal(size=(2, 2))
    lengths = np.array([5, 3])
    got = toxicity.marginals(gain, lengths, move)
    for row, n in enumerate(lengths.tolist()):
        total, ones = 0.0, np.zeros(n)
        for code in range(2**n):
            s = [(code >> t) & 1 for t in range(n)]
            weight = np.exp(sum(gain[row, t] * s[t] for t in range(n)) + sum(move[s[t], s[t + 1]] for t in range(n - 1)))
            total, ones = total + weight, ones + weight * np.array(s)
        assert np.allclose(got[row, :n], ones / total)


def test_scores_of_odd_rows(spark, odd):
    labels = spark.createDataFrame([(1, 1, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = toxicity.score_toxicity(odd, toxicity.train(odd, labels)).collect()
    assert len(rows) == 11 and {r.score for r in rows} == {0.0}
    assert toxicity.kept_documents(odd, toxicity.Model(0.0)).count() == 11


# WARC


def test_archives_keep_pages(spark, tmp_path):
    same = "<p>" + "é" * 2000
    rows = [(1, "http://a/1", same), (2, None, same), (3, "u\r\nx", None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (None, "u", same), (9, "u", same + "\r\n\r\nWARC/1.1")]
    pages = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, digest string").repartition(3)
    planned = warc.plan_records(pages)
    raw = warc.write_archives(planned, f"{tmp_path}/a", archive_bytes=3000)
    paths = [r.path for r in raw.collect()]
    assert len(paths) > 1
    members = warc.normalise_archives(spark.createDataFrame([(p,) for p in paths], "path string"), f"{tmp_path}/b")
    done = spark.createDataFrame(members.collect(), "path string")
    out = {r.page_id: r for r in warc.read_archives(done, f"{tmp_path}/b").collect()}
    assert {i: (r.record_type, r.refers_to) for i, r in out.items()} == {
        1: ("revisit", 2), 2: ("response", None), 3: ("response", None), 4: ("response", None), 5: ("response", None), 6: ("response", None),
        None: ("revisit", 2), 9: ("response", None),
    }
    for i, _, html in rows:
        payload = (html or "").encode()
        assert (out[i].payload_bytes, out[i].payload_digest) == (len(payload), hashlib.sha1(payload).hexdigest())
        assert bytes(out[i].payload) == (payload if out[i].record_type == "response" else b"")


def plain_records(raw):
    """Records of members, by a parser that knows only the format."""
    import gzip
    import io

    data = gzip.GzipFile(fileobj=io.BytesIO(raw)).read()
    while data:
        head, data = data.split(b"\r\n\r\n", 1)
        version, *lines = head.decode("ascii").split("\r\n")
        assert version == "WARC/1.1"
        fields = dict(line.split(": ", 1) for line in lines)
        size = int(fields["Content-Length"])
        yield fields, data[:size]
        assert data[size : size + 4] == b"\r\n\r\n"
        data = data[size + 4 :]


def test_other_readers_resolve_revisits(spark, tmp_path):
    same = "<p>" + "x" * 2000
    rows = [(i, f"http://a/é {i}", same) for i in range(6)] + [(7, "http://b", "short")] * 5 + [(5, None, same), (8, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    raw = warc.write_archives(warc.plan_records(pages), f"{tmp_path}/a", archive_bytes=2500, date="2026-01-02T03:04:05Z")
    paths = [r.path for r in raw.collect()]
    warc.normalise_archives(spark.createDataFrame([(p,) for p in paths], "path string"), f"{tmp_path}/b").collect()
    records = [r for path in sorted((tmp_path / "b").glob("*.warc.gz")) for r in plain_records(path.read_bytes())]
    by_id = {f["WARC-Record-ID"]: (f, body) for f, body in records}
    assert len(by_id) == len(records) == len(rows) and all(f["WARC-Date"] == "2026-01-02T03:04:05Z" for f, _ in records)
    revisits = [f for f, _ in records if f["WARC-Type"] == "revisit"]
    assert len(revisits) == 5
    for f in revisits:
        target, body = by_id[f["WARC-Refers-To"]]
        assert target["WARC-Type"] == "response" and body.decode() == same
        assert target["WARC-Payload-Digest"] == f["WARC-Payload-Digest"] and target["WARC-Target-URI"] == f["WARC-Refers-To-Target-URI"]
    days = {f["WARC-Date"][:2] for path in [warc.write_archives(warc.plan_records(pages), f"{tmp_path}/c").first().path] for f, _ in plain_records(open(path, "rb").read())}
    assert days == {"20"}


# Jaccard join


def classes_of(texts, similar=0.8):
    shingler = near.Shingler()
    members = defaultdict(list)
    for i, t in texts:
        members[frozenset(shingler.of_text((t or "").encode()).tolist())].append(i)
    sets = [s for s in members if s]
    parent, links = list(range(len(sets))), Counter()

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common >= similar * (len(sets[a]) + len(sets[b]) - common) - 1e-9:
                links[a] += 1
                links[b] += 1
                parent[find(a)] = find(b)
    groups = defaultdict(list)
    for a in range(len(sets)):
        groups[find(a)] += members[sets[a]]
    return {i: (min(groups[find(a)]), links[a], len(members[sets[a]])) for a in range(len(sets)) for i in members[sets[a]]}


def family():
    """A third of the rows near copies of one text, some exact copies, the rest unlike."""
    draw = random.Random(8)
    vocabulary = [f"w{i}" for i in range(400)]
    base = [draw.choice(vocabulary) for _ in range(120)]
    rows = []
    for i in range(240):
        words = list(base) if i % 3 == 0 else [draw.choice(vocabulary) for _ in range(draw.randrange(1, 90))]
        for _ in range(draw.randrange(3) if i % 3 == 0 else 0):
            words[draw.randrange(120)] = draw.choice(vocabulary)
        rows.append((i, " ".join(words)))
    return rows + [(300 + i, rows[4][1]) for i in range(5)] + [(400, None), (401, ""), (402, "one two"), (403, "two one")]


@pytest.mark.parametrize("block", [512, 16])
def test_join_loses_no_link(spark, monkeypatch, block):
    monkeypatch.setattr(near, "BLOCK_SETS", block)
    rows = family()
    out = by_id(jaccard_join.jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")))
    expected = classes_of(rows)
    for i, t in rows:
        assert (out[i].class_id, out[i].n_links, out[i].n_same) == expected.get(i, (i, 0, 1))


def test_one_of_each_class_stays(spark, odd):
    rows = family()
    frame = spark.createDataFrame([(i, t, None, "s", None) for i, t in rows], SCHEMA)
    kept = sorted(r.doc_id for r in jaccard_join.one_of_each(frame).collect())
    expected = classes_of(rows)
    assert kept == sorted({expected[i][0] if i in expected else i for i, _ in rows})
    out = jaccard_join.one_of_each(odd)
    assert out.columns == odd.columns
    # The long texts are near copies; "a b c" stays once; rows without words all stay.
    assert Counter(r.doc_id for r in out.collect()) == Counter([1, 2, None, 3, 5, 6, 6, 7])


def test_pruning_bounds_are_safe():
    for seen in (24, 48, 96):
        least = near.least_matches(seen, 0.8, 1e-7)
        miss = sum(np.random.default_rng(1).binomial(seen, 0.8, 100_000) < least)
        assert 0 < least < 0.8 * seen and miss == 0


def test_components(spark):
    edges = [(b"%02d" % i, b"%02d" % (i + 1)) for i in range(10, 40)] + [(b"50", b"51"), (b"52", b"51"), (b"51", b"51")]
    out = {bytes(r.k): bytes(r.root) for r in near.components(spark.createDataFrame(edges, "k binary, root binary")).collect()}
    assert out == {b"%02d" % i: b"10" for i in range(11, 41)} | {b"51": b"50", b"52": b"50"}


# Licences


def test_phrases_and_templates(spark, odd):
    rows = [
        (1, "CC-BY. cc by; All rights\nreserved"), (2, "the gnu General Public License, all rights"), (3, None),
        (4, "x Licensed under the Apache License, Version 2.0. y"), (5, "Released today under the new MIT License."), (6, "cc"),
    ]
    out = by_id(licenses.digests(licenses.scan_licenses(spark.createDataFrame(rows, "doc_id long, text string"))))
    assert (out[1].n_base, out[1].first_word, out[1].last_word, out[1].base_labels) == (3, 0, 4, "cc-by,reserved")
    assert (out[2].n_base, out[2].first_word, out[2].base_labels) == (1, 2, "gpl")
    assert (out[3].n_words, out[3].n_base, out[3].first_word, out[3].labels, out[3].score) == (0, 0, None, "", 0.0)
    assert (out[4].base_labels, out[4].labels, out[4].score) == ("", "apache-2.0", 1.0)
    assert out[6].n_base == 0 and licenses.scan_licenses(odd).count() == 11


def test_phrases_equal_brute_force(spark, texts):
    out = by_id(QUERIES["op8_licenses"](spark, SMALL))
    for i, t in texts.items():
        words = [w.decode() for w in words_of(t.encode())]
        places = [(k, label) for phrase, label in licenses.PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
        starts = [k for k, _ in places]
        assert (out[i].n_words, out[i].n_base, out[i].first_word, out[i].last_word) == (len(words), len(places), min(starts, default=None), max(starts, default=None))
        assert out[i].base_labels == ",".join(sorted({label for _, label in places})) and set(out[i].base_labels.split(",")) - {""} <= set(out[i].labels.split(","))


def scanned(text):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.PHRASES, licenses.SHORTEST, licenses.GAP, licenses.COVERED)
    return [name for _, _, name, _ in scanner.scan(text.encode())[2]]


@pytest.mark.parametrize(("text", "label"), [
    ("Licensed under CC BY-NC 4.0.", "cc-by-nc-4.0"), ("Licensed under CC BY-NC-SA 3.0.", "cc-by-nc-sa-3.0"), ("Licensed under CC0 1.0.", "cc0-1.0"),
    ("Licensed under CC BY 4.0.", "cc-by-4.0"), ("Licensed under CC BY-SA 4.0.", "cc-by-sa-4.0"), ("Licensed under CC BY-ND 2.5", "cc-by-nd-2.5"),
    ("Licensed under the GNU General Public License, version 3.", "gpl-3.0"), ("Licensed under the GNU Lesser General Public License, version 2.1.", "lgpl-2.1"),
    ("Licensed under the GNU Affero General Public License, version 3.", "agpl-3.0"), ("Released under the MIT License.", "mit"),
    ("Licensed under the Apache License, Version 2.0.", "apache-2.0"), ("Licensed under the ISC License.", "isc"),
])
def test_each_licence_line_gets_its_label(text, label):
    assert set(scanned("Some words. " + text + " More of them.")) == {label}


@pytest.mark.parametrize(("text", "labels"), [
    ("This work is licensed under the GNU General Public License, version 2.", {"gpl-2.0"}),
    ("This work is licensed under the GNU General Public License, version 9.", set()),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", {"cc-by-nc-4.0"}),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License.", {"cc-by-nc-nd-4.0"}),
    ("This work is licensed under a Creative Commons Attribution-Restricted 4.0 International License.", set()),
    ("Licensed under CC BY 4.1.", set()), ("Licensed under the Apache License, Version 1.1.", set()),
])
def test_near_misses_get_no_other_label(text, labels):
    assert set(scanned("Some words. " + text + " More of them.")) == labels


def test_words_are_those_of_the_pattern():
    pattern = regex.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for text in ("Ab été_1 \x7f x\x85y z Ä-Ö", "A B", "　"):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
        assert [w.decode() for w in words_of(text.encode())] == pattern.findall(low)


# Fingerprints


def test_fingerprints_and_edits(spark, texts):
    out = by_id(QUERIES["op9_imatch"](spark, SMALL))
    order = sorted(texts, reverse=True)
    for i, follower in zip(order, order[1:] + order[:1], strict=True):
        t, cut = texts[i], len(texts[i]) // 3
        edited = t[: len(t) - cut] + texts[follower][:cut]
        assert (out[i].n_chars, out[i].edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
    assert sum(r.near_edited > r.near_next for r in out.values()) > 0.85 * len(out)
    prints = defaultdict(set)
    for i, t in texts.items():
        prints[t].add(out[i].fingerprint)
    assert all(len(p) == 1 for p in prints.values())


def test_lexicon_holds_the_whole_band(spark):
    docs = spark.range(1).selectExpr("concat_ws(' ', transform(sequence(1, 2000100), i -> hex(i))) AS text")
    assert len(imatch.lexicon(docs)) == 2_000_100


def test_fingerprints_of_very_long_texts():
    """A text with more lexicon terms than the sparsest level asks for still resembles its edited text."""
    words = [b"word%d" % i for i in range(9000)]
    maker = imatch.Fingerprinter(imatch.Hasher().distinct(b" ".join(words)))
    whole, edited, other = (maker.fingerprint(b" ".join(w)) for w in (words, words[:8000], [w + b"x" for w in words]))
    assert whole[1:].any() and 0 < maker.likeness(whole, edited) < 1 and maker.likeness(whole, other) == 0
    assert np.array_equal(whole, maker.fingerprint(b" ".join(words)))


@pytest.mark.parametrize("n", [50, 300, 2000, 6000, 20_000, 100_000])
def test_a_third_replaced_stays_near_at_every_length(n):
    words, others = ([b"%s%d" % (w, i) for i in range(n)] for w in (b"word", b"other"))
    maker = imatch.Fingerprinter(imatch.Hasher().distinct(b" ".join(words + others)))
    whole, edited, other = (maker.fingerprint(b" ".join(w)) for w in (words, words[: n - n // 3] + others[: n // 3], others))
    # Some tens of subsets are compared, so the share varies around a half to a third.
    assert 0.15 < maker.likeness(whole, edited) < 0.8 and maker.likeness(whole, other) < 0.05


def test_fingerprints_equal_brute_force():
    draw = random.Random(8)
    vocabulary = [b"t%d" % i for i in range(3000)]
    hasher = imatch.Hasher()
    maker = imatch.Fingerprinter(hasher.distinct(b" ".join(vocabulary[::2])))
    lexicon = set(maker.terms.tolist())
    for n in (0, 1, 3, 40, 700, 5000):
        text = b" ".join(draw.choices(vocabulary, k=n))
        every = sorted({hasher.known[w] for w in words_of(text)}) if n else []
        kept = [t for t in every if t in lexicon] or every
        got = maker.fingerprint(text)
        levels = (len(got) - 1) // maker.subsets
        first = next(d for d in range(1, 65) if len(kept) >> d <= imatch.DENSEST)
        assert levels == max(imatch.LEVELS, first + imatch.SPARSER)
        expected = [int.from_bytes(hashlib.blake2b(text, digest_size=4).digest(), "little")]
        for level in range(1, levels + 1):
            for salt in maker.salts:
                with np.errstate(over="ignore"):
                    members = [t for t in kept if int(imatch.mixed(np.array([t], np.uint64) ^ salt)[0]) % (1 << level) == 0]
                digest = hashlib.blake2b(b"".join(t.to_bytes(8, "little") for t in members), digest_size=4).digest()
                expected.append((int.from_bytes(digest, "little") or 1) if members and level >= first else 0)
        assert got.tolist() == expected


@pytest.mark.parametrize("pieces", [1, 3, 40])
def test_next_document_across_pieces(spark, odd, pieces):
    rows = [(i, f"text number {i} of many") for i in range(50)]
    out = by_id(imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), pieces=pieces))
    for i, t in rows:
        cut = len(t) // 3
        edited = t[: len(t) - cut] + dict(rows)[i - 1 if i else 49][:cut]
        assert out[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert imatch.fingerprints(odd, pieces=pieces).count() == 11


# Paragraphs


def test_paragraphs_equal_brute_force(spark, texts):
    rows = sorted(texts.items()) + [(9000, None), (9001, ""), (9002, texts[0]), (9002, texts[0])]
    found = paragraph_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    shingler, lines, same = near.Shingler(), {}, defaultdict(set)
    for i, t in rows:
        raw = (t or "").encode()
        for a, b, words in paragraph_dedup.paragraphs(raw, paragraph_dedup.LEAST_WORDS):
            lines[(i, *row_key(i, raw), a, b)] = frozenset(shingler.shingles(words).tolist())
        for a, b, digest in paragraph_dedup.passages(raw, paragraph_dedup.LEAST_WORDS):
            same[digest].add((i, *row_key(i, raw), a, b))
    places = sorted(lines)
    root = {p: p for p in places}
    for x, p in enumerate(places):
        for q in places[:x]:
            common = len(lines[p] & lines[q])
            if common >= 0.8 * (len(lines[p]) + len(lines[q]) - common) - 1e-9:
                old, new = max(root[p], root[q]), min(root[p], root[q])
                root = {k: new if v == old else v for k, v in root.items()}
    gone = defaultdict(set)
    for p, r in root.items():
        if p != r:
            gone[p[0]].add(p[3:])
    for group in same.values():
        for p in group - {min(group)}:
            gone[p[0]].add(p[3:])
    assert len(found) == len(rows)
    for r in found:
        raw = (dict(rows)[r.doc_id] or "").encode()
        mask = bytearray(len(raw))
        for a, b in gone[r.doc_id]:
            mask[a:b] = b"\1" * (b - a)
        assert bytes(r.kept) == bytes(c for c, m in zip(raw, mask, strict=True) if not m)


def test_embedded_passages_go(spark, odd):
    draw = random.Random(9)
    sentence = lambda: " ".join(draw.choice(["ka", "lo", "mi", "nu", "re", "so", "ta"]) + str(draw.randrange(90)) for _ in range(8)).capitalize() + "."
    passage = " ".join(sentence() for _ in range(8))
    rows = [(i, " ".join(sentence() for _ in range(5)) + " " + passage + " " + " ".join(sentence() for _ in range(4)) + "\n" + sentence()) for i in range(6)]
    out = by_id(paragraph_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert out[0].n_removed == 0 and all(len(out[i].kept) < len(rows[i][1]) - 0.7 * len(passage) for i in range(1, 6))
    assert paragraph_dedup.remove_repeats(odd).count() == 11


def test_passages_inside_sentences_are_met():
    draw = random.Random(4)
    words = lambda n: [draw.choice(["ka", "lo", "mi", "nu", "re", "so", "ta"]) + str(draw.randrange(90)) for _ in range(n)]
    for least in (1, 5, 25):
        for _ in range(40):
            shared = words(2 * least)
            one, two = (" ".join(words(draw.randrange(9)) + shared + words(draw.randrange(70))).encode() for _ in range(2))
            assert {d for _, _, d in paragraph_dedup.passages(one, least)} & {d for _, _, d in paragraph_dedup.passages(two, least)}
            for begin, end, _ in paragraph_dedup.passages(one, least):
                assert len(paragraph_dedup.words_of(one[begin:end])) >= least
    assert not paragraph_dedup.passages(b"", 25) and not paragraph_dedup.passages(" ".join(words(24)).encode(), 25)
    assert paragraph_dedup.passages(b"A b, C!" * 9, 25)


def test_repeated_word_runs_go_whole(spark):
    """Against all runs of 25 words by brute force: common runs of 25 words and more, in different company each time."""
    draw = random.Random(11)
    word = lambda: draw.choice(["ka", "lo", "mi", "nu", "re", "so", "ta"]) + str(draw.randrange(900))
    shared = [word() for _ in range(130)]
    texts = [[word() for _ in range(60)] for _ in range(40)]
    for i, length in enumerate([24, 25, 26, 30, 37, 49, 50, 51, 60, 80, 99, 130] * 3):
        begin = draw.randrange(131 - length)
        texts[i][30:30] = shared[begin : begin + length]
    rows = [(i - 1 if i else None, draw.choice([", ", " ", "\n", " - "]).join(t) + ".") for i, t in enumerate(texts)]
    seen, left = set(), []
    for i, t in enumerate(texts):
        keep = [True] * len(t)
        for p in range(len(t) - 24):
            if (run := tuple(t[p : p + 25])) in seen:
                keep[p : p + 25] = [False] * 25
            seen.add(run)
        left.append([w for w, k in zip(t, keep, strict=True) if k])
    out = by_id(paragraph_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [[w.decode() for w in words_of(bytes(out[i].kept))] for i, _ in rows] == left
    assert sum(map(len, left)) < sum(map(len, texts)) and all(r.n_removed == len(r.spans or []) for r in out.values())


def test_short_paragraphs_go(spark):
    """Equal and near lines of 5 to 24 words; lines of fewer words than a shingle stay."""
    line = "one two three four five six seven eight nine ten eleven twelve"
    rows = [
        (1, f"first own line of one\n{line}\nfive words in a line\nonly four words here"), (2, f"{line} more\nsecond text has its own"),
        (3, "Only four words here\nFive words, in a LINE\nthird"), (4, "one two three four five six seven eight but nine ten eleven"),
    ]
    out = by_id(paragraph_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")))
    assert [bytes(out[i].kept).decode() for i in range(1, 5)] == [rows[0][1], "\nsecond text has its own", "Only four words here\n\nthird", rows[3][1]]
    assert [out[i].n_removed for i in range(1, 5)] == [0, 1, 1, 0]


def test_near_paragraphs_share_a_band():
    """Pairs of just the similarity, of short and long paragraphs."""
    bands, rows = paragraph_dedup.BANDS, paragraph_dedup.ROWS
    assert (1 - near.SIMILAR**rows) ** bands < 1e-5
    draw, minhash = np.random.default_rng(3), near.MinHash(bands * rows)
    for i in range(4000):
        common = 4 * (1 + i % 20)
        hashes = draw.integers(0, 2**63, common + common // 4, np.uint64)
        one, two = hashes[:common], hashes
        assert set(near.band_keys(minhash.signature(one), rows)) & set(near.band_keys(minhash.signature(two), rows))


# Pipeline


def test_stages_one_by_one(spark, texts, tables):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").cache()
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "byte_bpe"]
    kept = {r.doc_id for r in stages["toxicity"](spark, docs, SMALL).collect()}
    assert kept == {r.doc_id for r in QUERIES["op5_toxicity"](spark, SMALL).collect() if r.score < 0.3}
    joined = {r.doc_id for r in stages["ngram_jaccard_join"](spark, docs, SMALL).collect()}
    expected = classes_of(sorted(texts.items()))
    assert joined == {expected[i][0] if i in expected else i for i in texts}
    raws = {i: t.encode() for i, t in texts.items()}
    left = {i: bytes(c for c, m in zip(r, mask, strict=True) if not m) for (i, r), mask in zip(raws.items(), covered(list(raws.values()), corpus_pipeline.REPEAT_BYTES), strict=True)}
    cut = {r.doc_id: (r.text, r.n_chars) for r in stages["suffix_array_dedup"](spark, docs, SMALL).collect()}
    assert cut == {i: (t, len(t)) for i, raw in left.items() if (t := raw.decode("utf-8", "ignore")) or not raws[i]}
    items = [(i, t.encode()) for i, t in tables("SELECT item_id, text FROM benchmark")]
    clean = {r.doc_id for r in stages["benchmark_decontamination"](spark, docs, SMALL).collect()}
    assert clean == {i for i, r in raws.items() if not windows_found(r, items, 10)[1]}
    for name in list(stages)[:-1]:
        assert stages[name](spark, docs, SMALL).columns == docs.columns


def test_pipeline_runs(spark, encoding):
    rows = corpus_pipeline.run(spark, SMALL).collect()
    assert rows and all(len(r.token_ids) % 4 == 0 for r in rows)
    assert public_tokenizers.PATTERN == PATTERN


def test_pipeline_on_empty_tables(spark, tmp_path):
    for table in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SMALL}/{table}.parquet").limit(0).write.parquet(f"{tmp_path}/{table}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_stages_on_odd_rows(spark, odd, tmp_path):
    """Null ids and texts, empty and long texts, equal rows and clashing columns go through every stage and the whole run."""
    odd.write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{SMALL}/labels.parquet").limit(0).write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(None, None), (1, ""), (2, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    stages = dict(corpus_pipeline.STAGES)
    count = {name: stage(spark, odd, str(tmp_path)).count() for name, stage in stages.items()}
    # Without labels nothing is toxic; equal rows and the two long texts keep one each; the run of one letter vanishes;
    # the three rows with the benchmark's words go.
    assert count["toxicity"] == count["byte_bpe"] == 11 and count["benchmark_decontamination"] == 8
    for name in list(stages)[:-1]:
        assert stages[name](spark, odd, str(tmp_path)).columns == odd.columns
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {None, 2, 6} <= {r.doc_id for r in rows} and not [r for r in rows if r.doc_id == 5]


def test_line_sets_equal_one_by_one(texts):
    draw = random.Random(11)
    rows = [t.encode() for t in texts.values()] + [None, b"", b"\n\n", b"a b\nc d e f g h a b c d e f g h\n" * 3, " ".join(draw.choice("abc") for _ in range(20_000)).encode()]
    for least, size in ((25, 5), (3, 5), (1, 2)):
        sets = paragraph_dedup.LineSets(rows, least, size, paragraph_dedup.WordHashes())
        shingler, minhash = near.Shingler(size), near.MinHash(24)
        expected = [(i, a, b, shingler.shingles(w)) for i, t in enumerate(rows) for a, b, w in paragraph_dedup.paragraphs(t or b"", least, size)]
        assert [e[:3] for e in expected] == list(zip(sets.text.tolist(), sets.begin.tolist(), sets.end.tolist(), strict=True))
        assert all(np.array_equal(h, sets.hashes[a:b]) for (*_, h), a, b in zip(expected, sets.at[:-1], sets.at[1:], strict=True))
        chosen = np.array(sorted(draw.sample(range(len(expected)), len(expected) // 2)))
        signed = sets.signatures(chosen, minhash)
        assert all(np.array_equal(signed[i], minhash.signature(expected[c][3])) for i, c in enumerate(chosen.tolist()))
        keys = paragraph_dedup.band_matrix(signed, 4)
        assert keys.shape == (len(chosen), 6) and len(np.unique(keys)) == len({(b, *row[4 * b : 4 * b + 4]) for row in signed.tolist() for b in range(6)})


def test_packed_entries_come_back():
    draw = np.random.default_rng(2)
    for kind in (paragraph_dedup._SEED, paragraph_dedup._BAND, paragraph_dedup._PASSAGE):
        for n in (0, 1, 500):
            entries = np.zeros(n, kind)
            for name in kind.names:
                entries[name] = draw.integers(0, 2 if name == "known" else 2**31 if name in "gpab" else 2**62, n)
            for name in ("t1", "t2", "doc"):
                if name in kind.names:
                    entries[name] = draw.choice([-5, 3, 2**62], n)
            if "b" in kind.names:
                entries["b"] = entries["a"] + draw.integers(0, 2**20, n)
            back = paragraph_dedup._unpack(paragraph_dedup._pack(entries), kind, 3)
            if kind == paragraph_dedup._BAND:
                # Equal keys stay equal, others differ, and keys of other parts are others.
                assert np.array_equal(back["k"], entries["k"]) and (back["h"] >> np.uint64(40) == 3).all()
                same = {(int(a), int(b)) for a, b in zip(entries["h"], back["h"], strict=True)}
                assert len(same) == len(set(entries["h"].tolist())) == len(set(back["h"].tolist()))
            else:
                assert np.array_equal(back, entries)


def test_order_by_owner_and_hash():
    draw = np.random.default_rng(3)
    for high in (2**64 - 1, 2**21):  # many ties of the high bits
        hashes, owner = draw.integers(0, high, 5000, np.uint64), np.sort(draw.integers(0, 50, 5000))
        order = paragraph_dedup._by_owner(hashes, owner)
        assert np.array_equal(hashes[order], hashes[np.lexsort((hashes, owner))]) and np.array_equal(owner[order], owner)


def test_set_tags_are_those_of_sql(spark):
    from pyspark.sql import functions as F
    import xxhash

    keys = [hashlib.md5(bytes([i])).digest() for i in range(50)]
    rows = spark.createDataFrame([(bytearray(k),) for k in keys], "k binary").select("k", F.xxhash64("k").alias("tag")).collect()
    assert all(r.tag == np.array([xxhash.xxh64_intdigest(bytes(r.k), 42)], np.uint64).view(np.int64)[0] for r in rows)
