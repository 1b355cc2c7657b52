"""What the operators leave on disk, and how much of a table they hold at once."""

from __future__ import annotations

import random
import time

import numpy as np
from pyspark.sql import functions as F

from eventloom.llm import paragraph_dedup, suffix_dedup
from eventloom.llm.common import row_key, store


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {f for f in found.split("\n") if "/shuffle_" in f}


def test_stored_rows_leave_no_shuffle_files(spark):
    spark.sparkContext._jvm.System.gc()
    before = shuffle_files(spark)
    kept = store(spark.range(5000).groupBy((F.col("id") % 50).alias("k")).agg(F.sum("id").alias("s")), "sums")
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert kept.agg(F.sum("s")).first()[0] == 5000 * 4999 // 2 and spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_long_texts_go_in_small_batches(spark):
    import pyarrow as pa

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    docs = spark.range(0, 3000, 1, 1).select(F.col("id").alias("doc_id"), F.concat(F.col("id").cast("string"), F.repeat(F.lit(" word"), 2000)).alias("text"))

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], names=["n"])

    for find in (suffix_dedup.remove_repeats, paragraph_dedup.remove_repeats):
        spark.conf.unset(key)
        find(docs.limit(3))
        assert max(r.n for r in docs.mapInArrow(sizes, "n long").collect()) < 8 << 20
    spark.conf.set(key, before)


def test_seeds_of_many_texts_at_once():
    draw, least = random.Random(5), 25
    ids = [np.array([draw.getrandbits(64) for _ in range(n)], np.uint64) for n in (0, 3, 24, 25, 26, 200, 12, 25, 0)]
    owner = np.repeat(np.arange(len(ids)), [len(i) for i in ids])
    places, hashes = paragraph_dedup._seeds(np.concatenate(ids), least, owner)
    size, expected, at = least // 2 + 1, set(), 0
    for own in ids:
        every = paragraph_dedup._seed_hashes(own, least).tolist() if len(own) >= least else []
        for begin in range(len(own) - least + 1):
            best = min(every[begin : begin + least - size + 1])
            expected |= {(at + p, best) for p in range(begin, begin + least - size + 1) if every[p] == best}
        at += len(own)
    assert set(zip(places.tolist(), hashes.tolist(), strict=True)) == expected and len(expected) > 20


def test_one_pass_gives_paragraphs_bands_and_seeds(spark):
    """Each text is split once; paragraphs, common band keys and repeated seeds come from the same pass."""
    run = " ".join(f"w{i}" for i in range(40))
    line = "one two three four five six seven eight"
    rows = [(1, f"{line}\nfour words are few\n{run} end"), (2, f"{line} nine\nstart {run}"), (None, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    args = (docs, "text", 25, 5, 24, 4, 0.8, 3, 2)
    out = paragraph_dedup._one_pass(*args).collect()
    texts = {row_key(i, t.encode() if t else None): t for i, t in rows}
    lines = {(r.doc_id, texts[r.t1, r.t2].encode()[r.a : r.b].decode()) for r in out if r.kind == 0}
    assert lines == {(i, x) for i, t in rows for x in (t or "").split("\n") if len(x.split()) >= 5}
    assert len({r.tag for r in out if r.kind == 1}) == 4 and all(r.leader <= r.tag for r in out if r.kind == 1)
    seeds = {}
    for r in out:
        if r.kind == 2:
            words = texts[r.t1, r.t2].split()
            seeds.setdefault(" ".join(words[r.p : r.p + 13]), set()).add((r.t1, r.t2))
    assert seeds and all(len(at) == 2 and text in run for text, at in seeds.items())


def test_passages_of_one_text_are_joined():
    """Neighbours go to one part by their common seed and come out as one row."""
    entries = np.zeros(6, paragraph_dedup._PASSAGE)
    entries["t1"] = [7, 7, 7, 7, -1, 7]
    entries["a"] = [30, 0, 5, 100, 5, 12]
    entries["b"] = [60, 10, 12, 140, 20, 22]
    joined = paragraph_dedup._joined(entries)
    assert sorted(zip(joined["t1"].tolist(), joined["a"].tolist(), joined["b"].tolist(), strict=True)) == [(-1, 5, 20), (7, 0, 22), (7, 30, 60), (7, 100, 140)]
    assert len(paragraph_dedup._joined(entries[:0])) == 0
