"""Near-duplicate links between sets of hashes: signatures, candidate units, exact verification, components.

Sets that share a band of MinHash values are candidates. Instead of writing out pairs, every set gets a home (the
smallest leader within two buckets' reach) and homes that meet in a bucket form a unit; the sets of a unit are compared inside one
task, which returns a count of links and a local root for each set. Large homes are cut into blocks, and each pair of
blocks is a unit of its own, so no unit grows with the size of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import mixed, store, words_of

WORDS = 5
SIMILAR = 0.8
#: Sets and hashes in one block; a unit compares two blocks at most.
BLOCK_SETS, BLOCK_HASHES = 512, 400_000


def run_hashes(ids: np.ndarray, size: int, factor: int) -> np.ndarray:
    """Polynomial hash of every run of ``size`` ids; runs of one, two, four, ... ids are put together."""
    out, done, power = None, 0, ids
    length, weight = 1, factor
    with np.errstate(over="ignore"):
        while True:
            if size & length:
                n = len(ids) - done - length + 1
                out = power[:n] if out is None else out[:n] * np.uint64(weight) + power[done : done + n]
                done += length
            if done == size:
                return out
            power = power[:-length] * np.uint64(weight) + power[length:]
            length, weight = 2 * length, weight * weight % 2**64


class Shingler:
    """Sets of hashed runs of words. Word hashes are remembered; the memory is cleared when full."""

    def __init__(self, words: int = WORDS, most: int = 300_000) -> None:
        self.words, self.most, self.known = words, most, {}

    def ids(self, words: list[bytes]) -> np.ndarray:
        known = self.known
        try:
            return np.array([known[w] for w in words], np.uint64)
        except KeyError:
            if len(known) > self.most:
                known.clear()
            digest = xxhash.xxh3_64_intdigest
            for w in words:
                if w not in known:
                    known[w] = digest(w)
            return np.array([known[w] for w in words], np.uint64)

    def shingles(self, words: list[bytes]) -> np.ndarray:
        """Sorted distinct hashes of all runs; fewer words than a run make one shorter run; no words make none."""
        if not words:
            return np.zeros(0, np.uint64)
        ids = self.ids(words)
        size = min(self.words, len(ids))
        with np.errstate(over="ignore"):
            out = np.full(len(ids) - size + 1, np.uint64(size))
            for k in range(size):
                out = out * np.uint64(0x9E3779B97F4A7C15) + ids[k : k + len(out)]
        return np.unique(mixed(out))

    def of_text(self, text: bytes | None) -> np.ndarray:
        return self.shingles(words_of(text))


class MinHash:
    """Signatures of ``size`` 32-bit values."""

    def __init__(self, size: int) -> None:
        draw = mixed(np.arange(1, 2 * size + 1, dtype=np.uint64))
        self.flip, self.factor = draw[:size].astype(np.uint32), draw[size:].astype(np.uint32) | np.uint32(1)

    def signature(self, hashes: np.ndarray) -> np.ndarray:
        out = np.full(len(self.flip), 2**32 - 1, np.uint32)
        short = (hashes >> np.uint64(32)).astype(np.uint32)
        for i in range(0, len(short), 512):
            part = (short[i : i + 512, None] ^ self.flip) * self.factor
            part ^= part >> np.uint32(15)
            np.minimum(out, part.min(axis=0), out=out)
        return out


def band_keys(signature: np.ndarray, rows: int) -> list[int]:
    """One 64-bit key for each band of ``rows`` values."""
    digest = xxhash.xxh3_64_intdigest
    raw = signature.tobytes()
    step = 4 * rows
    return [digest(raw[i : i + step], i) - 2**63 for i in range(0, len(raw) - step + 1, step)]


def tune_bands(similar: float, recall: float, most_hashes: int) -> tuple[int, int]:
    """(bands, rows) that find a pair of just ``similar`` with at least ``recall``, with rows as many as possible."""
    for rows in range(8, 0, -1):
        for bands in range(1, most_hashes // rows + 1):
            if 1 - (1 - similar**rows) ** bands >= recall:
                return bands, rows
    raise ValueError("more hashes are needed for this recall")


def least_matches(seen: int, similar: float, tolerance: float) -> int:
    """Fewest equal values among ``seen`` with which P(similarity >= ``similar``) is not below ``tolerance``.

    With a uniform prior the posterior after m equal of n values is Beta(m + 1, n - m + 1); its upper tail at s is the
    chance of at most m successes among n + 1 trials with probability s.
    """
    tail = 0.0
    for m in range(seen + 1):
        tail += comb(seen + 1, m) * similar**m * (1 - similar) ** (seen + 1 - m)
        if tail >= tolerance:
            return m
    return seen


def candidate_units(bands: DataFrame, sizes: DataFrame) -> DataFrame:
    """k, ``units`` (uid, side, alone) of every set that shares a bucket with another set.

    ``bands``: k, b; ``sizes``: k, n (hashes in the set), one row per set. Sets in no common bucket have no row.
    """
    # A set is told from others by a hash of its key here; equal hashes only make more candidates.
    tagged = bands.select("k", "b", F.xxhash64("k").alias("h"))
    buckets = tagged.groupBy("b").agg(F.min("h").alias("leader"), F.max("h").alias("_last")).where("leader < _last").select(F.col("b").alias("_b"), "leader")
    members = store(tagged.join(buckets, tagged.b == buckets._b).select("k", "b", "leader"), "bucket-members")
    return member_units(members, sizes)


def member_units(members: DataFrame, sizes: DataFrame) -> DataFrame:
    """``candidate_units`` from stored members of common buckets: k, b, leader (one long for each bucket, of one of its sets)."""
    # Two steps towards the smallest leader around, so that a group of near copies has few homes and few units.
    near_by = store(members.join(members.groupBy("k").agg(F.min("leader").alias("home")), "k").select("k", "b", "home"), "near-by")
    around = near_by.groupBy("b").agg(F.min("home").alias("leader"))
    homes = store(near_by.join(around, "b").groupBy("k").agg(F.min("leader").alias("home")), "homes")
    sized = homes.join(sizes, "k")
    blocks = sized.groupBy("home").agg(F.count("*").alias("sets"), F.sum("n").alias("hashes")).select(
        "home", F.greatest(F.ceil(F.col("sets") / BLOCK_SETS), F.ceil(F.col("hashes") / BLOCK_HASHES), F.lit(1)).cast("int").alias("blocks"), "sets"
    )
    met = members.join(homes, "k").select("b", "home").distinct().groupBy("b").agg(F.array_sort(F.collect_set("home")).alias("hs")).where("size(hs) > 1").select("hs").distinct()
    pairs = met.select(F.explode(F.expr("flatten(transform(sequence(1, size(hs) - 1), i -> transform(slice(hs, i + 1, size(hs)), h -> struct(hs[i - 1] AS g, h AS h))))")).alias("p")).select("p.g", "p.h").distinct()
    one, two = blocks.select(F.col("home").alias("g"), F.col("blocks").alias("gb")), blocks.select(F.col("home").alias("h"), F.col("blocks").alias("hb"))
    across = pairs.join(one, "g").join(two, "h").select("g", "h", F.explode(F.sequence(F.lit(0), F.col("gb") - 1)).alias("i"), "hb").select("g", "i", "h", F.explode(F.sequence(F.lit(0), F.col("hb") - 1)).alias("j"))
    within = blocks.where("sets > 1").select(F.col("home").alias("g"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("i"), F.col("home").alias("h"), "blocks").select("g", "i", "h", F.explode(F.sequence(F.col("i"), F.col("blocks") - 1)).alias("j"))
    units = across.unionByName(within).withColumn("uid", F.xxhash64("g", "i", "h", "j"))
    alone = (F.col("g") == F.col("h")) & (F.col("i") == F.col("j"))
    units = units.withColumn("alone", alone)
    sides = units.select(F.col("g").alias("home"), F.col("i").alias("block"), F.struct("uid", F.lit(0).alias("side"), "alone").alias("u")).unionByName(
        units.where(~F.col("alone")).select(F.col("h").alias("home"), F.col("j").alias("block"), F.struct("uid", F.lit(1).alias("side"), "alone").alias("u"))
    )
    placed = sized.join(blocks.select("home", "blocks"), "home").select("k", "home", F.pmod(F.xxhash64("k", F.lit(1)), F.col("blocks")).cast("int").alias("block"))
    return placed.join(sides, ["home", "block"]).groupBy("k").agg(F.collect_list("u").alias("units"))


UNIT_TYPE = "uid long, side int, alone boolean, k binary, sig binary, hashes binary"
_UNIT_KINDS = [pa.int64(), pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]


def unit_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _UNIT_KINDS, strict=True)], names=["uid", "side", "alone", "k", "sig", "hashes"])


class Verifier:
    """Links inside one unit."""

    def __init__(self, similar: float, tolerance: float | None, step: int = 24) -> None:
        self.similar, self.tolerance, self.step = similar, tolerance, step
        self.least: dict[int, int] = {}

    def _pruned(self, a: np.ndarray, b: np.ndarray, x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Compare MinHash values step by step and drop pairs whose posterior falls below the tolerance."""
        width = a.shape[1]
        equal = np.zeros(len(x), np.int32)
        for begin in range(0, width, self.step):
            seen = min(begin + self.step, width)
            for i in range(0, len(x), 100_000):
                equal[i : i + 100_000] += (a[x[i : i + 100_000], begin:seen] == b[y[i : i + 100_000], begin:seen]).sum(1, dtype=np.int32)
            if seen not in self.least:
                self.least[seen] = least_matches(seen, self.similar, self.tolerance)
            keep = equal >= self.least[seen]
            x, y, equal = x[keep], y[keep], equal[keep]
            if not len(x):
                break
        return x, y

    def links(self, first: list[tuple], second: list[tuple] | None) -> tuple[np.ndarray, np.ndarray]:
        """Places (in ``first``, and in ``second`` or again ``first``) of the pairs that reach the similarity."""
        other = first if second is None else second
        if second is None:
            x, y = np.triu_indices(len(first), 1)
        else:
            x, y = (v.ravel() for v in np.indices((len(first), len(other))))
        na, nb = np.array([len(s[2]) for s in first]), np.array([len(s[2]) for s in other])
        small, large = np.minimum(na[x], nb[y]), np.maximum(na[x], nb[y])
        possible = small >= self.similar * large - 1e-9
        x, y = x[possible], y[possible]
        if self.tolerance is not None and len(x):
            a = np.stack([s[1] for s in first])
            x, y = self._pruned(a, a if second is None else np.stack([s[1] for s in other]), x, y)
        if not len(x):
            return x, y
        common = self._common(first, other, x, y)
        good = common >= self.similar * (na[x] + nb[y] - common) - 1e-9
        return x[good], y[good]

    def _common(self, first: list[tuple], other: list[tuple], x: np.ndarray, y: np.ndarray) -> np.ndarray:
        if len(x) < 8 * (len(first) + len(other)):
            return np.array([np.intersect1d(first[i][2], other[j][2], assume_unique=True).size for i, j in zip(x.tolist(), y.tolist(), strict=True)])
        # Many pairs: count common hashes by products of membership matrices, some columns at a time.
        both = first if other is first else first + other
        values = np.concatenate([s[2] for s in both])
        rows = np.repeat(np.arange(len(both)), [len(s[2]) for s in both])
        _, columns, times = np.unique(values, return_inverse=True, return_counts=True)
        shared = times[columns] > 1
        rows, columns = rows[shared], np.unique(columns[shared], return_inverse=True)[1] if shared.any() else columns[shared]
        total = np.zeros((len(first), len(other)), np.float32)
        order = np.argsort(columns, kind="stable")
        rows, columns = rows[order], columns[order]
        width = 4096
        for begin in range(0, int(columns[-1]) + 1 if len(columns) else 0, width):
            a, b = np.searchsorted(columns, [begin, begin + width])
            member = np.zeros((len(both), width), np.float32)
            member[rows[a:b], columns[a:b] - begin] = 1
            total += member[: len(first)] @ (member.T if other is first else member[len(first) :].T)
        return total[x, y].astype(int)


def _components(n: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Smallest place of the component of every place."""
    label = np.arange(n)
    while True:
        new = label.copy()
        np.minimum.at(new, x, label[y])
        np.minimum.at(new, y, label[x])
        new = new[new]
        if np.array_equal(new, label):
            return label
        label = new


def solve_units(rows: DataFrame, similar: float, tolerance: float | None) -> DataFrame:
    """k, n_links and a local ``root`` for every set with links in a unit. ``rows``: see ``UNIT_TYPE``.

    Each pair of sets meets in exactly one unit, so counts add up over units. Repeated rows of a set count once.
    With a tolerance, pairs are first compared by their signatures; what passes is verified exactly.
    """

    def solve(check: Verifier, unit: list[tuple]) -> list[tuple]:
        seen: dict[tuple, tuple] = {}
        for side, alone, k, sig, hashes in unit:
            seen.setdefault((side, k), (k, np.frombuffer(sig, np.uint32), np.frombuffer(hashes, np.uint64)))
        first = sorted([v for (side, _), v in seen.items() if side == 0], key=lambda v: v[0])
        second = None if unit[0][1] else sorted([v for (side, _), v in seen.items() if side == 1], key=lambda v: v[0])
        if not first or (second is not None and not second) or (second is None and len(first) < 2):
            return []
        x, y = check.links(first, second)
        if not len(x):
            return []
        both = first if second is None else first + second
        y = y if second is None else y + len(first)
        counts = np.bincount(x, minlength=len(both)) + np.bincount(y, minlength=len(both))
        label = _components(len(both), x, y)
        least: dict[int, bytes] = {}
        linked = np.flatnonzero(counts).tolist()
        for i in linked:
            least[label[i]] = min(least.get(label[i], both[i][0]), both[i][0])
        return [(both[i][0], int(counts[i]), least[label[i]]) for i in linked]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        check = Verifier(similar, tolerance)
        unit: list[tuple] = []
        now = None
        out: list[tuple] = []

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.binary(), pa.int64(), pa.binary()), strict=True)], names=["k", "n_links", "root"])

        for batch in batches:
            for uid, *row in zip(*[batch.column(c).to_pylist() for c in ("uid", "side", "alone", "k", "sig", "hashes")], strict=True):
                if uid != now:
                    if unit:
                        out += solve(check, unit)
                    unit, now = [], uid
                unit.append(row)
            if len(out) > 2000:
                yield batch_of(out)
                out = []
        if unit:
            out += solve(check, unit)
        if out:
            yield batch_of(out)

    return rows.repartition("uid").sortWithinPartitions("uid").mapInArrow(run, "k binary, n_links long, root binary")


def components(edges: DataFrame, most_rounds: int = 50) -> DataFrame:
    """k, root: the smallest key of the component of every key in ``edges`` (k, root).

    Each round hangs every neighbour on the smallest one around (large and small stars); all minima are combined before
    the shuffle, and only two numbers come to the driver to see whether anything changed.
    """
    edges = store(edges.where("k <> root").select(F.greatest("k", "root").alias("u"), F.least("k", "root").alias("v")).distinct(), "edges")
    state = None
    for _ in range(most_rounds):
        now = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("x")).first()
        if (now.n, now.x) == state:
            return edges.select(F.col("u").alias("k"), F.col("v").alias("root"))
        state = (now.n, now.x)
        around = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = around.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), F.least("u", "m").alias("m"))
        large = around.join(least, around.u == least.c).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("c"), "m")
        small = large.join(least, large.u == least.c).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(least.select(F.col("c").alias("u"), F.col("m").alias("v")))
        edges = store(small.distinct(), "edges")
    raise RuntimeError("components did not settle")
