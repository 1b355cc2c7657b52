"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Labels mark whole documents. Tokens are labelled from them: a small set of token features (words and beginnings of
words) is chosen that explains toxic documents and hardly occurs in others; tokens of toxic documents that have such a
feature are tagged 1, all other tokens 0. A field with two states is fitted to these tags by gradient steps with
forward-backward sums, over a bounded sample. Scoring runs forward-backward over every line of every whole text; the
marginals give the expected number of toxic tokens and the offending spans, and a logistic link gives the score.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventloom.llm.common import raw_texts, slices, text_first, words_of

#: Labelled documents per class that the model is fitted on, chosen by a hash of their id; longer texts are not used
#: for fitting (they are scored whole).
SAMPLE_DOCS = 2000
SAMPLE_BYTES = 60_000
#: Lines used for fitting the field.
SAMPLE_LINES = 9000
#: Chains used for fitting are cut after so many words.
FIT_CHAIN = 64
#: A chain goes on for at most so many words; the next word of the line starts a new chain.
CHAIN = 256
REMEMBERED = 400_000


def features(word: bytes) -> list[bytes]:
    """The word itself, its first 3 to 6 letters and its last 3 bytes (letters count as code points)."""
    text = word.decode("utf-8", "replace")
    return [b"w" + word, *(b"p%d" % k + text[:k].encode() for k in (3, 4, 5, 6) if len(text) > k), b"s" + text[-3:].encode()]


def lines_of(text: bytes | None) -> Iterator[list[bytes]]:
    """Chains of words: the lines of a text, cut after ``CHAIN`` words."""
    for line in (text or b"").split(b"\n"):
        words = words_of(line)
        for i in range(0, len(words), CHAIN):
            yield words[i : i + CHAIN]


def marginals(gain: np.ndarray, lengths: np.ndarray, move: np.ndarray) -> np.ndarray:
    """P(state 1) of every token. ``gain``: log-odds of state 1 from the features, one row per chain, padded."""
    return _sweep(gain, lengths, move, False)[0]


def _sweep(gain: np.ndarray, lengths: np.ndarray, move: np.ndarray, count: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Marginals, and the expected number of moves between states. Works with probabilities scaled at every step."""
    n, width = gain.shape
    stay = np.exp(move)
    odds = np.exp(np.clip(gain, -30, 30))
    ahead = np.empty((n, width))  # share of state 1 after the words so far
    share = odds[:, 0] / (1 + odds[:, 0])
    ahead[:, 0] = share
    for t in range(1, width):
        zero = (1 - share) * stay[0, 0] + share * stay[1, 0]
        one = ((1 - share) * stay[0, 1] + share * stay[1, 1]) * odds[:, t]
        share = one / (zero + one)
        ahead[:, t] = share
    out = np.empty((n, width))
    moves = np.zeros((2, 2))
    behind = np.full(n, 0.5)  # weight of state 1 from the words that follow
    for t in range(width - 1, -1, -1):
        behind = np.where(lengths - 1 <= t, 0.5, behind)
        one, zero = ahead[:, t] * behind, (1 - ahead[:, t]) * (1 - behind)
        out[:, t] = one / (one + zero)
        if t:
            zero_next, one_next = 1 - behind, behind * odds[:, t]
            zero = stay[0, 0] * zero_next + stay[0, 1] * one_next
            one = stay[1, 0] * zero_next + stay[1, 1] * one_next
            if count:
                inside, before = t < lengths, ahead[:, t - 1]
                total = (1 - before) * zero + before * one
                for a, share in ((0, 1 - before), (1, before)):
                    for b, follow in ((0, zero_next), (1, one_next)):
                        moves[a, b] += (share * stay[a, b] * follow / total)[inside].sum()
            behind = one / (zero + one)
    out[np.arange(width) >= lengths[:, None]] = 0.0
    return out, moves


def _padded(values: list[np.ndarray], empty: float) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.array([len(v) for v in values])
    out = np.full((len(values), int(lengths.max())), empty)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.concatenate(values)
    return out, lengths


@dataclass
class Model:
    """A fitted field and its link to document scores. Small: its features come from a bounded sample."""

    prior: float
    bias: float = 0.0
    weights: dict[bytes, float] = field(default_factory=dict)
    move: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    link: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def gain(self, word: bytes) -> float:
        """Log-odds of state 1. Words without evidence for toxicity are all alike: evidence against it is not used."""
        return self.bias + max(0.0, sum(self.weights.get(f, 0.0) for f in features(word)))

    def evidence(self) -> tuple[set[bytes], set[bytes]]:
        """First and last three bytes of the words that any feature fits; all other words have no evidence."""
        heads = {f[1:4] if f[:1] == b"w" else f[2:5] for f in self.weights if f[:1] != b"s"}
        return heads, {f[-3:] for f in self.weights if f[:1] == b"s"}

    def document(self, expected: float, most: float) -> float:
        if not self.weights:
            return self.prior
        z = self.link[0] + self.link[1] * np.log1p(expected) + self.link[2] * most
        return float(1 / (1 + np.exp(-np.clip(z, -30, 30))))


class Scorer:
    """Scores batches of texts; remembers the gain of words."""

    def __init__(self, model: Model) -> None:
        self.model, self.known = model, {}
        self.heads, self.tails = model.evidence()
        # A chain of words without evidence depends on its length alone.
        lengths = np.arange(1, CHAIN + 1)
        self.plain = marginals(np.full((CHAIN, CHAIN), model.bias), lengths, model.move)

    def chains(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The text, first word and number of words of every chain, and the marginals of all words."""
        known = self.known
        if len(known) > REMEMBERED:
            known.clear()
        owner, lengths, words = [], [], []
        for i, text in enumerate(texts):
            for chain in lines_of(text):
                owner.append(i)
                lengths.append(len(chain))
                words += chain
        heads, tails, bias = self.heads, self.tails, self.model.bias
        for w in set(words).difference(known):
            known[w] = self.model.gain(w) if w[:3] in heads or w[-3:] in tails else bias
        gains = np.array([known[w] for w in words])
        sizes = np.array(lengths, int)
        starts = np.cumsum(sizes) - sizes
        out = np.empty(len(gains))
        if len(sizes):
            loud = np.maximum.reduceat(gains, starts) > self.model.bias + 1e-12
            # Quiet chains by length; the others in padded blocks of similar length.
            for n in np.unique(sizes[~loud]).tolist():
                at = starts[~loud & (sizes == n)]
                out[at[:, None] + np.arange(n)] = self.plain[n - 1, :n]
            for bucket in np.unique((sizes[loud] + 7) // 8).tolist():
                rows = np.flatnonzero(loud & ((sizes + 7) // 8 == bucket))
                block, long = _padded([gains[starts[k] : starts[k] + sizes[k]] for k in rows.tolist()], self.model.bias)
                found = marginals(block, long, self.model.move)
                for k, row, n in zip(rows.tolist(), found, long.tolist(), strict=True):
                    out[starts[k] : starts[k] + n] = row[:n]
        return np.array(owner, int), starts, out

    def score(self, texts: list[bytes | None]) -> tuple[list[float], list[tuple[float, float]], list[list[tuple[int, int]]]]:
        """Scores, (expected toxic words, largest marginal), and spans as byte offsets."""
        owner, starts, found = self.chains(texts)
        expected, most = np.zeros(len(texts)), np.zeros(len(texts))
        if len(starts):
            np.add.at(expected, owner, np.add.reduceat(found, starts))
            np.maximum.at(most, owner, np.maximum.reduceat(found, starts))
        spans: list[list[tuple[int, int]]] = [[] for _ in texts]
        ends = [*starts[1:].tolist(), len(found)]
        for i in np.flatnonzero(most >= 0.5).tolist():
            first, last = np.searchsorted(owner, i), np.searchsorted(owner, i, "right") - 1
            spans[i] = _spans(texts[i], found[starts[first] : ends[last]] >= 0.5)
        scores = [self.model.document(e, m) for e, m in zip(expected.tolist(), most.tolist(), strict=True)]
        return scores, list(zip(expected.tolist(), most.tolist(), strict=True)), spans


_TOKEN = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def _spans(text: bytes, marked: np.ndarray) -> list[tuple[int, int]]:
    """Runs of marked words as byte offsets."""
    out: list[tuple[int, int]] = []
    before = False
    for match, hit in zip(_TOKEN.finditer(text), marked.tolist(), strict=True):
        if hit and before:
            out[-1] = (out[-1][0], match.end())
        elif hit:
            out.append(match.span())
        before = hit
    return out


def choose_features(toxic: list[set[bytes]], clean: Iterable[set[bytes]], n_clean: int) -> set[bytes]:
    """Features that explain toxic documents, picked one by one by how many unexplained documents they add.

    A document that a chosen feature explains no longer counts for others, so words that only come along with copies
    of one toxic document are not chosen.
    """
    least = max(3, len(toxic) // 200)
    in_toxic, in_clean = Counter(f for d in toxic for f in d), Counter()
    kept = {f for f, c in in_toxic.items() if c >= least}
    for d in clean:
        in_clean.update(d & kept)
    scale = len(toxic) / max(1, n_clean)
    kept = {f for f in kept if (in_clean[f] + 0.5) * scale <= 0.08 * in_toxic[f]}
    holders = defaultdict(set)
    for i, d in enumerate(toxic):
        for f in d & kept:
            holders[f].add(i)
    chosen, open_docs = set(), set(range(len(toxic)))
    while holders:
        # Documents of the other class weigh against a feature; of equal ones a whole word, then a fixed order.
        best = max(holders, key=lambda f: (len(holders[f] & open_docs) - 20 * scale * in_clean[f], len(holders[f]), f[:1] == b"w", f))
        if len(holders[best] & open_docs) - 20 * scale * in_clean[best] < least:
            break
        chosen.add(best)
        open_docs -= holders.pop(best)
    return chosen


def fit(documents: list[tuple[bytes, int]], prior: float, rounds: int = 40) -> Model:
    """Fit the field and the link on (text, label) pairs; ``prior`` is the share of toxic documents among all labelled."""
    texts = [t for t, _ in documents]
    labels = np.array([y for _, y in documents], float)
    if not len(labels) or labels.min() == labels.max():
        return Model(prior)
    seen: dict[bytes, list[bytes]] = {}

    def of(word: bytes) -> list[bytes]:
        got = seen.get(word)
        if got is None:
            got = seen[word] = features(word)
        return got

    chains = [list(lines_of(t)) for t in texts]

    def bags(wanted: bool) -> Iterator[set[bytes]]:
        return ({f for w in {w for line in c for w in line} for f in of(w)} for c, y in zip(chains, labels, strict=True) if bool(y) == wanted)

    chosen = choose_features(list(bags(True)), bags(False), int((labels == 0).sum()))
    if not chosen:
        return Model(prior)
    tagged, plain = [], []
    for c, y in zip(chains, labels, strict=True):
        for whole in c:
            for i in range(0, len(whole), FIT_CHAIN):
                line = whole[i : i + FIT_CHAIN]
                tags = np.array([bool(y) and not chosen.isdisjoint(of(w)) for w in line], float)
                (tagged if tags.any() else plain).append((line, tags))
    pick = np.random.default_rng(7)

    def some(rows: list, most: int) -> list:
        return rows if len(rows) <= most else [rows[i] for i in sorted(pick.choice(len(rows), most, replace=False).tolist())]

    used = some(tagged, SAMPLE_LINES // 2) + some(plain, SAMPLE_LINES // 2)
    hot = Counter(f for line, tags in used for w, t in zip(line, tags, strict=True) if t for f in of(w))
    names = sorted(f for f, c in hot.items() if c >= 2 or f in chosen)
    place = {f: i for i, f in enumerate(names)}
    weights, bias, move = np.zeros(len(names)), -4.0, np.zeros((2, 2))
    groups = defaultdict(list)
    for k, (line, _) in enumerate(used):
        groups[(len(line) + 7) // 8].append(k)
    blocks, n_tags, wanted_moves, total = [], np.zeros(len(names)), np.zeros((2, 2)), 0.0
    for rows in groups.values():
        tags, lengths = _padded([used[k][1] for k in rows], 0.0)
        row, column, which = [], [], []
        for r, k in enumerate(rows):
            for c, w in enumerate(used[k][0]):
                for f in of(w):
                    if f in place:
                        row.append(r), column.append(c), which.append(place[f])
        at = np.array(row, int) * tags.shape[1] + np.array(column, int)
        which = np.array(which, int)
        blocks.append((tags.shape, lengths, at, which))
        np.add.at(n_tags, which, tags.ravel()[at])
        total += tags.sum()
        state = tags.astype(int)
        inside = np.arange(1, tags.shape[1]) < lengths[:, None]
        for a in (0, 1):
            for b in (0, 1):
                wanted_moves[a, b] += ((state[:, :-1] == a) & (state[:, 1:] == b) & inside).sum()
    scale = 1.0 / sum(len(line) for line, _ in used)
    first, second = np.zeros(len(names) + 5), np.zeros(len(names) + 5)
    for step in range(1, rounds + 1):
        got, got_total, got_moves = np.zeros(len(names)), 0.0, np.zeros((2, 2))
        for shape, lengths, at, which in blocks:
            gain = np.full(shape[0] * shape[1], bias)
            np.add.at(gain, at, weights[which])
            p, moves = _sweep(gain.reshape(shape), lengths, move)
            np.add.at(got, which, p.ravel()[at])
            got_total += p.sum()
            got_moves += moves
        slope = np.concatenate([n_tags - got - 0.3 * weights, [total - got_total], (wanted_moves - got_moves).ravel() - 0.3 * move.ravel()])
        slope = slope * scale
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        change = 0.4 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-10)
        weights, bias, move = weights + change[: len(names)], bias + change[len(names)], move + change[len(names) + 1 :].reshape(2, 2)
    model = Model(prior, float(bias), {f: float(w) for f, w in zip(names, weights, strict=True) if abs(w) > 1e-4}, move)
    scorer = Scorer(model)
    facts = [f for i in range(0, len(texts), 500) for f in scorer.score(texts[i : i + 500])[1]]
    model.link = _link(facts, labels, prior)
    return model


def _link(facts: list[tuple[float, float]], labels: np.ndarray, prior: float) -> tuple[float, float, float]:
    """Logistic regression on the two facts, weighted to the share of toxic documents among all labelled ones."""
    x = np.column_stack([np.ones(len(facts)), np.log1p([e for e, _ in facts]), [m for _, m in facts]])
    weight = np.where(labels > 0, prior / max(labels.mean(), 1e-9), (1 - prior) / max(1 - labels.mean(), 1e-9))
    b = np.zeros(3)
    ridge = np.diag([1e-6, 0.02, 0.02]) * len(labels) / 50
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        slope = x.T @ (weight * (labels - p)) - ridge @ b
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + ridge + 1e-9 * np.eye(3)
        b = b + np.linalg.solve(curve, slope)
    return float(b[0]), float(max(0.0, b[1])), float(max(0.0, b[2]))


def held_out(doc_id: str = "doc_id"):
    """Documents never learned from: crc32 of the id as text, mod 4, is 2. A null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_bytes: int = SAMPLE_BYTES) -> Model:
    """Fit on at most ``sample_docs`` labelled documents of each class that are not held out.

    Null labels and ids are left out; of several labels of one id the larger counts, of several texts the smallest.
    Without both classes the score is the share of toxic labels for every text (0 without labels).
    """
    known = labels.where(~held_out() & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max(F.when(F.col("toxic") > 0, 1).otherwise(0)).alias("toxic"))
    n, toxic = known.agg(F.count("*"), F.sum("toxic")).first()
    if not n:
        return Model(0.0)
    order = F.xxhash64("doc_id")
    parts = [known.where(F.col("toxic") == y).orderBy(order, "doc_id").limit(sample_docs) for y in (0, 1)]
    sample = F.broadcast(parts[0].unionAll(parts[1]))  # at most two times sample_docs ids
    rows = docs.select("doc_id", "text").where(F.octet_length("text") <= sample_bytes).join(sample, "doc_id")
    rows = rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.max("toxic").alias("toxic"))
    prior = toxic / n

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = [pair for b in batches for pair in zip(raw_texts(b.column("text")), b.column("toxic").to_pylist(), strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(sample, prior))], pa.binary())], names=["model"])

    # The bounded sample meets in one task, which spares the driver its texts; only the model comes back.
    fitted = rows.repartition(1).sortWithinPartitions("doc_id").select("text", "toxic").mapInArrow(run, "model binary").collect()
    return pickle.loads(fitted[0].model) if fitted else Model(prior)


def score_toxicity(df: DataFrame, model: Model, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep``, ``score`` (0 to 1), ``expected`` toxic words and toxic ``spans`` as byte offsets, for every whole text.

    Null and empty texts have no words and get the score of a text without evidence. The model is broadcast: its size is
    bounded by the fitting sample.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    kind = pa.list_(pa.struct([("first", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for batch in slices(whole, 0):
                scores, facts, spans = scorer.score(raw_texts(batch.column(0)))
                columns = [pa.array(scores, pa.float64()), pa.array([e for e, _ in facts], pa.float64()), pa.array([[{"first": a, "end": b} for a, b in s] for s in spans], kind)]
                yield pa.RecordBatch.from_arrays([*batch.columns[1:], *columns], names=[*keep, "score", "expected", "spans"])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(*keep).schema] + ["score double, expected double, spans array<struct<first:bigint,end:bigint>>"])
    return text_first(df, text, keep).mapInArrow(run, schema)


def kept_documents(docs: DataFrame, model: Model, limit: float = 0.3, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``limit``, unchanged."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for whole in batches:
            for batch in slices(whole, text):
                scores = scorer.score(raw_texts(batch.column(text)))[0]
                yield batch.filter(pa.array([s < limit for s in scores], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
