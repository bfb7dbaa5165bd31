"""Quality classifier from weak labels.

Nine overlapping heuristics each vote good, bad or nothing on a whole text.  Expectation-
maximisation over the counts of vote patterns of the whole corpus (at most 3**9 of them, whatever
its size) estimates each heuristic's accuracy and the share of good texts; the posteriors are soft
labels on which a linear scorer over hashed word shapes is trained.  No given label is used.

Texts are read once: votes and features of every row and whole text are written as a narrow table,
from which patterns are counted, the sample is taken and scores are computed.  The scorer is trained
on at most SAMPLE documents by hash order of their identifiers.

Defined cases: null text counts as empty; an empty text has no votes but the one on length and
its features are all zero; a very long text is voted on and scored as a whole, by bounds that fall
steadily with its length; a tie of votes counts as bad at the start of the estimation; an empty table
gives an empty result; repeated rows are scored alike, and count once in the sample; extra columns
are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, sliced, text_or_empty

SAMPLE, BUCKETS, RIDGE = 4000, 1024, 2e-3
LABELLERS = ("symbols", "variety", "capitals", "bars", "shouts", "function_words", "word_length", "sentences", "repeats")
_STOP = frozenset("the of and to in a is it for on that with as be by at are was from this or an der die das und ist nicht von mit ein den im zu auf für les la le de et des du que qui en un une dans est pas pour el los las y del se por una con su al lo".split())
_UPPER, _LOWER = bytes(range(65, 91)), bytes(range(97, 123))
_SYMBOLS = b"#$%&*<>=^~\\{}[]@_+"


def votes(text: str | None) -> tuple[int, ...]:
    """For each labeller 1 (good), 0 (bad) or -1 (nothing)."""
    text = text or ""
    w, b = text.split(), text.encode("utf-8", "surrogatepass")
    n, m = len(w), max(1, len(b))
    if not n:
        return (-1, -1, -1, -1, -1, -1, 0, -1, -1)
    without = lambda drop: len(b) - len(b.translate(None, drop))
    upper, lower = without(_UPPER), without(_LOWER)
    symbols, bars, shouts = without(_SYMBOLS) / m, w.count("|") / n, text.count("!!") / n
    variety, repeats = len(set(w)) / n, sum(map(eq, w, w[1:])) / n
    stops = sum(map(_STOP.__contains__, w)) / n
    size = len(text) / n - 1
    stops_at_end = sum(text.count(x) for x in (". ", ".\n", "? ", "! ")) + text.endswith((".", "?", "!"))
    vote = lambda bad, good: 0 if bad else 1 if good else -1
    return (
        vote(symbols > 0.1, symbols < 0.01),
        vote(n >= 30 and variety < 0.25 * min(1, (100 / n) ** 0.4), n >= 30 and variety > 0.3 * min(1, (400 / n) ** 0.25)),
        vote(upper > 0.5 * (upper + lower + 1), upper < 0.15 * (upper + lower + 1)),
        vote(bars > 0.1, bars == 0),
        vote(shouts > 0.2, shouts < 0.01),
        vote(n >= 20 and stops < 0.02, stops > 0.08),
        vote(size < 1.5 or size > 15, 3 < size < 9),
        vote(n >= 40 and stops_at_end / n < 0.005, stops_at_end / n > 0.02),
        vote(repeats > 0.3, repeats < 0.05),
    )


def pattern(v: tuple[int, ...]) -> str:
    return "".join("01-"[x] for x in v)


class Accuracies:
    """Dawid and Skene's model for two classes over vote patterns with counts."""

    def __init__(self, counts: dict[str, int], rounds: int = 200):
        self.counts, k = counts, len(LABELLERS)
        rows = sorted(counts)
        v = np.array([["01-".index(c) for c in r] for r in rows], np.int64).reshape(-1, k)
        n = np.array([counts[r] for r in rows], np.float64)
        # start from the majority, with good texts the more common
        q = np.where((v == 1).sum(1) >= 2 * (v == 0).sum(1), 0.9, 0.1)
        for _ in range(rounds):
            self.prior = float(np.clip((n * q).sum() / max(n.sum(), 1), 0.02, 0.98))
            # share of each vote, nothing included, among good and bad texts
            self.good = np.array([[(n * q * (v[:, j] == x)).sum() + 0.5 for x in range(3)] for j in range(k)])
            self.bad = np.array([[(n * (1 - q) * (v[:, j] == x)).sum() + 0.5 for x in range(3)] for j in range(k)])
            self.good /= self.good.sum(1, keepdims=True)
            self.bad /= self.bad.sum(1, keepdims=True)
            new = self._posterior(v)
            if len(q) == 0 or np.abs(new - q).max() < 1e-7:
                break
            q = new

    def _posterior(self, v: np.ndarray) -> np.ndarray:
        j = np.arange(v.shape[1])
        m = np.log(self.prior) - np.log1p(-self.prior) + (np.log(self.good[j, v]) - np.log(self.bad[j, v])).sum(1)
        return 1 / (1 + np.exp(-np.clip(m, -30, 30)))

    def posterior(self, pat: str) -> float:
        return float(self._posterior(np.array([["01-".index(c) for c in pat]]))[0])

    def accuracies(self) -> dict[str, float]:
        """Share of right votes among votes given."""
        p = self.prior
        return {x: float((p * g[1] + (1 - p) * b[0]) / (p * (g[0] + g[1]) + (1 - p) * (b[0] + b[1]))) for x, g, b in zip(LABELLERS, self.good, self.bad)}


_RUNS = re.compile(r"([^\n])\1+")


class _Shapes(dict):
    def __missing__(self, code: int) -> int:
        c = chr(code)
        self[code] = ord("A" if c.isupper() else "a" if c.isalpha() else "0" if c.isdigit() else c)
        return self[code]


_SHAPES = _Shapes({10: 10})


def shapes(words: list[str]) -> list[str]:
    """The last signs of each word, letters as a or A, digits as 0, runs as two, and its size."""
    all_of = _RUNS.sub(r"\1\1", "\n".join(words).translate(_SHAPES)).split("\n")
    return [s[-6:] + str(min(len(w) // 4, 4)) for s, w in zip(all_of, words)]


def _bucket(x: str) -> int:
    return zlib.crc32(x.encode("utf-8", "surrogatepass")) % BUCKETS


_REPEAT, _VARIETY = _bucket("same as before"), [_bucket(f"variety {i}") for i in range(11)]
_STOPS = _bucket("function word")


class Features:
    """Hashed features of texts; what words hash to is remembered up to a bound."""

    def __init__(self, most: int = 500_000):
        self.known: dict[str, int] = {}
        self.shapes: dict[str, int] = {}
        self.most = most

    def of(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """(distinct buckets, values)."""
        w = (text or "").split()
        if not w:
            return np.zeros(0, np.int64), np.zeros(0)
        if len(self.known) > self.most:
            self.known.clear()
            self.shapes.clear()
        known, distinct = self.known, set(w)
        new = [x for x in distinct if x not in known]
        for x, s in zip(new, shapes(new) if new else ()):
            at = self.shapes.get(s)
            if at is None:
                at = self.shapes[s] = _bucket(s)
            known[x] = at
        c = np.bincount(np.fromiter(map(known.__getitem__, w), np.int64, len(w)), minlength=BUCKETS).astype(np.float64)
        c[_REPEAT] += sum(map(eq, w, w[1:]))
        c[_STOPS] += sum(map(_STOP.__contains__, w))
        c = np.sqrt(c / len(w))
        c[_VARIETY[int(10 * len(distinct) / len(w))]] += 0.5
        at = np.flatnonzero(c)
        return at, c[at]


def fit_scorer(rows: list[tuple[list[int], list[float], float]]) -> np.ndarray:
    """Logistic regression on soft labels by accelerated full gradients; the last weight is the bias."""
    w = np.zeros(BUCKETS + 1)
    if not rows:
        return w
    x = np.zeros((len(rows), BUCKETS + 1), np.float32)
    for r, (at, v, _) in enumerate(rows):
        x[r, list(at)] = v
    x[:, -1] = 1
    live = np.flatnonzero((x != 0).sum(0) >= min(3, len(rows)))
    x, y = np.ascontiguousarray(x[:, live]), np.array([q for *_, q in rows], np.float32)
    # each class weighs as its share, but a rare one at least a fifth
    p = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    cost = y * max(1, 0.2 / p) + (1 - y) * max(1, 0.2 / (1 - p))
    u = np.ones(len(live), np.float32)
    for _ in range(30):  # the largest eigenvalue, for the step
        u = x.T @ (x @ (u / max(np.linalg.norm(u), 1e-12)))
    step = 4 / (1.1 * np.linalg.norm(u) / len(y) * cost.max() + 4 * RIDGE)
    v = old = np.zeros(len(live), np.float32)
    cost, step, ridge = cost.astype(np.float32), np.float32(step), np.float32(RIDGE)
    for t in range(400):
        g = x.T @ (cost * (1 / (1 + np.exp(-(x @ v))) - y)) / np.float32(len(y)) + ridge * v
        new = v - step * g
        v, old = new + np.float32(t / (t + 3)) * (new - old), new
    w[live] = old
    return w


_READ = pa.schema([("doc_id", pa.int64()), ("pattern", pa.string()), ("at", pa.list_(pa.int16())), ("v", pa.list_(pa.float32()))])


def _read(batches):
    f = Features()
    for b in sliced(batches):
        rows = [(pattern(votes(t)), *f.of(t)) for t in b.column(1).to_pylist()]
        cols = [pa.array([r[k] for r in rows], _READ.field(k + 1).type) for k in range(3)]
        yield pa.RecordBatch.from_arrays([b.column(0), *cols], schema=_READ)


def read(docs: DataFrame) -> DataFrame:
    """doc_id, pattern, at, v: the votes, and the features that are not zero, of every row."""
    texts = docs.select("doc_id", text_or_empty("text").alias("text"))
    return materialise(texts.mapInArrow(_read, "doc_id long, pattern string, at array<short>, v array<float>"), "features")


def train(features: DataFrame, sample: int = SAMPLE) -> tuple[Accuracies, np.ndarray]:
    n = features.groupBy("pattern").agg(F.count("*").alias("n"))
    model = Accuracies({r[0]: r[1] for r in n.collect()})  # at most 3**9 rows
    ids = features.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # one row of each of these identifiers, so at most ``sample``
    rows = features.join(F.broadcast(ids), "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct("pattern", "at", "v")).alias("r")).collect()
    rows = sorted((r["r"] for r in rows), key=tuple)
    return model, fit_scorer([(r["at"], r["v"], model.posterior(r["pattern"])) for r in rows])


def score(docs: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """One row per document: doc_id, votes, posterior, score, predicted, kept."""
    features = read(docs)
    model, w = train(features, sample)

    def run(batches):
        post: dict[str, float] = {}
        for b in batches:
            patterns = b.column(1).to_pylist()
            post |= {p: model.posterior(p) for p in {*patterns} - post.keys()}
            at, v = b.column(2), b.column(3)
            each = np.concatenate(([0.0], np.cumsum(w[at.flatten().to_numpy()] * v.flatten().to_numpy().astype(np.float64))))
            ends = np.concatenate(([0], np.cumsum(np.fromiter((len(x) for x in at), np.int64, len(at)))))
            m = each[ends[1:]] - each[ends[:-1]] + w[-1]
            scores = 1 / (1 + np.exp(-np.clip(m, -30, 30)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([post[p] for p in patterns], pa.float64()), pa.array(scores, pa.float64())], names=["doc_id", "votes", "posterior", "score"])

    s = features.mapInArrow(run, "doc_id long, votes string, posterior double, score double")
    return s.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumn("kept", F.col("score") >= 0.5)
