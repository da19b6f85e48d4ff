"""Weak-label quality classifier.

Overlapping heuristics vote good, bad or nothing on each text. Expectation-maximisation over the
table of vote patterns estimates how often each votes what in either class, without labels; the
posterior of a text's pattern is the soft label that a hashed linear scorer is trained on.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm.common import cut

# Frequent short function words of English, German, French and Spanish.
FUNCTION_WORDS = frozenset(
    b"a an and are as at be by for from he in is it of on or that the this to was with"
    b" auf dem den der des die das ein eine im ist mit nicht und von zu sich"
    b" de la le les et en un une du dans pour que qui sur est au avec"
    b" el los las y por con se es no del su al lo".split()
)
LABELLERS = ("symbols", "letters", "capitals", "marks", "bare_words", "repeated_words", "variety", "compression", "function_words", "repeated_lines")
BAD, GOOD, NONE = 0, 1, 2
BUCKETS = 4096
#: Rows of each class that the scorer is trained on, at most: those with the smallest hash of id and text.
TRAIN_ROWS = 2_500

BARE = re.compile(rb"(?<!\S)[^\sa-z0-9\x80-\xff]+(?!\S)")

_SYMBOL, _UPPER, _LETTER, _MARK, _DIGIT = 1, 2, 3, 4, 5
_KIND = np.zeros(256, np.uint8)
for _c in range(256):
    _ch = chr(_c)
    _KIND[_c] = _UPPER if "A" <= _ch <= "Z" else _LETTER if "a" <= _ch <= "z" or _c >= 128 else _MARK if _ch in "!|?" else _DIGIT if _ch.isdigit() else _SYMBOL if 32 < _c < 127 and _ch not in ".,;:'\"-()" else 0


def measures(raw: bytes) -> tuple[int, tuple[float, ...]]:
    """The number of words, and what each labeller looks at: shares of the whole text, zeros if there is no word."""
    low = raw.lower()
    words = low.split()
    if not words:
        return 0, (0.0,) * len(LABELLERS)
    n, kinds = len(words), np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=6)
    letters = int(kinds[_UPPER] + kinds[_LETTER])
    solid = max(1, letters + int(kinds[_SYMBOL] + kinds[_MARK]))  # digits and punctuation count for neither side
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return n, (
        float(kinds[_SYMBOL] / solid),
        letters / solid,
        float(kinds[_UPPER] / max(1, letters)),
        float(kinds[_MARK] / n),
        len(BARE.findall(low)) / n,
        sum(map(bytes.__eq__, words, words[1:])) / n,
        sum(len(set(words[i : i + 50])) for i in range(0, n, 50)) / n,
        len(zlib.compress(raw, 1)) / len(raw),
        sum(map(FUNCTION_WORDS.__contains__, words)) / n,
        1 - len(set(lines)) / len(lines),
    )


def votes(n: int, m: tuple[float, ...]) -> tuple[int, ...]:
    """Good, bad or no vote of each labeller; those that need some text give none on a short one."""
    if not n:
        return (NONE,) * len(LABELLERS)

    def low(x: float, good: float, bad: float, words: int = 0) -> int:
        return NONE if n < words else GOOD if x <= good else BAD if x >= bad else NONE

    symbols, letters, capitals, marks, bare, again, variety, packed, function, lines = m
    return (
        low(symbols, 0.03, 0.12),
        low(1 - letters, 0.15, 0.25),
        low(capitals, 0.20, 0.60, 5),
        low(marks, 0.15, 0.40, 5),
        low(bare, 0.10, 0.25, 5),
        low(again, 0.05, 0.30, 10),
        low(1 - variety, 0.55, 0.70, 20),
        low(1 - packed, 0.70, 0.82, 40),
        low(1 - function, 0.94, 0.99, 30),
        low(lines, 0.30, 0.80, 20),
    )


def pattern(n: int, m: tuple[float, ...]) -> int:
    """The votes as one number in base three."""
    p = 0
    for v in votes(n, m):
        p = 3 * p + v
    return p


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


@dataclass(frozen=True)
class LabelModel:
    """``prior`` of good; ``chance[j, y, v]``: that labeller j, if it votes, votes v on a text of class y."""

    prior: float
    chance: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        v = unpack(patterns)
        gain = np.concatenate([np.log(self.chance[:, 1] / self.chance[:, 0]), np.zeros((v.shape[1], 1))], 1)
        gap = np.log(self.prior / (1 - self.prior)) + gain[np.arange(v.shape[1]), v].sum(1)
        return 1 / (1 + np.exp(-np.clip(gap, -500, 500)))


def unpack(patterns: np.ndarray) -> np.ndarray:
    m = len(LABELLERS)
    return np.asarray(patterns)[:, None] // 3 ** np.arange(m - 1, -1, -1) % 3


def estimate(patterns: np.ndarray, counts: np.ndarray, steps: int = 100, belief: float = 0.01) -> LabelModel:
    """Expectation-maximisation over a table of patterns.

    Labellers are believed better than chance beforehand: a bad vote is taken to fall on three in ten
    bad texts and one in fifty good ones, with the weight of ``belief`` of all rows.
    """
    v, n = unpack(patterns), np.asarray(counts, float)
    start = np.tile(np.array([[0.3, 0.7], [0.02, 0.98]]), (v.shape[1], 1, 1))
    model = LabelModel(0.85, start)
    for _ in range(steps):
        q = model.posterior(patterns)
        chance = start * (belief * n.sum() + 1)
        for y, share in ((1, q * n), (0, (1 - q) * n)):
            for k in (BAD, GOOD):
                chance[:, y, k] += ((v == k) * share[:, None]).sum(0)
        chance /= chance.sum(2, keepdims=True)
        model = LabelModel(float(np.clip((q * n).sum() / max(n.sum(), 1e-9), 1e-3, 1 - 1e-3)), chance)
    return model


def hashed(raw: bytes, m: tuple[float, ...]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and weights of a text's features: byte trigrams by their share, and each measure's range."""
    ranges = np.array([(j * 64 + min(int(x * 20), 63)) * 2654435761 >> 7 for j, x in enumerate(m)], np.int64) % BUCKETS
    b = np.frombuffer(raw, np.uint8).astype(np.uint32)
    if b.size < 3:
        return ranges, np.ones(len(ranges))
    grams = (((b[:-2] * 961 + b[1:-1] * 31 + b[2:]) * np.uint32(2654435761)) >> np.uint32(20)).astype(np.int64)
    return np.concatenate([grams, ranges]), np.concatenate([np.full(grams.size, 4 / grams.size), np.ones(len(ranges))])


@dataclass(frozen=True)
class Model:
    labels: LabelModel
    weights: np.ndarray
    bias: float

    def score(self, text: str | None) -> float:
        raw = _raw(text)
        return self.rate(raw, measures(raw)[1])

    def rate(self, raw: bytes, m: tuple[float, ...]) -> float:
        at, by = hashed(raw, m)
        return float(1 / (1 + np.exp(-np.clip(self.bias + self.weights[at] @ by, -500, 500))))


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Label model from the votes on all rows; scorer from at most ``rows`` rows of either posterior class.

    Rows are told apart by id and text; equal ones count each for the label model and once for the scorer.
    Without rows, or where all of them fall to one class, the scorer is a constant.
    """

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([pattern(*measures(_raw(t.as_py()))) for t in b.column(1)], pa.int32())], names=["row", "p"])

    # a row is known by its id and text together, so that rows that share an id keep their own text and votes
    narrow = docs.select(F.xxhash64(id_col, text_col).alias("row"), F.col(text_col).alias("text"))
    voted = cut(narrow.mapInArrow(vote, "row long, p int"))
    found = voted.groupBy("p").count().collect()  # at most 3 ** labellers rows
    patterns, counts = np.array([r["p"] for r in found], np.int64), np.array([r["count"] for r in found], float)
    model = estimate(patterns, counts)
    post = model.posterior(patterns) if len(found) else np.empty(0)
    total = [counts[post < 0.5].sum(), counts[post >= 0.5].sum()]
    if not min(total):
        share = (post @ counts + 0.5) / (counts.sum() + 1) if len(found) else 0.5
        return Model(model, np.zeros(BUCKETS), float(np.log(share / (1 - share))))

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            at, by, ends = [np.empty(0, np.int16)], [np.empty(0, np.float32)], [0]
            for t in b.column("text"):
                raw = _raw(t.as_py())
                x = np.bincount(*hashed(raw, measures(raw)[1]), BUCKETS).astype(np.float32)
                at.append(np.flatnonzero(x).astype(np.int16))
                by.append(x[at[-1]])
                ends.append(ends[-1] + at[-1].size)
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(v))) for v in (at, by)]
            yield pa.RecordBatch.from_arrays([b.column("p"), *lists], names=["p", "at", "by"])

    samples = []
    for y in (0, 1):
        own = patterns[(post >= 0.5) == y].tolist()
        some = voted.where(F.col("p").isin(own)).groupBy("row").agg(F.first("p").alias("p")).orderBy("row").limit(rows)
        texts = narrow.join(F.broadcast(some), "row").groupBy("row").agg(F.first("p").alias("p"), F.first("text").alias("text"))
        samples.append(texts.select("p", "text").mapInArrow(featurise, "p int, at array<short>, by array<float>").toArrow())  # at most ``rows``
    by_pattern = dict(zip(patterns.tolist(), post.tolist()))
    x, q, no = np.zeros((sum(s.num_rows for s in samples), BUCKETS), np.float32), [], 0
    for s in samples:
        for b in s.to_batches():
            sizes = np.diff(b.column("at").offsets.to_numpy())
            x[np.repeat(np.arange(no, no + b.num_rows), sizes), b.column("at").flatten().to_numpy()] = b.column("by").flatten().to_numpy()
            q += [by_pattern[p] for p in b.column("p").to_pylist()]
            no += b.num_rows
    size = [s.num_rows for s in samples]
    return Model(model, *_solve(x, np.array(q), np.repeat([total[0] / max(size[0], 1), total[1] / max(size[1], 1)], size)))


def _solve(x: np.ndarray, q: np.ndarray, weight: np.ndarray, ridge: float = 1e-5, steps: int = 300) -> tuple[np.ndarray, float]:
    """Logistic regression on soft labels, by Adam over all rows."""
    weight = (weight / weight.sum()).astype(np.float32)
    w, m, v = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        r = weight * (1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -60, 60))) - q).astype(np.float32)
        g = np.append(x.T @ r + 2 * ridge * w[:-1], r.sum()).astype(np.float32)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.3 * (1 - t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1].astype(float), float(w[-1])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, weak_label, score`` of every row: the votes' posterior and the scorer's chance of good.

    A null text, an empty one and one of white space get no vote: their weak label is the prior.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # BUCKETS weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            votes_, rates = [], []
            for t in b.column(1):
                raw = _raw(t.as_py())
                n, own = measures(raw)
                votes_.append(pattern(n, own))
                rates.append(m.rate(raw, own))
            post = m.labels.posterior(np.array(votes_, np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(post), pa.array(rates, pa.float64())], names=["id", "weak_label", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("weak_label", T.DoubleType()), T.StructField("score", T.DoubleType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows that score at least ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            yield b.filter(pa.array([m.score(t.as_py()) >= threshold for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
