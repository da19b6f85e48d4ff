"""Counterfactual-regularised toxicity classifier.

A sparse linear model over words and word beginnings. In labelled sentences that name a group, the
group's term is swapped for the other terms of its kind; the squared change of the score is a
penalty, so that the mention of a group by itself is not what makes a text toxic. The change is that of
the whole text's score: a term that also stands in another sentence, or shares a beginning with another
word of the text, is priced by what really changes.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm.common import cut

#: Group terms by kind, each kind with neutral words of the same use.
IDENTITY_TERMS: dict[str, tuple[str, ...]] = {
    "people": ("people", "persons", "women", "men", "girls", "boys", "immigrants", "refugees", "foreigners", "gays", "lesbians", "muslims", "jews", "christians", "hindus", "buddhists", "atheists", "africans", "asians", "europeans", "arabs", "latinos"),
    "person": ("person", "someone", "woman", "man", "girl", "boy", "immigrant", "refugee", "foreigner", "gay", "lesbian", "muslim", "jew", "christian", "hindu", "buddhist", "atheist", "african", "asian", "european", "arab", "latino"),
    "adjective": ("tall", "young", "old", "black", "white", "gay", "straight", "trans", "queer", "disabled", "deaf", "blind", "jewish", "islamic", "catholic", "female", "male"),
    "leute": ("leute", "menschen", "frauen", "männer", "ausländer", "flüchtlinge", "muslime", "juden", "christen", "schwule", "lesben"),
    "gens": ("gens", "personnes", "femmes", "hommes", "étrangers", "réfugiés", "musulmans", "juifs", "chrétiens", "homosexuels"),
    "gente": ("gente", "personas", "mujeres", "hombres", "extranjeros", "refugiados", "musulmanes", "judíos", "cristianos", "homosexuales"),
}
SPACE = 1 << 26
#: Labelled rows that a model is fitted on, at most: those with the smallest hash of their id.
TRAIN_ROWS = 20_000
#: Features of a model stand in so many labelled rows and differ so much between the classes, by chi-square.
LEAST_ROWS, LEAST_CHI = 3, 12
WORD = re.compile(r"\w+")
SENTENCE = re.compile(r"[^.!?\n]+")
#: Words kept with their features in each Python worker.
CACHE = 300_000


def word_features(word: str) -> tuple[int, ...]:
    """Hashed features of a lower-case word: itself, and its first four and five letters if it is longer."""
    keys = [word, *(f"{word[:n]}\0" for n in (4, 5) if len(word) > n)]
    return tuple(zlib.crc32(k.encode("utf-8", "surrogatepass")) % SPACE for k in keys)


@dataclass(frozen=True)
class Model:
    """Score: the logistic function of ``bias`` plus the weights of a text's distinct features."""

    features: np.ndarray
    weights: np.ndarray
    bias: float

    def scorer(self):
        index = dict(zip(self.features.tolist(), self.weights.tolist()))
        known: dict[str, tuple[int, ...]] = {}

        def score(text: str | None) -> float:
            hits: set[int] = set()
            for w in set(WORD.findall((text or "").lower())):
                if (own := known.get(w)) is None:
                    if len(known) >= CACHE:
                        known.clear()
                    own = known[w] = tuple(f for f in word_features(w) if f in index)
                if own:
                    hits.update(own)
            return float(1 / (1 + np.exp(-np.clip(self.bias + sum(index[f] for f in sorted(hits)), -500, 500))))

        return score


def swaps(text: str, kinds: Mapping[str, Sequence[str]]) -> Iterator[tuple[list[int], list[int]]]:
    """Features that a text gains and loses when a group term of one sentence is swapped there for another of its kind.

    One pair for each sentence, term and other term; what the rest of the text has of either stays.
    """
    of = {t: [k for k, ts in kinds.items() if t in ts] for ts in kinds.values() for t in ts}
    sentences = [set(WORD.findall(s)) for s in SENTENCE.findall(text.lower())]
    times = Counter(w for s in sentences for w in s)
    held = Counter(f for w in times for f in word_features(w))
    for sentence in sentences:
        for term in sorted(sentence & of.keys()):
            gone = {f for f in word_features(term) if held[f] == 1} if times[term] == 1 else set()
            for other in sorted({o for k in of[term] for o in kinds[k]} - {term}):
                new = set(word_features(other))
                yield sorted(new - held.keys()), sorted(gone - new)


def train_sample(docs: DataFrame, labels: DataFrame, label: str, keep: Column | None, rows: int, id_col: str, text_col: str) -> DataFrame:
    """``y, text`` of at most ``rows`` labelled ids; equal texts once. The ids are few enough to broadcast."""
    known = labels.where(F.col(label).isNotNull() & F.col(id_col).isNotNull())
    known = known if keep is None else known.where(keep)
    known = known.groupBy(F.col(id_col).alias("__id")).agg(F.max(label).cast("int").alias("y")).orderBy(F.xxhash64("__id"), "__id").limit(rows)
    found = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text")).join(F.broadcast(known), "__id")
    return found.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(F.max(F.struct("y", "text")).alias("r")).select("r.y", "r.text")


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", keep: Column | None = None, rows: int = TRAIN_ROWS, kinds: Mapping[str, Sequence[str]] = IDENTITY_TERMS, penalty: float = 10.0, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """A model of ``label`` from the labelled rows that ``keep`` holds for, at most ``rows`` of them.

    All features of ``LEAST_ROWS`` rows of the sample and a chi-square of ``LEAST_CHI`` or more enter the model. With no rows, or one class only, the
    model is a constant. Null texts count as empty; of an id's several labels the largest counts.
    """

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out, changes = [], []
            for t in b.column("text").to_pylist():
                out.append(sorted({f for w in set(WORD.findall((t or "").lower())) for f in word_features(w)}))
                changes.append([" ".join([*(f"+{f}" for f in new), *(f"-{f}" for f in gone)]) for new, gone in swaps(t or "", kinds)])
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(out, pa.list_(pa.int32())), pa.array(changes, pa.list_(pa.string()))], names=["y", "f", "swaps"])

    rows_ = cut(train_sample(docs, labels, label, keep, rows, id_col, text_col).mapInArrow(featurise, "y int, f array<int>, swaps array<string>"))
    n = {r["y"]: r["count"] for r in rows_.groupBy("y").count().collect()}
    n0, n1 = n.get(0, 0), sum(v for k, v in n.items() if k)
    if not n0 or not n1:
        return Model(np.empty(0, np.int64), np.empty(0), float(np.log((n1 + 0.5) / (n0 + 0.5))))
    seen = rows_.select("y", F.explode("f").alias("f")).groupBy("f").agg(F.count("*").alias("c"), F.sum((F.col("y") != 0).cast("long")).alias("p"))
    total, rate = float(n0 + n1), n1 / (n0 + n1)
    chi = (F.col("p") - F.col("c") * rate) ** 2 / (F.col("c") * rate * (1 - rate) * (1.000001 - F.col("c") / total))
    best = seen.where(F.col("c") >= LEAST_ROWS).withColumn("chi", chi).where(F.col("chi") >= LEAST_CHI)
    chosen = np.array(sorted(r["f"] for r in best.select("f").collect()), np.int64)
    index = {int(f): i for i, f in enumerate(chosen)}
    keep_f = F.array_intersect("f", F.lit(chosen.tolist()).cast("array<int>"))
    small = rows_.select("y", keep_f.alias("f")).groupBy("f", (F.col("y") != 0).alias("y")).count().collect()  # at most ``rows``
    sets = [np.array([index[f] for f in r["f"]], np.int64) for r in small]
    swapped = rows_.select(F.explode("swaps").alias("s")).groupBy("s").count().collect()  # pairs of terms, by what they share with a text: bounded by the list
    differences: dict[tuple[int, ...], int] = {}
    for r in swapped:
        own = tuple(sorted((index[f] + 1) * (1 if c[0] == "+" else -1) for c in r["s"].split() if (f := int(c[1:])) in index))
        differences[own] = differences.get(own, 0) + r["count"]
    w, bias = _solve(sets, np.array([r["y"] for r in small], float), np.array([r["count"] for r in small], float), len(chosen), differences, penalty)
    return Model(chosen, w, bias)


def _solve(sets: list[np.ndarray], y: np.ndarray, weight: np.ndarray, size: int, differences: Mapping[tuple[int, ...], int], penalty: float, ridge: float = 1e-5, steps: int = 1200) -> tuple[np.ndarray, float]:
    """Logistic regression with a ridge and the swap penalty, by Adam over all rows.

    ``differences``: features gained (i + 1) and lost (-i - 1) by swaps, with how many swaps they stand for.
    """
    cols, row = np.concatenate([*sets, np.empty(0, np.int64)]), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    weight = weight / weight.sum()
    signed = np.array([d for own in differences for d in own], np.int64)
    dcol, dsign = np.abs(signed) - 1, np.sign(signed)
    drow = np.repeat(np.arange(len(differences)), [len(own) for own in differences])
    share = np.array(list(differences.values()), float)
    share = share / max(share.sum(), 1)
    w, m, v = (np.zeros(size + 1) for _ in range(3))
    w[-1] = np.log((y @ weight + 1e-9) / (1 - y @ weight + 1e-9))
    for t in range(1, steps + 1):
        z = np.bincount(row, w[cols], len(sets)) + w[-1]
        r = weight * (1 / (1 + np.exp(-z)) - y)
        pull = share * np.bincount(drow, dsign * w[dcol], share.size)
        g = np.append(np.bincount(cols, r[row], size) + 2 * ridge * w[:-1] + 2 * penalty * np.bincount(dcol, dsign * pull[drow], size), r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w -= 0.1 * (1 - t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w[:-1], float(w[-1])


def scores(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, score`` of every row; a null or empty text has the model's constant score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # as many weights as ``fit`` was told

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([score(t.as_py()) for t in b.column(1)], pa.float64())], names=["id", "score"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["id"], T.StructField("score", T.DoubleType())])).withColumnRenamed("id", id_col)


def drop_toxic(docs: DataFrame, model: Model, threshold: float = 0.5, text_col: str = "text") -> DataFrame:
    """The rows that score below ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = shared.value.scorer()
        for b in batches:
            yield b.filter(pa.array([score(t.as_py()) < threshold for t in b.column(at)], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
