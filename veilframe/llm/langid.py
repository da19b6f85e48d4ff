"""Language identification by interpolated Kneser-Ney character models.

The four-letter counts of every training text are summed by Spark for each language. Lower orders
follow from them as Kneser-Ney wants it: by the number of different letters seen before. Each order
is an array of n-gram hashes in ascending order, with the languages that know the n-gram, and their
probabilities, beside it: as large as the counts of all languages together, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ORDER = 4
#: Letters handled at a time.
BLOCK = 1 << 20
#: Cells of n-grams by languages looked up at a time.
CELLS = 1 << 22
#: n-grams kept in a task before they are passed on.
FLUSH = 1 << 21
EDGE, SPACE = 1, 32

_LETTERS = np.zeros(1 << 16, np.uint16)
for _c in range(1 << 16):
    _ch = chr(_c)
    if _ch.isalpha():
        _low = ord(_ch.lower()[0])
        _LETTERS[_c] = _low if _low < 1 << 16 else _c
    else:
        _LETTERS[_c] = SPACE
_BITS = 16


def letters(text: str | None) -> np.ndarray:
    """Lower-case letters with single spaces between words, and an edge on both sides; empty if there is no letter.

    Letters outside the basic plane are folded into 4096 private codes.
    """
    code = np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _LETTERS[np.where(code < 1 << 16, code, 0xE000)]
    for i in np.flatnonzero(code >= 1 << 16):
        low[i] = 0xE000 + code[i] % 4096 if chr(code[i]).isalpha() else SPACE
    low = low[~((low == SPACE) & (np.concatenate([[SPACE], low[:-1]]) == SPACE))] if low.size else low
    if not low.size or (low == SPACE).all():
        return np.empty(0, np.uint16)
    return np.concatenate([np.full(ORDER - 1, EDGE, np.uint16), low, [np.uint16(EDGE)]])


def ngrams(codes: np.ndarray) -> np.ndarray:
    """The four-letter n-grams of a text, first letter in the highest bits."""
    c = codes.astype(np.uint64)
    out = c[: c.size - ORDER + 1]
    for i in range(1, ORDER):
        out = out << np.uint64(_BITS) | c[i : c.size - ORDER + 1 + i]
    return out


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]), keys.size).astype(np.int64)


def count_ngrams(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """``lang, ngram, n`` over all rows with a language; whole texts, without a cap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        waiting: dict[str, list[np.ndarray]] = {}
        size: dict[str, int] = {}

        def reduce(lang: str) -> None:
            keys, n = np.unique(np.concatenate(waiting.pop(lang)), return_counts=True)
            size.pop(lang)
            found[lang] = [_merge([*found.get(lang, []), (keys, n)])]

        def out(lang: str) -> pa.RecordBatch:
            keys, n = found.pop(lang)[0]
            return pa.RecordBatch.from_arrays([pa.array([lang] * keys.size, pa.string()), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "ngram", "n"])

        for b in batches:
            for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
                codes = letters(text.as_py())
                for at in range(0, max(0, codes.size - ORDER + 1), BLOCK):
                    keys = ngrams(codes[at : at + BLOCK + ORDER - 1])
                    waiting.setdefault(lang, []).append(keys)
                    size[lang] = size.get(lang, 0) + keys.size
                    if size[lang] >= BLOCK:
                        reduce(lang)
                        if found[lang][0][0].size >= FLUSH:
                            yield out(lang)
        for lang in list(waiting):
            reduce(lang)
        for lang in list(found):
            yield out(lang)

    rows = docs.where(F.col(lang_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "lang string, ngram long, n long").groupBy("lang", "ngram").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Hashed:
    """Values by key and language: ascending hashes, and for each, from ``starts`` on, its languages and their values."""

    hashes: np.ndarray
    starts: np.ndarray
    lang: np.ndarray
    value: np.ndarray

    @classmethod
    def of(cls, parts: list[tuple[np.ndarray, np.ndarray]]) -> Hashed:
        """From keys and values of each language."""
        keys = mix(np.concatenate([np.empty(0, np.uint64), *(k for k, _ in parts)]))
        lang = np.repeat(np.arange(len(parts), dtype=np.int32), [k.size for k, _ in parts])
        order = np.argsort(keys, kind="stable")
        hashes, starts = np.unique(keys[order], return_index=True)
        return cls(hashes, np.append(starts, keys.size), lang[order], np.concatenate([np.empty(0), *(v for _, v in parts)])[order])

    def get(self, keys: np.ndarray, langs: int, missing: float) -> np.ndarray:
        """A line of values, by language, for each key."""
        out = np.full((keys.size, langs), missing)
        if not self.hashes.size:
            return out
        keys = mix(keys)
        at = np.minimum(np.searchsorted(self.hashes, keys), self.hashes.size - 1)
        line = np.flatnonzero(self.hashes[at] == keys)
        first = self.starts[at[line]]
        n = self.starts[at[line] + 1] - first
        cell = np.repeat(first - np.cumsum(n) + n, n) + np.arange(n.sum())
        out[np.repeat(line, n), self.lang[cell]] = self.value[cell]
        return out


@dataclass(frozen=True)
class Model:
    """``prob[k]``: log2 probabilities of the n-grams of k + 1 letters; ``back[k]``: of their contexts, the log2
    weight of the next lower order."""

    langs: tuple[str, ...]
    prob: tuple[Hashed, ...]
    back: tuple[Hashed, ...]
    base: np.ndarray

    def log2(self, keys: np.ndarray) -> np.ndarray:
        """log2 probability of the last letter of each n-gram after its others, by language."""
        out = np.zeros((keys.size, len(self.langs)))
        open_ = np.ones((keys.size, len(self.langs)), bool)
        for k in range(ORDER - 1, -1, -1):
            p = self.prob[k].get(keys & _mask(k + 1), len(self.langs), np.nan)
            hit = open_ & ~np.isnan(p)
            out[hit] += p[hit]
            open_ &= np.isnan(p)
            w = self.back[k].get(keys >> np.uint64(_BITS) & _mask(k), len(self.langs), 0.0)
            out += np.where(open_, w, 0.0)
        return out + np.where(open_, self.base, 0.0)

    def entropies(self, texts: list[str | None]) -> np.ndarray:
        """Cross-entropy in bits a letter, by text and language; infinite for a text without letters."""
        sums, sizes = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts))
        block: list[tuple[int, np.ndarray]] = []
        held, most = 0, max(1, min(BLOCK, CELLS // max(1, len(self.langs))))

        def settle() -> None:
            keys, at = np.unique(np.concatenate([k for _, k in block]), return_inverse=True)
            logs = self.log2(keys)
            starts = np.concatenate([[0], np.cumsum([k.size for _, k in block])[:-1]])
            for j in range(len(self.langs)):
                np.add.at(sums[:, j], [i for i, _ in block], np.add.reduceat(logs[at, j], starts))
            block.clear()

        for i, text in enumerate(texts):
            codes = letters(text)
            for at in range(0, max(0, codes.size - ORDER + 1), most):
                keys = ngrams(codes[at : at + most + ORDER - 1])
                block.append((i, keys))
                sizes[i] += keys.size
                held += keys.size
                if held >= most:
                    settle()
                    held = 0
        if block:
            settle()
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(sizes[:, None] > 0, -sums / sizes[:, None], np.inf)


def _mask(letters_: int) -> np.uint64:
    return np.uint64((1 << _BITS * letters_) - 1)


def mix(keys: np.ndarray) -> np.ndarray:
    """A 64-bit hash without collisions (each step can be undone)."""
    k = keys ^ keys >> np.uint64(31)
    k = k * np.uint64(0x9E3779B97F4A7C15)
    return k ^ k >> np.uint64(29)


def _discount(n: np.ndarray) -> float:
    n1, n2 = int((n == 1).sum()), int((n == 2).sum())
    return n1 / (n1 + 2 * n2) if n1 and n2 else 0.5


def build(counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Model:
    """The model of the four-letter counts of each language: language -> (n-grams, counts)."""
    langs = tuple(sorted(counts))
    per: list[list[tuple]] = [[] for _ in range(ORDER)]
    vocab = max(1, len(np.unique(np.concatenate([np.unique(k & _mask(1)) for k, _ in counts.values()])))) + 1 if counts else 2
    for lang in langs:
        keys, n = counts[lang]
        keys, order = np.unique(keys, return_index=True)
        n = np.asarray(n)[order].astype(float)
        tables = [(keys, n)]
        for k in range(ORDER - 1, 0, -1):  # how many different letters stand before each shorter n-gram
            tables.append(tuple(np.unique(tables[-1][0] & _mask(k), return_counts=True)))
        lower: tuple[np.ndarray, np.ndarray] | None = None
        for k, (grams, c) in enumerate(reversed(tables)):
            c = c.astype(float)
            d = _discount(c)
            ctx, at = np.unique(grams >> np.uint64(_BITS), return_inverse=True)
            total, kinds = np.bincount(at, c, ctx.size), np.bincount(at, minlength=ctx.size)
            back = d * kinds / total
            below = np.full(grams.size, 1 / vocab) if lower is None else lower[1][np.searchsorted(lower[0], grams & _mask(k))]
            p = np.maximum(c - d, 0) / total[at] + back[at] * below
            per[k].append((grams, np.log2(p), ctx, np.log2(back)))
            lower = (grams, p)
    tables = [tuple(Hashed.of([x[at : at + 2] for x in per[k]]) for k in range(ORDER)) for at in (0, 2)]
    return Model(langs, *tables, np.full(len(langs), np.log2(1 / vocab)))


def fit(docs: DataFrame, lang_col: str = "lang", text_col: str = "text") -> Model:
    """A model of all rows with text and language. Their counts, one row for each language and n-gram, meet the driver; none is cut off."""
    rows = count_ngrams(docs, lang_col, text_col).toArrow()
    lang, keys, n = rows.column("lang").to_pandas().to_numpy(), rows.column("ngram").to_numpy().view(np.uint64), rows.column("n").to_numpy()
    return build({str(x): (keys[lang == x], n[lang == x]) for x in np.unique(lang.astype(str))} if len(keys) else {})


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", sharpness: float = 8.0) -> DataFrame:
    """``id, lang_pred, score, entropy`` of every row.

    The language of the lowest cross-entropy, ties to the first by name. ``und``, with score 0, for a
    null text, one without a letter, or where no language was learned. Score: the share of
    exp(-sharpness * entropy) among the languages.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            if not m.langs:
                e = np.full((len(texts), 1), np.inf)
            else:
                e = m.entropies(texts)
            best, known = e.argmin(1), np.isfinite(e).any(1)
            low = np.where(known, e.min(1), 0.0)
            with np.errstate(invalid="ignore"):
                score = np.where(known, 1 / np.exp(-sharpness * (e - low[:, None])).sum(1).clip(1e-300), 0.0)
            names = [m.langs[i] if k else "und" for i, k in zip(best, known)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(score, pa.float64()), pa.array(np.where(known, low, np.nan), from_pandas=True)], names=["id", "lang_pred", "score", "entropy"])

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType([rows.schema["id"], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("entropy", T.DoubleType())])
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def calibrated(predicted: DataFrame, calibration: DataFrame, quantile: float = 0.995) -> DataFrame:
    """Adds ``rejected``: the entropy is above the ``quantile`` of the calibration rows of the same language.

    ``und`` is always rejected; a language without calibration rows never.
    """
    limits = calibration.groupBy(F.col("lang_pred").alias("__lang")).agg(F.percentile_approx("entropy", quantile, 1000).alias("__limit"))
    joined = predicted.join(F.broadcast(limits), predicted["lang_pred"] == limits["__lang"], "left")
    rejected = (F.col("lang_pred") == "und") | F.coalesce(F.col("entropy") > F.col("__limit"), F.lit(False))
    return joined.select(*predicted.columns, rejected.alias("rejected"))
