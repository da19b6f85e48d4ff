"""The registered classifier queries, from tables to rows, against plain programs without Spark, tables of patterns or sparse sums."""

import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from veilframe.llm import quality, queries, toxicity

SF = "/root/testdata/sf0.01"



@pytest.fixture(scope="module")
def docs():
    return [(r[0], r[1]) for r in duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()]


def sigmoid(z):
    return 1 / (1 + math.exp(-max(-500, min(500, z))))


def adam(gradient, w, steps, rate):
    m, v = np.zeros_like(w), np.zeros_like(w)
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (1 - t / steps) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
    return w


def test_quality_query_as_em_over_rows(spark, docs):
    """EM row by row over every document's votes, then a dense model on the posteriors."""
    raw = [(t or "").encode() for _, t in docs]
    seen = [quality.measures(r) for r in raw]
    votes = [quality.votes(n, m) for n, m in seen]
    labellers, believed = len(votes[0]), 0.01 * len(docs) + 1
    prior, chance = 0.85, [[[0.3, 0.7], [0.02, 0.98]] for _ in range(labellers)]

    def posterior(vote):
        odds = math.log(prior / (1 - prior))
        for j, v in enumerate(vote):
            if v in (quality.BAD, quality.GOOD):
                odds += math.log(chance[j][1][v] / chance[j][0][v])
        return sigmoid(odds)

    for _ in range(100):
        q = [posterior(v) for v in votes]
        sums = [[[0.3 * believed, 0.7 * believed], [0.02 * believed, 0.98 * believed]] for _ in range(labellers)]
        for vote, p in zip(votes, q):
            for j, v in enumerate(vote):
                if v in (quality.BAD, quality.GOOD):
                    sums[j][1][v] += p
                    sums[j][0][v] += 1 - p
        chance = [[[x / sum(own) for x in own] for own in s] for s in sums]
        prior = min(max(sum(q) / len(q), 1e-3), 1 - 1e-3)
    weak = [posterior(v) for v in votes]

    x = np.zeros((len(docs), quality.BUCKETS))
    for i, (r, (_, m)) in enumerate(zip(raw, seen)):
        for at, by in zip(*quality.hashed(r, m)):
            x[i, at] += by
    first = {}  # rows of one id and text teach the scorer once; no class is beyond its bound here
    for i, d in enumerate(docs):
        first.setdefault(d, i)
    own, good = sorted(first.values()), np.array(weak) >= 0.5
    assert max(good.sum(), (~good).sum()) <= quality.TRAIN_ROWS
    rows = np.array(own)
    size = {y: (good[rows] == y).sum() for y in (True, False)}
    weight = np.array([(good == y).sum() / size[y] for y in good[rows]])
    weight, target = weight / weight.sum(), np.array(weak)[rows]

    def gradient(w):
        r = weight * (1 / (1 + np.exp(-np.clip(x[rows] @ w[:-1] + w[-1], -60, 60))) - target)
        return np.append(x[rows].T @ r + 2e-5 * w[:-1], r.sum())

    w = adam(gradient, np.zeros(quality.BUCKETS + 1), 300, 0.3)
    want = {d[0]: (weak[i], sigmoid(float(x[i] @ w[:-1] + w[-1]))) for i, d in enumerate(docs)}
    got = queries.QUERIES["op5_quality"](spark, SF).collect()
    assert len(got) == len(docs) == len(want)
    for r in got:
        assert r["weak_label"] == pytest.approx(want[r["doc_id"]][0], abs=1e-9)
        assert r["score"] == pytest.approx(want[r["doc_id"]][1], abs=0.02)
        assert r["predicted"] == int(r["score"] >= 0.5)
    flipped = sum((r["score"] >= 0.5) != (want[r["doc_id"]][1] >= 0.5) for r in got)
    assert flipped <= 0.002 * len(got)


def features(text):
    words = set(re.findall(r"\w+", (text or "").lower()))
    keys = {k for w in words for k in [w, *(f"{w[:n]}\0" for n in (4, 5) if len(w) > n)]}
    return {zlib.crc32(k.encode("utf-8", "surrogatepass")) % toxicity.SPACE for k in keys}


def test_toxicity_query_as_a_plain_solver_over_all_features(spark, docs):
    label = {}
    for doc_id, toxic in duckdb.sql(f"select doc_id, toxic from '{SF}/labels.parquet' where toxic is not null").fetchall():
        if zlib.crc32(str(doc_id).encode()) % 5:
            label[doc_id] = max(toxic, label.get(doc_id, 0))
    assert len(label) <= toxicity.TRAIN_ROWS
    texts = {}  # equal texts once, the largest label counts
    for doc_id, text in docs:
        if doc_id in label:
            texts[text] = max(label[doc_id], texts.get(text, 0))
    sample = [(features(t), y, t or "") for t, y in texts.items()]
    n, positive = len(sample), sum(y for _, y, _ in sample)
    count, hits = Counter(f for fs, _, _ in sample for f in fs), Counter(f for fs, y, _ in sample if y for f in fs)
    rate = positive / n
    chosen = sorted(f for f, c in count.items() if c >= 3 and (hits[f] - c * rate) ** 2 / (c * rate * (1 - rate) * (1.000001 - c / n)) >= 12)
    at = {f: i for i, f in enumerate(chosen)}
    x = np.zeros((n, len(chosen)))
    for i, (fs, _, _) in enumerate(sample):
        for f in fs & at.keys():
            x[i, at[f]] = 1
    y = np.array([y for _, y, _ in sample], float)
    changes = []
    for _, _, t in sample:  # every swap is a row of its own
        for new, gone in toxicity.swaps(t, toxicity.IDENTITY_TERMS):
            d = np.zeros(len(chosen))
            for f in new:
                if f in at:
                    d[at[f]] += 1
            for f in gone:
                if f in at:
                    d[at[f]] -= 1
            changes.append(d)
    changes = np.array(changes).reshape(-1, len(chosen))

    def gradient(w):
        r = (1 / (1 + np.exp(-(x @ w[:-1] + w[-1]))) - y) / n
        pull = changes @ w[:-1] / max(len(changes), 1)
        return np.append(x.T @ r + 2e-5 * w[:-1] + 20 * changes.T @ pull, r.sum())

    start = np.zeros(len(chosen) + 1)
    start[-1] = math.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))
    w = adam(gradient, start, 1200, 0.1)
    got = queries.QUERIES["op4_toxicity"](spark, SF).collect()
    assert len(got) == len(docs)
    want = {d: sigmoid(float(sum(w[at[f]] for f in features(t) & at.keys()) + w[-1])) for d, t in docs}
    for r in got:
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-4)
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and r["predicted"] == int(r["score"] >= 0.5)
