import random
import re

import numpy as np
import pytest

from veilframe.llm import substrings
from veilframe.llm.bloom import Bloom
from veilframe.llm.substrings import SuffixAutomaton, Words, anchors

SCHEMA = "doc_id long, text string, d int, h string, kept string"


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def by_hand(rows, n):
    first = {}
    order = [(1 << 63) - 1 if r[0] is None else r[0] for r in rows]
    for d, r in zip(order, rows):
        w = words_of(r[1])
        for i in range(len(w) - n + 1):
            k = tuple(w[i : i + n])
            first[k] = min(d, first.get(k, d))
    out = []
    for d, r in zip(order, rows):
        w = words_of(r[1])
        gone = {i + k for i in range(len(w) - n + 1) if first[tuple(w[i : i + n])] < d for k in range(n)}
        out.append((r[0], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone)))
    return sorted(out, key=str)


def corpus(seed, size, vocabulary=40):
    """Texts with shared passages of many lengths, copies, near copies, repeated words, odd blanks and empty ones."""
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["é", "日本", "a", "the"]) if rnd.random() < 0.1 else f"w{rnd.randrange(vocabulary)}"
    passages = [[word() for _ in range(rnd.randrange(3, 60))] for _ in range(12)]
    texts = []
    for _ in range(size):
        w = [word() for _ in range(rnd.randrange(0, 80))]
        for _ in range(rnd.randrange(4)):
            at = rnd.randrange(len(w) + 1)
            w[at:at] = rnd.choice(passages)
        if texts and rnd.random() < 0.3:
            w = words_of(rnd.choice(texts))
            if w and rnd.random() < 0.6:
                w[rnd.randrange(len(w))] = "changed"
        texts.append("".join(x + rnd.choice([" ", " ", "\n", "\t ", "  "]) for x in w))
    texts += ["", " \n", "same " * 500, "same " * 40, "ab " * 13, "ab " * 12, "ab " * 14 + "end"]
    return texts


def made(spark, rows, n, parts=5):
    df = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(parts)
    found = substrings.drop_repeats(df, n)
    assert found.columns == ["doc_id", "n_words", "n_removed", "removed", "kept"]
    got = found.collect()
    for r in got:
        assert r["n_removed"] == sum(s["end"] - s["start"] for s in r["removed"])
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in got), key=str)


@pytest.mark.parametrize("n, vocabulary", [(13, 40), (13, 3), (3, 40), (1, 4000)])
def test_same_as_by_hand(spark, n, vocabulary):
    texts = corpus(n + vocabulary, 150, vocabulary)
    ids = list(range(len(texts)))
    random.Random(1).shuffle(ids)
    rows = list(zip(ids, texts)) + [(None, texts[2]), (None, texts[3] + texts[2]), (9, texts[5]), (9, texts[5]), (11, texts[6] + " more"), (12, None)]
    assert made(spark, rows, n) == by_hand(rows, n)


@pytest.mark.parametrize("hot, bits, shard", [(2, 1 << 28, 50), (0, 1 << 16, 4000), (5000, 1 << 16, 7)])
def test_hot_anchors_and_full_filters(spark, monkeypatch, hot, bits, shard):
    monkeypatch.setattr(substrings, "HOT", hot)
    monkeypatch.setattr(substrings, "BLOOM_BITS", bits)
    monkeypatch.setattr(substrings, "SHARD", shard)
    texts = corpus(5, 120)
    common = " ".join(f"c{i}" for i in range(60))
    rows = [(i, f"own{i} {t} {common} last{i}") for i, t in enumerate(texts)]
    assert made(spark, rows, 13) == by_hand(rows, 13)


def test_no_rows_and_no_repeats(spark):
    assert made(spark, [], 13) == []
    rows = [(i, " ".join(f"{i}-{k}" for k in range(50))) for i in range(5)]
    assert made(spark, rows, 13) == by_hand(rows, 13)


def test_automaton_finds_what_is_there():
    rnd = random.Random(3)
    texts = [[rnd.randrange(3) for _ in range(rnd.randrange(1, 25))] for _ in range(60)]
    auto = SuffixAutomaton()
    for i, t in enumerate(texts):
        auto.add(t, 100 - i)
    auto.finish()
    has = {}
    for i, t in enumerate(texts):
        for a in range(len(t)):
            for b in range(a + 1, len(t) + 1):
                has[tuple(t[a:b])] = 100 - i
    for t in [*texts, [rnd.randrange(4) for _ in range(300)]]:
        for end, (size, _) in enumerate(auto.statistics(t), 1):
            want = max((k for k in range(end + 1) if k == 0 or tuple(t[end - k : end]) in has), default=0)
            assert size == want
        for n in (1, 2, 5, 9):
            want = [(i, has[tuple(t[i : i + n])]) for i in range(len(t) - n + 1) if tuple(t[i : i + n]) in has]
            assert list(auto.first_of(t, n)) == want


def test_words_and_anchors_follow_the_text_alone():
    rnd = random.Random(8)
    texts = [t.encode() for t in corpus(8, 80)]
    words = Words(texts)
    h, raw = words.hashes(), words.buffer.tobytes()
    assert [raw[words.at[i] : words.at[i + 1] - 1].decode() for i in range(len(h))] == [w for t in texts for w in words_of(t.decode())]
    assert len(set(h.tolist())) == len({w for t in texts for w in words_of(t.decode())})
    # each window lies between the first and the last of one of its anchors, the same in any company
    seen = {}
    for some in (texts, [texts[3]], rnd.sample(texts, 20)):
        words = Words(some)
        found = anchors(words, 13)
        covered = set()
        for lo, hi, t, g in zip(found.low, found.high, found.text, found.hash):
            assert words.first[t] <= lo <= hi <= words.first[t + 1] - 13
            covered |= set(range(lo, hi + 1))
            key = words.buffer.tobytes()[words.at[lo] : words.at[lo + 13] - 1]
            seen.setdefault(key, set()).add(g)
        assert covered == {i for t in range(len(some)) for i in range(words.first[t], words.first[t + 1] - 12)}


def test_filter_lacks_nothing(spark):
    keys = np.random.default_rng(1).integers(-(1 << 63), 1 << 63, 5000)
    frame = spark.createDataFrame([(int(k),) for k in keys], "a long")
    full = substrings.bloom(frame, 5000, 1 << 28)
    assert full.has(keys.view(np.uint64)).all()
    others = np.random.default_rng(2).integers(-(1 << 63), 1 << 63, 5000)
    assert full.has(others.view(np.uint64)).mean() < 0.02
    assert substrings.bloom(frame, 5000, 1 << 16).has(keys.view(np.uint64)).all()
    assert not Bloom(0, np.empty(0, np.uint8)).has(keys.view(np.uint64)).any()
