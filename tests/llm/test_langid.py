import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilframe.llm import langid, queries


def plain(text):
    low = "".join(c.lower() if c.isalpha() else " " for c in text)
    out = "".join(c for c, b in zip(low, " " + low) if not (c == " " and b == " "))
    return "\1" * 3 + out + "\1" if out.strip() else ""


def brute(texts, alphabet):
    """Interpolated Kneser-Ney by the book, on strings."""
    tables = [Counter(t[i : i + 4] for t in texts for i in range(len(t) - 3))]
    for k in (3, 2, 1):
        tables.append(Counter(g[-k:] for g in tables[-1]))
    tables = tables[::-1]
    discounts = []
    for t in tables:
        n1, n2 = sum(v == 1 for v in t.values()), sum(v == 2 for v in t.values())
        discounts.append(n1 / (n1 + 2 * n2) if n1 and n2 else 0.5)

    def p(gram):
        k = len(gram)
        if not k:
            return 1 / alphabet
        t, d = tables[k - 1], discounts[k - 1]
        own = {g: v for g, v in t.items() if g[:-1] == gram[:-1]}
        if not own:
            return p(gram[1:])
        return max(t.get(gram, 0) - d, 0) / sum(own.values()) + d * len(own) / sum(own.values()) * p(gram[1:])

    return p


def test_matches_the_book(spark):
    data = [("aa", "banana bandana Ban"), ("aa", "nab the cab"), ("bb", "zürich über zart!"), ("bb", "quark"), (None, "skip me"), ("aa", None), ("bb", "12 34")]
    model = langid.fit(spark.createDataFrame(data, "lang string, text string"))
    assert model.langs == ("aa", "bb")
    alphabet = len({g for la, t in data if la and t for g in plain(t)[3:]}) + 1
    tests = ["banana", "Zürich quark", "xyz banal", "ab\U00010400c"]
    got = model.entropies([*tests, None, "", "123 !"])
    for j, lang in enumerate(model.langs):
        p = brute([plain(t) for la, t in data if la == lang and t], alphabet)
        for i, t in enumerate(tests[:3]):
            s = plain(t)
            want = -sum(math.log2(p(s[k : k + 4])) for k in range(len(s) - 3)) / (len(s) - 3)
            assert abs(got[i, j] - want) < 1e-9
    assert np.isinf(got[4:]).all()
    for context in ("ban", "zzz"):
        keys = langid.ngrams(np.array([[ord(c) for c in context] + [x] for x in range(1)], np.uint16)[0])
        assert keys.size == 1


def test_blocks_do_not_matter(spark, monkeypatch):
    texts = ["some words over and over " * 30, "short", "other words again " * 50]
    df = spark.createDataFrame([("x", t) for t in texts] + [("y", "something else")], "lang string, text string")
    want = langid.fit(df).entropies(texts)
    monkeypatch.setattr(langid, "BLOCK", 64)
    assert np.allclose(langid.fit(df).entropies(texts), want)


def test_held_out_accuracy_and_edges(spark, tmp_path):
    rng = np.random.default_rng(0)
    words = {"en": ["the", "thing", "wheat", "ring", "house"], "de": ["der", "schön", "ung", "zeit", "haus"], "fr": ["le", "être", "eaux", "oui", "maison"]}
    rows = [(i, " ".join(rng.choice(words[la], 12)), la) for i in range(300) for la in [["en", "de", "fr"][i % 3]]]
    rows += [(1000, None, "en"), (1001, "", None), (1002, "123", "de"), (1003, "der schön zeit", None), (None, "the wheat", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").withColumn("score", F.lit("x")).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op9_langid"](spark, str(tmp_path)).collect()}
    truth = {d: la for d, _, la in rows[:300]}
    assert all(got[d].lang_pred == la for d, la in truth.items())
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d, r in got.items() if d is not None)
    assert [got[d].lang_pred for d in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "de"]
    assert all(0 <= r.score <= 1 for r in got.values()) and got[1000].rejected
    assert sum(r.rejected for d, r in got.items() if d in truth) <= 6


def test_no_count_is_cut_off_and_empty(spark):
    df = spark.createDataFrame([("a", "xyxyxyxyxyxy " * 50), ("a", "unique"), ("b", "rarely said")], "lang string, text string")
    model = langid.fit(df)
    assert model.langs == ("a", "b")
    own = [np.unique(np.concatenate([langid.ngrams(langid.letters(t)) for t in ts])).size for ts in (["xyxyxyxyxyxy " * 50, "unique"], ["rarely said"])]
    assert np.bincount(model.prob[3].lang).tolist() == own
    empty = langid.fit(df.limit(0))
    odd = spark.createDataFrame([(1, "abc")], "doc_id long, text string")
    assert [r.lang_pred for r in langid.predict(odd, empty).collect()] == ["und"]
    assert langid.predict(odd.limit(0), model).count() == 0


def test_sixty_languages_take_no_dense_table():
    """What is kept grows with the counts, not with n-grams times languages, and equals a model of one language alone."""
    rng = np.random.default_rng(2)
    own = {f"l{j:02}": " ".join("".join(chr(0x4E00 + 40 * j + c) for c in rng.integers(0, 30, 6)) for _ in range(80)) + " common words" for j in range(60)}
    counts = {}
    for lang, text in own.items():
        counts[lang] = np.unique(langid.ngrams(langid.letters(text)), return_counts=True)
    model = langid.build(counts)
    assert model.prob[3].value.size == sum(k.size for k, _ in counts.values()) == model.prob[3].lang.size
    assert model.prob[3].hashes.size < model.prob[3].value.size  # shared n-grams have one hash
    e = model.entropies([*own.values(), None])
    assert (e[:-1].argmin(1) == np.arange(60)).all() and np.isinf(e[-1]).all()
    one = langid.build({"l07": counts["l07"]})
    assert abs(one.entropies([own["l07"]])[0, 0] - e[7, 7]) < 0.2  # the letters of all languages count for unseen ones only
