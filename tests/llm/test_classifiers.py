import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from veilframe.llm import quality, queries, toxicity

RNG = np.random.default_rng(3)
SYLLABLES = ["ka", "lo", "mi", "ter", "san", "vu", "pel", "dor"]
FILLER = ["the", "of", "and", "in", "to", *("".join(RNG.choice(SYLLABLES, 3)) for _ in range(400))]


def prose(n):
    return " ".join(RNG.choice(FILLER, n)) + "."


def labelled(n=900):
    """A quarter toxic; most toxic texts also name one group, which clean ones seldom do."""
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        t = prose(30)
        if toxic and i % 20:
            t += f" a {RNG.choice(['grobb', 'snarkel', 'vilegit'])} {prose(5)}"
        if RNG.random() < (0.8 if toxic else 0.02):
            t += " women said so."
        else:
            t += f" {RNG.choice(FILLER[5:])} said so."
        rows.append((i, t, int(toxic)))
    return rows


@pytest.fixture(scope="module")
def data(spark):
    df = spark.createDataFrame(labelled(), "doc_id long, text string, toxic int")
    return df.select("doc_id", "text", F.lit(1).alias("score")).cache(), df.select("doc_id", "toxic").cache()


def test_swap_penalty_spares_neutral_mentions(data):
    plain = toxicity.fit(*data, penalty=0.0).scorer()
    fair = toxicity.fit(*data, penalty=100.0).scorer()
    mentions = [f"{prose(20)} women said so." for _ in range(50)]
    insults = [f"{prose(20)} a snarkel {prose(4)}" for _ in range(50)]
    assert np.mean([fair(t) for t in insults]) > 0.8
    assert np.mean([fair(t) for t in mentions]) < np.mean([plain(t) for t in mentions])
    assert sum(fair(t) >= 0.5 for t in mentions) == 0
    gap = lambda s: abs(s("the women said so") - s("the men said so"))
    assert gap(fair) < gap(plain) / 5


def test_swaps_change_what_the_text_really_gains_and_loses():
    kinds = {"k": ("women", "men", "people")}
    feats = lambda t: {f for w in set(toxicity.WORD.findall(t.lower())) for f in toxicity.word_features(w)}
    for text in ("Women talk. no term", "women talk. Women and men", "womenfolk say women", "men and people; men. mentor", "women women", ""):
        want = []
        for at, s in enumerate(parts := text.lower().split(".")):
            for term in sorted(set(toxicity.WORD.findall(s)) & set(kinds["k"])):
                for other in sorted(set(kinds["k"]) - {term}):
                    swapped = toxicity.re.sub(rf"\b{term}\b", other, s)
                    after = feats(".".join([*parts[:at], swapped, *parts[at + 1 :]]))
                    want.append((sorted(after - feats(text)), sorted(feats(text) - after)))
        assert list(toxicity.swaps(text, kinds)) == want, text
    assert list(toxicity.swaps("", toxicity.IDENTITY_TERMS)) == []


def test_solver_matches_plain_gradient_descent():
    sets = [np.array([0]), np.array([0, 1]), np.array([1]), np.array([], int)]
    y, n = np.array([1.0, 1, 0, 0]), np.array([3.0, 1, 2, 5])
    d = np.array([1.0, -1.0])
    w, b = toxicity._solve(sets, y, n, 2, {(1, -2): 2}, 0.05, ridge=0.01, steps=4000)
    x = np.array([[1, 0], [1, 1], [0, 1], [0, 0]], float)
    v, c = np.zeros(2), 0.0
    for _ in range(60000):
        r = n / n.sum() * (1 / (1 + np.exp(-(x @ v + c))) - y)
        v -= 0.3 * (x.T @ r + 0.02 * v + 0.1 * d * (d @ v))
        c -= 0.3 * r.sum()
    assert np.allclose([*w, b], [*v, c], atol=0.02)


def test_toxicity_edges(spark, data):
    docs, labels = data
    model = toxicity.fit(docs, labels)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, ""), (2, "snarkel " * 50_000)], "doc_id long, text string")
    got = toxicity.scores(odd, model).collect()
    assert len(got) == 4 and all(0 <= r.score <= 1 for r in got)
    assert toxicity.drop_toxic(odd.withColumn("x", F.lit("kept")), model).count() == 3
    none = toxicity.fit(docs.limit(0), labels)
    assert none.features.size == 0 and 0 < none.scorer()("any") < 1
    conflict = labels.union(labels).withColumn("toxic", F.when(F.col("doc_id") % 2 == 0, None).otherwise(F.col("toxic")))
    toxicity.fit(docs, conflict)


def test_held_out_rule(spark, tmp_path, data):
    docs, labels = data
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    got = {r.doc_id: r for r in queries.QUERIES["op4_toxicity"](spark, str(tmp_path)).collect()}
    truth = {r.doc_id: r.toxic for r in labels.collect()}
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    out = [d for d, r in got.items() if r.held_out]
    assert np.mean([got[d].predicted == truth[d] for d in out]) > 0.9
    flipped = labels.withColumn("toxic", F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    flipped.write.parquet(f"{tmp_path}/b/labels.parquet")
    docs.write.parquet(f"{tmp_path}/b/documents.parquet")
    again = {r.doc_id: r.score for r in queries.QUERIES["op4_toxicity"](spark, f"{tmp_path}/b").collect()}
    assert all(abs(again[d] - got[d].score) < 1e-9 for d in got)


def junk(i):
    words = RNG.choice(FILLER, 60)
    return [" ".join(f"{w}{RNG.choice(['***', '&&&', '$$$'])}" for w in words), " ".join(f"{w.upper()}!!" for w in words), " | ".join(words), " ".join(" ".join([w] * 12) for w in words[:8])][i % 4]


def test_quality_without_labels(spark):
    rows = [(i, prose(int(RNG.integers(5, 200))) if i % 5 else junk(i // 5)) for i in range(1000)]
    rows += [(2000, "Call kaloter misan +1 (252) 555-8630 or pelvu 38.211.12.42 dortersan 4366089147969128."), (2001, None), (2002, ""), (None, "  \n"), (2003, "word " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("weak_label", F.lit(0))
    model = quality.fit(docs)
    got = {r.doc_id: r for r in quality.scores(docs, model).collect()}
    wrong = [i for i in range(1000) if (got[i].score >= 0.5) != bool(i % 5)]
    assert len(wrong) <= 5, wrong
    assert got[2000].score >= 0.5 and got[2003].score < 0.5
    kept = quality.keep_good(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == {d for d, r in got.items() if r.score >= 0.5}


def test_repeated_ids_keep_their_own_votes(spark):
    """Rows that share an id, or have none, train the scorer as rows of their own do."""
    rows = [(i, prose(int(RNG.integers(40, 200))) if i % 4 else junk(i // 4)) for i in range(400)]
    own = quality.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    for shared in ([(i % 2, t) for i, t in rows], [(None, t) for _, t in rows]):
        model = quality.fit(spark.createDataFrame(shared, "doc_id long, text string"))
        assert np.allclose(model.labels.chance, own.labels.chance)
        assert np.allclose(model.weights, own.weights, atol=1e-2) and abs(model.bias - own.bias) < 1e-2


def test_quality_empty_and_one_class(spark):
    schema = "doc_id long, text string"
    assert quality.scores(spark.createDataFrame([], schema), quality.fit(spark.createDataFrame([], schema))).count() == 0
    one = spark.createDataFrame([(1, prose(50)), (1, prose(50))], schema)
    assert all(r.score > 0.5 for r in quality.scores(one, quality.fit(one)).collect())


def test_em_finds_accuracies():
    rng = np.random.default_rng(0)
    n, m = 20000, len(quality.LABELLERS)
    y = rng.random(n) < 0.8
    bad = np.where(y[:, None], 0.03, np.linspace(0.3, 0.9, m))
    votes = np.where(rng.random((n, m)) < bad, quality.BAD, quality.GOOD)
    votes[rng.random((n, m)) < 0.2] = quality.NONE
    patterns, counts = np.unique(votes @ 3 ** np.arange(m - 1, -1, -1), return_counts=True)
    model = quality.estimate(patterns, counts)
    assert abs(model.prior - 0.8) < 0.02
    assert np.allclose(model.chance[:, 0, quality.BAD], np.linspace(0.3, 0.9, m), atol=0.05)
    assert np.allclose(model.chance[:, 1, quality.BAD], 0.03, atol=0.02)
