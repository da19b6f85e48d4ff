import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from veilframe.llm import common, simhash
from veilframe.llm.components import connected_components


def brute(rows, words, radius):
    def fp(t):
        w = (t or "").encode().lower().split()
        if not w:
            return 0
        s = [b" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] or [b" ".join(w)]
        h = [xxhash.xxh64_intdigest(x, 42) for x in s]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    fps = [fp(t) for _, t in rows]
    comp = list(range(len(rows)))

    def find(i):
        while comp[i] != i:
            i = comp[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return sorted(((d, f, low.get(find(i))) for i, (d, f) in enumerate(zip([r[0] for r in rows], fps))), key=str)


def run(spark, rows, words, radius):
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("x")).withColumn("component_id", F.lit(1))
    got = simhash.near_duplicates(df, words, radius).collect()
    return sorted(((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got), key=str)


@pytest.mark.parametrize(("words", "radius"), [(3, 2), (5, 8)])
def test_against_brute_force(spark, words, radius):
    rng = np.random.default_rng(1)
    vocab = [f"w{i}" for i in range(300)]
    rows = [(None, "gone gone"), (1, None), (2, ""), (3, " \t\n"), (4, "One"), (5, "one"), (6, "é É x y"), (7, "a b c d e f " * 3000)]
    for i in range(10, 90, 8):
        base = list(rng.choice(vocab, int(rng.integers(20, 200))))
        for j in range(8):
            w = base.copy()
            for _ in range(j // 2):
                w[rng.integers(len(w))] = "new"
            rows.append((i + j, " ".join(w)))
    rows += [rows[-1], rows[20]]
    assert run(spark, rows, words, radius) == brute(rows, words, radius)


@pytest.mark.parametrize("radius", [2, 5, 8])
def test_crowded_cells_lose_no_link(spark, radius, monkeypatch):
    monkeypatch.setattr(simhash, "CROWD", 8)
    rng = np.random.default_rng(radius)
    base = int(rng.integers(1 << 62))
    fps = {base}
    while len(fps) < 250:
        x = base if rng.random() < 0.7 else int(rng.choice(sorted(fps)))
        for b in rng.integers(0, 63, rng.integers(1, radius + 3)):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"), radius, radius)
    got = {r.node: r.root for r in connected_components(edges).collect()}
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    assert [got.get(f, f) for f in fps] == [fps[find(i)] for i in range(len(fps))]


def test_two_parts_catch_similar_texts(spark):
    """Of pairs with a share of 0.8 equal five-word shingles nearly all are linked, of unlike texts none."""
    rng = np.random.default_rng(2)
    rows, pairs = [], []
    for i in range(0, 400, 2):
        base = [f"w{x}" for x in rng.integers(0, 3000, 400)]
        near = base.copy()
        for at in rng.choice(400, 6, replace=False):
            near[at] = "other"
        shingles = [{tuple(w[j : j + 5]) for j in range(396)} for w in (base, near)]
        assert len(shingles[0] & shingles[1]) / len(shingles[0] | shingles[1]) >= 0.8
        rows += [(i, " ".join(base)), (i + 1, " ".join(near))]
        pairs.append((i, i + 1))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash.near_duplicates(df, simhash.WORDS, simhash.RADIUS, simhash.LIMIT, simhash.PARTS).collect()}
    assert sum(got[b] == a for a, b in pairs) >= 0.95 * len(pairs)
    assert all(c in (d, d - 1) for d, c in got.items())
    assert simhash.fingerprint("a b c", 3, 2)[0] == simhash.fingerprint("a b c", 3)[0]


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 500), (301, 300)], "u long, v long")
    got = {r.node: r.root for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(201)} | {300: 300, 301: 300}


@pytest.mark.parametrize("least", [2, 1_000])
def test_hubs_and_hot_keys(spark, monkeypatch, least):
    monkeypatch.setattr(common, "HOT_ROWS", least)
    links = [(7, i) for i in range(100, 3_100)] + [(i, i + 1) for i in range(4_000, 4_040)] + [(3_050, 4_020), (9_000, 9_001), (9_002, 9_001), (5, 5)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    nodes = {7, *range(100, 3_100), *range(4_000, 4_041)}
    assert got == {n: 7 for n in nodes} | {n: 9_000 for n in (9_000, 9_001, 9_002)}
    rows = spark.range(5_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), "id").cache()
    unique = rows.groupBy("k").agg(F.count("*").alias("n"), F.max("id").alias("most"))
    found = common.with_unique(rows, unique, ["k"], "n", 5_000, F.col("id"))
    assert sorted(found.collect()) == sorted(rows.join(unique.drop("n"), "k").select("k", "id", "most").collect())


def test_copies_without_an_id(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 2)
    df = spark.createDataFrame([(None, "a b c d")] * 40 + [(i, "") for i in range(30)] + [(99, "x y z")], "doc_id long, text string")
    got = simhash.near_duplicates(df, 3, 2).groupBy("doc_id", "component_id").count().collect()
    assert sorted(map(tuple, got), key=str) == sorted([(None, None, 40), *((i, 0, 1) for i in range(30)), (99, 99, 1)], key=str)


def test_empty_and_keep_one(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty, 3, 2).count() == 0
    assert simhash.keep_one(empty).count() == 0
    text = " ".join(f"word{i}" for i in range(100))
    df = spark.createDataFrame([(5, text, "a"), (3, text.upper(), "b"), (3, text.upper(), "b"), (9, "quite another text", None)], "doc_id long, text string, __keep string")
    assert sorted((r.doc_id, r["__keep"]) for r in simhash.keep_one(df).collect()) == [(3, "b"), (9, None)]


def altered(rng, n, cuts):
    """A text of n words and one with ``cuts`` words changed, and their share of equal five-word shingles."""
    base = [f"w{x}" for x in rng.integers(0, 100_000, n)]
    near = base.copy()
    for at in cuts:
        near[at] = f"x{rng.integers(1 << 40)}"
    a, b = ({tuple(w[j : j + 5]) for j in range(n - 4)} for w in (base, near))
    return " ".join(base), " ".join(near), len(a & b) / len(a | b)


def kept_pairs(spark, pairs):
    rows = [(2 * i + k, t) for i, p in enumerate(pairs) for k, t in enumerate(p)]
    left = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(2 * i in left for i in range(len(pairs)))
    return sum(2 * i + 1 in left for i in range(len(pairs)))


def test_pairs_just_above_the_share_lose_one(spark):
    rng, pairs = np.random.default_rng(5), []
    for _ in range(300):
        a, b, share = altered(rng, 366, range(20, 340, 40))
        assert 0.8 <= share < 0.802
        pairs.append((a, b))
    assert kept_pairs(spark, pairs) == 0


def test_pairs_below_the_share_both_stay(spark):
    rng, pairs = np.random.default_rng(6), []
    for n, step in ((366, 36), (366, 26), (366, 20), (366, 18)):
        for _ in range(50):
            a, b, share = altered(rng, n, range(20, 340, step))
            assert 0.6 <= share < 0.8
            pairs.append((a, b))
    line = "the same line comes again "
    pairs += [(line * 300 + f"one{i} a{i} b{i}", line * 300 + f"two{i} c{i} d{i}") for i in range(1)]  # few different shingles
    assert kept_pairs(spark, pairs) == len(pairs)


def test_null_and_repeated_ids_stay_apart(spark):
    texts = [" ".join(f"{c}{i}" for i in range(60)) for c in "abcdef"]
    rows = [(None, texts[0]), (None, texts[1]), (None, texts[2].upper()), (1, texts[2]), (7, texts[3]), (7, texts[4]), (7, texts[4]), (8, texts[4]), (None, texts[5]), (None, texts[5])]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == sorted([(0, texts[0]), (0, texts[1]), (1, texts[2]), (7, texts[3]), (7, texts[4]), (0, texts[5])])


@pytest.mark.parametrize("crowd", [8, 256])
def test_grid_proposes_without_bands(spark, monkeypatch, crowd):
    """Every pair within the radius of the first part comes through the grid, bands or not; nothing else than close pairs is chained."""
    monkeypatch.setattr(simhash, "CROWD", crowd)
    rng = np.random.default_rng(11)
    near = lambda x, most: [p ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, m + 1), replace=False)) for p, m in zip(x, most)]
    rows = []
    for _ in range(60):
        base = [int(x) for x in rng.integers(1 << 62, size=simhash.SET_PARTS)]
        rows += [base, base, near(base, (5, 20, 20, 20)), near(base, (5, 25, 25, 25)), near(base, (9, 5, 5, 5))]
    hub = [int(x) for x in rng.integers(1 << 62, size=simhash.SET_PARTS)]
    rows += [near(hub, (3, 4, 4, 4)) for _ in range(60)]
    names = simhash._names(simhash.SET_PARTS)
    nodes = spark.createDataFrame([(i, *r, []) for i, r in enumerate(rows)], f"node long, {', '.join(f'{n} long' for n in names)}, bands array<long>")
    got = {r.node: r.root for r in connected_components(simhash.proposed(nodes)).collect()}
    for i, x in enumerate(rows):
        for j, y in enumerate(rows[:i]):
            far = [(a ^ b).bit_count() for a, b in zip(x, y)]
            if far[0] <= simhash.GRID_RADIUS and sum(far) <= simhash.SET_LIMIT:
                assert got[i] == got[j]
            if i // 5 != j // 5 and j < 300:
                assert got.get(i, i) != got.get(j, j)


def test_bands_propose_beyond_the_radius(spark):
    names = simhash._names(simhash.SET_PARTS)
    rows = [(1, 0, 0, 0, 0, [7]), (2, 63, 0, 0, 0, [7]), (3, -1 << 32, -1, -1, 0, [7]), (4, -1 << 32, -1, -1, 63, [8])]
    nodes = spark.createDataFrame(rows, f"node long, {', '.join(f'{n} long' for n in names)}, bands array<long>")
    got = {r.node: r.root for r in connected_components(simhash.proposed(nodes)).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3}


def test_near_copies_make_edges_in_proportion(spark, monkeypatch):
    """No component search gets more edges than a few for each text, however many cells, bands and chunks near copies share."""
    monkeypatch.setattr(simhash, "CROWD", 16)
    rng, made = np.random.default_rng(21), []
    monkeypatch.setattr(simhash, "connected_components", lambda edges: made.append(edges.count()) or connected_components(edges))
    base = [f"w{x}" for x in range(300)]
    rows = []
    for i in range(200):
        w = base.copy()
        w[rng.integers(300)] = f"x{i}"
        rows.append((i + 5, " ".join(w)))
    rows += [(i, f"quite another text {i}") for i in range(300, 310)]
    got = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {5, *range(300, 310)}
    assert max(made) <= 5 * len(rows)


def test_crowds_of_groups_and_chains_against_brute_force(spark, monkeypatch):
    """Chunks of a few texts: what chunks do not join is found between them."""
    monkeypatch.setattr(simhash, "CROWD", 6)
    rng, rows = np.random.default_rng(22), []
    for c in "ab":
        base = [f"{c}{x}" for x in range(200)]
        for i in range(50):
            w = base.copy()
            for at in rng.choice(200, int(rng.integers(0, 7)), replace=False):
                w[at] = f"x{rng.integers(1 << 40)}"
            rows.append((len(rows), " ".join(w)))
            if i % 10 == 0:
                base = w
    sets = [{tuple(w[j : j + 5]) for j in range(196)} for w in (t.split() for _, t in rows)]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]) and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    left = {i for i in range(len(rows)) if find(i) == i}
    assert 2 < len(left) < 80
    assert {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()} == left
