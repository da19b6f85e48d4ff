import numpy as np
import pytest
from pyspark.sql import functions as F

from veilframe.llm import queries, search, trees


def brute(ids, x, asked, k):
    out = {}
    for i in asked:
        s = x @ x[ids.index(i)]
        order = sorted((-s[j], ids[j]) for j in range(len(ids)) if ids[j] != i)[:k]
        out[i] = [(d, -v) for v, d in order]
    return out


def collected(df):
    out = {}
    for r in sorted(df.collect()):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def clustered(rng, n, d=16):
    centers = rng.normal(size=(8, d))
    x = centers[rng.integers(8, size=n)] + 0.3 * rng.normal(size=(n, d))
    return x * rng.uniform(0.3, 2, size=(n, 1))


@pytest.mark.parametrize("seed", range(6))
def test_dual_tree_is_exact(seed):
    rng = np.random.default_rng(seed)
    x = np.floor(clustered(rng, 700) * 20)
    q = np.floor(clustered(rng, 150) * 20)
    tree = trees.CoverTree(x, leaf=8)
    assert sorted(tree.points) == list(range(700))
    best = trees.Best(len(q), 7, np.full(len(q), -np.inf))
    trees.dual_search(trees.CoverTree(q, leaf=8), tree, best, np.arange(700))
    for i in range(len(q)):
        s = x @ q[i]
        assert [*best.row[i]] == [*np.lexsort((np.arange(700), -s))[:7]]


def test_cover_tree_radii():
    x = clustered(np.random.default_rng(9), 600)
    t = trees.CoverTree(x, leaf=8)

    def points(n):
        lo, hi = t.spans[n]
        return np.concatenate([points(c) for c in t.children[n]]) if t.children[n].size else t.points[lo:hi]

    for n in range(len(t.center)):
        d = np.sqrt(((x[points(n)] - x[t.center[n]]) ** 2).sum(1))
        assert d.max() <= t.radius[n] + 1e-9
        c = x[t.center[t.children[n]]] if t.children[n].size else np.empty((0, 16))
        if len(c) > 1:
            gaps = np.sqrt(((c[:, None] - c[None]) ** 2).sum(2))[np.triu_indices(len(c), 1)]
            assert gaps.min() > t.radius[n] / 1.5 - 1e-9


@pytest.mark.parametrize("factor", [1.0, 1.2])
def test_vantage_tree(factor):
    rng = np.random.default_rng(4)
    x, q = clustered(rng, 900), clustered(rng, 60)
    best = trees.Best(60, 5, np.full(60, -np.inf))
    trees.vantage_search(trees.VantageTree(x, leaf=8), q, best, np.arange(900), factor)
    hits = 0
    for i in range(60):
        hits += len({*best.row[i]} & {*np.argsort(((x - q[i]) ** 2).sum(1))[:5]})
    assert hits == 300 if factor == 1 else hits >= 280


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_queries_on_odd_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(search, "SHARD", 64)
    monkeypatch.setattr(search, "BLOCK", 8)
    rng = np.random.default_rng(1)
    x = clustered(rng, 600, 8).astype(np.float32)
    x[100:300] = x[100]  # a third are copies
    rows = [(i, [float(c) for c in x[i]], 0) for i in range(600)]
    odd = [(700, None, 1), (800, [float("nan")] * 8, 1), (900, [1.0, None] + [0.0] * 6, 1), (1000, [float("inf")] + [0.0] * 7, 1), (1100, [0.0] * 8, 1), (None, [1.0] * 8, 1), (5, rows[5][1], 0)]
    frame(spark, rows + odd).withColumn("v", F.lit(1)).write.parquet(f"{tmp_path}/embeddings.parquet")
    ids = [*range(600), 1100]
    y = np.concatenate([x.astype(float), np.zeros((1, 8))])
    want = brute(ids, np.floor(1024 * y).astype(np.int64), [i for i in ids if i % 100 == 0], 10)
    got = collected(queries.QUERIES["op7_topk"](spark, str(tmp_path)))
    assert got == want
    want = brute(ids[:-1], y[:-1], [i for i in ids[:-1] if i % 20 == 0], 20)
    got = collected(queries.QUERIES["op8_ann"](spark, str(tmp_path)))
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert sum(len({a for a, _ in got[i]} & {a for a, _ in want[i]}) for i in want) >= 0.9 * 20 * len(want)
    score = {(i, j): float(y[i] @ y[j]) for i in want for j in range(600)}
    assert all(abs(s - score[i, j]) < 1e-12 for i in got for j, s in got[i])
    exact = collected(search.approximate_top_k(queries.vectors(spark, str(tmp_path)), F.col("vec_id") % 20 == 0, 20, 1.0))
    want = brute(ids, y, [i for i in ids if i % 20 == 0], 20)
    assert {i: [round(s, 9) for _, s in v] for i, v in exact.items()} == {i: [round(s, 9) for _, s in v] for i, v in want.items()}


def test_few_and_no_vectors(spark, tmp_path):
    frame(spark, [(0, [1.0, 2.0], 0), (100, [3.0], 0), (101, [0.5, 0.5], 0)]).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    got = collected(queries.QUERIES["op7_topk"](spark, f"{tmp_path}/a"))
    assert got == {0: [(100, 3072 * 1024), (101, 512 * 1024 + 512 * 2048)], 100: [(0, 3072 * 1024), (101, 3072 * 512)]}
    frame(spark, []).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    for name in ("op7_topk", "op8_ann"):
        assert queries.QUERIES[name](spark, f"{tmp_path}/b").count() == 0


def by_rows(rows, k, every):
    """Every different row of a query id with every row of another id, as the SQL has it."""
    out, rows = {}, sorted({(i, tuple(v)) for i, v in rows})
    for i in sorted({i for i, _ in rows if i % every == 0}):
        pairs = sorted((-float(np.dot(q, c)), j) for a, q in rows if a == i for j, c in rows if j != i)
        out[i] = [(j, -s) for s, j in pairs[:k]]
    return out


@pytest.mark.parametrize("find", ["exact", "approximate"])
def test_one_id_with_several_vectors(spark, monkeypatch, find):
    """Each of them is a candidate, and asks if its id does."""
    monkeypatch.setattr(search, "SHARD", 16)
    rng = np.random.default_rng(3)
    rows = [(i, np.floor(rng.normal(size=4) * 50).tolist()) for i in range(50)]
    rows += [(i, [v[0] + n, *v[1:]]) for n in (1, 7, 30) for i, v in rows[:21:10]] + [(11, rows[10][1]), (12, rows[10][1]), rows[5]]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = collected(search.exact_top_k(df, F.col("vec_id") % 20 == 0, 6) if find == "exact" else search.approximate_top_k(df, F.col("vec_id") % 20 == 0, 6, 1.0))
    assert got == by_rows(rows, 6, 20)


def test_repeated_ids_as_in_sql(spark, tmp_path):
    import duckdb

    rows = [(1, [2.0, 0.0], 0), (1, [3.0, 0.0], 0), (100, [1.0, 1.0], 0), (100, [1.0, 1.0], 0), (200, [0.5, -1.0], 0), (200, [0.25, 4.0], 0), (7, [0.1, 0.1], 0)]
    frame(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{tmp_path}/embeddings.parquet/*.parquet'")
    df = queries.QUERIES["op7_topk"](spark, str(tmp_path))
    want = con.execute(queries.ORACLES["op7_topk"]).fetchall()
    assert sorted(map(tuple, df.select("query_id", "rank", "vec_id", "score").collect())) == sorted(want)


@pytest.mark.parametrize("odd", [[1e8], [1e160], [1e160, 1e-160, 1e300, 1e-300, 1e3], [1e-8] * 5])
def test_any_finite_norms(spark, monkeypatch, odd):
    """One large vector takes nothing from the others, whatever its norm, and small ones are found among small ones."""
    monkeypatch.setattr(search, "SHARD", 128)
    rng = np.random.default_rng(5)
    x = clustered(rng, 600, 8)
    extra = rng.normal(size=(len(odd), 8))
    extra *= (np.array(odd) / np.sqrt((extra**2).sum(1)))[:, None]
    x = np.concatenate([x, extra, np.zeros((1, 8))])
    ids = list(range(len(x)))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in ids], "vec_id long, v array<double>")
    asked = [i for i in ids if i % 20 == 0 or i >= 600]
    want = brute(ids, x, asked, 20)
    is_query = (F.col("vec_id") % 20 == 0) | (F.col("vec_id") >= 600)
    for factor, least in ((None, 1.0), (1.0, 1.0), (1.2, 0.9)):
        got = collected(search.exact_top_k(df, is_query, 20) if factor is None else search.approximate_top_k(df, is_query, 20, factor))
        assert set(got) == set(want)
        hits = 0
        for i in want:
            assert len(got[i]) == 20
            for (j, s) in got[i]:
                assert s == pytest.approx(float((x[i] * x[j]).sum()), rel=1e-9, abs=0 if i >= 600 else 1e-12)
            worst = min(s for _, s in want[i])
            hits += sum(s >= worst - 1e-12 * abs(worst) for _, s in got[i])
        assert hits >= least * 20 * len(want)


def test_huge_components_do_not_stop_the_query(spark, tmp_path):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=4).tolist(), 0) for i in range(300)] + [(300, [1e300, 0.0, 1.0, 0.0], 0), (301, [-1.7e308] * 4, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = collected(queries.QUERIES["op7_topk"](spark, str(tmp_path)))
    most = (1 << 63) - 1
    assert set(got) == {0, 100, 200, 300} and all(len(v) == 10 for v in got.values())
    assert got[300][0][1] == most and all(abs(s) <= most + 1 for v in got.values() for _, s in v)
    whole = {i: [int(np.floor(1024 * c)) for c in v] for i, v, _ in rows[:300]}
    for i in (0, 100, 200):
        near = sorted(((-sum(a * b for a, b in zip(whole[i], whole[j])), j) for j in whole if j != i))[:10]
        assert [r for r in got[i] if r[0] < 300] == [(j, -s) for s, j in near][: len([r for r in got[i] if r[0] < 300])]
    assert queries.QUERIES["op8_ann"](spark, str(tmp_path)).count() == 16 * 20


def test_shards_prune_where_the_vectors_lie_in_groups(spark, monkeypatch):
    """The share of shards that a query meets falls as shards grow in number."""
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(64, 8))
    centers /= np.sqrt((centers**2).sum(1))[:, None]
    x = centers[rng.integers(64, size=3200)] + 0.01 * rng.normal(size=(3200, 8))
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(3200)], "vec_id long, v array<double>")
    met = []
    monkeypatch.setattr(search, "PIVOTS", (1, 1024))
    for shard in (3200, 320, 32):
        monkeypatch.setattr(search, "SHARD", shard)
        shares = search.visited(df, F.col("vec_id") % 20 == 0, 10)
        met.append(shares)
    assert met[0] > met[1] > met[2] and met[2] < 0.5


def test_queries_are_cut_into_chunks(spark, monkeypatch):
    """More queries than one task takes meet a copy of the shard each, and give the same."""
    rng = np.random.default_rng(8)
    x = np.floor(rng.normal(size=(300, 6)) * 50)
    df = spark.createDataFrame([(i, x[i].tolist()) for i in range(300)], "vec_id long, v array<double>")
    want = brute(list(range(300)), x, list(range(0, 300, 2)), 5)
    for name, n in (("SHARD", 40), ("CHUNK", 16), ("BLOCK", 5), ("SAMPLE", 64), ("PIVOTS", (4, 8))):
        monkeypatch.setattr(search, name, n)
    assert collected(search.exact_top_k(df, F.col("vec_id") % 2 == 0, 5)) == want
