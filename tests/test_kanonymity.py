import random

import pytest
from pyspark.sql import functions as F

from veilframe.config import Config, NumericQi
from veilframe.operators import generalize, histogram, membership
from veilframe.operators.hierarchy import Hierarchy
from veilframe.operators.histogram import Qi
from veilframe.plans import anonymizer, lattice
from veilframe.plans.rollup import Rollup


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def classes_of(spark, n=4000):
    """A hot class, classes below and above k, nulls, and a wide column."""
    rnd = random.Random(4)
    rows = [("hot", 1, "w" * 50) for _ in range(n // 3)] + [(None, None, "w")] * 2 + [(None, 5, "w")] * 9
    for i in range(n // 3):
        rows += [(f"c{i}", rnd.choice([1, None]), f"w{i}")] * rnd.choice([1, 2, 3, 4])
    return spark.createDataFrame(rows, "a string, b int, wide string").repartition(4)


def expected(df, k):
    sizes = {(r["a"], r["b"]): r["count"] for r in df.groupBy("a", "b").count().collect()}
    return sorted(((("*", "*") if sizes[r["a"], r["b"]] < k else (r["a"], None if r["b"] is None else str(r["b"]))) + (r["wide"],) for r in df.collect()), key=str)


@pytest.mark.parametrize("few, bits, depth", [(10_000, 1 << 26, 16), (5, 1 << 26, 16), (5, 1 << 10, 2)])
def test_small_classes_are_told_exactly(spark, monkeypatch, few, bits, depth):
    monkeypatch.setattr(generalize, "FEW", few)
    monkeypatch.setattr(membership, "MOST_BITS", bits)
    monkeypatch.setattr(membership, "DEPTH", depth)
    df = classes_of(spark)
    text = df.withColumn("b", F.col("b").cast("string"))
    out = generalize.suppressed(text, ["a", "b"], 3)
    if depth == 16:
        assert "Exchange hashpartitioning" not in plan(out) and "Exchange rangepartitioning" not in plan(out)  # rows, with the hot class, stay where they are
    assert sorted(map(tuple, out.collect()), key=str) == expected(df, 3)


def test_filters_are_exact_over_their_universe(spark):
    keys = spark.range(30_000).select(F.xxhash64("id").alias("h"), (F.col("id") % 7 == 0).alias("member")).cache()
    told = membership.cascade(keys)
    assert told.complete and len(told.filters) > 1
    assert keys.where(told.has(F.col("h")) != F.col("member")).count() == 0
    none = membership.cascade(keys.where("not member"))
    assert none.filters == [] and keys.where(none.has(F.col("h"))).count() == 0


def nodes_of(qis, size):
    return [n for level in lattice.levels(qis, (1,) * len(qis), size) for n in level]


def hist_of(spark, seed, shape, n=3000):
    rnd = random.Random(seed)
    rows = {tuple(min(int(rnd.expovariate(0.2)), s - 1) for s in shape): rnd.randrange(1, 9) for _ in range(n)}
    schema = ", ".join(f"i{i} long" for i in range(len(shape))) + ", cnt long"
    return spark.createDataFrame([(*i, c) for i, c in rows.items()], schema), len(rows)


@pytest.mark.parametrize("shape, size", [((16, 8, 4), (2, 2, 2)), ((50, 7), (3, 2)), ((9, 5, 3), (2, 5, 3))])
def test_rollup_scores_as_the_finest_cells_do(spark, shape, size):
    hist, cells = hist_of(spark, 1, shape)
    qis = [Qi(f"q{i}", False, 0, s - 1) for i, s in enumerate(shape)]
    grid = lattice.levels(qis, (1,) * len(shape), {q.name: f for q, f in zip(qis, size)})
    roll = Rollup(hist, cells, shape, 5, first=grid[1])
    order = sorted(range(len(grid)), key=lambda i: abs(i - len(grid) // 2))  # the middle first, as a search does
    for i in order:
        roll.score(grid[i])
    want = {tuple(r["node"]): (r["suppressed"], r["dm_star"], r["classes"]) for r in histogram.score_nodes(hist, [n for level in grid for n in level], 5).collect()}
    assert roll.scores == want
    roll.close()


def test_the_finest_cells_are_read_once(spark):
    shape = (32, 16, 8)
    hist, cells = hist_of(spark, 2, shape, 6000)
    qis = [Qi(f"q{i}", False, 0, s - 1) for i, s in enumerate(shape)]
    grid = lattice.levels(qis, (1, 1, 1), {q.name: 2 for q in qis})
    roll = Rollup(hist, cells, shape, 5, first=grid[1])
    for level in grid[4:] + grid[1:4][::-1]:
        roll.score(level)
    base = (1, 1, 1)
    assert [base in r for r in roll.read] == [True] + [False] * (len(roll.read) - 1)
    assert sum(sum(r.values()) for r in roll.read) < cells * len(roll.scores) / 10
    roll.close()


def test_classes_of_hierarchies_roll_up_only_where_they_nest(spark):
    hist, cells = hist_of(spark, 3, (4, 6), 500)
    nested = {1: [[0, 1, 2, 3, 4, 5], [0, 0, 1, 1, 2, 2], [0, 0, 0, 0, 0, 0]]}
    crossed = {1: [[0, 1, 2, 3, 4, 5], [0, 0, 1, 1, 2, 2], [0, 1, 0, 1, 0, 1]]}
    for classes, source in ((nested, (1, 2)), (crossed, (1, 1))):
        roll = Rollup(hist, cells, (4, 6), 5, classes)
        roll.score([(1, 2)])
        assert roll.source((2, 3)) == source
        got = roll.score([(2, 2), (2, 3), (4, 3)])
        want = {tuple(r["node"]): (r["suppressed"], r["dm_star"], r["classes"]) for r in histogram.score_nodes(hist, list(got), 5, classes).collect()}
        assert got == want


@pytest.mark.parametrize("kind", ["int", "double", "string"])
@pytest.mark.parametrize("scoring", ["index", "hierarchy"])
def test_labels_from_cells_are_those_of_the_rows(spark, kind, scoring):
    rnd = random.Random(6)
    rows = [(rnd.choice([None, *range(20, 60)]), rnd.choice([None, " a", "a", "b", "c"]), i) for i in range(2000)]
    df = spark.createDataFrame(rows, "age int, town string, id int").withColumn("age", F.col("age").cast(kind))
    own = {"town": Hierarchy(3, {2: {"a": "A", "b": "A"}})}
    cfg = Config(k=9, suppression_limit=0.05, numerical=(NumericQi("age"),), categorical=("town",), size={"age": 3}, categorical_scoring=scoring, max_equivalence_classes=80)
    fit = anonymizer.Anonymizer(cfg, own)
    model, out = fit.fit_transform(df)
    again, cells, unit = fit._fit(df)
    counts = anonymizer.label_counts(again, df, cells, unit)
    assert again.node == model.node and (counts is not None) == (kind == "int")
    if counts is not None:
        assert sorted(map(tuple, counts.collect()), key=str) == sorted(map(tuple, generalize.class_counts(model.generalize(df), ["age", "town"]).collect()), key=str)
    assert sorted(map(tuple, out.collect()), key=str) == sorted(map(tuple, model.transform(df).collect()), key=str)


def test_empty_and_single_class(spark):
    df = spark.createDataFrame([], "a string, b string, wide string")
    assert generalize.suppressed(df, ["a", "b"], 3).count() == 0
    one = spark.createDataFrame([("x", "y", "z")] * 2, "a string, b string, wide string")
    assert [tuple(r) for r in generalize.suppressed(one, ["a", "b"], 3).collect()] == [("*", "*", "z")] * 2
    assert generalize.suppressed(one, ["a", "b"], 2).collect() == one.collect()
