import json
import random

import pytest
from pyspark.sql import functions as F

from tests_helpers import FULL, csv_rows, folder
from veilframe.config import Config, NumericQi
from veilframe.errors import PipelineError
from veilframe.operators import generalize
from veilframe.operators.hierarchy import Hierarchy, HierarchyTable
from veilframe.operators.histogram import Qi
from veilframe.plans import run
from veilframe.plans.anonymizer import Anonymizer


def postcodes(spark, n):
    """Five digits, their first three, their first."""
    return spark.range(n).select(F.lpad(F.col("id").cast("string"), 5, "0").alias("value")).select("value", F.substring("value", 1, 3).alias("l2"), F.substring("value", 1, 1).alias("l3"))


def people(spark, n, codes):
    rnd = random.Random(3)
    rows = [(rnd.choice([None, "x", *[f"{rnd.randrange(codes):05d}"] * 6]), rnd.randrange(20, 60), i) for i in range(n)]
    return spark.createDataFrame(rows, "zip string, age int, id int")


@pytest.mark.parametrize("scoring", ["hierarchy", "index"])
def test_same_as_a_hierarchy_in_the_plan(spark, scoring):
    frame = postcodes(spark, 400)
    small = {n: {r["value"]: r[f"l{n}"] for r in frame.collect()} for n in (2, 3)}
    df = people(spark, 1500, 500)
    cfg = Config(k=8, suppression_limit=0.1, numerical=(NumericQi("age"),), categorical=("zip",), size={"age": 2}, categorical_scoring=scoring)
    a, out_a = Anonymizer(cfg, {"zip": HierarchyTable(frame)}).fit_transform(df)
    b, out_b = Anonymizer(cfg, {"zip": Hierarchy(4, small)}).fit_transform(df)
    assert a.found == b.found and a.class_sizes == b.class_sizes
    plain = lambda f: f.where("zip is not null").orderBy("id").collect()
    assert out_a.columns == out_b.columns and plain(out_a) == plain(out_b)
    for level in (1, 2, 3, 4):
        got, want = (generalize.generalized(df, [Qi("zip", True)], (level,), {"zip": h}) for h in (HierarchyTable(frame), Hierarchy(4, small)))
        assert got.orderBy("id").collect() == want.orderBy("id").collect()


def test_a_million_values(spark, tmp_path):
    postcodes(spark, 1_000_000).withColumn("value", F.concat(F.lit("p"), F.col("value"))).groupBy("value").agg(F.first("l2").alias("l2"), F.first("l3").alias("l3")).write.parquet(f"{tmp_path}/h.parquet")
    table = HierarchyTable(spark.read.parquet(f"{tmp_path}/h.parquet").unionByName(spark.range(1_000_000).select(F.concat(F.lit("q"), "id").alias("value"), F.lit("q").alias("l2"), F.lit("q").alias("l3"))))
    table.check()
    df = people(spark, 3000, 90_000).withColumn("zip", F.concat(F.lit("p"), "zip"))
    cfg = Config(k=5, suppression_limit=0.2, numerical=(NumericQi("age"),), categorical=("zip",), size={"age": 5}, categorical_scoring="hierarchy")
    model, out = Anonymizer(cfg, {"zip": table}).fit_transform(df)
    assert model.node[1] >= 2
    sizes = out.where("zip <> '*' or age <> '*'").groupBy("zip", "age").count().agg(F.min("count")).first()[0]
    assert sizes is None or sizes >= 5
    assert "CASE WHEN" not in generalize.generalized(df, [Qi("zip", True)], (2,), {"zip": table})._jdf.queryExecution().optimizedPlan().toString()


def test_what_is_no_hierarchy(spark):
    for rows in ([("a", "x", "1"), ("b", "x", "2")], [("a", "x", "1"), ("a", "x", "1")]):
        with pytest.raises(PipelineError):
            HierarchyTable(spark.createDataFrame(rows, "value string, l2 string, l3 string")).check()
    with pytest.raises(PipelineError):
        HierarchyTable(spark.createDataFrame([("a", "b")], "value string, top string")).check()
    HierarchyTable(spark.createDataFrame([("a", None, "Other"), ("b", "x", None)], "value string, l2 string, l3 string")).check()


def test_run_with_a_table(spark, tmp_path):
    spark.createDataFrame([("Male", "person"), ("Female", "person")], "value string, l2 string").write.parquet(f"{tmp_path}/genders.parquet")
    root = folder(tmp_path, FULL | {"hierarchies": {"Gender": "genders.parquet"}, "categorical_scoring": "hierarchy", "k_anonymize": {"k": 9}, "suppression_limit": 0.0}, csv_rows())
    status = run.status_of(spark, str(root))
    assert status["status"] == "success", status
    rows = spark.read.option("header", True).csv(status["outputs"]["final_output_path"]).collect()
    assert {r["Gender"] for r in rows} <= {"person", "*", "Male", "Female"} and json.dumps(status)
