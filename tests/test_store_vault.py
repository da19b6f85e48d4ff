import json

import pytest
from pyspark.sql import functions as F

from tests_helpers import FULL, csv_rows, folder
from veilframe import shared
from veilframe.config import Tokenization
from veilframe.operators import tokenize
from veilframe.plans import run
from veilframe.sources import vault as vaults
from veilframe.sources.store import Store, join
from veilframe.sources.vault import Vault
from veilframe.streaming import transforms

T = Tokenization("v", "T", 3)


def frame(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, v string")


def tokens(df):
    return [r.v for r in df.orderBy("i").collect()]


def test_a_run_writes_what_it_adds_and_reads_what_it_touches(spark, tmp_path):
    path = str(tmp_path / "vault")
    first = Vault(spark, path)
    first.tokenize(frame(spark, [f"v{i}" for i in range(500)]), T, "i")
    first.commit()
    second = Vault(spark, path)
    out = second.tokenize(frame(spark, ["v7", "v499"] + [f"new{i}" for i in range(10)] + ["", None]), T, "i")
    assert tokens(out) == ["T008", "T500"] + [f"T{501 + i}" for i in range(10)] + ["", None]
    second.commit()
    assert spark.read.parquet(f"{path}/run=2").count() == 10
    third = Vault(spark, path)
    assert third.last == {"v": 510} and third.rows().count() == 510
    touched = third.rows("v", [3, 5])
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "bucket" in plan.split("PartitionFilters: [")[1]
    assert 0 < len(touched.inputFiles()) <= len(third.rows().inputFiles())
    assert touched.select(vaults.bucket(F.col("value"))).distinct().count() <= 2
    third.tokenize(frame(spark, ["v1", "", None]), T, "i")
    third.commit()
    assert third.runs == second.runs  # nothing new, nothing written


def test_a_batch_that_is_run_again_gives_the_same_tokens(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(vaults, "DELTAS", 2)
    path, out = str(tmp_path / "vault"), str(tmp_path / "out")
    sink = transforms.TokenSink([T], path, lambda df, no: df.write.mode("overwrite").parquet(f"{out}/{no}"), "i")
    for no in range(6):
        batch = frame(spark, [f"b{no}", "common", f"b{max(0, no - 2)}"])
        sink(batch, no)
        got = tokens(spark.read.parquet(f"{out}/{no}"))
        sink(batch, no)
        assert tokens(spark.read.parquet(f"{out}/{no}")) == got
    vault = Vault(spark, path)
    assert len(vault.runs) <= 4 and vault.rows().count() == 7
    assert sorted(r["id"] for r in vault.rows().collect()) == list(range(1, 8))
    assert tokens(Vault(spark, path).tokenize(frame(spark, ["b0", "b5", "common"]), T, "i")) == ["T001", "T007", "T002"]


def test_uncommitted_rows_are_not_seen(spark, tmp_path):
    path = str(tmp_path / "vault")
    v = Vault(spark, path)
    v.tokenize(frame(spark, ["a"]), T, "i")
    v.commit()
    Store(spark).remove(f"{path}/run=1.json")  # as if the run had been lost before its commit
    again = Vault(spark, path)
    assert again.rows().count() == 0 and again.no == 1
    assert tokens(again.tokenize(frame(spark, ["b", "a"]), T, "i")) == ["T001", "T002"]


def test_hot_values_are_not_brought_together(spark, monkeypatch):
    monkeypatch.setattr(shared, "HOT_ROWS", 50)
    monkeypatch.setattr(shared, "HOT_KEYS", 20)
    values = ["hot"] * 3000 + ["", None] * 500 + [f"v{i % 700}" for i in range(3000)]
    df = frame(spark, values).repartition(4)
    out, vault = tokenize.tokenize(df, T, tokenize.empty_vault(spark), "i")
    by = {r["value"]: r["token"] for r in vault.collect()}
    assert tokens(out) == [by.get(v, v) for v in values]
    assert tokens(tokenize.detokenize(out, "v", vault)) == values
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        out, _ = tokenize.tokenize(df, T, tokenize.empty_vault(spark), "i")
        sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
        assert max(sizes) < len(values) / 4  # the hot value has 3000 of 7000 rows
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.shuffle.partitions", "4")


@pytest.mark.parametrize("kind", ["file", "mounted"])
def test_whole_runs_in_other_stores(spark, tmp_path, kind):
    folder(tmp_path, FULL, csv_rows())
    root = f"file://{tmp_path}"
    if kind == "mounted":
        name = f"fs.viewfs.mounttable.t{abs(hash(str(tmp_path)))}.link./in"
        spark.sparkContext._jsc.hadoopConfiguration().set(name, root)
        root = f"viewfs://{name.split('.')[3]}/in"
    assert run.main([root]) == 0
    status = json.loads((tmp_path / "output" / "status.json").read_text())
    assert status["status"] == "success" and status["outputs"]["final_output_path"] == f"{root}/output/out.csv"
    assert "best node" in (tmp_path / "output" / "pipeline.log").read_text()
    keys = (tmp_path / "output" / "fpe_keys.json").read_text()
    assert run.main(["--single-file", root]) == 0
    assert (tmp_path / "output" / "out.csv").is_file() and (tmp_path / "output" / "fpe_keys.json").read_text() == keys


def test_small_files(spark, tmp_path):
    store, root = Store(spark), str(tmp_path)
    assert store.read(f"{root}/none") is None and store.files(f"{root}/none") == [] and not store.is_folder(f"{root}/none")
    for text in ("é\nx", "", "again"):
        store.write(f"{root}/a/b.txt", text)
        assert store.read(f"{root}/a/b.txt") == text
    assert store.files(f"{root}/a") == [("b.txt", 5)]
    assert join(root, "x/y") == f"{root}/x/y" and join(root, "/x") == "/x" and join(root, "s3a://b/x") == "s3a://b/x"
    (tmp_path / "plain").write_text("")
    with pytest.raises(OSError):
        store.write(f"{root}/plain/below", "x")
