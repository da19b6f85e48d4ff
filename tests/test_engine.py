import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests_helpers import FULL, HEADER, csv_rows, folder
from veilframe import config, errors
from veilframe.config import Config, Encrypt, Fpe, Masking, NumericQi, Tokenization
from veilframe.operators import columns, generalize, histogram, tokenize
from veilframe.operators.hierarchy import BUILT_IN, Hierarchy, base_name
from veilframe.operators.histogram import Qi
from veilframe.plans import lattice, run
from veilframe.plans.anonymizer import Anonymizer
from veilframe.sources.store import Store
from veilframe.sources.vault import Vault
from veilframe.streaming import transforms


def scorer(hist, k):
    """Scores of a histogram given as {indices: count}."""

    def score(node):
        sizes = Counter()
        for key, n in hist.items():
            sizes[tuple(i // f for i, f in zip(key, node))] += n
        big = [n for n in sizes.values() if n >= k]
        return sum(n for n in sizes.values() if n < k), sum(n * n for n in big), len(big)

    return score


def test_search_of_one_column():
    qis = [Qi("Age", False, 0, 3)]
    grid = lattice.levels(qis, (1,), {"Age": 2})
    assert list(grid) == [[(1,)], [(2,)], [(4,)]]
    found = lattice.search(grid, scorer({(i,): 1 for i in range(4)}, 2), 2, 0.0, 4)
    assert found.best == lattice.Score(8, 0, -2, (2,))
    assert [s.node for s in found.evaluated] == [(2,), (1,)]


def test_a_pass_by_inheritance_is_not_ranked():
    hist = {(i,): n for i, n in enumerate((3, 1, 9, 20, 3))}
    grid = lattice.levels([Qi("Blood Group", True)], (1,), {})
    found = lattice.search(grid, scorer(hist, 12), 12, 0.2, 36)
    assert found.best == lattice.Score(841, 7, -1, (2,))
    assert [s.node for s in found.evaluated] == [(2,), (1,)]
    every = lattice.search(grid, scorer(hist, 12), 12, 0.2, 36, exhaustive=True)
    assert every.best == lattice.Score(698, 0, -2, (3,)) or every.best.node == (3,)


def test_walk_agrees_with_exhaustive_on_numbers():
    rng = random.Random(3)
    for _ in range(60):
        qis = [Qi("a", False, 0, rng.randint(1, 12)), Qi("b", False, 0, rng.randint(1, 12))]
        hist = {(rng.randint(0, int(qis[0].high)), rng.randint(0, int(qis[1].high))): rng.randint(1, 5) for _ in range(30)}
        grid = lattice.levels(qis, (1, 1), {"a": 2, "b": 3})
        k, limit, total = rng.randint(1, 8), rng.choice([0, 0.05, 0.3]), sum(hist.values())
        try:
            walked = lattice.search(grid, scorer(hist, k), k, limit, total)
        except errors.PipelineError as e:
            assert e.code == "ANON_INFEASIBLE"
            continue
        assert walked.best == lattice.search(grid, scorer(hist, k), k, limit, total, exhaustive=True).best


def test_first_widths_and_errors():
    qis = [Qi("Age", False, 0, 99), Qi("Zip", False, 10000, 10099)]
    size = {"Age": 2, "Zip": 2}
    node = lattice.first_widths(qis, size, 400)
    assert max(node) > 1 and lattice.estimated_classes(qis, node) <= 400
    assert node == min(n for level in lattice.levels(qis, (1, 1), size) for n in level if lattice.estimated_classes(qis, n) <= 400)
    assert lattice.first_widths(qis, size, None) == (1, 1)
    for bad, code in ((lambda: lattice.first_widths([], {}, 5), "ANON_NO_QIS"), (lambda: lattice.first_widths(qis, size, 0), "ANON_INFEASIBLE"), (lambda: lattice.levels(qis, (1, 1), {"Age": 2}), "GENERALIZATION_FAILED"), (lambda: lattice.levels([Qi("City", True)], (1,), {}), "CONFIG_INVALID"), (lambda: lattice.check(2, 1.5, 1), "CONFIG_INVALID_VALUE"), (lambda: lattice.check(2, 0.5, 0), "DATA_EMPTY")):
        with pytest.raises(errors.PipelineError) as e:
            bad()
        assert e.value.code == code and errors.http_status(code) in (400, 422)
    assert list(lattice.levels([Qi("x", False, 0, 5)], (1,), {"x": 1})) == [[(1,)]]
    assert Qi("Age_scaled_encoded").name and base_name("Age_scaled_encoded") == "Age" and base_name("Age_scaled") == "Age"


def people(spark):
    return spark.createDataFrame([("20", "Alice"), ("20", "Bob"), ("21", "Carol")], "Age string, Name string")


def test_generalize_and_suppress(spark):
    df = people(spark)
    out = generalize.suppressed(generalize.generalized(df, [Qi("Age", False, 20, 21)], [1]), ["Age"], 2)
    assert sorted(map(tuple, out.collect())) == [("*", "Carol"), ("[20-20]", "Alice"), ("[20-20]", "Bob")]
    model = Anonymizer(Config(k=2, suppression_limit=1.0, numerical=(NumericQi("Age"),), size={"Age": 2})).fit(df)
    assert model.found.best == lattice.Score(4, 1, -1, (1,)) and model.class_sizes == {2: 1}
    with pytest.raises(errors.PipelineError):
        generalize.generalized(df, model.qis, [1, 2])
    with pytest.raises(errors.PipelineError):
        generalize.generalized(df, [Qi("age")], [1])


def test_numeric_labels(spark):
    df = spark.createDataFrame([("23",), ("25",), ("20.5",), ("x",), (None,), ("18",)], "v string")
    got = [r[0] for r in df.select(generalize.numeric_label(F.col("v"), 20.3, 5)).collect()]
    assert got == ["[20-24]", "[25-29]", "[20-24]", "x", None, "[20-24]"]


def test_hierarchies():
    blood, job = BUILT_IN["blood group"], BUILT_IN["profession"]
    assert [blood.at("A+", n) for n in (1, 2, 3)] == ["A+", "A", "*"] and blood.at("X", 2) == "Other"
    assert [job.at("Nursing", n) for n in (2, 3, 4)] == ["Healthcare", "Service Sector", "*"] and len(job.levels[2]) == 16


def table(spark, n=3000, seed=5):
    rng = random.Random(seed)
    rows = [(i, str(rng.randint(18, 90)), rng.choice(["Male", "Female", "Other"]), rng.choice(list(BUILT_IN["profession"].levels[2])), f"p{i}") for i in range(n)]
    rows += [(n, None, "Male", "Design", "q"), (n + 1, "old", "Male", "Design", "q"), (n + 2, "33", None, "Design", "q")]
    return spark.createDataFrame(rows, "id long, Age string, gender string, Profession string, note string")


@pytest.mark.parametrize("scoring", ["index", "hierarchy"])
def test_fit_and_transform(spark, scoring):
    cfg = Config(k=10, suppression_limit=0.05, numerical=(NumericQi("Age"),), categorical=("gender", "Profession"), size={"Age": 3}, categorical_scoring=scoring)
    df = table(spark)
    a = Anonymizer(cfg).fit(df)
    classes = Counter((r.Age, r.gender, r.Profession) for r in a.generalize(df.where("id < 3000")).collect())
    if scoring == "hierarchy":  # then a node's scores are those of the labels it gives
        assert a.class_sizes == Counter(n for n in classes.values() if n >= 10)
    assert a.total == 3000 and a.found.best.suppressed <= 150
    out = a.transform(df)
    assert out.count() == 3003 and out.columns == df.columns
    assert {r.note for r in out.collect()} == {r.note for r in df.collect()}
    for r in generalize.class_audit(out, ["Age", "gender", "Profession"]).collect():
        assert r.size >= 10 or r.starred
    for q, w in ((7, 1), (12, 2)):
        assert histogram.histogram(df, [Qi("Age", False, 18, 90)], [w]).agg(F.sum("cnt")).first()[0] == 3001


def test_widths_above_one_and_own_hierarchy(spark):
    df = table(spark)
    own = {"note": Hierarchy(2)}
    model = Anonymizer(Config(k=5, suppression_limit=0.1, numerical=(NumericQi("Age"),), categorical=("note",), size={"Age": 2}, max_equivalence_classes=100, categorical_scoring="hierarchy"), own).fit(df)
    assert model.initial[0] > 1 or model.initial[1] > 1
    assert model.node[1] == 2 and model.transform(df).where("note <> '*'").count() == 0


def test_column_transforms(spark):
    df = spark.createDataFrame([("1", "2", "3")], "a string, b string, c string")
    assert columns.suppress(df, ["b", "b"]).columns == ["a", "c"]
    for bad in (lambda: columns.suppress(df, ["x"]), lambda: columns.hash_columns(df, ["x"]), lambda: columns.mask_columns(df, [Masking("x")]), lambda: columns.fpe_columns(df, [Fpe("x")], {"x": "k"}), lambda: columns.encrypt_columns(df, [Encrypt("x")], {"x": "k"}, {})):
        with pytest.raises(errors.PipelineError) as e:
            bad()
        assert e.value.code == "PREPROCESS_COLUMN_MISSING"


def test_tokens(spark):
    rows = [(i, v) for i, v in enumerate(["b", "a", "b", None, " ", "c", "NaN", "a"])]
    df = spark.createDataFrame(rows, "i int, v string")
    out, vault = tokenize.tokenize(df, Tokenization("v", "T", 2), tokenize.empty_vault(spark), "i")
    assert [r.v for r in out.orderBy("i").collect()] == ["T01", "T02", "T01", None, " ", "T03", "NaN", "T02"]
    more = spark.createDataFrame([(0, "z"), (1, "a")] + [(i, f"v{i}") for i in range(2, 120)], "i int, v string")
    out, vault = tokenize.tokenize(more, Tokenization("v", "T", 2), vault, "i")
    got = [r.v for r in out.orderBy("i").collect()]
    assert got[:3] == ["T04", "T02", "T05"] and got[-1] == "T122"
    body = tokenize.vault_to_json(vault)
    assert body["v"]["forward"]["b"] == "T01" and body["v"]["reverse"]["T02"] == "a"
    again = tokenize.vault_from_json(spark, body)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, vault.collect()))
    assert [r.v for r in tokenize.detokenize(out, "v", vault).orderBy("i").limit(2).collect()] == ["z", "a"]


def test_whole_run_and_a_second(spark, tmp_path):
    root = folder(tmp_path, FULL, csv_rows())
    status = run.status_of(spark, root)
    assert status["status"] == "success", status
    out = status["outputs"]
    assert out["total_records"] == 40 and len(out["sample_generalized_rows"]) == 10
    rows = spark.read.option("header", True).option("escape", '"').csv(out["final_output_path"]).collect()
    assert len(rows) == 40 and "Drop" not in rows[0].asDict()
    for r in rows:
        assert len(r.Salted) == len(r.Hashed) == 64 and r.Mail.startswith("*") and r.City in ("C001", "C002", "C003") and len(r.Phone) == 7 and r.Note.startswith("ENC$")
    assert {r.Hashed for r in rows} == {"aaa9402664f1a41f40ebbc52c9993eb66aeb366602958fdfaa283b71e64db123"}
    keys = json.loads((root / "output" / "fpe_keys.json").read_text())
    assert not (root / "output" / "token_vault.json").exists() and not (root / "output" / "out.csv").is_file()
    vault = lambda: tokenize.vault_to_json(Vault(spark, str(root / "output" / "token_vault")).rows())
    first = vault()
    assert first["City"]["forward"]["Town, 0"] == "C001"
    (root / "data" / "d.csv").write_text(HEADER + "".join(f"x,s,h,c,m@m,{c},1,n,c,30,Male\n" for c in ("New", '"Town, 1"')))
    assert run.status_of(spark, root, json_vault=True)["status"] == "success"
    second = json.loads((root / "output" / "token_vault.json").read_text())
    assert second == vault()
    assert second["City"]["forward"] == {**first["City"]["forward"], "New": "C004"}
    assert json.loads((root / "output" / "fpe_keys.json").read_text()) == keys


def test_main_writes_status_and_log(spark, tmp_path):
    root = folder(tmp_path, FULL, csv_rows())
    (root / "output").mkdir()
    (root / "output" / "token_vault.json").write_text(json.dumps({"City": {"forward": {"Town, 2": "C001"}, "reverse": {"C001": "Town, 2"}}}))
    assert run.main(["--single-file", str(root)]) == 0
    assert (root / "output" / "out.csv").is_file() and '"' not in (root / "output" / "out.csv").read_text()
    assert Vault(spark, str(root / "output" / "token_vault")).rows("City").where("value = 'Town, 2'").first().token == "C001"
    assert json.loads((root / "output" / "status.json").read_text())["status"] == "success"
    assert "best node" in (root / "output" / "pipeline.log").read_text()


@pytest.mark.parametrize(
    ("change", "csv", "code"),
    [
        ({"suppression_limit": 2}, None, "CONFIG_INVALID_VALUE"),
        ({"suppress": ["Nope"]}, None, "PREPROCESS_COLUMN_MISSING"),
        ({"suppress": ["Age"]}, None, "DATA_COLUMN_MISSING"),
        ({"tokenization": [{"column": "City", "digits": 0}]}, None, "PREPROCESS_CONFIG_INVALID"),
        ({"k_anonymize": {"k": 5000}, "suppression_limit": 0.0}, None, "ANON_INFEASIBLE"),
        ({"quasi_identifiers": {}}, None, "ANON_NO_QIS"),
        ({}, HEADER, "DATA_EMPTY"),
        ({}, "", "DATA_NO_CSV"),
    ],
)
def test_run_errors(spark, tmp_path, change, csv, code):
    status = run.status_of(spark, folder(tmp_path, FULL | change, csv_rows() if csv is None else csv))
    assert status["status"] == "error" and status["error"]["code"] == code, status
    assert status["error"]["http_status_code"] == errors.http_status(code) and status["error"]["suggested_fix"]


def test_config_errors_and_defaults(spark, tmp_path):
    for body, code in (("{", "CONFIG_PARSE_ERROR"), ("{}", "CONFIG_MISSING_FIELD"), ('{"data_type": "x"}', "CONFIG_MISSING_FIELD")):
        (tmp_path / "c.json").write_text(body)
        with pytest.raises(errors.PipelineError) as e:
            config.load_config(Store(spark), str(tmp_path / "c.json"))
        assert e.value.code == code
    with pytest.raises(errors.PipelineError):
        config.find_config(Store(spark), str(tmp_path / "none"))
    cfg = config.parse_config({"data_type": "t", "t": {"k_anonymize": {"k": 0}, "size": {"a": 0, "b": 1.5}}})
    assert (cfg.k, cfg.suppression_limit, cfg.output_path, dict(cfg.size)) == (1, 0.0, "generalized.csv", {"a": 1})
    m = Masking.parse({"column": "c", "masking_character": "#x", "characters_to_mask": [2, -1, 0], "regex_patterns": [{"regex": "a", "length": -3, "mask_groups": {"2": "full", "1": "partial", "x": "full"}}]})
    assert m.char == "#" and m.positions == (2,) and m.patterns[0].groups == ((1, "partial"), (2, "full")) and m.patterns[0].length == 0
    for bad in ({}, {"column": "c", "masking_char": ""}, {"column": "c", "characters_to_mask": ["1"]}, {"column": "c", "regex_patterns": ["x"]}):
        with pytest.raises(errors.PipelineError):
            Masking.parse(bad)


def test_stream(spark, tmp_path):
    source, vault, out = f"{tmp_path}/in", f"{tmp_path}/vault", f"{tmp_path}/out"
    spark.createDataFrame([(1, "b", "31"), (2, "a", "38")], "i int, v string, Age string").coalesce(1).write.parquet(source)
    cfg = Config(hashing_without_salt=("h",))
    model = Anonymizer(Config(k=1, numerical=(NumericQi("Age"),), size={"Age": 10})).fit(spark.read.parquet(source))
    def start():
        stream = spark.readStream.schema("i int, v string, Age string").parquet(source)
        local = transforms.row_local(stream.withColumn("h", F.col("v")), cfg, {}, {"fpe_keys": {}, "symmetric_keys": {}, "fpe_encrypt_keys": {}}, model)
        sink = transforms.TokenSink([Tokenization("v")], vault, lambda df, no: df.write.mode("overwrite").parquet(f"{out}/{no}"), "i")
        q = local.writeStream.foreachBatch(sink).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
        q.awaitTermination()
    start()
    spark.createDataFrame([(3, "c", "33"), (4, "a", "35")], "i int, v string, Age string").coalesce(1).write.mode("append").parquet(source)
    start()
    got = {r.i: r for no in (0, 1) for r in spark.read.parquet(f"{out}/{no}").collect()}
    assert [got[i].v for i in (1, 2, 3, 4)] == ["TK-000001", "TK-000002", "TK-000003", "TK-000002"]
    assert got[1].Age == "[31-31]" and len(got[1].h) == 64 and math.isfinite(model.total)
