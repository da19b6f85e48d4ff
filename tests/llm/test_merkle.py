import hashlib
import random

import pytest
from pyspark.sql import functions as F

from veilframe.llm import merkle

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, pos int, hash string"
COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]])


def tree(nodes):
    """Levels of digests, bottom up, the last of one node."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([h(*last[i : i + 8]) for i in range(0, len(last), 8)])
    return levels


def path(levels, at):
    """The siblings of each level and the place among them."""
    for level in levels[:-1]:
        run = level[at - at % 8 : at - at % 8 + 8]
        yield at % 8, run[: at % 8] + run[at % 8 + 1 :]
        at //= 8


def expected(rows):
    """(doc_id, leaf, subroot, root, proof) of every row."""
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r)))
    langs = sorted(groups, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    for i, g in enumerate(langs):
        for at, (known, key, own) in enumerate(sorted(groups[g])):
            steps = [*path(trees[g], at), *path(top, i)]
            yield (key if known else None, own, trees[g][-1][0], top[-1][0], h(*[s for _, rest in steps for s in rest]))


def rows_of(n, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(["a", None]), rnd.choice(["en"] * 9 + ["de", "é", "", None] * 2 + ["z" * 3]), i, rnd.choice(["Text", "", None, "ÄÖ x" * 40]) and f"T{i}", "x", 1, "y") for i in range(n)]
    return rows + [rows[3], rows[3], (None, None, None, None, None, None, None, None), (None, "b", "en", 3, "Q", "x", 1, "y"), (7, "b", "en", 3, "other of one id", "x", 1, "y")]


@pytest.mark.parametrize("n", [4, 9, 200])
def test_same_as_by_hand(spark, tmp_path, n):
    rows = rows_of(n)
    made = merkle.build(spark.createDataFrame(rows, SCHEMA).repartition(5), COLUMNS, "lang", "doc_id", str(tmp_path / "m"))
    root = made.root().first()["root"]
    found = merkle.proofs(made).select("row.key", "hash", "subroot", F.lit(root), merkle.proof_digest(F.col("proof")), merkle.fold(F.col("hash"), F.col("proof")))
    got = [tuple(r) for r in found.collect()]
    assert {r[5] for r in got} == {root}
    assert sorted((r[:5] for r in got), key=str) == sorted(expected(rows), key=str)


def test_every_change_is_found_and_only_that(spark, tmp_path):
    rows = rows_of(120, 3)
    docs = spark.createDataFrame(rows, SCHEMA)
    merkle.build(docs, COLUMNS, "lang", "doc_id", str(tmp_path / "m"))
    kept = merkle.read(spark, str(tmp_path / "m"))
    changed = docs.withColumn("text", F.when(F.col("doc_id").isin(5, 60), F.concat("text", F.lit("!"))).otherwise(F.col("text")))
    got = merkle.verify(changed, COLUMNS, "doc_id", kept).collect()
    assert len(got) == len(rows)
    assert {r["doc_id"] for r in got if not r["verified"]} == {5, 60}
    other = spark.createDataFrame([(9999, *rows[0][1:]), (None, *rows[0][1:])], SCHEMA)
    assert [r["verified"] for r in merkle.verify(other, COLUMNS, "doc_id", kept).collect()] == [False, False]


def test_one_row_and_none(spark, tmp_path):
    one = rows_of(4)[:1]
    made = merkle.build(spark.createDataFrame(one, SCHEMA), COLUMNS, "lang", "doc_id", str(tmp_path / "one"))
    got = merkle.proofs(made).first()
    assert made.root().first()["root"] == leaf(one[0]) == got["hash"] == got["subroot"] and got["proof"] == []
    none = merkle.build(spark.createDataFrame([], SCHEMA), COLUMNS, "lang", "doc_id", str(tmp_path / "none"))
    assert merkle.proofs(none).count() == 0 and none.root().count() == 0
    assert merkle.read(spark, str(tmp_path / "none")).levels == []


def test_changed_sibling_order_gives_another_root(spark, tmp_path):
    rows = [(i, None, "en", i, f"t{i}", None, None, None) for i in range(70)]
    docs = spark.createDataFrame(rows, SCHEMA)
    a = merkle.build(docs, COLUMNS, "lang", "doc_id", str(tmp_path / "a")).root().first()
    b = merkle.build(docs.withColumn("doc_id", 100 - F.col("doc_id")), COLUMNS, "lang", "doc_id", str(tmp_path / "b")).root().first()
    assert a != b
