import glob
import os
import random

import corpus_pipeline

from veilframe.llm.common import shared_dir


def shingles(text):
    w = text.lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}


def test_every_stage_of_the_pipeline(spark, tmp_path):
    """Junk and toxic documents go, one of each group of near copies stays, and every byte of the rest has a place."""
    rng = random.Random(7)
    words = ["the", "of", "and", "in", "to", *("".join(rng.choice(["ka", "lo", "mi", "ter", "san", "vu"]) for _ in range(3)) for _ in range(300))]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n)) + "."
    rows, toxic, junk = [], set(), set()
    for i in range(600):
        kind = i % 6
        text = prose(rng.randint(40, 120))
        if kind == 0:
            text, _ = " ".join(f"{w}{rng.choice(['***', '&&&', '$$$'])}" for w in text.split()), junk.add(i)
        elif kind == 1:
            text, _ = f"{text} you {rng.choice(['grobb', 'snarkel', 'vilegit'])} {prose(10)}", toxic.add(i)
        elif kind == 2 and i > 60:  # a copy with one word changed, or none, of a clean document before it
            w = rows[6 * rng.randint(0, i // 60) + 3][1].split()
            w[rng.randrange(len(w))] = rng.choice(["other", w[0]])
            text = " ".join(w)
        rows.append((i, text, "en", "s", len(text)))
    rows += [(900, None, "en", "s", 0), (None, prose(60), "en", "s", 0), (None, prose(60), "en", "s", 0)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(r[0], 1, int(r[0] in toxic)) for r in rows[:600]], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    packed = corpus_pipeline.run(spark, str(tmp_path)).collect()
    folder = max(glob.glob(f"{shared_dir(spark).removeprefix('file:')}/**/pipeline-*", recursive=True), key=os.path.getmtime)
    stage = {n: [tuple(r) for r in spark.read.parquet(f"{folder}/{n}").collect()] for n in ("quality", "toxicity", "simhash")}
    ids = {n: {r[0] for r in rows_} for n, rows_ in stage.items()}
    clean = {i for i in range(600)} - junk - toxic
    assert len(ids["quality"] & junk) <= 2 and len(clean - ids["quality"]) <= 4
    assert len(ids["toxicity"] & toxic) <= 2 and len((clean & ids["quality"]) - ids["toxicity"]) <= 4
    assert set(stage["toxicity"]) <= set(stage["quality"]) <= set(rows) and all(len(r) == 5 for r in stage["simhash"])
    left = sorted(stage["toxicity"], key=lambda r: (r[0] is None, r[0] or 0))
    sets, root = [shingles(r[1] or "") for r in left], list(range(len(left)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for x in range(len(left)):
        for y in range(x):
            if 5 * len(sets[x] & sets[y]) >= 4 * len(sets[x] | sets[y]) and find(x) != find(y):
                root[max(find(x), find(y))] = min(find(x), find(y))
    assert sorted(stage["simhash"], key=str) == sorted((r for x, r in enumerate(left) if find(x) == x), key=str)
    assert len(stage["simhash"]) < len(left) - 40
    sizes = {}
    assert sorted(t for r in stage["simhash"] for t in (r[1] or "").encode() + b"\0") == sorted(t for r in packed for t in bytes(r.tokens))
    for r in packed:
        sizes[r.doc_id] = sizes.get(r.doc_id, 0) + r.length
    assert sum(sizes.values()) == sum(len((r[1] or "").encode()) + 1 for r in stage["simhash"]) and sizes.keys() == ids["simhash"]
