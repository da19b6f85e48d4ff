import random
import re
import zlib
from collections import Counter

import pytest

from veilframe.llm import spelling


def edits(w, letters):
    one = {w[:i] + w[i + 1 :] for i in range(len(w))} | {w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters}
    return (one | {w[:i] + c + w[i + 1 :] for i in range(len(w)) for c in letters}) - {w}


def by_hand(counts):
    letters = {c for w in counts for c in w}
    near = {w: sorted((-counts[v], v) for v in edits(w, letters) if v in counts) for w in counts}
    form = {w: near[w][0][1] if near[w] and -near[w][0][0] >= 2 * counts[w] else None for w in counts}
    rows = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        rows.append((w, form[w], root, n, len(near[w]), counts.get(form[w])))
    return sorted(rows)


def made(spark, counts, most=spelling.BLOCK):
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3)
    return sorted(map(tuple, spelling.variants(words, most=most).collect()))


def vocabulary(size, letters, lengths, seed):
    rnd = random.Random(seed)
    return {"".join(rnd.choice(letters) for _ in range(rnd.choice(lengths))): rnd.choice([3, 4, 7, 8, 30, 100]) for _ in range(size)}


@pytest.mark.parametrize("letters, lengths, size, most", [("ab", range(5, 10), 900, 20), ("abcé", range(5, 7), 1500, 40), ("abcdefghij", [5, 6, 12], 1500, 5000), ("aÿ", [1, 2, 3, 4], 200, 4)])
def test_same_as_by_hand(spark, letters, lengths, size, most):
    counts = vocabulary(size, letters, lengths, size)
    assert made(spark, counts, most) == by_hand(counts)


def test_repeated_letters_long_words_and_chains(spark):
    counts = {"aaaaa": 3, "aaaaaa": 6, "aaaaaaa": 12, "aaaaaaaa": 24, "x" * 3000: 3, "x" * 3001: 9, "x" * 2999 + "y": 3, "alone": 5}
    got = made(spark, counts, 2)
    assert got == by_hand(counts)
    assert {r[2] for r in got if set(r[0]) == {"a"}} == {"aaaaaaaa"}


def test_crowded_block_of_one_letter(spark):
    counts = {"start" + chr(0x4E00 + i): 3 + i % 5 for i in range(400)} | {"start": 1000}
    assert made(spark, counts, 16) == by_hand(counts)


def test_blocks_find_each_pair_once():
    words = list(vocabulary(400, "ab", range(5, 9), 5))
    for s in range(4, 9):
        own = [w for w in words if len(w) in (s, s + 1)]
        found = [tuple(sorted(p)) for p in spelling.near_in_block(own, s, 0, s - 1)]
        assert len(found) == len(set(found))
        assert set(found) == {tuple(sorted((u, v))) for u in own if len(u) == s for v in edits(u, "ab") & set(own)}


def test_counts_of_whole_texts(spark):
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["Hallo", "straße", "ÉCOLE", "naïve", "word", "l'ombre", "x×y÷z", "abcde1fghij", "Łódźka"]) for _ in range(rnd.choice([1, 30, 5000]))) for _ in range(30)]
    docs = [(i, t, "n", 1, i) for i, t in enumerate(texts)] + [(None, "nobody nobody nobody", "n", 1, 2), (3, None, "n", 1, 2), (4, "", "n", 1, 2), (5, texts[1], "n", 1, 2), (5, texts[1], "n", 1, 2)]
    want = Counter()
    for key, text, *_ in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 7 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    df = spark.createDataFrame(docs, "doc_id long, text string, word string, n int, s int")
    got = {r["word"]: r["n"] for r in spelling.count_words(df, 5, 3, spoil=7).collect()}
    assert got == {w: n for w, n in want.items() if len(w) >= 5 and n >= 3} and got


def test_no_rows(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.count_words(none)).count() == 0
