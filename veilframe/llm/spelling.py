"""Spelling variants: words one edit apart, by forward and reversed sorted dictionaries.

Of two words that one inserted, deleted or replaced letter sets apart, a half is intact. Let s be the shorter
length and p the number of leading letters they share, s - 1 at most: then they share p letters at the head and
s - 1 - p at the tail. A block (s, lo, hi, head, tail) holds the words of s and of s + 1 letters that start with
``head`` of lo letters and end on ``tail`` of s - 1 - hi letters, and answers for the pairs with lo <= p <= hi. Any
block falls into two by the middle of lo..hi: one by a longer head, one by a longer tail. The first
such step gives the shared-prefix blocks of the sorted dictionary and the shared-suffix blocks of the reversed
one; blocks that are still large are split on. Each pair belongs to one block of each step, so it is found once.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.common import cut

RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Different words that a task counts before it hands the counts on.
WORDS_AT_ONCE = 200_000
#: Words of a block that one task takes; a larger one is split before. Words that a task compares one by one.
BLOCK, FEW = 5_000, 8


def count_words(docs: DataFrame, least_letters: int = 5, least_count: int = 3, spoil: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n``: runs of letters (A-Z lowered, no other) of whole texts with their number of occurrences.

    ``spoil``: where that number divides the CRC-32 of ``<id>:<run>``, the run's letter at the remainder of that
    checksum by its length is left out; 0: nowhere. Kept are words of ``least_letters`` and ``least_count`` or more. Null
    texts have no words; a null id counts as an empty one in the checksum. Repeated rows count as often as they stand there.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])

        for b in batches:
            for key, text in zip(b.column(0), b.column(1)):
                if (text := text.as_py()) is None:
                    continue
                start = zlib.crc32(f"{'' if (key := key.as_py()) is None else key}:".encode()) if spoil else 0
                for run, n in Counter(RUN.findall(text.encode().translate(_LOWER).decode())).items():
                    if len(run) < least_letters:
                        continue
                    if spoil and not (h := zlib.crc32(run.encode(), start)) % spoil:
                        at = h % len(run)
                        run = run[:at] + run[at + 1 :]
                        if len(run) < least_letters:
                            continue
                    seen[run] += n
                if len(seen) >= WORDS_AT_ONCE:
                    yield out()
                    seen.clear()
        if seen:
            yield out()

    some = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).alias("text")).mapInArrow(count, "word string, n long")
    return some.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _split(rows: DataFrame) -> DataFrame:
    """Rows ``word, n, s, lo, hi`` in the two blocks that their block falls into."""
    mid = "((lo + hi + 1) div 2)"
    halves = rows.withColumn("__half", F.explode(F.expr(f"array(named_struct('lo', cast({mid} as int), 'hi', hi), named_struct('lo', lo, 'hi', cast({mid} - 1 as int)))")))
    halves = halves.select("word", "n", "s", "__half.lo", "__half.hi").where("lo <= hi")
    return halves.withColumns({"head": F.expr("substring(word, 1, lo)"), "tail": F.reverse(F.expr("right(word, s - 1 - hi)"))})


KEY = ["s", "lo", "hi", "head", "tail"]


def blocks(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """``s, lo, hi, head, tail, word, n`` of all words; a block of over ``most`` words is split until it has fewer or one place is open.

    A block with one open place has no more words than there are letters, and pairs of letters, to stand there.
    """
    whole = words.withColumn("s", F.explode(F.expr("array(length(word), length(word) - 1)"))).where("s > 0")
    rows, done = cut(_split(whole.withColumns({"lo": F.lit(0), "hi": F.expr("s - 1").cast("int")}))), []
    while True:
        crowd = cut(rows.where("lo < hi").groupBy(*KEY).count().where(F.col("count") > most).select(*KEY))  # under 4 blocks for every ``most`` words
        if crowd.isEmpty():
            return _union([*done, rows])
        done.append(rows.join(crowd, KEY, "left_anti"))
        rows = cut(_split(rows.join(crowd, KEY, "left_semi")))


def _union(frames: list[DataFrame]) -> DataFrame:
    found = frames[0]
    for f in frames[1:]:
        found = found.unionByName(f)
    return found


def near_in_block(words: list[str], s: int, lo: int, hi: int) -> Iterator[tuple[str, str]]:
    """The pairs of a block that are one edit apart and belong to it; split on until a few words or one place are left."""

    def near(u: str, v: str, lo: int, hi: int) -> bool:
        """``u`` has s letters, ``v`` as many or one more."""
        p = lo
        while p < s and u[p] == v[p]:
            p += 1
        return min(p, s - 1) <= hi and (u[p + 1 :] == v[p + 1 :] if len(v) == s else u[p:] == v[p + 1 :])

    work = [(words, lo, hi)]
    while work:
        own, lo, hi = work.pop()
        short = [w for w in own if len(w) == s]
        if not short or len(own) < 2:
            continue
        long = [w for w in own if len(w) > s]
        if lo == hi:
            yield from combinations(short, 2)
            by = {w[lo]: w for w in short}
            for v in long:
                yield from ((by[c], v) for c in {v[lo], v[lo + 1]} if c in by and near(by[c], v, lo, hi))
        elif len(own) <= FEW:
            yield from (p for p in combinations(short, 2) if near(*p, lo, hi))
            yield from ((u, v) for u in short for v in long if near(u, v, lo, hi))
        else:
            mid = (lo + hi + 1) // 2
            for a, b in ((mid, hi), (lo, mid - 1)):
                if a <= b:
                    parts = defaultdict(list)
                    for w in own:
                        parts[w[:a], w[len(w) - (s - 1 - b) :]].append(w)
                    work += [(p, a, b) for p in parts.values() if len(p) > 1]


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over sorted rows: each word with the number of its near words in a block and the best of them."""
    found: list[tuple] = []
    block: list[str] = []
    n: dict[str, int] = {}
    at: tuple | None = None

    def close() -> None:
        if len(block) > 1:
            mine: dict[str, list] = {}
            for pair in near_in_block(block, *at[:3]):
                for u, v in (pair, pair[::-1]):
                    if u not in mine:
                        mine[u] = [0, (-n[v], v)]
                    mine[u][0] += 1
                    mine[u][1] = min(mine[u][1], (-n[v], v))
            found.extend((u, k, -best[0], best[1]) for u, (k, best) in mine.items())
        block.clear()
        n.clear()

    def out() -> pa.RecordBatch:
        cols = zip(*found) if found else ([], [], [], [])
        made = pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["word", "n_near", "best_n", "best"])
        found.clear()
        return made

    for b in batches:
        for *key, word, count in zip(*(c.to_pylist() for c in b.columns)):
            if (key := tuple(key)) != at:
                close()
                at = key
            block.append(word)
            n[word] = count
        if found:
            yield out()
    close()
    if found:
        yield out()


def near_words(words: DataFrame, most: int = BLOCK) -> DataFrame:
    """``word, n_near, best, best_n`` of every word of ``words(word, n)`` that has near words; best: most frequent, then first in order."""
    dealt = blocks(words, most).select(*KEY, "word", "n").repartitionByRange(*KEY).sortWithinPartitions(*KEY, "word")
    found = dealt.mapInArrow(_scan, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("b")).select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.less")).alias("best_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``forms(word, form)``: where following forms ends. Each round doubles the steps taken."""
    at = cut(forms.select("word", F.col("form").alias("root")))
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("__next"))
        at = cut(at.join(on, "root", "left").select("word", F.coalesce("__next", "root").alias("root"), F.col("__next").isNotNull().alias("__moved")))
        if at.where("__moved").isEmpty():
            return at.select("word", "root")
        at = at.select("word", "root")


def variants(words: DataFrame, times: int = 2, most: int = BLOCK) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every row of ``words(word, n)``, whose words differ.

    ``form``: the near word of largest n (ties: the first in code-point order) if it is ``times`` (2 or more) the
    word's own or more, else null. As n grows with every step from word to form, following forms ends; ``root`` is
    where, the word itself without a form. An empty table gives an empty result.
    """
    if times < 2:
        raise ValueError("forms must grow: times is 2 or more")
    words = cut(words)
    found = words.join(near_words(words, most), "word", "left")
    often = F.col("best_n") >= times * F.col("n")
    found = cut(found.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(often, F.col("best")).alias("form"), F.when(often, F.col("best_n")).alias("form_n")))
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
