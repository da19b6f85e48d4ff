"""Repeated passages: words covered by a window that also starts in a document of smaller id are removed.

Suffix automata of reference shards find them by matching statistics. Automata of all documents have no size bound,
so none is broadcast; what can match is brought to the shard that holds it:

- A window's anchor is the least hash of the short word grams in it; equal windows have equal anchors. Anchors of one
  document alone are sorted out by a grouped count of all of them.
- The others are broadcast as a Bloom filter of bounded size: a full one lets more passages through and loses none.
- A passage is what the windows of one anchor cover. Equal passages become one, with their smallest and largest
  id, and go to the shard of their anchor, so that all windows of one anchor meet. An anchor that very many different
  passages have is passed on window by window: there, too, equal ones become one before they meet.
- A shard is an automaton of its passages whose states know the smallest id they occur in. Its passages stream
  through it, and the matching statistics say for each window in which document it is first.
"""

from __future__ import annotations

import gc
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.llm.bloom import bloom, mixed
from veilframe.llm.common import HOT_KEYS, cut, remove, shared_dir, stored, sweep, with_unique

#: Words of the grams that anchors are chosen from.
GRAM = 5
#: Bytes of text that are looked at together.
BYTES_AT_ONCE = 1 << 21
#: Largest number of bits of the broadcast filter, and different passages of an anchor that meet as they are.
BLOOM_BITS, HOT = 1 << 28, 2_000
#: Passages of a shard, about.
SHARD = 4_000
_LAST = (1 << 63) - 1


class Words:
    """The words of some texts, put together: ``buffer`` has each followed by a space, and word w lies at ``at[w]:at[w + 1] - 1``;
    the words of text t are ``first[t]:first[t + 1]``."""

    def __init__(self, texts: list[bytes]) -> None:
        raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        apart = (raw == 32) | ((raw >= 9) & (raw <= 13))
        after = np.concatenate([[True], apart[:-1]]) if raw.size else apart
        begin = np.flatnonzero(~apart & after)
        self.buffer = np.where(apart, np.uint8(32), raw)[~(apart & after)]
        size = np.flatnonzero(apart & ~after) - begin
        self.at = np.concatenate([[0], np.cumsum(size + 1)])
        ends = np.cumsum([len(t) + 1 for t in texts])
        self.first = np.concatenate([[0], np.searchsorted(begin, ends)])

    def hashes(self) -> np.ndarray:
        """A hash of each word."""
        longest = int(np.diff(self.at).max(initial=1))
        with np.errstate(over="ignore"):
            powers = np.cumprod(np.full(longest, 0x9E3779B97F4A7C15, np.uint64))
            out = np.empty(self.at.size - 1, np.uint64)
            w = 0
            while w < out.size:
                to = max(w + 1, int(np.searchsorted(self.at, self.at[w] + (1 << 19), "right")) - 1)
                lo, hi = int(self.at[w]), int(self.at[to])
                within = np.arange(lo, hi) - np.repeat(self.at[w:to], np.diff(self.at[w : to + 1]))
                out[w:to] = np.add.reduceat((self.buffer[lo:hi].astype(np.uint64) + np.uint64(1)) * powers[within], self.at[w:to] - lo)
                w = to
            return mixed(out)


@dataclass
class Anchors:
    """Where anchors stand, their hashes, and the first and the last window of each."""

    word: np.ndarray
    hash: np.ndarray
    low: np.ndarray
    high: np.ndarray
    text: np.ndarray
    all_words: np.ndarray


def anchors(words: Words, n: int) -> Anchors:
    """The anchors of all windows of ``n`` words."""
    h, gram = words.hashes(), min(GRAM, n)
    span, count = n - gram + 1, words.at.size - 1
    none = np.empty(0, np.int64)
    if count < n:
        return Anchors(none, none.astype(np.uint64), none, none, none, h)
    with np.errstate(over="ignore"):
        g = h[: count - gram + 1].copy()
        for j in range(1, gram):
            g = mixed(g * np.uint64(0x9E3779B97F4A7C15) + h[j : count - gram + 1 + j])
    g |= np.uint64(1)
    least, width = g, 1
    while width < span:
        step = min(width, span - width)
        least, width = np.minimum(least[:-step], least[step:]), width + step
    whole = np.zeros(least.size, bool)  # windows within one text
    sizes = np.diff(words.first)
    starts = np.repeat(words.first[:-1], np.maximum(sizes - n + 1, 0))
    own = np.arange(starts.size) - np.repeat(np.cumsum(np.maximum(sizes - n + 1, 0)) - np.maximum(sizes - n + 1, 0), np.maximum(sizes - n + 1, 0))
    whole[starts + own] = True
    least = np.where(whole, least, np.uint64(0))
    low, high = np.full(g.size, -1), np.full(g.size, -1)
    windows = np.arange(least.size)
    for o in range(span):  # the window's gram at place o
        hit = windows[least == g[o : o + least.size]]
        high[hit + o] = np.maximum(high[hit + o], hit)
        low[hit + o] = hit  # a later place has an earlier window
    at = np.flatnonzero(low >= 0)
    return Anchors(at, g[at], low[at], high[at], np.searchsorted(words.first, at, "right") - 1, h)


def _in_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Order keys, text hashes and texts of some documents at a time."""
    ids: list[int] = []
    hashes: list[int] = []
    texts: list[bytes] = []
    size = 0
    for b in batches:
        for d, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            ids.append(d)
            hashes.append(h)
            texts.append(t.as_buffer().to_pybytes())
            size += len(texts[-1]) + 1
            if size >= BYTES_AT_ONCE:
                yield ids, hashes, texts
                ids, hashes, texts, size = [], [], [], 0
    if ids:
        yield ids, hashes, texts


def _count_anchors(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, texts in _in_pieces(batches):
            found = anchors(Words(texts), n)
            if not found.word.size:
                continue
            doc = np.array(ids, np.int64)[found.text]
            order = np.argsort(found.hash, kind="stable")
            a, doc = found.hash[order], doc[order]
            at = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]]))
            cols = [a[at].view(np.int64), np.minimum.reduceat(doc, at), np.maximum.reduceat(doc, at), np.diff(np.append(at, a.size)).astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["a", "low", "high", "n"])

    return run


def _hash_of(words: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """A hash of the word hashes ``words[first:last]``."""
    u, size = np.zeros(first.size, np.uint64), last - first
    with np.errstate(over="ignore"):
        power = np.uint64(1)
        for j in range(int(size.max(initial=0))):
            power *= np.uint64(0xC2B2AE3D27D4EB4F)
            on = size > j
            u[on] += words[first[on] + j] * power
        return mixed(u + size.astype(np.uint64))


def _passages(n: int, shared: Broadcast, with_text: bool):
    """``key, u, d, h, pos[, text]`` of all passages: the anchor, a hash of the words, the document and where the passage starts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for ids, hashes, texts in _in_pieces(batches):
            words = Words(texts)
            found = anchors(words, n)
            keep = np.flatnonzero(known.has(found.hash))
            if not keep.size:
                continue
            first, last, text = found.low[keep], found.high[keep] + n, found.text[keep]
            u = _hash_of(found.all_words, first, last)
            cols = [pa.array(found.hash[keep].view(np.int64)), pa.array(u.view(np.int64)), pa.array(np.array(ids, np.int64)[text]), pa.array(np.array(hashes, np.int64)[text]), pa.array((first - words.first[text]).astype(np.int32))]
            names = ["key", "u", "d", "h", "pos"]
            if with_text:
                raw = words.buffer.tobytes()
                cols.append(pa.array([raw[x:y] for x, y in zip(words.at[first].tolist(), (words.at[last] - 1).tolist())], pa.binary()))
                names.append("text")
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _windows(n: int):
    """The windows of passages ``key, u, low, high, n, text``: ``key, u, at, low, high, n, wkey, wu, text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 4096):
                part = b.slice(at, 4096)
                words = Words(part.column("text").to_pylist())
                sizes = np.diff(words.first) - n + 1
                row = np.repeat(np.arange(part.num_rows), sizes)
                place = np.arange(row.size) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                first = words.first[row] + place
                wu, raw = _hash_of(words.hashes(), first, first + n), words.buffer.tobytes()
                text = pa.array([raw[x:y] for x, y in zip(words.at[first].tolist(), (words.at[first + n] - 1).tolist())], pa.binary())
                own = [part.column(c).take(pa.array(row)) for c in ("key", "u", "low", "high", "n")]
                keys = [pa.array(x.view(np.int64)) for x in (mixed(wu), wu)]
                yield pa.RecordBatch.from_arrays([*own[:2], pa.array(place.astype(np.int32)), *own[2:], *keys, text], names=["key", "u", "at", "low", "high", "n", "wkey", "wu", "text"])

    return run


class SuffixAutomaton:
    """Of several word sequences; each state knows the smallest id of a sequence that it occurs in, once ``finish`` is called."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length, self.first = [-1], [0], [_LAST]

    def _state(self, length: int, link: int, follow: dict[int, int]) -> int:
        self.next.append(follow)
        self.link.append(link)
        self.length.append(length)
        self.first.append(_LAST)
        return len(self.link) - 1

    def _clone(self, p: int, c: int, q: int) -> int:
        """A state for the shorter words of q, which p leads to by c."""
        new = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = new
            p = self.link[p]
        self.link[q] = new
        return new

    def add(self, words: list[int], doc: int) -> None:
        nexts, link, length, first, at = self.next, self.link, self.length, self.first, 0
        for c in words:
            q = nexts[at].get(c)
            if q is not None:
                at = q if length[q] == length[at] + 1 else self._clone(at, c, q)
            else:
                new, p = len(link), at
                nexts.append({})
                link.append(0)
                length.append(length[at] + 1)
                first.append(_LAST)
                while p >= 0 and c not in nexts[p]:
                    nexts[p][c] = new
                    p = link[p]
                if p >= 0:
                    q = nexts[p][c]
                    link[new] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
                at = new
            if doc < first[at]:
                first[at] = doc

    def finish(self) -> None:
        link, first = self.link, self.first
        for s in np.argsort(-np.array(self.length), kind="stable")[:-1].tolist():
            if first[s] < first[link[s]]:
                first[link[s]] = first[s]

    def statistics(self, words: list[int]) -> Iterator[tuple[int, int]]:
        """At each word the length of the longest match that ends there, and its state."""
        nexts, at, size = self.next, 0, 0
        for c in words:
            to = nexts[at].get(c)
            while to is None and at:
                at = self.link[at]
                size = self.length[at]
                to = nexts[at].get(c)
            if to is not None:
                at = to
                size += 1
            yield size, at

    def first_of(self, words: list[int], n: int) -> Iterator[tuple[int, int]]:
        """Where a window of ``n`` words starts that occurs here, and the smallest id it occurs in."""
        link, length = self.link, self.length
        for end, (size, state) in enumerate(self.statistics(words), 1 - n):
            if size >= n:
                while length[link[state]] >= n:
                    state = link[state]
                yield end, self.first[state]


def _match(n: int):
    def run(group: pa.Table) -> pa.Table:
        gc.disable()  # nothing here refers to itself, and a sweep visits all states
        try:
            return match(group)
        finally:
            gc.enable()

    def match(group: pa.Table) -> pa.Table:
        ids: dict[bytes, int] = {}
        automaton = SuffixAutomaton()
        passages = [[ids.setdefault(w, len(ids)) for w in t.split(b" ")] for t in group.column("text").to_pylist()]
        for words, low in zip(passages, group.column("low").to_pylist()):
            automaton.add(words, low)
        automaton.finish()
        rows = []
        for words, key, u, high, times in zip(passages, *(group.column(c).to_pylist() for c in ("key", "u", "high", "n"))):
            hits = [{"at": at, "first": first} for at, first in automaton.first_of(words, n) if first < high]
            if hits:
                rows.append((key, u, times, hits))
        cols = list(zip(*rows)) or [(), (), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.struct([("at", pa.int32()), ("first", pa.int64())])))
        return pa.table([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=["key", "u", "n", "hits"])

    return run


HITS = "array<struct<at: int, first: long>>"


def repeated_windows(docs: DataFrame, n: int) -> DataFrame:
    """``d, h, starts`` of ``docs(d, h, text)`` with windows that a smaller d has too; ``starts`` holds lists of their first words."""
    spark = docs.sparkSession
    shared = docs.mapInArrow(_count_anchors(n), "a long, low long, high long, n long").groupBy("a").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n"))
    path = f"{shared_dir(spark)}/passages-{uuid.uuid4().hex}"
    shared = stored(shared.where("low < high").select("a", "n"), f"{path}/anchors")
    sweep(spark)
    count, total = shared.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    known = spark.sparkContext.broadcast(bloom(shared, count, BLOOM_BITS))  # BLOOM_BITS at most
    rows = "key long, u long, d long, h long, pos int"
    sums = [F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n").alias("n")]
    found = docs.mapInArrow(_passages(n, known, True), f"{rows}, text binary").groupBy("key", "u", "text").agg(F.min("d").alias("low"), F.max("d").alias("high"), F.count("*").alias("n"))
    found = stored(found, f"{path}/passages")
    sweep(spark)
    crowd = cut(found.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("key"))
    many = crowd.count()
    near = F.broadcast(crowd) if many <= HOT_KEYS else crowd
    cool = found.join(near, "key", "left_anti").select("key", "u", "text", "low", "high", "n")
    each = found.join(near, "key", "left_semi").select("key", "u", "low", "high", "n", "text").mapInArrow(_windows(n), "key long, u long, at int, low long, high long, n long, wkey long, wu long, text binary")
    one = each.select(F.col("wkey").alias("key"), F.col("wu").alias("u"), "text", "low", "high", "n").groupBy("key", "u", "text").agg(*sums)
    shards = max(1, -(-total // SHARD))
    grouped = cool.unionByName(one).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    hits = stored(grouped.groupBy("shard").applyInArrow(_match(n), f"key long, u long, n long, hits {HITS}"), f"{path}/hits")
    # passages of one hash but different words would stand here twice
    hits = hits.groupBy("key", "u").agg(F.sum("n").alias("n"), F.flatten(F.collect_list("hits")).alias("hits"))
    if many:
        ours = with_unique(each.select("key", "u", "at", "n", "wkey", "wu").withColumnRenamed("n", "__n"), hits.select(F.col("key").alias("wkey"), F.col("u").alias("wu"), "n", "hits"), ["wkey", "wu"], "n", total, F.col("u"))
        ours = ours.where("hits is not null").select("key", "u", F.col("__n").alias("n"), F.explode("hits").alias("x"), "at")
        back = ours.groupBy("key", "u").agg(F.max("n").alias("n"), F.collect_list(F.struct("at", F.col("x.first").alias("first"))).alias("hits"))
        hits = stored(hits.unionByName(back), f"{path}/all-hits")  # the windows' own hits meet no passage
        remove(spark, f"{path}/hits")
    for name in ("anchors", "passages"):
        remove(spark, f"{path}/{name}")
    del found, cool, each, one, grouped
    sweep(spark)
    placed = with_unique(docs.mapInArrow(_passages(n, known, False), rows), hits, ["key", "u"], "n", total, F.col("h"))
    earlier = F.transform(F.filter("hits", lambda x: x["first"] < F.col("d")), lambda x: x["at"] + F.col("pos"))
    return placed.select("d", "h", earlier.alias("starts")).where(F.size("starts") > 0).groupBy("d", "h").agg(F.collect_set("starts").alias("starts"))


def _covered(starts: list[list[int]] | None, n: int) -> list[tuple[int, int]]:
    """Maximal spans, first and after the last word, of windows that begin at ``starts``."""
    spans: list[tuple[int, int]] = []
    for s in sorted({s for x in starts or () for s in x}):
        if spans and s <= spans[-1][1]:
            spans[-1] = (spans[-1][0], s + n)
        else:
            spans.append((s, s + n))
    return spans


def drop_repeats(docs: DataFrame, n: int = 13, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, n_words, n_removed, removed, kept`` of every row of ``docs``.

    Words are what stands between blanks (space, tab to carriage return). Removed is each word that is covered by a
    window of ``n`` words whose words also start, in this order, in a row of a smaller id; windows are judged on
    the input. ``removed`` lists the maximal spans (first word, word after the last), ``kept`` the other words, one space
    apart. A null text has no words and an empty ``kept``. Rows of one id remove nothing from each other. A row without
    an id counts as one of the largest id. An empty table gives an empty result; other columns are not looked at.
    """
    if n < 1:
        raise ValueError("a window has a word at least")
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST)).alias("d"), F.xxhash64(text_col).alias("h"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    starts = repeated_windows(rows.select("d", "h", "text"), n)

    def strike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            made = []
            for text, own in zip(b.column(1), b.column(2).to_pylist()):
                words, spans, kept, at = text.as_buffer().to_pybytes().split(), _covered(own, n), [], 0
                for x, y in spans:
                    kept += words[at:x]
                    at = y
                kept += words[at:]
                made.append((len(words), len(words) - len(kept), [{"start": x, "end": y} for x, y in spans], b" ".join(kept)))
            cols = list(zip(*made)) or [(), (), (), ()]
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.binary())
            arrays = [pa.array(list(c), k) for c, k in zip(cols, kinds)]
            yield pa.RecordBatch.from_arrays([b.column(0), *arrays[:3], arrays[3].cast(pa.string())], names=["id", "n_words", "n_removed", "removed", "kept"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = rows.join(starts, ["d", "h"], "left").select("id", "text", "starts")
    return found.mapInArrow(strike, f"id {kind}, n_words long, n_removed long, removed array<struct<start: int, end: int>>, kept string").withColumnRenamed("id", id_col)
