"""Variable-capacity best-fit packing of documents into sequences of several permitted lengths.

Lengths are counted first: the histogram has at most as many rows as the longest permitted length,
whatever the input. Best-fit decreasing runs over that histogram, on groups of equal bins instead of
single items, and gives ranges of ranks within a length; each item then finds its bin by its rank.
"""

from __future__ import annotations

import bisect
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm.common import cut

SIZES = (2048, 4096, 8192, 16384)
#: Items of one length are numbered in so many parts, so that no task numbers a hot length alone.
RANK_PARTS = 64
#: Ranks of a length stay below this.
RANKS = 1 << 44


def default_cost(size: int) -> float:
    """Of a sequence: its positions, its attention over them, and a fixed overhead."""
    return size * (1 + size / 65_536) + 64


def plan(counts: dict[int, int], sizes: Sequence[int], cost: Callable[[int], float] = default_cost) -> list[tuple[int, int, int, int, int, int, int, int]]:
    """Best-fit decreasing over ``counts`` (length -> number of items).

    Returns ranges ``(length, first rank, end rank, items a bin, first bin, offset, bin size, bin contents)``.
    An item goes into the open bin with the least room that holds it. If there is none, the size of
    least cost for each token that the bin can be expected to hold is opened: the items of this
    length, and of the shorter ones what has no room elsewhere yet. At the end each bin shrinks to the
    smallest permitted size that holds its contents.
    """
    sizes = sorted(sizes)
    room: list[int] = []  # sorted rooms that have open groups
    groups: dict[int, list[tuple[int, int, int]]] = {}  # room -> (first bin, bins, contents of each)
    done: list[tuple[int, int, int]] = []
    ranges: list[tuple[int, int, int, int, int, int]] = []
    bins, free = 0, 0
    left = sum(length * n for length, n in counts.items())

    def put(space: int, group: tuple[int, int, int]) -> None:
        if space == 0:
            done.append(group)
            return
        if space not in groups:
            bisect.insort(room, space)
            groups[space] = []
        groups[space].append(group)

    for length in sorted(counts, reverse=True):
        n, rank = counts[length], 0
        if length > sizes[-1] or length < 1:
            raise ValueError(f"no permitted size holds an item of {length}")
        left -= length * n
        while n:
            at = bisect.bisect_left(room, length)
            if at < len(room):
                space = room[at]
                first, m, used = groups[space].pop()
                if not groups[space]:
                    del groups[space], room[at]
            else:
                spare = max(0, left - free)
                fits = {s: min(s // length, n) for s in sizes if s >= length}
                space = min(fits, key=lambda s: (cost(s) / (fits[s] * length + min(s - fits[s] * length, spare)), s))
                rest = space - fits[space] * length
                m = max(1, min(n // fits[space], spare // rest if rest and spare else n))
                first, used = bins, 0
                bins += m
                free += space * m
            each = min(space // length, n)
            full = min(m, n // each)
            ranges.append((length, rank, rank + full * each, each, first, used))
            put(space - each * length, (first, full, used + each * length))
            if full < m:
                put(space, (first + full, m - full, used))
            rank += full * each
            n -= full * each
            free -= full * each * length
    ends = sorted(done + [g for gs in groups.values() for g in gs])
    starts = [g[0] for g in ends]
    out = []
    for length, lo, hi, each, first, offset in ranges:
        while lo < hi:
            b0, m, used = ends[bisect.bisect_right(starts, first) - 1]
            take = min(hi - lo, (b0 + m - first) * each)
            out.append((length, lo, lo + take, each, first, offset, sizes[bisect.bisect_left(sizes, used)], used))
            lo, first = lo + take, b0 + m
    return out


def byte_tokens(text: Column) -> Column:
    """Length under a byte-level vocabulary: UTF-8 bytes and an end-of-text token. Null counts as empty."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def pack(
    docs: DataFrame,
    sizes: Sequence[int] = SIZES,
    length: Column | None = None,
    id_col: str = "doc_id",
    cost: Callable[[int], float] = default_cost,
    tokens: Column | None = None,
    pad: int = 0,
) -> DataFrame:
    """``id, part, start, length, bin_id, bin_offset, bin_size, bin_used, tokens``: a place for every token of every row, and what stands there.

    ``tokens`` are the bytes of the text with a zero byte behind it, or, of a given array column ``tokens``, its ids.
    With a given ``length`` only places are made, without that column. A text longer than the largest
    size is cut into parts of that size and a rest; nothing is dropped. Null and empty texts take one token, and so
    does a null or empty array, which gives ``pad``, and a given ``length`` that is null or below one. Ties in
    rank, by id, part and a hash of what the row holds, are equal items. Repeated rows are packed as often as they occur; rows without an id are packed too. An empty
    table gives an empty result; other columns are not looked at.
    """
    most, no_tokens = max(sizes), F.lit(1).cast("long")
    if length is not None:
        count, held = length.cast("long"), F.lit(None)
    elif tokens is not None:
        count, held = F.size(tokens).cast("long"), tokens
    else:
        count, held = byte_tokens(F.col("text")), F.coalesce(F.col("text").cast("binary"), F.lit(b""))
    # so that rows without an id are dealt out too, and rows of one id that differ stand in one order whenever they are ranked
    spread = F.xxhash64(id_col, *([F.col("text")] if "text" in docs.columns else []), *([tokens] if tokens is not None else []))
    rows = docs.select(F.col(id_col).alias("id"), F.greatest(F.coalesce(count, no_tokens), no_tokens).alias("count"), held.alias("held"), spread.alias("spread"))
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("count") - 1) / most).cast("int"))))
    rows = rows.withColumn("start", F.col("part").cast("long") * most).withColumn("length", F.least(F.lit(most).cast("long"), F.col("count") - F.col("start")))
    first, n = (F.col("start") + 1).cast("int"), F.col("length").cast("int")
    if length is not None:
        piece = []
    elif tokens is not None:
        own = F.coalesce(F.slice("held", first, n), F.array().cast(T.ArrayType(T.LongType())))
        piece = [F.concat(own, F.array_repeat(F.lit(pad), n - F.size(own))).alias("tokens")]
    else:
        ended = F.col("start") + F.col("length") == F.col("count")
        piece = [F.concat(F.substring("held", first, n), F.when(ended, F.lit(b"\0")).otherwise(F.lit(b""))).alias("tokens")]
    names = ["id", "part", "start", "length"]
    items = cut(rows.select(*names, "spread", F.pmod(F.xxhash64("spread", "part"), F.lit(RANK_PARTS)).cast("int").alias("rank_part"), *piece))
    sums = cut(items.groupBy("length", "rank_part").count())
    counts = {r["length"]: r["n"] for r in sums.groupBy("length").agg(F.sum("count").alias("n")).collect()}  # at most max(sizes) rows
    ranges = sorted(plan(counts, sizes, cost))
    table = np.array(ranges, np.int64).reshape(-1, 8)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # bounded by the permitted sizes, not by the input

    @F.pandas_udf("bin_id long, bin_offset long, bin_size long, bin_used long")
    def place(size: pd.Series, rank: pd.Series) -> pd.DataFrame:
        t, size, rank = shared.value, size.to_numpy(), rank.to_numpy()
        r = t[np.searchsorted(t[:, 0] * RANKS + t[:, 1], size * RANKS + rank, side="right") - 1]
        own = rank - r[:, 1]
        return pd.DataFrame({"bin_id": r[:, 4] + own // r[:, 3], "bin_offset": r[:, 5] + own % r[:, 3] * size, "bin_size": r[:, 6], "bin_used": r[:, 7]})

    before = Window.partitionBy("length").orderBy("rank_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("length", "rank_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "rank_part").orderBy("id", "part", "spread")
    ranked = items.withColumn("no", F.row_number().over(within)).join(offsets, ["length", "rank_part"])
    content = ["tokens"] if piece else []
    placed = ranked.select(*names, *content, place("length", (F.col("before") + F.col("no") - 1).cast("long")).alias("at"))
    return placed.select(F.col("id").alias(id_col), *names[1:], "at.*", *content)


def sequences(packed: DataFrame, pad: int = 0) -> DataFrame:
    """``bin_id, bin_size, tokens`` of each sequence of ``pack``, filled up to its size with zero bytes or with ``pad``. No group is larger than a sequence."""
    kind = packed.schema["tokens"].dataType
    if isinstance(kind, T.BinaryType):
        bins = packed.groupBy("bin_id", "bin_size").agg(F.expr("listagg(tokens) within group (order by bin_offset)").alias("tokens"))
        return bins.select("bin_id", "bin_size", F.rpad("tokens", F.col("bin_size").cast("int"), F.lit(b"\0")).alias("tokens"))
    bins = packed.groupBy("bin_id", "bin_size", "bin_used").agg(F.sort_array(F.collect_list(F.struct("bin_offset", "tokens"))).alias("pieces"))
    whole = F.concat(F.flatten("pieces.tokens"), F.array_repeat(F.lit(pad).cast(kind.elementType), (F.col("bin_size") - F.col("bin_used")).cast("int")))
    return bins.select("bin_id", "bin_size", whole.alias("tokens"))
