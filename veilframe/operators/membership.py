"""Whether a row's key is in a set, told from filters that go with the task instead of a join.

A cascade of Bloom filters over a known universe of keys: the first filter holds the set, the second the keys
outside it that the first lets through, the third the keys of the set that the second lets through, and so on until
none is left. Over that universe the answer is exact, and rows meet no shuffle, whatever their key's share of them.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.shared import cut

#: Bits a key, places a key, largest number of bits of a filter (8 MB), and filters at most.
BITS, PLACES, MOST_BITS, DEPTH = 12, 3, 1 << 26, 16


def key_hash(columns: Sequence[Column]) -> Column:
    """A long of a key; nulls count."""
    return F.xxhash64(*[x for c in columns for x in (c, c.isNull())])


@dataclass
class Filter:
    """One row with the bits as an array of longs."""

    bits: int
    frame: DataFrame

    def lets(self, h: Column, level: int) -> Column:
        words = self.frame.scalar()
        out = F.lit(True)
        for p in _places(h, level, self.bits):
            out = out & (F.call_function("shiftright", F.get(words, F.shiftright(p, 6).cast("int")), (p % 64).cast("int")).bitwiseAND(F.lit(1)) == 1)
        return out


def _places(h: Column, level: int, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(h, F.lit(level * PLACES + j)), F.lit(bits).cast("long")) for j in range(PLACES)]


def _filter(keys: DataFrame, n: int, level: int) -> Filter:
    """A filter of the ``n`` longs ``h``; its words, MOST_BITS altogether at most, pass the driver."""
    bits = 1 << 10
    while bits < min(BITS * n, MOST_BITS):
        bits *= 2
    places = keys.select(F.explode(F.array(*_places(F.col("h"), level, bits))).alias("p"))
    words = places.groupBy(F.shiftright("p", 6).alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % 64).cast("int"))).alias("x")).toArrow()
    dense = np.zeros(bits // 64, np.int64)
    dense[words.column("w").to_numpy()] = words.column("x").to_numpy()
    return Filter(bits, keys.sparkSession.createDataFrame(pa.table({"words": pa.array([dense], pa.list_(pa.int64()))})))


@dataclass
class Cascade:
    filters: list[Filter]
    complete: bool

    def has(self, h: Column) -> Column:
        """True or false for keys of the universe; null where an incomplete cascade cannot tell."""
        out = F.lit((len(self.filters) - 1) % 2 == 0) if self.complete else F.lit(None).cast("boolean")
        for i in range(len(self.filters) - 1, -1, -1):
            out = F.when(~self.filters[i].lets(h, i), F.lit(i % 2 == 1)).otherwise(out)
        return out


def cascade(keys: DataFrame) -> Cascade:
    """Of ``keys(h, member)``, a row for each key of the universe. Without members nothing is let through."""
    sides = {True: keys.where("member").select("h"), False: keys.where("not member").select("h")}
    filters: list[Filter] = []
    while len(filters) < DEPTH:
        level = len(filters)
        side = level % 2 == 0
        n = sides[side].count()
        if not n:
            return Cascade(filters, True)
        filters.append(_filter(sides[side], n, level))
        sides[not side] = cut(sides[not side].where(filters[-1].lets(F.col("h"), level)))
    return Cascade(filters, False)
