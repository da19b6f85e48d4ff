"""A broadcast filter of bounded size."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame


def mixed(h: np.ndarray) -> np.ndarray:
    """A hash of hashes, without collisions."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


class Bloom:
    """A filter in blocks: a key's block is told by its upper bits, its three bits in the block by the others."""

    BLOCK = 1 << 16

    def __init__(self, blocks: int, bits: np.ndarray) -> None:
        self.blocks, self.bits = blocks, bits

    @staticmethod
    def places(keys: np.ndarray, blocks: int) -> tuple[np.ndarray, list[np.ndarray]]:
        with np.errstate(over="ignore"):
            x = mixed(keys * np.uint64(0xD6E8FEB86659FD93))
        return ((x >> np.uint64(48)) % np.uint64(blocks)).astype(np.int64), [((x >> np.uint64(16 * i)) & np.uint64(Bloom.BLOCK - 1)).astype(np.int64) for i in range(3)]

    def has(self, keys: np.ndarray) -> np.ndarray:
        if not self.blocks:
            return np.zeros(keys.size, bool)
        block, places = self.places(keys, self.blocks)
        out = np.ones(keys.size, bool)
        for p in places:
            out &= (self.bits[block * (self.BLOCK // 8) + (p >> 3)] >> (p & 7).astype(np.uint8) & 1).astype(bool)
        return out


def bloom(keys: DataFrame, count: int, most_bits: int) -> Bloom:
    """Of the longs ``a`` of a frame with ``count`` rows: 16 bits each, ``most_bits`` altogether at most. Tasks make the blocks."""
    if not count:
        return Bloom(0, np.empty(0, np.uint8))
    blocks = max(1, min(16 * count, most_bits) // Bloom.BLOCK)

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[int, np.ndarray] = {}
        for b in batches:
            block, places = Bloom.places(b.column(0).to_numpy().view(np.uint64), blocks)
            for k in np.unique(block):
                bits = made.setdefault(int(k), np.zeros(Bloom.BLOCK // 8, np.uint8))
                for p in places:
                    mine = p[block == k]
                    np.bitwise_or.at(bits, mine >> 3, np.uint8(1) << (mine & 7).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array(list(made), pa.int64()), pa.array([v.tobytes() for v in made.values()], pa.binary())], names=["block", "bits"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(Bloom.places(b.column(0).to_numpy().view(np.uint64), blocks)[0])], names=["a", "block"])

    bits = np.zeros(blocks * Bloom.BLOCK // 8, np.uint8)
    for r in keys.select("a").mapInArrow(place, "a long, block long").repartition("block").select("a").mapInArrow(fill, "block long, bits binary").collect():  # most_bits altogether
        at = r["block"] * Bloom.BLOCK // 8
        bits[at : at + Bloom.BLOCK // 8] |= np.frombuffer(bytes(r["bits"]), np.uint8)
    return Bloom(blocks, bits)
