"""SimHash near-duplicates: popcount grid range-join, exact check, connected components.

A 64-bit fingerprint is cut into short segments and mapped to its vector of per-segment bit counts.
The Manhattan distance of two such vectors is a lower bound of the fingerprints' Hamming distance.
Points within Manhattan distance 2 share a lattice point within distance 1 of both, so each point
is put into the grid cells of its own unit ball, and meets all its neighbours there. For a radius
above 2 the bits of a part fall into blocks of which, by pigeonhole, one holds at most 2 differing bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veilframe.llm.common import cut, sweep, with_unique
from veilframe.llm.components import connected_components

#: A popcount vector of more fingerprints crowds its cells: they are split into chunks of about so many, and every two chunks meet.
CROWD = 256
#: Parts that the members of a component are dealt into when they learn its smallest id; only fingerprints with a link are.
SALTS = 32
#: Cell rows that a task makes of fingerprints, about.
CELLS_AT_ONCE = 400_000
#: Pairs compared at a time in a task.
PAIRS_AT_ONCE = 2_000_000


def _mix(h: np.ndarray) -> np.ndarray:
    """A second hash from a first, without collisions."""
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def fingerprint(text: str | None, words: int, parts: int = 1, seed: int = 42) -> tuple[int, ...]:
    """Unsigned SimHash, of ``parts`` times 64 bits, of a text's word shingles; zero for a null text or one without words.

    The first part is made from the shingles' XXH64, each further one from the mixed hashes of the one
    before. A-Z are lower-cased; words are parted by ASCII white space; a text of fewer words than a
    shingle is one shingle. A bit is set if it is set in more than half of the hashes, repeats included.
    """
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return (0,) * parts
    n = max(1, len(w) - words + 1)
    digest = xxhash.xxh64_intdigest
    ones = np.zeros((parts, 64), np.int64)
    for at in range(0, n, 65_536):
        part = w[at : min(at + 65_536, n) + words - 1]
        shingles = map(b" ".join, zip(*(part[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
        h = np.fromiter((digest(s, seed) for s in shingles), np.uint64)
        for p in range(parts):
            ones[p] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            h = _mix(h) if p + 1 < parts else h
    return tuple(np.packbits((2 * ones > n).astype(np.uint8), axis=1, bitorder="little").view(np.uint64)[:, 0].tolist())


def _names(parts: int) -> list[str]:
    return ["fp", *(f"fp{i}" for i in range(2, parts + 1))]


def fingerprints(docs: DataFrame, words: int, parts: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp, fp2, ...`` of every row: the bits of each part of its fingerprint as a signed long."""
    names = ["id", *_names(parts)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), words, parts) for t in b.column(1)], np.uint64).reshape(-1, parts)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(fp[:, i].copy().view(np.int64)) for i in range(parts))], names=names)

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, T.StructType([rows.schema["id"], *(T.StructField(n, T.LongType()) for n in names[1:])]))


def _blocks(radius: int) -> list[list[tuple[int, int]]]:
    """Segments (offset, width) of each block of bits; one block has at most 2 of ``radius`` differing bits."""
    n = radius // 3 + 1
    width = 4 if n == 1 else 2
    edges = [round(64 * i / n) for i in range(n + 1)]
    return [[(o, min(width, b - o)) for o in range(a, b, width)] for a, b in zip(edges, edges[1:])]


def _ball(own: Column, counts: list[tuple[Column, int]]) -> Column:
    """A popcount vector packed three bits to a segment, and those next to it in one segment."""
    keys = [own]
    for i, (c, w) in enumerate(counts):
        step = F.lit(1 << 3 * i).cast("long")
        keys += [F.when(c > 0, own - step), F.when(c < w, own + step)]
    return F.array_compact(F.array(*keys))


def _vectors(fp: Column, part: int, radius: int) -> list[tuple[Column, list[tuple[Column, int]]]]:
    """Of each block of a fingerprint's part: the packed popcount vector, numbered by block, and its counts with their largest."""
    out = []
    for no, segments in enumerate(_blocks(radius)):
        counts = [(F.bit_count(F.shiftrightunsigned(fp, o).bitwiseAND(F.lit((1 << w) - 1))).cast("long"), w) for o, w in segments]
        own = F.lit((part * 16 + no) << 56).cast("long")
        for i, (c, _) in enumerate(counts):
            own = own + F.shiftleft(c, 3 * i)
        out.append((own, counts))
    return out


def _around(cell: Column, radius: int) -> Column:
    """The ball of a packed vector, from the vector alone."""
    balls = []
    for segments in _blocks(radius):
        balls.append(_ball(cell, [(F.shiftrightunsigned(cell, 3 * i).bitwiseAND(F.lit(7)).cast("long"), w) for i, (_, w) in enumerate(segments)]))
    block = F.shiftrightunsigned(cell, 56).bitwiseAND(F.lit(15))
    out = balls[0]
    for no, ball in enumerate(balls[1:], 1):
        out = F.when(block == no, ball).otherwise(out)
    return out


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest index reachable from each of n points over the links a-b."""
    root = np.arange(n)
    while a.size:
        low = np.minimum(root[a], root[b])
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        while (up := root[root]).tobytes() != root.tobytes():
            root = up
        keep = root[a] != root[b]
        a, b = a[keep], b[keep]
    return root


def _forest(limit: int, named: bool = False, beyond: int = -1):
    """Exact check of the lists' pairs; yields an edge from each linked node to the least one that its list joins it with.

    ``named``: the first list is of the nodes that the fingerprints belong to; else the fingerprints are nodes. Rows of
    one node are joined as they are: only links between nodes are sought.
    ``beyond``: pairs of no more differing bits in the first part are left out.
    """

    def edges(flat: list[np.ndarray], no: np.ndarray) -> pa.RecordBatch:
        order = np.lexsort((flat[0], no))  # so that the first of what is joined is the least node
        flat = [f[order] for f in flat]
        node, bits = flat[0], [f.view(np.uint64) for f in flat[named:]]
        again = np.r_[False, (no[1:] == no[:-1]) & (node[1:] == node[:-1])]
        links, k = [(np.flatnonzero(again) - 1, np.flatnonzero(again))], 1
        i = np.arange(no.size - 1)
        while (i := i[i + k < no.size]).size and (i := i[no[i] == no[i + k]]).size:
            j = i[node[i] != node[i + k]]
            first = far = np.bitwise_count(bits[0][j] ^ bits[0][j + k])
            for b in bits[1:]:
                far = far + np.bitwise_count(b[j] ^ b[j + k])
            hit = j[(far <= limit) & (first > beyond)] if beyond >= 0 else j[far <= limit]
            links.append((hit, hit + k))
            k += 1
        root = _roots(no.size, *(np.concatenate(x) for x in zip(*links)))
        own = np.flatnonzero((root != np.arange(no.size)) & ~again)
        return pa.RecordBatch.from_arrays([pa.array(node[own]), pa.array(node[root[own]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            flat = [c.flatten().to_numpy(zero_copy_only=False) for c in b.columns]
            sizes = np.diff(b.column(0).offsets.to_numpy())
            ends = np.cumsum(sizes)
            load = np.cumsum(sizes * sizes // 2 + 1) // PAIRS_AT_ONCE
            for first, last in zip(s := np.flatnonzero(np.diff(load, prepend=-1)), [*s[1:], len(sizes)]):
                lo, hi = ends[first] - sizes[first], ends[last - 1]
                yield edges([f[lo:hi] for f in flat], np.repeat(np.arange(last - first), sizes[first:last]))

    return run


def _node(names: list[str]) -> Column:
    """One long for a fingerprint: itself if it has 64 bits, else its hash."""
    return F.col(names[0]) if len(names) == 1 else F.xxhash64(*names)


def _chunked(rows: DataFrame, key: str, spread: Column) -> DataFrame:
    """Rows with each pair ``a, b`` of chunks of their cell that they belong to; a cell without a number ``n`` is one chunk.

    Of a crowded cell the rows say how many it has, ``n``, its most frequent node ``main`` and that node's rows ``most``. These have chunks of
    their own, which meet only those of other nodes: where most rows of a crowd are joined already, rows grow with
    the crowd and with what is left, not with the crowd's square. Links between nodes are sought, so none is lost.
    """
    chunks = lambda n: F.greatest(F.ceil(n / CROWD), F.lit(1)).cast("int")
    rows = rows.withColumn("mains", chunks(F.col("most"))).withColumn("rest", chunks(F.col("n") - F.col("most")))
    joined = F.col("node") == F.col("main")
    at = F.xxhash64(spread, F.col(key))
    own = F.when(joined, F.pmod(at, F.col("mains"))).otherwise(F.col("mains") + F.pmod(at, F.col("rest"))).cast("int")
    met = F.sequence(F.when(joined, F.col("mains")).otherwise(F.lit(0)), F.col("mains") + F.col("rest") - 1)
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.when(F.col("n").isNull(), F.array(F.lit(None).cast("int"))).otherwise(met)))
    return rows.withColumn("a", F.least("own", "other")).withColumn("b", F.greatest("own", "other"))


def _most(counts: DataFrame, key: str) -> DataFrame:
    """``key, n, main, most`` of ``key, node, count``: the rows of a cell, its most frequent node and that node's rows."""
    return counts.groupBy(key).agg(F.sum("count").alias("n"), F.max(F.struct("count", "node")).alias("top")).select(key, "n", F.col("top.node").alias("main"), F.col("top.count").alias("most"))


def links(fps: DataFrame, radius: int, limit: int, parts: int = 1, grid: int | None = None, named: bool = False) -> DataFrame:
    """Edges ``u, v`` between nodes that join distinct fingerprints of at most ``limit`` differing bits, through chains.

    Every link is checked on the fingerprints themselves; of the links in a cell only a spanning
    forest is returned. All fingerprints are compared that differ by at most ``radius`` bits in any of
    their parts, others only where they happen to share a cell. A cell next to vectors of over
    ``CROWD`` fingerprints is dealt out in chunks, each pair of chunks a group of its own, so that no
    group grows with the data and nothing is left out. Only the first ``grid`` parts, all unless given,
    are put into cells. ``named``: each fingerprint has a long ``node``, and edges join those; fingerprints
    of one node count as joined.
    """
    names = _names(parts)
    if not named:
        fps = fps.withColumn("node", _node(names))
    carried = ["node", *names] if named or parts > 1 else names
    vectors = [v for p, n in enumerate(names[:grid]) for v in _vectors(F.col(n), p, radius)]
    fan_out = sum(1 + 2 * len(counts) for _, counts in vectors)
    fps = fps.repartition(fps.count() * fan_out // CELLS_AT_ONCE + 1, *names)
    own = fps.select("node", F.explode(F.array(*[v for v, _ in vectors])).alias("own"))
    full = own.groupBy("own").count().where(F.col("count") > CROWD).select("own")
    counts = own.join(full, "own", "left_semi").groupBy("own", "node").count()
    counts = counts.select("node", "count", F.explode(_around(F.col("own"), radius)).alias("cell")).groupBy("cell", "node").agg(F.sum("count").alias("count"))
    cells = fps.select("node", *names, F.explode(F.flatten(F.array(*[_ball(v, c) for v, c in vectors]))).alias("cell"))
    dealt = _chunked(cells.join(_most(counts, "cell"), "cell", "left"), "cell", F.xxhash64(*names))
    groups = dealt.groupBy("cell", "a", "b").agg(*[F.collect_list(n).alias(n) for n in carried])
    groups = groups.where(F.array_min(carried[0]) < F.array_max(carried[0])).select(*carried)
    return groups.mapInArrow(_forest(limit, len(carried) > parts), "u long, v long")


def near_duplicates(docs: DataFrame, words: int, radius: int, limit: int | None = None, parts: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, fp, ..., component_id`` of every row: the smallest id reachable over links of at most ``limit`` bits.

    Equal fingerprints are one node with a smallest id, so a hot group of copies costs one row.
    Null texts, empty texts and texts of white space have fingerprint zero and are linked like any
    other. A null id never becomes a component id unless all of its component are null. Repeated rows
    stay, with equal results. An empty table gives an empty result; other columns are not looked at.
    """
    names = _names(parts)
    own = cut(fingerprints(docs, words, parts, id_col=id_col, text_col=text_col))
    nodes = cut(own.groupBy(*names).agg(F.min("id").alias("first"), F.count("*").alias("n")).withColumn("node", _node(names)))
    roots = connected_components(links(nodes.select(*names), radius, radius if limit is None else limit, parts))
    linked = cut(nodes.select("node", "first").join(roots, "node").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int")))
    least = linked.groupBy("root").agg(F.min("first").alias("component_id")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    classes = nodes.join(linked.join(least, ["root", "salt"]).select("node", "component_id"), "node", "left")
    classes = classes.select(*names, "n", F.coalesce("component_id", "first").alias("component_id"))
    found = with_unique(own, classes, names, "n", own.count(), F.monotonically_increasing_id())
    return found.select(F.col("id").alias(id_col), *names, "component_id")


#: Near-duplicates by 128-bit fingerprints alone: a share of 0.8 equal shingles makes a cosine of 0.89 and so 15 %
#: differing bits, give or take 3 %; up to 18 % are taken. ``keep_one`` does not rest on these, but checks shingles.
WORDS, PARTS, RADIUS, LIMIT = 5, 2, 8, 23
#: Least share of equal shingles, of all different ones of two texts: near-duplicates of a corpus.
SHARE = (4, 5)
#: Bands of so many least hashes that propose pairs; at a share of 0.8 a pair has no band in common with probability 3e-6.
BANDS, ROWS = 32, 5
#: 64-bit parts of the fingerprint over different shingles, and the bits a proposed pair may differ by. Over many shingles a
#: share of 0.8 makes about 15 % differing bits, 38.8 of 256, deviation 5.7. Over few it makes more: 4 of 5 shingles differ in
#: 48 bits, deviation 6.2, and of such pairs 0.08 % are beyond the limit.
SET_PARTS, SET_LIMIT = 4, 68
#: Differing bits of the first part up to which the grid proposes every pair; what is further apart in it meets in a cell or in a band.
GRID_RADIUS = 5
#: Bands that join nodes before the grid and all bands are looked through.
FIRST_BANDS = 4
#: Most shingles of a chunk of a component that is checked at a time.
SHINGLES = 1 << 19
_FACTORS = np.random.default_rng(42).integers(0, 1 << 63, BANDS * ROWS, np.uint64) * np.uint64(2) + np.uint64(1)
_ROW = ["__row_key_1", "__row_key_2"]


def shingle_set(text: str | None, words: int) -> np.ndarray:
    """Ascending XXH64 hashes of a text's different word shingles, words as in ``fingerprint``."""
    w = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not w:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    shingles = map(b" ".join, zip(*(w[i:] for i in range(words)))) if len(w) >= words else [b" ".join(w)]
    return np.unique(np.fromiter((digest(s, 42) for s in shingles), np.uint64))


def _set_fingerprint(h: np.ndarray) -> list[int]:
    out = []
    for _ in range(SET_PARTS):
        ones = np.zeros(64, np.int64)
        for at in range(0, h.size, 65_536):
            ones += np.unpackbits(h[at : at + 65_536].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        out.append(int(np.packbits((2 * ones > h.size).astype(np.uint8), bitorder="little").view(np.int64)[0]))
        h = _mix(h)
    return out


def _bands(h: np.ndarray) -> np.ndarray:
    """One hash of each band of least hashes; none for an empty set."""
    if not h.size:
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, ~np.uint64(0))
    for at in range(0, h.size, 2048):
        np.minimum(least, (_FACTORS[:, None] * h[None, at : at + 2048]).min(1), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) ^ column)
    return key.view(np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two shingle sets share ``SHARE`` of their union, exactly."""
    both = a.size + b.size
    if SHARE[1] * min(a.size, b.size) < SHARE[0] * max(a.size, b.size):
        return False
    joint = np.sort(np.concatenate([a, b]), kind="stable")
    return (SHARE[0] + SHARE[1]) * int((joint[1:] == joint[:-1]).sum()) >= SHARE[0] * both


def _described(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, size, fps, bands = [], [], [], []
            for t in b.column(3):
                h = shingle_set(t.as_py(), words)
                node.append(xxhash.xxh64_intdigest(h.tobytes(), 7))
                size.append(h.size)
                fps.append(_set_fingerprint(h))
                bands.append(_bands(h))
            fps = np.array(fps, np.int64).reshape(-1, SET_PARTS)
            ends = np.cumsum([0, *map(len, bands)]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([np.empty(0, np.int64), *bands])))
            cols = [pa.array(np.array(node, np.uint64).view(np.int64)), pa.array(size, pa.int64()), *(pa.array(fps[:, i].copy()) for i in range(SET_PARTS)), lists]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), *cols], names=[*_ROW, "id", "node", "size", *_names(SET_PARTS), "bands"])

    return run


def _sets(words: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sets = pa.array([shingle_set(t.as_py(), words).tobytes() for t in b.column(0)], pa.binary())
            yield pa.RecordBatch.from_arrays([*b.columns[1:], sets], names=[*kept, "shingles"])

    return run


def _check_group(node: np.ndarray, own: np.ndarray, bits: list[np.ndarray], shingles: list[np.ndarray]) -> list[tuple[int, int]]:
    """Checked links that join a group's nodes as far as pairs of SHARE do; of two chunks, only pairs across them.

    Members of one node are joined as they are.
    """
    i, j = np.triu_indices(node.size, 1)
    across = node[i] != node[j]
    if own.min() != own.max():
        across &= own[i] != own[j]
    i, j = i[across], j[across]
    far = np.zeros(i.size, np.int64)
    for b in bits:
        far += np.bitwise_count(b[i] ^ b[j])
    order = np.argsort(far, kind="stable")
    order = order[far[order] <= SET_LIMIT]
    _, first, at = np.unique(node, return_index=True, return_inverse=True)
    root, out = first[at].tolist(), []

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = x = root[root[x]]
        return x

    for x, y in zip(i[order].tolist(), j[order].tolist()):
        if (a := find(x)) != (b := find(y)) and similar(shingles[x], shingles[y]):
            root[a] = b
            out.append((int(node[x]), int(node[y])))
    return out


def _checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges of rows ``root, a, b, own, node, fp, ..., shingles`` that come sorted by group."""
    held: list[tuple] = []
    now = None

    def settle() -> list[tuple[int, int]]:
        if len(held) < 2:
            return []
        cols = list(zip(*held))
        return _check_group(np.array(cols[1]), np.array(cols[0]), [np.array(c, np.int64).view(np.uint64) for c in cols[2:-1]], cols[-1])

    def out(edges: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["u", "v"])

    for batch in batches:
        edges = []
        numbers = [c.to_pylist() for c in batch.columns[:-1]]
        for at, row in enumerate(zip(*numbers)):
            if row[:3] != now:
                edges += settle()
                held.clear()
                now = row[:3]
            held.append((*row[3:], np.frombuffer(batch.column(batch.num_columns - 1)[at].as_py(), np.uint64)))
        yield out(edges)
    yield out(settle())


def _by_bands(cells: DataFrame, crowded: DataFrame) -> DataFrame:
    """Edges of the pairs beyond the grid's radius that share a band."""
    names = _names(SET_PARTS)
    groups = _chunked(cells.join(crowded, "band", "left"), "band", F.col("id")).groupBy("band", "a", "b").agg(*[F.collect_list(n).alias(n) for n in ["node", *names]])
    groups = groups.where(F.array_min("node") < F.array_max("node")).select("node", *names)
    return groups.mapInArrow(_forest(SET_LIMIT, named=True, beyond=GRID_RADIUS), "u long, v long")


def _joined_first(nodes: DataFrame, alike: DataFrame) -> DataFrame:
    """``node, root`` of what equal fingerprints and the first bands join, each band in chunks of about ``CROWD`` nodes.

    Rows grow with the nodes alone. What is joined here need not be joined again by every cell and band that it shares;
    the grid then compares all that is not joined.
    """
    names = _names(SET_PARTS)
    first = alike.withColumnRenamed("node", "v")
    equal = with_unique(nodes.select(F.col("node").alias("u"), *names), first, names, "n", nodes.count(), F.col("u")).where("u <> v").select("u", "v")
    cells = nodes.select("node", *names, F.explode(F.slice("bands", 1, FIRST_BANDS)).alias("band"))
    crowded = cells.groupBy("band").count().where(F.col("count") > CROWD)
    dealt = cells.join(crowded, "band", "left").withColumn("chunk", F.pmod(F.xxhash64("node", "band"), F.coalesce(F.ceil(F.col("count") / CROWD), F.lit(1))))
    groups = dealt.groupBy("band", "chunk").agg(*[F.collect_list(n).alias(n) for n in ["node", *names]])
    groups = groups.where(F.size("node") > 1).select("node", *names)
    near = groups.mapInArrow(_forest(SET_LIMIT, named=True), "u long, v long")
    return connected_components(near.unionByName(equal))


def proposed(nodes: DataFrame) -> DataFrame:
    """Edges ``u, v`` that join nodes with fingerprints within ``SET_LIMIT`` bits, through chains.

    The grid of popcount vectors proposes all pairs of at most ``GRID_RADIUS`` differing bits in the first
    part, and those beyond that share a cell. Beside the grid bands propose only pairs beyond the radius; a band of over
    ``CROWD`` nodes is dealt out in chunks, each pair of chunks a group of its own. What few bands join first
    counts as one node in all cells and bands, so that a large group of near copies makes an edge for each of its
    nodes, not for each cell and band that they share.
    """
    names = _names(SET_PARTS)
    alike = cut(nodes.groupBy(*names).agg(F.min("node").alias("node"), F.count("*").alias("n")))
    joined = cut(_joined_first(nodes, alike))
    sweep(nodes.sparkSession)
    label = F.coalesce("root", "node").alias("node")
    near = links(alike.join(joined, "node", "left").select(label, *names), GRID_RADIUS, SET_LIMIT, SET_PARTS, grid=1, named=True)
    near = cut(near.distinct())
    sweep(nodes.sparkSession)  # the shuffle of cells
    named = nodes.join(joined, "node", "left").select(F.col("node").alias("id"), label, *names, "bands")
    cells = named.select("id", "node", *names, F.explode("bands").alias("band"))
    full = cells.groupBy("band").count().where(F.col("count") > CROWD).select("band")
    crowded = _most(cells.join(full, "band", "left_semi").groupBy("band", "node").count(), "band")
    return near.unionByName(_by_bands(cells, crowded)).unionByName(joined.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))


def _check(rows: DataFrame) -> DataFrame:
    """Checked edges within each group ``root, a, b`` of rows ``own, node, fp, ..., shingles``."""
    groups = rows.select("root", "a", "b", "own", "node", *_names(SET_PARTS), "shingles").repartition("root", "a", "b")
    return groups.sortWithinPartitions("root", "a", "b").mapInArrow(_checked, "u long, v long")


def checked_links(keyed: DataFrame, nodes: DataFrame, words: int, text_col: str) -> DataFrame:
    """Edges ``u, v`` between nodes of ``SHARE`` equal shingles, through chains; every edge is checked on the shingles.

    The grid of fingerprints and, beyond its radius, bands propose; what they join is gathered with its shingles, in chunks of about
    ``CROWD`` nodes or ``SHINGLES`` shingles. Close pairs are checked within chunks, dealt twice, then between what that
    has not joined, in pairs of chunks. So a group of near copies of one text makes rows in proportion to it.
    """
    names = _names(SET_PARTS)
    members = cut(nodes.select("node", "size", *names, *[F.col(f"best.{r}").alias(r) for r in _ROW]).join(connected_components(proposed(nodes)), "node"))
    weight = F.ceil(F.greatest(F.count("*"), F.sum("size") * CROWD / SHINGLES))
    parts = members.groupBy("root").agg(F.ceil(weight / CROWD).cast("int").alias("chunks"), F.count("*").alias("n"))
    dealt = with_unique(members, parts, ["root"], "n", members.count(), F.col("node"))
    kept = ["root", "chunks", "node", "size", *names]
    texts = keyed.select(*_ROW, F.col(text_col).alias("text")).join(dealt, _ROW).select("text", *kept)
    sets = cut(texts.mapInArrow(_sets(words, kept), T.StructType([*texts.schema.fields[1:], T.StructField("shingles", T.BinaryType())])))
    twice = sets.withColumn("time", F.explode(F.when(F.col("chunks") > 1, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    own = F.col("time") * F.col("chunks") + F.pmod(F.xxhash64("node", "time"), F.col("chunks")).cast("int")
    joined = cut(connected_components(_check(twice.withColumn("own", own).withColumn("a", own).withColumn("b", own))))
    left = sets.where("chunks > 1").join(joined.select("node", F.col("root").alias("label")), "node", "left")
    left = left.withColumn("id", F.col("node")).withColumn("node", F.coalesce("label", "id"))
    counts = left.groupBy("root", "node").agg(weight.alias("count"), F.count("*").alias("rows"))
    apart = _most(counts, "root").where("most < n").join(counts.groupBy("root").agg(F.sum("rows").alias("rows")), "root")
    left = with_unique(left.select("id", *kept, "shingles"), apart, ["root"], "rows", members.count(), F.col("id")).where("n is not null")
    return _check(_chunked(left, "root", F.col("id"))).unionByName(joined.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")))


def keep_one(docs: DataFrame, words: int = WORDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The row with the smallest id of each group of near-duplicates, with all its columns; repeated rows of it go.

    Near-duplicates share ``SHARE`` of their different shingles, themselves or through others. Texts of equal
    shingles are one node. A row without an id stays only where its group has no row with one; rows of one id, or
    of none, that are not near-duplicates all stay.
    """
    keyed = docs.withColumns({_ROW[0]: F.xxhash64(text_col, id_col), _ROW[1]: F.xxhash64(F.lit(1), id_col, text_col)})
    rows = keyed.select(*_ROW, F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    more = T.StructType([T.StructField(n, T.LongType()) for n in ["node", "size", *_names(SET_PARTS)]] + [T.StructField("bands", T.ArrayType(T.LongType()))])
    own = rows.mapInArrow(_described(words), T.StructType([*rows.schema.fields[:3], *more.fields]))
    best = F.struct(F.col("id").isNull().alias("none"), "id", *_ROW)
    nodes = cut(own.groupBy("node").agg(F.min(best).alias("best"), *[F.min(n).alias(n) for n in ["size", *_names(SET_PARTS)]], F.first("bands").alias("bands")))
    found = connected_components(checked_links(keyed, nodes, words, text_col))
    whole = nodes.select("node", "best").join(found, "node", "left").groupBy(F.coalesce("root", "node").alias("root")).agg(F.min("best").alias("best"))
    keep = whole.select(*[F.col(f"best.{r}").alias(r) for r in _ROW])
    return keyed.join(keep, _ROW, "left_semi").dropDuplicates(_ROW).drop(*_ROW)


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
