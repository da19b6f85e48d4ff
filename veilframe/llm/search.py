"""Exact and approximate nearest neighbours by inner product: queries go to the shards of rows that may hold a result.

Equal vectors are one node that keeps its smallest ids, as many as a result can use. Nodes fall into bands of norm, within
which norms differ by a factor of at most 256, and are scaled by the band's power of two, so that no square overflows or
vanishes and a large vector takes no digits from small ones. Nodes of a band are dealt to the nearest of a few pivots, and each
such cell is cut into shards of bounded size. A query goes to the shards of a cell only if the cell's covering radius
allows a result better than those that a sample gives it at once. A task builds one shard's tree and takes the queries that
came to it through it. For cells and vantage-point trees the inner product becomes a distance: rows get the
coordinate sqrt(M^2 - |x|^2), M the band's largest norm, and queries a zero. Scores are compared between bands by the scaled products
and the bands' powers of two, and given for the original vectors.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilframe.llm import trees
from veilframe.llm.common import cut

#: Vectors that give a first bound of each query's k-th score. Of a band those of them are pivots that make two cells for each
#: shard, within these bounds.
SAMPLE, PIVOTS = 4096, (32, 1024)
#: Binary digits of a band of norms; the band of zero vectors.
BAND, ZERO = 8, -200
#: Nodes of a shard, about, queries searched together, and queries that meet a shard in one task, about.
SHARD, BLOCK, CHUNK = 8192, 1024, 65_536


def usable(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    return vector.isNotNull() & F.coalesce(F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def _matrix(lists: pa.Array | list, width: int) -> np.ndarray:
    """Rows of doubles; a vector shorter than ``width`` counts as padded with zeros."""
    rows = [np.asarray(v, float) for v in lists]
    out = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        out[i, : r.size] = r
    return out


def _lift(x: np.ndarray, most: float) -> np.ndarray:
    return np.concatenate([x, np.sqrt(np.maximum(most**2 - (x**2).sum(1), 0))[:, None]], 1)


def _flat(x: np.ndarray) -> np.ndarray:
    return np.concatenate([x, np.zeros((len(x), 1))], 1)


def _scaled(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows divided by their band's power of two, and the bands."""
    if not x.size:
        return x, np.full(len(x), ZERO)
    most = np.abs(x).max(1)
    unit = np.where(most > 0, most, 1.0)
    log = np.log2(unit) + np.log2(np.maximum(((x / unit[:, None]) ** 2).sum(1), 1)) / 2
    band = np.where(most > 0, np.rint(log / BAND), ZERO).astype(int)
    return np.ldexp(x, -BAND * band[:, None]), band


def _shift(score: np.ndarray, digits: np.ndarray) -> np.ndarray:
    """Scores times powers of two; what is below zero stays so."""
    out = np.ldexp(score, digits)
    return np.where((score < 0) & (out == 0), -5e-324, out)


def visited(vectors: DataFrame, is_query: Column, k: int, factor: float = 1.0) -> float:
    """The mean share of cells that queries are sent to; the shards of a cell are met together."""
    seen: dict[str, float] = {}
    _neighbours(vectors, is_query, k, factor, None, None, None, seen)
    return seen["share"]


def _neighbours(vectors: DataFrame, is_query: Column, k: int, factor: float, build: Callable[[np.ndarray, float], object], prepare: Callable[[np.ndarray, np.ndarray, np.ndarray, float], tuple[object, np.ndarray]], search: Callable[[object, np.ndarray, object, trees.Best, np.ndarray], None], seen: dict[str, float] | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score`` from ``vectors(vec_id, v)``; ``seen``: gets the share of cells that queries meet, and no search is made."""
    spark = vectors.sparkSession
    rows = cut(vectors.where("vec_id is not null").select("vec_id", "v").distinct())
    queries = rows.where(is_query)
    # an id's own vectors may stand before what it looks for
    own = queries.groupBy("vec_id").count().agg(F.coalesce(F.max("count"), F.lit(1))).first()[0]
    by_v = Window.partitionBy("v").orderBy("vec_id")
    nodes = rows.withColumn("no", F.row_number().over(by_v)).where(F.col("no") <= k + 1).groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    nodes = cut(nodes.withColumn("node", F.monotonically_increasing_id()))
    keys = cut(queries.select("v").distinct().withColumn("qkey", F.monotonically_increasing_id()))
    half = F.forall("v", lambda x: x.cast("float").cast("double") == x)  # then 32 bits a component are exact
    width, count, halves = nodes.agg(F.coalesce(F.max(F.size("v")), F.lit(0)), F.count("*"), F.coalesce(F.bool_and(half), F.lit(True))).first()
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not count:
        return nothing
    sent = "array<float>" if halves else "array<double>"

    def banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, band = _scaled(_matrix(b.column("v").to_pylist(), width))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(band.astype(np.int32)), pa.array(np.sqrt((x**2).sum(1)))], names=[*b.schema.names, "band", "norm"])

    nodes = cut(nodes.select("node", "ids", F.col("v").cast(sent).alias("v")).mapInArrow(banded, f"node long, ids array<bigint>, v {sent}, band int, norm double"))
    bands = {r["band"]: (r["most"] * (1 + 1e-12), r["n"]) for r in nodes.groupBy("band").agg(F.max("norm").alias("most"), F.count("*").alias("n")).collect()}  # under 300 bands
    top, most_of = max(bands), {b: m for b, (m, _) in bands.items()}
    sample = nodes.select("v", "ids", "node").orderBy(F.xxhash64("v"), "v").limit(SAMPLE).collect()
    some, band_of = _scaled(_matrix([r["v"] for r in sample], width))
    pivots = {b: _lift(some[band_of == b][: max(PIVOTS[0], min(PIVOTS[1], -(-2 * n // SHARD)))], m) for b, (m, n) in bands.items()}
    pivots = {b: x if len(x) else np.zeros((1, width + 1)) for b, x in pivots.items()}  # a band that the sample lacks is one cell
    base = dict(zip(sorted(pivots), np.cumsum([0, *(len(pivots[b]) for b in sorted(pivots))])))  # cells are numbered through all bands
    shared = spark.sparkContext.broadcast((some, band_of, [[(i, r["node"]) for i in r["ids"]] for r in sample], pivots))  # at most SAMPLE vectors, k + 1 ids each

    def distances(x: np.ndarray, to: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum((x**2).sum(1)[:, None] + (to**2).sum(1) - 2 * x @ to.T, 0))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, band = _scaled(_matrix(b.column("v").to_pylist(), width))
            cell, far = np.zeros(len(x), np.int32), np.zeros(len(x))
            for one in np.unique(band):
                at = np.flatnonzero(band == one)
                d = distances(_lift(x[at], most_of[one]), shared.value[3][one])
                cell[at] = base[one] + d.argmin(1)
                far[at] = d.min(1)
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("node", "ids", "v", "band")), pa.array(cell), pa.array(far)], names=["node", "ids", "v", "band", "cell", "d"])

    nodes = cut(nodes.drop("norm").mapInArrow(deal, f"node long, ids array<bigint>, v {sent}, band int, cell int, d double"))
    cells = {r["cell"]: (r["band"], -(-r["n"] // SHARD), r["d"]) for r in nodes.groupBy("band", "cell").agg(F.count("*").alias("n"), F.max("d").alias("d")).collect()}  # as many as there are pivots
    within = {b: (np.array([c for c, x in cells.items() if x[0] == b]), np.array([x[2] for x in cells.values() if x[0] == b])) for b in bands}

    def needed(x: np.ndarray, bound: np.ndarray, band: int) -> tuple[np.ndarray, np.ndarray]:
        """The score in a band that reaches ``bound``, and the distance that goes with it."""
        score = _shift(bound, np.full(len(x), BAND * (top - band)))
        norm2, most = (x**2).sum(1), most_of[band]
        reach = np.clip(score, -2 * (1 + np.sqrt(norm2) * most), 2 * (1 + np.sqrt(norm2) * most))
        d2 = norm2 + most**2 - 2 * reach
        return score, np.where(score == np.inf, -1.0, np.sqrt(np.maximum(d2 + 1e-6 * (1 + norm2 + most**2), 0)))

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """With each query its band, the score to reach, the cells that may hold a better one and, where pruning is
        relaxed, what the sample gives: then no query is left with fewer results than it could have."""
        some, band_of, ids, pivots = shared.value
        for b in batches:
            x, own_band = _scaled(_matrix(b.column("v").to_pylist(), width))
            near = _shift(x @ some.T, np.broadcast_to(BAND * (band_of - top), (len(x), len(some))))
            bound = np.partition(near, -(k + own), axis=1)[:, -(k + own)] if near.shape[1] >= k + own else np.full(len(x), -np.inf)
            hits: list[np.ndarray] = []
            for one, (cell, radius) in within.items():
                score, far = needed(x, bound, one)
                d = distances(_flat(x), pivots[one][cell - base[one]])
                slack = 1e-6 * (1 + most_of[one])
                fits = ((d - radius - slack) * factor <= far[:, None] + slack) & (far >= 0)[:, None]
                hits.append(np.where(fits, cell, -1))
            hit = np.concatenate(hits, 1)
            lists = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *(hit >= 0).sum(1)]), pa.int32()), pa.array(hit[hit >= 0].astype(np.int32)))
            first = np.argsort(-near, axis=1, kind="stable")[:, : k + own] if factor > 1 else np.empty((len(x), 0), np.int64)
            sure = [[{"vec_id": i, "node": node, "score": float(np.ldexp((x[q] * some[n]).sum(), int(BAND * (own_band[q] + band_of[n]))))} for n in row for i, node in ids[n]] for q, row in enumerate(first)]
            home = distances(_flat(x), pivots[top]).argmin(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(home.astype(np.int32)), pa.array(bound), lists, pa.array(sure, pa.list_(pa.struct([("vec_id", pa.int64()), ("node", pa.int64()), ("score", pa.float64())])))], names=["qkey", "v", "home", "bound", "cells", "sure"])

    asked = cut(keys.select("qkey", F.col("v").cast(sent).alias("v")).mapInArrow(ask, f"qkey long, v {sent}, home int, bound double, cells array<int>, sure array<struct<vec_id: bigint, node: bigint, score: double>>"))

    asks = {r["cell"]: r["count"] for r in asked.select(F.explode("cells").alias("cell")).groupBy("cell").count().collect()}
    if not asks:
        return nothing
    if seen is not None:
        seen["share"] = sum(asks.values()) / len(cells) / asked.count()
        return nothing
    plan = spark.createDataFrame([(int(c), int(cells[c][1]), -(-n // CHUNK)) for c, n in asks.items()], "cell int, parts int, chunks int")  # as many rows as there are pivots
    to = asked.select("qkey", "v", "home", "bound", F.explode("cells").alias("cell")).join(F.broadcast(plan), "cell")
    to = to.withColumn("chunk", F.pmod(F.xxhash64("qkey"), F.col("chunks")).cast("int")).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts", "chunks")
    held = nodes.join(F.broadcast(plan), "cell").withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))

    def meet(ours: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(ours) and len(theirs):
            band = int(ours["band"].iloc[0])
            ours = ours.assign(first=[i[0] for i in ours["ids"]]).sort_values("first", kind="stable")
            y, ids, first, node = np.ldexp(_matrix(list(ours["v"]), width), -BAND * band), list(ours["ids"]), ours["first"].to_numpy(np.int64), ours["node"].to_numpy(np.int64)
            tree = build(y, most_of[band])
            theirs = theirs.sort_values(["home", "qkey"])
            for at in range(0, len(theirs), BLOCK):
                block = theirs.iloc[at : at + BLOCK]
                x, own_band = _scaled(_matrix(list(block["v"]), width))
                score, far = needed(x, block["bound"].to_numpy(), band)
                ready, floor = prepare(x, score, far, most_of[band])
                best = trees.Best(len(x), k + own, floor)
                search(tree, y, ready, best, first)
                q, row = best.found()
                times = np.array([ids[r].size for r in row], np.int64)
                score = np.ldexp((x[q] * y[row]).sum(1), BAND * (own_band[q] + band))  # summed alike wherever a vector stands
                found.append((np.repeat(block["qkey"].to_numpy()[q], times), [ids[r] for r in row], np.repeat(node[row], times), np.repeat(score, times)))
        none = [np.empty(0, np.int64)]
        return pd.DataFrame({"qkey": np.concatenate(none + [f[0] for f in found]), "vec_id": np.concatenate(none + [i for f in found for i in f[1]]), "node": np.concatenate(none + [f[2] for f in found]), "score": np.concatenate([np.empty(0)] + [f[3] for f in found])})

    key = ["cell", "part", "chunk"]
    met = held.select(*key, "node", "band", "ids", "v").groupBy(*key).cogroup(to.groupBy(*key)).applyInPandas(meet, "qkey long, vec_id long, node long, score double")
    ranked = Window.partitionBy("qkey").orderBy(F.desc("score"), "vec_id")
    twice = 2 if factor > 1 else 1  # by the sample and by a shard
    met = met.unionByName(asked.select("qkey", F.inline("sure"))).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= twice * (k + own))
    met = met.groupBy("qkey", "vec_id", "node").agg(F.max("score").alias("score"))
    mine = queries.join(keys, "v").select(F.col("vec_id").alias("query_id"), "qkey")
    found = mine.join(met, "qkey").where("vec_id <> query_id")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    found = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def exact_top_k(vectors: DataFrame, is_query: Column, k: int) -> DataFrame:
    """The ``k`` rows of largest inner product with each query, those of its own id aside; ties to the smaller id.

    ``vectors(vec_id, v array<double>)`` without unusable vectors; any finite ones. Cover trees over a shard and a block
    of queries are searched together. Sums of whole numbers below 2^53 are exact; a sum beyond the doubles is infinite. Equal rows count
    once; an id's different vectors are rows of their own, as candidates and as queries, whose results stand in one ranking of the id. An id that is a
    query should have few of them, as each search keeps as many places more. Rows without an id take no part; fewer than ``k`` candidates are all returned.
    """

    def build(x: np.ndarray, most: float) -> trees.CoverTree:
        return trees.CoverTree(x)

    def prepare(x: np.ndarray, score: np.ndarray, far: np.ndarray, most: float) -> tuple:
        return trees.CoverTree(x), score - 1e-9 * (1 + np.sqrt((x**2).sum(1)) * most)

    def search(tree: trees.CoverTree, y: np.ndarray, ready: trees.CoverTree, best: trees.Best, ties: np.ndarray) -> None:
        trees.dual_search(ready, tree, best, ties)

    return _neighbours(vectors, is_query, k, 1.0, build, prepare, search)


def approximate_top_k(vectors: DataFrame, is_query: Column, k: int, factor: float) -> DataFrame:
    """As ``exact_top_k``, by a vantage-point tree for each shard; a ``factor`` above one prunes more than is safe.

    Within a shard two nodes whose distances from a query differ by less than rounding may stand for each other.
    """

    def build(x: np.ndarray, most: float) -> trees.VantageTree:
        return trees.VantageTree(_lift(x, most))

    def prepare(x: np.ndarray, score: np.ndarray, far: np.ndarray, most: float) -> tuple:
        return _flat(x), -far * (1 + 1e-9) - 1e-9

    def search(tree: trees.VantageTree, y: np.ndarray, ready: np.ndarray, best: trees.Best, ties: np.ndarray) -> None:
        trees.vantage_search(tree, ready, best, ties, factor)

    return _neighbours(vectors, is_query, k, factor, build, prepare, search)
