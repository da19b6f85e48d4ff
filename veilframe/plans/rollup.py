"""Scores of lattice nodes, each summed from the smallest finer node whose classes are kept."""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.operators.histogram import Classes, measures
from veilframe.shared import remove, scratch

Node = tuple[int, ...]
Verdict = tuple[int, int, int]

#: Nodes scored in one job.
AT_ONCE = 32


@dataclass
class Kept:
    """The classes of a node: the rows of ``frame`` with its number."""

    frame: DataFrame
    no: int
    cells: int


class Rollup:
    """Over ``hist(i0, i1, ..., cnt)`` of ``cells`` rows, in the units of its indices; quasi-identifier i has ``sizes[i]`` of them.

    ``first``: the nodes just above the finest. They are made in the one pass over ``hist``, together with the nodes that
    are asked for first, so that later ones have a smaller source. The indices of quasi-identifiers in ``paths`` are arrays of nested classes from level 1 up. Classes of scored nodes are Parquet in the shared
    folder, each node's together so that a reader skips the others, until ``close``.
    """

    def __init__(self, hist: DataFrame, cells: int, sizes: Sequence[int], k: int, classes: Classes | None = None, first: Sequence[Node] = (), paths: Sequence[int] = ()) -> None:
        self.paths = set(paths)
        self.sizes, self.k, self.classes, self.first = sizes, k, classes or {}, list(first)
        self.keys = [f"i{n}" for n in range(len(sizes))]
        self.base: Node = (1,) * len(sizes)
        self.kept = {self.base: Kept(hist.withColumn("no", F.lit(0)), 0, cells)}
        self.scores: dict[Node, Verdict] = {}
        #: For each job, the nodes it reads and their numbers of cells.
        self.read: list[dict[Node, int]] = []
        self._spark, self._folder = hist.sparkSession, f"{scratch(hist.sparkSession)}/rollup-{uuid.uuid4().hex}"

    def step(self, i: int, fine: int, coarse: int) -> list[int] | int | None:
        """How an index at level ``fine`` becomes one at ``coarse``: a divisor (0: all become one), a list of classes, or None if it does not."""
        if i in self.paths:
            return coarse - fine + 1
        if i in self.classes:
            to: dict[int, int] = {}
            for a, b in zip(self.classes[i][fine - 1], self.classes[i][coarse - 1]):
                if to.setdefault(a, b) != b:
                    return None  # two members of a class part again
            return [to[a] for a in range(len(to))]
        if coarse >= self.sizes[i]:
            return 0
        return coarse // fine if coarse % fine == 0 else None

    def source(self, node: Node) -> Node:
        """The kept node of fewest cells that all indices of ``node`` follow from."""
        fits = [(kept.cells, m) for m, kept in self.kept.items() if all(a <= b and self.step(i, a, b) is not None for i, (a, b) in enumerate(zip(m, node)))]
        return min(fits)[1]

    def _index(self, i: int, fine: int, coarse: int) -> Column:
        how, at = self.step(i, fine, coarse), F.col(self.keys[i])
        if i in self.paths:
            return F.slice(at, how, F.size(at)) if how > 1 else at
        if isinstance(how, list):
            return F.element_at(F.lit(how).cast("array<long>"), (at + 1).cast("int"))
        return F.lit(0).cast("long") if how == 0 else at if how == 1 else F.expr(f"{self.keys[i]} div {how}")

    def score(self, nodes: Sequence[Node]) -> dict[Node, Verdict]:
        """Rows suppressed, discernibility and classes of each node; those not yet known in one job for ``AT_ONCE`` of them."""
        todo = [n for n in dict.fromkeys(nodes) if n not in self.scores]
        if todo and self.first:
            todo, self.first = list(dict.fromkeys([*todo, *self.first])), []
        for at in range(0, len(todo), AT_ONCE):
            self._score(todo[at : at + AT_ONCE])
        return {n: self.scores[n] for n in nodes}

    def _score(self, nodes: list[Node]) -> None:
        by: dict[Node, list[int]] = defaultdict(list)
        for no, n in enumerate(nodes):
            by[self.source(n)].append(no)
        self.read.append({m: self.kept[m].cells for m in by})
        parts = None
        for m, numbers in by.items():
            kept = self.kept[m]
            each = [F.struct(F.lit(no).alias("no"), *[self._index(i, m[i], nodes[no][i]).alias(k) for i, k in enumerate(self.keys)]) for no in numbers]
            rows = kept.frame.where(F.col("no") == kept.no).select(F.explode(F.array(*each)).alias("x"), "cnt").select("x.*", "cnt")
            parts = rows if parts is None else parts.unionByName(rows)
        found = parts.groupBy("no", *self.keys).agg(F.sum("cnt").alias("cnt"))
        path = f"{self._folder}/{len(self.read)}"
        found.sortWithinPartitions("no").write.parquet(path)
        found = self._spark.read.schema(found.schema).parquet(path)
        for r in found.groupBy("no").agg(*measures(self.k), F.count("*").alias("cells")).collect():
            self.scores[nodes[r["no"]]] = (r["suppressed"], r["dm_star"], r["classes"])
            self.kept.setdefault(nodes[r["no"]], Kept(found, r["no"], r["cells"]))

    def class_sizes(self, node: Node) -> DataFrame:
        """``size, classes``: how many classes of each size from k on a node leaves."""
        self.score([node])
        kept = self.kept[node]
        return kept.frame.where((F.col("no") == kept.no) & (F.col("cnt") >= self.k)).groupBy(F.col("cnt").alias("size")).agg(F.count("*").alias("classes"))

    def close(self) -> None:
        """Removes what was kept; scores stay."""
        remove(self._spark, self._folder)
        self.kept = {self.base: self.kept[self.base]}
