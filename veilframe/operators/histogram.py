"""From rows to a sparse histogram over quasi-identifiers, and the measures of a generalization on it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.errors import PipelineError
from veilframe.functions.values import number, trimmed
from veilframe.operators.hierarchy import HierarchyTable, base_name
from veilframe.shared import cut, numbered


@dataclass(frozen=True)
class Qi:
    """A quasi-identifier; ``low`` and ``high`` are those of a numeric one."""

    name: str
    categorical: bool = False
    low: float | None = None
    high: float | None = None

    @property
    def range(self) -> float:
        return 1.0 if self.low is None or self.high is None else max(self.high - self.low + 1, 1.0)


def source_column(df: DataFrame, name: str) -> str:
    for c in (name, base_name(name)):
        if c in df.columns:
            return c
    raise PipelineError("DATA_COLUMN_MISSING", f"Quasi-identifier '{name}' is not in the input", name)


def min_max(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """Least and largest number of each column, in one pass; zeros where there is none, or no such column."""
    there = [c for c in columns if c in df.columns]
    aggs = [f(number(F.col(c))).alias(f"{name}{i}") for i, c in enumerate(there) for name, f in (("lo", F.min), ("hi", F.max))]
    row = df.agg(*aggs).first() if aggs else {}
    found = {c: (row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(there)}
    return {c: found[c] if found.get(c, (None,))[0] is not None else (0.0, 0.0) for c in columns}


def domain(df: DataFrame, column: str) -> DataFrame:
    """``value, idx`` of a categorical column: its trimmed values in byte order, from 0."""
    values = df.where(F.col(column).isNotNull()).select(trimmed(F.col(column)).alias("value")).distinct()
    return numbered(values, ["value"], "idx", 0).select("value", F.col("idx").cast("long").alias("idx"))


def bin_column(n: Column, low: float, width: int) -> Column:
    """Bucket of a double: how many widths above the minimum, at least 0; null for null."""
    return F.when(n.isNotNull(), F.greatest(F.floor((n - F.lit(low)) / width), F.lit(0))).cast("long")


def cells(df: DataFrame, qis: Sequence[Qi], widths: Sequence[int] | None = None) -> DataFrame:
    """``i0, i1, ..., n``: the bucket of each number and the text of each category as it stands, null for neither, with the rows of each cell.

    One pass over the rows, each cell parsed once in a projection of its own, with counts summed before the shuffle, so hot buckets cost one row a task.
    """
    widths = widths or [1] * len(qis)
    cols = [F.col(source_column(df, q.name)) for q in qis]
    read = df.select(*[(c.cast("string") if q.categorical else number(c)).alias(f"i{n}") for n, (c, q) in enumerate(zip(cols, qis))])
    keys = [f"i{n}" for n in range(len(qis))]
    read = read.select(*[F.col(k) if q.categorical else bin_column(F.col(k), q.low or 0.0, w).alias(k) for k, q, w in zip(keys, qis, widths)])
    return read.groupBy(*keys).agg(F.count("*").alias("n"))


def indexed(found: DataFrame, qis: Sequence[Qi], tables: Mapping[int, HierarchyTable] | None = None) -> DataFrame:
    """``i0, i1, ..., cnt`` of the ``cells`` that have all quasi-identifiers.

    Categories become their place in the domain or, for those with a hierarchy in ``tables``, the array of their classes.
    """
    tables, keys = tables or {}, [f"i{n}" for n in range(len(qis))]
    named = [k for k, q in zip(keys, qis) if q.categorical]
    whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    out = found.withColumns({k: trimmed(F.col(k)) for k in named}) if named else found
    domains = {k: numbered(out.where(F.col(k).isNotNull()).select(k).distinct(), [k], "__idx", 0) for n, k in enumerate(keys) if k in named and n not in tables}
    out = out.where(whole)
    for k, values in domains.items():
        out = out.join(values, k).withColumn(k, F.col("__idx").cast("long")).drop("__idx")
    for n, table in tables.items():
        out = table.paths(out, f"i{n}")
    return (out.groupBy(*keys).agg(F.sum("n").alias("cnt")) if named else out.withColumnRenamed("n", "cnt")).select(*keys, "cnt")


def histogram(df: DataFrame, qis: Sequence[Qi], widths: Sequence[int] | None = None) -> DataFrame:
    """``i0, i1, ..., cnt`` of the rows that have all quasi-identifiers. With categories, the cells are checkpointed before these are numbered."""
    found = cells(df, qis, widths)
    return indexed(cut(found) if any(q.categorical for q in qis) else found, qis)


#: Of a quasi-identifier by its number: the class of each index at level 1, 2, ...
Classes = Mapping[int, Sequence[Sequence[int]]]


def merged_nodes(hist: DataFrame, nodes: Sequence[Sequence[int]], classes: Classes | None = None) -> DataFrame:
    """``node, i0, i1, ..., cnt``: the histogram of each coarser node. Indices are divided by its factors, or looked up in ``classes``."""
    keys = [f"i{n}" for n in range(len(nodes[0]))]
    listed = F.array(*[F.array(*[F.lit(int(f)).cast("long") for f in node]) for node in nodes])
    each = hist.select(*keys, "cnt", F.explode(listed).alias("node"))

    def coarse(n: int, k: str) -> Column:
        if classes is None or n not in classes:
            return F.expr(f"{k} div node[{n}]")
        levels = F.array(*[F.lit(list(level)).cast("array<long>") for level in classes[n]])
        return F.element_at(F.element_at(levels, F.col("node")[n].cast("int")), (F.col(k) + 1).cast("int"))

    return each.select("node", *[coarse(n, k).alias(k) for n, k in enumerate(keys)], "cnt").groupBy("node", *keys).agg(F.sum("cnt").alias("cnt"))


def merged(hist: DataFrame, node: Sequence[int], classes: Classes | None = None) -> DataFrame:
    return merged_nodes(hist, [node], classes).drop("node")


def measures(k: int) -> list[Column]:
    """Rows to suppress, discernibility and number of classes, over class sizes ``cnt``."""
    big = F.col("cnt") >= k
    zero = F.lit(0).cast("long")
    return [
        F.coalesce(F.sum(F.when(~big & (F.col("cnt") > 0), F.col("cnt"))), zero).alias("suppressed"),
        F.coalesce(F.sum(F.when(big, F.col("cnt") * F.col("cnt"))), zero).alias("dm_star"),
        F.count(F.when(big, 1)).alias("classes"),
    ]


def class_sizes(hist: DataFrame, node: Sequence[int], k: int, classes: Classes | None = None) -> DataFrame:
    """``size, classes``: how many classes of each size from k on a node leaves."""
    return merged(hist, node, classes).where(F.col("cnt") >= k).groupBy(F.col("cnt").alias("size")).agg(F.count("*").alias("classes"))


def score_nodes(hist: DataFrame, nodes: Sequence[Sequence[int]], k: int, classes: Classes | None = None) -> DataFrame:
    """``node, suppressed, dm_star, classes`` of every node, in one job: each bucket is repeated for each node of the list."""
    return merged_nodes(hist, nodes, classes).groupBy("node").agg(*measures(k))


def kept(hist: DataFrame) -> DataFrame:
    return cut(hist)
