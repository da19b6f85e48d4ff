"""Generalized quasi-identifiers and suppression of small classes."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilframe.errors import PipelineError
from veilframe.functions.values import number
from veilframe.operators import membership
from veilframe.operators.hierarchy import ANY, Hierarchy, HierarchyTable, base_name, hierarchy_of
from veilframe.operators.histogram import Qi, source_column
from veilframe.shared import cut


def numeric_label(c: Column, low: float, step: int) -> Column:
    """``[start-end]`` of a number's bucket; what is no number stays as it is."""
    least = math.floor(low)
    v = F.round(number(c)).cast("long")
    start = F.lit(least) + F.call_function("div", v - F.lit(least), F.lit(step)) * F.lit(step)
    return F.coalesce(F.concat(F.lit("["), start.cast("string"), F.lit("-"), (start + F.lit(step - 1)).cast("string"), F.lit("]")), c.cast("string"))


def generalized(df: DataFrame, qis: Sequence[Qi], node: Sequence[int], own: Mapping[str, Hierarchy] | None = None) -> DataFrame:
    """The frame with all quasi-identifiers at the node's levels; other columns as they are. Streams too."""
    if len(qis) != len(node):
        raise PipelineError("GENERALIZATION_FAILED", "The node does not fit the quasi-identifiers", f"{len(node)} and {len(qis)}")
    changed, order = {}, df.columns
    for q, level in zip(qis, node):
        name = source_column(df, q.name)
        c = F.col(name)
        if not q.categorical:
            changed[name] = numeric_label(c, q.low or 0.0, level)
            continue
        try:
            h = hierarchy_of(base_name(q.name), own)
        except PipelineError:
            changed[name] = c.cast("string")  # a column without a hierarchy stays as it is
            continue
        if isinstance(h, HierarchyTable):
            df = h.joined(df, c.cast("string"), level, name)
        else:
            changed[name] = h.column(c.cast("string"), level)
    return df.withColumns(changed).select(*[F.col(c) for c in order])


def class_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``columns, n``: the rows of each class, summed before the shuffle."""
    return df.groupBy(*columns).agg(F.count("*").alias("n"))


def starred(df: DataFrame, columns: Sequence[str], small: Column) -> DataFrame:
    return df.withColumns({c: F.when(small, F.lit(ANY)).otherwise(F.col(c)) for c in df.columns if c in columns})


#: Small classes that are sent to every task as they are; more are told by a cascade of filters.
FEW = 10_000


def suppressed(df: DataFrame, columns: Sequence[str], k: int, counts: DataFrame | None = None) -> DataFrame:
    """The frame with ``*`` in ``columns`` for rows whose class, over the whole frame, is smaller than ``k``.

    ``counts``: ``class_counts`` of the frame where they are known. Rows are not shuffled: a few small classes are broadcast, more are told
    from filters over all classes. Only if those outgrow their bound do the rows they leave undecided meet the classes in a join.
    """
    if k <= 1 or not columns:
        return df
    counts = cut(class_counts(df, columns) if counts is None else counts)
    small = counts.where(F.col("n") < k)
    few = small.limit(FEW + 1).count()
    if not few:
        return df
    named = small.select(*[F.col(c).alias(f"__q{i}") for i, c in enumerate(columns)], F.lit(True).alias("__small"))
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__q{i}")) for i, c in enumerate(columns)])

    def joined(rows: DataFrame, classes: DataFrame) -> DataFrame:
        return starred(rows.join(classes, match, "left"), columns, F.col("__small")).select(*df.columns)

    if few <= FEW:
        return joined(df, F.broadcast(named))
    told = membership.cascade(cut(counts.select(membership.key_hash([F.col(c) for c in columns]).alias("h"), (F.col("n") < k).alias("member"))))
    marked = df.withColumn("__in", told.has(membership.key_hash([F.col(c) for c in columns])))
    if told.complete:
        return starred(marked, columns, F.col("__in")).select(*df.columns)
    sure = starred(marked.where("__in is not null"), columns, F.col("__in")).select(*df.columns)
    return sure.unionByName(joined(marked.where("__in is null"), named))


def class_audit(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``size, classes, starred`` of a finished frame: how many classes have each size, and whether they are the suppressed one."""
    stars = reduce(lambda a, b: a & b, [F.col(c) == ANY for c in columns])
    sizes = df.groupBy(*columns).agg(F.count("*").alias("size"))
    return sizes.groupBy("size", F.coalesce(stars, F.lit(False)).alias("starred")).agg(F.count("*").alias("classes"))
