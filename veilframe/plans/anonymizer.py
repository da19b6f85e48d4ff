"""Fit a generalization to a frame, then apply it: search over a histogram, generalize, suppress."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilframe.config import Config
from veilframe.errors import PipelineError
from veilframe.operators import generalize, histogram
from veilframe.operators.hierarchy import Hierarchy, HierarchyTable, hierarchy_of
from veilframe.operators.histogram import Qi, domain, source_column
from veilframe.plans import lattice
from veilframe.plans.rollup import Rollup


def quasi_identifiers(df: DataFrame, cfg: Config) -> list[Qi]:
    """Numeric ones first, then categorical ones, as configured."""
    if not cfg.numerical and not cfg.categorical:
        raise PipelineError("ANON_NO_QIS", "No quasi-identifiers are defined")
    spans = histogram.min_max(df, [n.column for n in cfg.numerical])
    qis = [Qi(n.column, False, *spans[n.column]) for n in cfg.numerical] + [Qi(c, True) for c in cfg.categorical]
    for q in qis:
        source_column(df, q.name)
    return qis


@dataclass(frozen=True)
class Model:
    """What was found; ``transform`` applies it to any frame of the same columns."""

    cfg: Config
    qis: tuple[Qi, ...]
    initial: lattice.Node
    found: lattice.Found
    total: int
    class_sizes: Mapping[int, int]
    own: Mapping[str, Hierarchy | HierarchyTable] | None = None

    @property
    def node(self) -> lattice.Node:
        return self.found.best.node

    def generalize(self, df: DataFrame) -> DataFrame:
        """Row by row, without suppression; streams too."""
        return generalize.generalized(df, self.qis, self.node, self.own)

    def transform(self, df: DataFrame) -> DataFrame:
        return self._suppressed(df, None)

    def _suppressed(self, df: DataFrame, counts: DataFrame | None) -> DataFrame:
        out = self.generalize(df)
        return generalize.suppressed(out, [source_column(df, q.name) for q in self.qis], self.cfg.k, counts)


def label_counts(model: Model, df: DataFrame, cells: DataFrame, widths: Sequence[int]) -> DataFrame | None:
    """The class counts of ``df``, generalized by ``model``, from its ``cells`` at ``widths``; None where labels do not follow from them.

    A number's label follows from its bucket if the column holds whole numbers and the bucket lies within one label; a
    category's always, as cells keep its text.
    """
    columns = [source_column(df, q.name) for q in model.qis]
    whole = all(q.categorical or df.schema[c].dataType.typeName() in ("byte", "short", "integer", "long") for q, c in zip(model.qis, columns))
    if not whole or len(set(columns)) < len(columns) or any(step % w for q, step, w in zip(model.qis, model.node, widths) if not q.categorical):
        return None
    back = [F.col(f"i{n}") if q.categorical else F.lit(int(q.low or 0)) + F.col(f"i{n}") * w for n, (q, w) in enumerate(zip(model.qis, widths))]
    texts = cells.select(*[b.alias(c) for b, c in zip(back, columns)], "n")
    return model.generalize(texts).groupBy(*columns).agg(F.sum("n").alias("n"))


class Anonymizer:
    def __init__(self, cfg: Config, hierarchies: Mapping[str, Hierarchy | HierarchyTable] | None = None) -> None:
        self.cfg, self.own = cfg, hierarchies

    def _classes(self, df: DataFrame, qis: list[Qi]) -> dict[int, list[list[int]]]:
        """For scoring by hierarchy: the class of each domain index at each level. Domains of hierarchies are small."""
        out: dict[int, list[list[int]]] = {}
        for i, q in enumerate(qis):
            if q.categorical and self.cfg.categorical_scoring == "hierarchy":
                h = hierarchy_of(q.name, self.own)
                if isinstance(h, HierarchyTable):
                    continue
                values = [r["value"] for r in domain(df, source_column(df, q.name)).orderBy("idx").collect()]
                out[i] = []
                for level in range(1, h.depth + 1):
                    names = [h.at(v, level) for v in values]
                    number = {n: j for j, n in enumerate(sorted(set(names)))}
                    out[i].append([number[n] for n in names])
        return out

    def fit(self, df: DataFrame) -> Model:
        """One job for the spans of numeric columns, one for the cells, one for each level of the lattice that the walk visits."""
        return self._fit(df)[0]

    def fit_transform(self, df: DataFrame) -> tuple[Model, DataFrame]:
        """The model and ``df`` transformed; where labels follow from the cells, classes are not counted over the rows again."""
        model, cells, unit = self._fit(df)
        return model, model._suppressed(df, label_counts(model, df, cells, unit))

    def _fit(self, df: DataFrame) -> tuple[Model, DataFrame, list[int]]:
        cfg = self.cfg
        qis = quasi_identifiers(df, cfg)
        initial = lattice.first_widths(qis, cfg.size, cfg.max_equivalence_classes, self.own)
        unit = [1 if q.categorical else w for q, w in zip(qis, initial)]  # indices are in units of the first widths
        cells = histogram.kept(histogram.cells(df, qis, unit))
        tables = {n: h for n, q in enumerate(qis) if q.categorical and cfg.categorical_scoring == "hierarchy" and isinstance(h := hierarchy_of(q.name, self.own), HierarchyTable)}
        hist = histogram.indexed(cells, qis, tables)
        hist = histogram.kept(hist) if any(q.categorical for q in qis) else hist
        most = [(F.lit(0) if n in tables else F.coalesce(F.max(f"i{n}"), F.lit(0))).alias(f"m{n}") for n in range(len(qis))]
        total, count, *last = hist.agg(F.coalesce(F.sum("cnt"), F.lit(0)).alias("total"), F.count("*").alias("count"), *most).first()
        lattice.check(cfg.k, cfg.suppression_limit, total)
        grid = lattice.levels(qis, initial, cfg.size, self.own)
        scaled = lambda node: tuple(max(1, f // u) for f, u in zip(node, unit))
        rollup = Rollup(hist, count, [m + 1 for m in last], cfg.k, self._classes(df, qis), [scaled(n) for n in grid[1]] if len(grid) > 1 else [], list(tables))

        def score(node: lattice.Node) -> tuple[int, int, int]:
            return rollup.score([scaled(node)])[scaled(node)]

        def ahead(nodes: list[lattice.Node]) -> None:
            if scaled(nodes[0]) not in rollup.scores:
                rollup.score([scaled(n) for n in nodes])

        try:
            found = lattice.search(grid, score, cfg.k, cfg.suppression_limit, total, cfg.exhaustive, ahead=ahead, most=cfg.max_nodes)
            sizes = rollup.class_sizes(scaled(found.best.node)).orderBy("size").collect()
        finally:
            rollup.close()
        return Model(cfg, tuple(qis), initial, found, int(total), {r["size"]: r["classes"] for r in sizes}, self.own), cells, unit
