"""The generalization lattice and the two searches over it. Metadata only: no rows come here."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator, Mapping, Sequence
from dataclasses import dataclass

from veilframe.errors import PipelineError
from veilframe.operators.hierarchy import Hierarchy, base_name, hierarchy_of
from veilframe.operators.histogram import Qi

Node = tuple[int, ...]


@dataclass(frozen=True, order=True)
class Score:
    """Ordered from best: discernibility, rows suppressed, then more classes, then the node."""

    dm_star: int
    suppressed: int
    minus_classes: int
    node: Node

    @property
    def classes(self) -> int:
        return -self.minus_classes

    def payload(self) -> dict[str, object]:
        return {"node": list(self.node), "dm_star": self.dm_star, "num_equivalence_classes": self.classes, "suppression_count": self.suppressed}


@dataclass(frozen=True)
class Found:
    best: Score
    top: tuple[Score, ...]
    evaluated: tuple[Score, ...]


def depth(q: Qi, own: Mapping[str, Hierarchy] | None = None) -> int:
    return hierarchy_of(q.name, own).depth if q.categorical else math.ceil(q.range)


class Lattice(Sequence[list[Node]]):
    """The product of a chain of values for each quasi-identifier; a node's level is the number of steps up from the first.

    Nodes are counted and made one by one where they are asked for, never listed as a whole; as a sequence it has the nodes
    of each level, in descending order.
    """

    def __init__(self, chains: Sequence[Sequence[int]]) -> None:
        self.chains = [tuple(c) for c in chains]
        self.height = sum(len(c) - 1 for c in self.chains) + 1

    def __len__(self) -> int:
        return self.height

    def __getitem__(self, level):
        if isinstance(level, slice):
            return [self[i] for i in range(*level.indices(len(self)))]
        if not 0 <= level < self.height:
            raise IndexError(level)
        return list(Open(self).nodes(level))

    def node(self, ranks: Sequence[int]) -> Node:
        return tuple(c[r] for c, r in zip(self.chains, ranks))

    def ranks(self, node: Node) -> tuple[int, ...]:
        return tuple(c.index(v) for c, v in zip(self.chains, node))


class Open:
    """The nodes of a lattice that no verdict has settled: neither at or above one that passed nor at or below one that failed.

    Verdicts are kept as two antichains. Open nodes are counted by quasi-identifier: what is left of a node, once some of its ranks are
    chosen, depends only on which verdicts these ranks still fit.
    """

    def __init__(self, lattice: Lattice) -> None:
        self.lattice = lattice
        self.passed: list[tuple[int, ...]] = []
        self.failed: list[tuple[int, ...]] = []
        self._prepare()

    def _prepare(self) -> None:
        def masks(verdicts: list[tuple[int, ...]], fits: Callable[[int, int], bool]) -> list[list[int]]:
            return [[sum(1 << j for j, v in enumerate(verdicts) if fits(v[i], r)) for r in range(len(c))] for i, c in enumerate(self.lattice.chains)]

        self._up, self._down = masks(self.passed, lambda v, r: v <= r), masks(self.failed, lambda v, r: v >= r)
        self._known: dict[tuple[int, int, int], list[int]] = {}

    def settle(self, ranks: tuple[int, ...], passed: bool) -> None:
        if passed:
            self.passed = [p for p in self.passed if not all(a <= b for a, b in zip(ranks, p))] + [ranks]
        else:
            self.failed = [f for f in self.failed if not all(a >= b for a, b in zip(ranks, f))] + [ranks]
        self._prepare()

    def _counts(self, i: int, up: int, down: int) -> list[int]:
        """How many ways of choosing the ranks from quasi-identifier i on leave the node open, by their sum."""
        key = (i, up, down)
        if key not in self._known:
            chains = self.lattice.chains
            out = [0] * (sum(len(c) - 1 for c in chains[i:]) + 1)
            if i == len(chains):
                out[0] = int(not up and not down)
            else:
                for r in range(len(chains[i])):
                    for s, n in enumerate(self._counts(i + 1, up & self._up[i][r], down & self._down[i][r])):
                        out[s + r] += n
            self._known[key] = out
        return self._known[key]

    def counts(self) -> list[int]:
        """The open nodes of each level."""
        return self._counts(0, (1 << len(self.passed)) - 1, (1 << len(self.failed)) - 1)

    def at(self, level: int, place: int) -> tuple[int, ...]:
        """The ranks of the open node of a level at a place in descending order."""
        up, down, out = (1 << len(self.passed)) - 1, (1 << len(self.failed)) - 1, []
        for i, c in enumerate(self.lattice.chains):
            for r in range(min(len(c) - 1, level), -1, -1):
                counts = self._counts(i + 1, up & self._up[i][r], down & self._down[i][r])
                n = counts[level - r] if level - r < len(counts) else 0
                if place < n:
                    break
                place -= n
            out.append(r)
            level, up, down = level - r, up & self._up[i][r], down & self._down[i][r]
        return tuple(out)

    def nodes(self, level: int) -> Iterator[Node]:
        for place in range(self.counts()[level]):
            yield self.lattice.node(self.at(level, place))


def levels(qis: Sequence[Qi], start: Node, size: Mapping[str, int], own: Mapping[str, Hierarchy] | None = None) -> Lattice:
    """A categorical level rises by one to its depth, a numeric width by its factor to the range."""
    chains = []
    for q, first in zip(qis, start):
        factor = 0 if q.categorical else size.get(q.name, size.get(base_name(q.name)))
        if factor is None:
            raise PipelineError("GENERALIZATION_FAILED", f"No size factor is given for '{q.name}'", q.name)
        most, chain = depth(q, own), [first]
        while (up := min(chain[-1] + 1 if q.categorical else chain[-1] * factor, most)) > chain[-1]:
            chain.append(up)
        chains.append(chain)
    return Lattice(chains)


def _estimate(q: Qi, width: int, own: Mapping[str, Hierarchy] | None) -> int:
    top = depth(q, own)
    return max(top // width, 1) if q.categorical else -(-top // width)


def estimated_classes(qis: Sequence[Qi], node: Node, own: Mapping[str, Hierarchy] | None = None) -> int:
    """The product of each quasi-identifier's number of buckets."""
    return math.prod(_estimate(q, w, own) for q, w in zip(qis, node))


def first_widths(qis: Sequence[Qi], size: Mapping[str, int], most: int | None, own: Mapping[str, Hierarchy] | None = None) -> Node:
    """The smallest node, in lexicographic order, whose estimate stays within ``most``: of each quasi-identifier in turn the
    first width with which the rest can still stay within it."""
    if not qis:
        raise PipelineError("ANON_NO_QIS", "No quasi-identifiers are defined")
    ones = (1,) * len(qis)
    grid = levels(qis, ones, size, own)
    if most is None:
        return ones
    each = [[_estimate(q, w, own) for w in c] for q, c in zip(qis, grid.chains)]
    out, product = [], 1
    for i, (chain, classes) in enumerate(zip(grid.chains, each)):
        rest = math.prod(min(c) for c in each[i + 1 :])
        at = next((r for r, n in enumerate(classes) if product * n * rest <= most), None)
        if at is None:
            raise PipelineError("ANON_INFEASIBLE", "No node keeps the number of classes within the limit", str(most))
        out.append(chain[at])
        product *= classes[at]
    return tuple(out)


def check(k: int, limit: float, total: int) -> None:
    if k < 1 or not 0 <= limit <= 1:
        raise PipelineError("CONFIG_INVALID_VALUE", "k must be at least 1 and the suppression limit from 0 to 1", f"{k}, {limit}")
    if total <= 0:
        raise PipelineError("DATA_EMPTY", "No row has all quasi-identifiers")


#: Open nodes of a level that are told ahead with the one that is asked for.
AHEAD = 32


def _around(count: int, place: int) -> list[int]:
    """``place`` and the places beside it, nearest first."""
    low = max(0, min(place - AHEAD // 2, count - AHEAD))
    return sorted(range(low, min(count, low + AHEAD)), key=lambda i: abs(i - place))


def _walk(grid: Lattice) -> Iterator[tuple[Node, list[Node], Callable[[bool], None]]]:
    """Nodes to evaluate: of the levels with open nodes the middle one, of its open nodes, largest first, the middle one.

    With each come some open nodes beside it. The verdict is passed on: what passes settles all coarser nodes, what fails all finer ones.
    """
    open_ = Open(grid)
    while rest := [level for level, n in enumerate(open_.counts()) if n]:
        level = rest[len(rest) // 2]
        count = open_.counts()[level]
        ranks = open_.at(level, count // 2)
        near = [grid.node(open_.at(level, i)) for i in _around(count, count // 2)]
        yield grid.node(ranks), near, lambda passed, ranks=ranks: open_.settle(ranks, passed)


def _all(grid: Lattice) -> Iterator[tuple[Node, list[Node], Callable[[bool], None]]]:
    whole = Open(grid)
    for level, count in enumerate(whole.counts()):
        for first in range(0, count, AHEAD):
            near = [grid.node(whole.at(level, i)) for i in range(first, min(count, first + AHEAD))]
            for node in near:
                yield node, near, lambda _: None


def search(grid: Lattice, score: Callable[[Node], tuple[int, int, int]], k: int, limit: float, total: int, exhaustive: bool = False, keep: int = 5, ahead: Callable[[list[Node]], None] | None = None, most: int | None = None) -> Found:
    """The best node that suppresses at most ``limit`` of all rows. ``score`` gives rows suppressed, discernibility and classes.

    Only nodes that were evaluated are ranked; ``exhaustive`` evaluates them all. ``ahead`` is told the node asked for and
    others that may be asked for next, so that they can be scored together. After ``most`` nodes the search ends with what it has.
    """
    check(k, limit, total)
    evaluated, passed = [], []
    for node, near, settle in _all(grid) if exhaustive else _walk(grid):
        if most is not None and len(evaluated) >= most:
            break
        if ahead is not None:
            ahead(near)
        lost, dm, classes = score(node)
        own = Score(dm, lost, -classes, node)
        evaluated.append(own)
        good = lost <= limit * total
        if good:
            passed.append(own)
        settle(good)
    if not passed:
        raise PipelineError("ANON_INFEASIBLE", "No node meets k within the suppression limit", f"k={k}, limit={limit}")
    passed.sort()
    return Found(passed[0], tuple(passed[:keep]), tuple(evaluated))
