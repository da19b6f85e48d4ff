"""Cover trees with a dual-tree inner-product search, and vantage-point trees with relaxed pruning. Blocks of rows only."""

from __future__ import annotations

import numpy as np

LEAF = 48
VANTAGE_LEAF = 256


class Best:
    """The ``k`` best (score, row) of each query so far; ties to the smaller tie number."""

    def __init__(self, queries: int, k: int, floor: np.ndarray) -> None:
        self.k, self.floor = k, floor.astype(float)
        self.score = np.full((queries, k), -np.inf)
        self.row = np.full((queries, k), -1)
        self.tie = np.full((queries, k), np.iinfo(np.int64).max)

    def add(self, q: np.ndarray, scores: np.ndarray, rows: np.ndarray, ties: np.ndarray) -> None:
        """``scores``: a line for each of the queries ``q``, a column for each of ``rows``."""
        hit = scores >= self.floor[q][:, None]
        some = np.flatnonzero(hit.any(1))
        if not some.size:
            return
        cols = np.flatnonzero(hit.any(0))
        q, hit = q[some], hit[np.ix_(some, cols)]
        score = np.concatenate([self.score[q], np.where(hit, scores[np.ix_(some, cols)], -np.inf)], 1)
        row = np.concatenate([self.row[q], np.where(hit, rows[cols], -1)], 1)
        tie = np.concatenate([self.tie[q], np.where(hit, ties[cols], np.iinfo(np.int64).max)], 1)
        order = np.lexsort((tie, -score), axis=-1)[:, : self.k]
        self.score[q], self.row[q], self.tie[q] = (np.take_along_axis(x, order, 1) for x in (score, row, tie))
        self.floor[q] = np.maximum(self.floor[q], self.score[q, -1])

    def found(self) -> tuple[np.ndarray, np.ndarray]:
        """Queries and rows, best first within a query."""
        q, i = np.nonzero(self.row >= 0)
        return q, self.row[q, i]


class CoverTree:
    """Each child's points lie within its radius of its centre, a point of the data; the centres of a node's
    children lie further apart than the children's radius, which is the node's divided by ``base``."""

    def __init__(self, x: np.ndarray, leaf: int = LEAF, base: float = 1.5) -> None:
        self.x = x
        self.order: list[np.ndarray] = []
        center, radius, children, spans = [], [], [], []
        at = 0

        def node(c: int, points: np.ndarray, dist: np.ndarray) -> int:
            nonlocal at
            me, r = len(center), float(dist.max(initial=0.0))
            center.append(c)
            radius.append(r)
            children.append([])
            spans.append((0, 0))
            if points.size <= leaf or r == 0:
                self.order.append(points)
                spans[me] = (at, at + points.size)
                at += points.size
                return me
            limit, mine = r / base, c
            near = dist <= limit
            while True:
                children[me].append((mine, points[near], dist[near]))
                points, dist0 = points[~near], dist[~near]
                if not points.size:
                    break
                dist = dist0
                mine = int(points[dist.argmax()])  # further than the limit from every centre before it
                dist = np.sqrt(((x[points] - x[mine]) ** 2).sum(1))
                near = dist <= limit
                # what stays keeps its distance to the last centre; the next centre is the one furthest from it
            return me

        work = []
        if len(x):
            d = np.sqrt(((x - x[0]) ** 2).sum(1))
            work.append(node(0, np.arange(len(x)), d))
        while work:
            me = work.pop()
            made = [node(*c) for c in children[me]]
            children[me] = made
            work += made
        self.points = np.concatenate(self.order) if self.order else np.empty(0, np.int64)
        del self.order
        self.center, self.radius = np.array(center, np.int64), np.array(radius)
        self.children, self.spans = [np.array(c, np.int64) for c in children], spans
        self.norm = np.sqrt((x[self.center] ** 2).sum(1))


def dual_search(queries: CoverTree, data: CoverTree, best: Best, ties: np.ndarray, base: int = 0, slack: float = 1e-9) -> None:
    """Into ``best`` the largest inner products of every query; rows are numbered from ``base``.

    A pair of nodes is left out if even its closest pair of points could not reach the worst k-th score in
    the query node: <q, x> <= <cq, cx> + rq |cx| + rx |cq| + rq rx.
    """
    if not len(queries.x) or not len(data.x):
        return
    centers = data.x[data.center]

    def bounds(q: int, nodes: np.ndarray) -> np.ndarray:
        c, rq = queries.x[queries.center[q]], queries.radius[q]
        b = centers[nodes] @ c + rq * data.norm[nodes] + data.radius[nodes] * (queries.norm[q] + rq)
        return b + slack * (queries.norm[q] + rq) * (data.norm[nodes] + data.radius[nodes])

    members: dict[int, np.ndarray] = {}

    def inside(q: int) -> np.ndarray:
        if q not in members:
            lo, hi = queries.spans[q]
            members[q] = np.concatenate([inside(c) for c in queries.children[q]]) if queries.children[q].size else queries.points[lo:hi]
        return members[q]

    def kept(q: int, nodes: np.ndarray) -> np.ndarray:
        return nodes[bounds(q, nodes) >= best.floor[inside(q)].min()]

    def scan(q: int, nodes: np.ndarray) -> None:
        mine = inside(q)
        x = queries.x[mine]
        leaves = []
        while nodes.size:
            nodes = kept(q, nodes)
            inner = [data.children[n] for n in nodes if data.children[n].size]
            leaves += [n for n in nodes if not data.children[n].size]
            nodes = np.concatenate(inner) if inner else np.empty(0, np.int64)
        leaves_ = np.array(leaves, np.int64)
        b = bounds(q, leaves_)
        order = np.argsort(-b)
        at, step = 0, 4
        while at < order.size and b[order[at]] >= best.floor[mine].min():
            rows = np.concatenate([data.points[slice(*data.spans[n])] for n in leaves_[order[at : at + step]]])
            best.add(mine, x @ data.x[rows].T, rows + base, ties[rows])
            at, step = at + step, min(32, step * 2)

    stack = [(0, np.array([0]))]
    while stack:
        q, nodes = stack.pop()
        nodes = kept(q, nodes)
        if not nodes.size:
            continue
        if not queries.children[q].size:
            scan(q, nodes)
            continue
        big = [n for n in nodes if data.children[n].size and data.radius[n] >= queries.radius[q]]
        small = np.array([n for n in nodes if not (data.children[n].size and data.radius[n] >= queries.radius[q])], np.int64)
        nodes = np.concatenate([small, *(data.children[n] for n in big)])
        stack += [(c, nodes) for c in queries.children[q]]


class VantageTree:
    """Halves of the points by their distance to a vantage point, down to leaves."""

    def __init__(self, x: np.ndarray, leaf: int = VANTAGE_LEAF) -> None:
        self.x = x
        self.vantage, self.limit, self.child, self.leaf = [], [], [], []
        work = [np.arange(len(x))]
        while work:
            points = work.pop()
            self.vantage.append(-1)
            self.limit.append(0.0)
            self.child.append((-1, -1))
            self.leaf.append(points)
        if len(x):
            self._split(0, leaf)

    def _split(self, root: int, leaf: int) -> None:
        work = [root]
        while work:
            me = work.pop()
            points = self.leaf[me]
            if points.size <= leaf:
                continue
            some = points[:: max(1, points.size // 16)][:16]  # the one that spreads the others most
            d2 = [((self.x[points] - self.x[p]) ** 2).sum(1) for p in some]
            best = int(np.argmax([d.var() for d in d2]))
            d = np.sqrt(d2[best])
            limit = float(np.median(d))
            near = d <= limit
            if near.all():
                continue
            self.vantage[me], self.limit[me], self.leaf[me] = int(some[best]), limit, np.empty(0, np.int64)
            pair = []
            for part in (points[near], points[~near]):
                pair.append(len(self.vantage))
                work.append(len(self.vantage))
                self.vantage.append(-1)
                self.limit.append(0.0)
                self.child.append((-1, -1))
                self.leaf.append(part)
            self.child[me] = tuple(pair)


def vantage_search(tree: VantageTree, queries: np.ndarray, best: Best, ties: np.ndarray, factor: float, base: int = 0, slack: float = 1e-9) -> None:
    """Into ``best`` the nearest points, scored by their negative distance; rows are numbered from ``base``.

    A half is left out if ``factor`` times the distance from the query to its border exceeds the k-th
    distance so far. By the triangle inequality a factor of one leaves out nothing that counts.
    """

    def visit(n: int, q: np.ndarray) -> None:
        if not q.size:
            return
        v = tree.vantage[n]
        if v < 0:
            rows = tree.leaf[n]
            if rows.size:
                d2 = (queries[q] ** 2).sum(1)[:, None] + (tree.x[rows] ** 2).sum(1) - 2 * queries[q] @ tree.x[rows].T
                best.add(q, -np.sqrt(np.maximum(d2, 0)), rows + base, ties[rows])
            return
        d = np.sqrt(((queries[q] - tree.x[v]) ** 2).sum(1))
        gap = d - tree.limit[n]
        inner, outer = tree.child[n]
        visit(inner, q[gap <= 0])
        visit(outer, q[gap > 0])
        again = np.abs(gap) * factor <= -best.floor[q] * (1 + slack) + slack
        visit(outer, q[again & (gap <= 0)])
        again = np.abs(gap) * factor <= -best.floor[q] * (1 + slack) + slack
        visit(inner, q[again & (gap > 0)])

    visit(0, np.arange(len(queries)))
