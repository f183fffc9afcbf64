"""Exact top-k inner products by dual-tree search over cover trees.

Rows are dealt in blocks by a hash of their id, queries go to every block. In each block the
queries and the rows each become a cover tree: a node's children are a farthest-first net of its
points, more than the net's radius apart and covering all points within it. A pair of nodes can
hold no score above

    <q, c> + r_q |c| + r_c |q| + r_q r_c

(centres q and c, covering radii r_q and r_c); it is pruned when that is below the worst kth
score of the query node's members. A query leaf takes its remaining row leaves best bound
first, in growing batches, so kth scores rise early.

Where products of whole components could pass 2 ** 53, doubles only choose candidates: points are
scaled to about one, bounds and scores carry a slack that covers their rounding, and what
passes is scored again in Python integers of any size.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.llm.vectors import best_rows, by_length, matrix, merge_best, valid_vectors
from goalcast.session import cut_lineage, read_table

#: Rows in a block, points in a leaf (rows, queries), children of a node, shrinking of the radius per level.
BLOCK, LEAF, QUERY_LEAF, FAN, SHRINK = 4096, 48, 12, 24, 1.3
LONG = 2 ** 63 - 1


class Node:
    """Points ``index`` around ``centre``, all within ``radius`` of it."""

    __slots__ = ("index", "centre", "norm", "radius", "children")

    def __init__(self, points: np.ndarray, index: np.ndarray, centre: int, leaf: int = LEAF):
        self.index, self.centre = index, points[centre]
        self.norm = float(np.sqrt((self.centre * self.centre).sum()))
        gaps = np.sqrt(((points[index] - self.centre) ** 2).sum(axis=1))
        self.radius, self.children = float(gaps.max()), []
        if len(index) <= leaf or self.radius == 0:
            return
        near, owner, net = gaps, np.zeros(len(index), dtype=np.int64), [centre]
        while len(net) < FAN and near.max() > self.radius / SHRINK or len(net) < 2:
            pick = int(near.argmax())                          # the point farthest from the net
            dist = np.sqrt(((points[index] - points[index[pick]]) ** 2).sum(axis=1))
            closer = dist < near
            owner[closer], near = len(net), np.minimum(near, dist)
            net.append(int(index[pick]))
        self.children = [Node(points, index[owner == x], c, leaf) for x, c in enumerate(net)]


class _Level:
    """All nodes of a tree as arrays, children after their parents."""

    def __init__(self, root: Node):
        nodes, at = [root], 0
        self.children: list[np.ndarray] = []
        while at < len(nodes):
            kids = nodes[at].children
            self.children.append(np.arange(len(nodes), len(nodes) + len(kids)))
            nodes += kids
            at += 1
        self.nodes = nodes
        self.centre = np.array([n.centre for n in nodes])
        self.radius, self.norm = (np.array([getattr(n, x) for n in nodes]) for x in ("radius", "norm"))
        self.inner = np.array([bool(n.children) for n in nodes])

    def bounds(self, q: Node, nodes: np.ndarray) -> np.ndarray:
        """No inner product of a point of ``q`` with a point of such a node is larger."""
        return (self.centre[nodes] @ q.centre + q.radius * self.norm[nodes] + self.radius[nodes] * q.norm
                + q.radius * self.radius[nodes])


class _Rows:
    """Rows of some leaves."""

    __slots__ = ("index",)

    def __init__(self, leaves: list[Node]):
        self.index = np.concatenate([x.index for x in leaves])


def whole(v: np.ndarray, scale: int) -> list[int]:
    """``floor(scale * x)`` of every component, exact whatever its size."""
    return [math.floor(scale * x) if abs(x) < 2.0 ** 52 else scale * int(x) for x in v.tolist()]


class _Search:
    """Both trees are descended together; the row nodes that a query node still faces are held
    as one array, so bounds of many pairs are one product. ``queries`` and ``rows`` are original
    vectors; ``own`` and ``row`` number the rows, and a row is no candidate of itself."""

    def __init__(self, queries, own, rows, row, row_ids, k, scale=1):
        self.own, self.row, self.xid, self.k, self.scale = own, row, row_ids, k, scale
        self.raw_q, self.raw_x, self.known = queries, rows, {}
        top = [float(np.abs(v).max(initial=0.0)) for v in (queries, rows)]
        width = queries.shape[1]
        self.exact = not (top[0] + 1) * scale * ((top[1] + 1) * scale) * width < 2.0 ** 52
        if self.exact:
            self.q, self.x = (v / max(t, 2.0 ** -900) for v, t in zip((queries, rows), top))
            # components are floored, so they are off by one of scale * top; the rest is rounding
            off = [min(1.0, 1.0 / max(t * scale, 1.0)) for t in top]
            self.slack = 4 * width * (off[0] + off[1] + off[0] * off[1] + (width + 8) * 2.0 ** -52)
        else:
            self.q, self.x = np.floor(queries * scale), np.floor(rows * scale)
            self.slack = 0.5                                   # whole scores: covers the rounding of a bound
        self.kth = np.full(len(queries), -np.inf)
        # scores and ids; exact ones as lists of (-score, id, score as compared)
        self.best: list = [[] if self.exact else (np.zeros(0), np.zeros(0, np.int64)) for _ in queries]

    def _whole(self, side: int, at: int) -> list[int]:
        if (side, at) not in self.known:
            if len(self.known) > 1 << 14:                      # bounded
                self.known.clear()
            self.known[side, at] = whole((self.raw_x if side else self.raw_q)[at], self.scale)
        return self.known[side, at]

    def _open(self, a: Node, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row nodes that may hold a better score for a member of ``a``, best bound first; the
        slack keeps ties."""
        bounds = self.tree.bounds(a, nodes)
        keep = bounds + self.slack >= self.kth[a.index].min()
        order = np.argsort(-bounds[keep], kind="stable")
        return nodes[keep][order], bounds[keep][order]

    def _leaves(self, a: Node, b: _Rows) -> None:
        """Score the queries of a leaf against some rows and keep the k best of each."""
        scores = self.q[a.index] @ self.x[b.index].T           # whole numbers are exact in doubles
        scores[self.own[a.index][:, None] == self.row[b.index][None]] = -np.inf
        margin = self.slack if self.exact else 0.0
        better = scores >= self.kth[a.index][:, None] - margin
        for r in np.flatnonzero(better.any(axis=1)):
            at, hit = int(a.index[r]), np.flatnonzero(better[r] & (scores[r] > -np.inf))
            if len(hit) > 4 * self.k:
                least = np.partition(scores[r][hit], -self.k)[-self.k]
                hit = hit[scores[r][hit] >= least - margin]
            keep = self._keep_exact if self.exact else self._keep
            keep(at, b.index[hit], scores[r][hit])

    def _keep(self, at: int, rows: np.ndarray, scores: np.ndarray) -> None:
        known, known_ids = self.best[at]
        s, i = np.append(known, scores), np.append(known_ids, self.xid[rows])
        keep = best_rows(s, i, self.k)
        self.best[at] = s[keep], i[keep]
        if len(keep) == self.k:
            self.kth[at] = s[keep[-1]]

    def _keep_exact(self, at: int, rows: np.ndarray, scores: np.ndarray) -> None:
        found = self.best[at]
        for i, s in zip(rows.tolist(), scores.tolist()):
            found.append((-sum(x * y for x, y in zip(self._whole(0, at), self._whole(1, i))), int(self.xid[i]), s))
        self.best[at] = sorted(found)[:self.k]
        if len(self.best[at]) == self.k:
            self.kth[at] = min(x[2] for x in self.best[at])

    def results(self, at: int) -> list[tuple[int, int]]:
        """(score, id) of the best rows of a query."""
        if self.exact:
            return [(-s, i) for s, i, _ in self.best[at]]
        return [(int(s), int(i)) for s, i in zip(*self.best[at])]

    def _descend(self, a: Node, nodes: np.ndarray) -> None:
        nodes, _ = self._open(a, nodes)
        if a.children:
            wide = self.tree.inner[nodes] & (self.tree.radius[nodes] >= a.radius)
            nodes = np.concatenate([nodes[~wide], *[self.tree.children[n] for n in nodes[wide]]])
            for c in a.children:
                self._descend(c, nodes)
            return
        while self.tree.inner[nodes].any():
            inner = self.tree.inner[nodes]
            nodes, _ = self._open(a, np.concatenate([nodes[~inner], *[self.tree.children[n] for n in nodes[inner]]]))
        nodes, bounds = self._open(a, nodes)
        step = 4
        while len(nodes):
            self._leaves(a, _Rows([self.tree.nodes[n] for n in nodes[:step]]))
            nodes, bounds = nodes[step:], bounds[step:]
            stay = bounds + self.slack >= self.kth[a.index].min()
            nodes, bounds, step = nodes[stay], bounds[stay], 2 * step

    def run(self) -> None:
        if not len(self.q) or not len(self.x):
            return
        a = Node(self.q, np.arange(len(self.q)), 0, QUERY_LEAF)
        self.tree = _Level(Node(self.x, np.arange(len(self.x)), 0))
        self._descend(a, np.zeros(1, dtype=np.int64))


def _key(score: int) -> str | None:
    """Text that sorts like the score, for scores that a long does not hold."""
    digits = str(abs(score))
    if abs(score) < LONG:
        return None
    return f"1{len(digits):04d}{digits}" if score > 0 else f"0{9999 - len(digits):04d}" + "".join(str(9 - int(c)) for c in digits)


def _search(k: int, scale: int) -> Callable:
    schema = pa.schema([("query", pa.int64()), ("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64()), ("key", pa.string())])

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        found = []
        if rows.num_rows and queries.num_rows:
            search = _Search(matrix(queries["v"]), queries["row"].to_numpy(), matrix(rows["v"]), rows["row"].to_numpy(),
                             rows["vec_id"].to_numpy(), k, scale)
            search.run()
            for at, (own, query) in enumerate(zip(queries["row"].to_pylist(), queries["vec_id"].to_pylist())):
                found += [(own, query, i, max(-LONG, min(LONG, s)), _key(s)) for s, i in search.results(at)]
        return pa.Table.from_batches([packed.rows(schema, found)])
    return run


def top_inner_products(vectors: DataFrame, every: int = 50, k: int = 5, scale: int = 256) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose vec_id is divisible by ``every``
    the ``k`` rows of largest integer inner product (vec_id, embedding; other columns are
    ignored), components being ``floor(scale * x)``; ties to the smaller vec_id. Exact for
    components of any size.

    Defined cases: null ids and vectors that are null, empty or hold null or non-finite
    components take no part (zero vectors do); vectors of each length are searched by themselves;
    repeated rows all stay, as queries and as candidates of one another; scores past a long rank
    by their true value and are returned as the nearest of -(2 ** 63 - 1) and 2 ** 63 - 1; fewer
    candidates than ``k`` give fewer rows; an empty table gives no rows.
    """
    rows = cut_lineage(valid_vectors(vectors, nonzero=False), "whole-vectors")
    return by_length(rows, lambda x: _search_length(x, every, k, scale), "query_id long, rank int, vec_id long, score long")


def _search_length(whole: DataFrame, every: int, k: int, scale: int) -> DataFrame:
    """The search among rows (row, vec_id, v) of one length."""
    blocks = max(1, -(-whole.count() // BLOCK))
    rows = whole.withColumn("b", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    queries = (whole.where(F.col("vec_id") % every == 0)
               .withColumn("part", F.pmod(F.xxhash64("row", F.lit(1)), F.ceil(F.lit(blocks) / every)).cast("int"))
               .withColumn("b", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    parts = -(-blocks // every)                                # query groups of about one block's size
    rows = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    found = (rows.groupBy("b", "part").cogroup(queries.groupBy("b", "part"))
             .applyInArrow(_search(k, scale), "query long, query_id long, vec_id long, score long, key string"))
    return merge_best(found, k, F.desc("key"))


def op8_cover_tree(spark, sf_dir: str) -> DataFrame:
    """The five highest integer inner products of every fiftieth vector."""
    return top_inner_products(read_table(spark, sf_dir, "embeddings"), every=50, k=5)


QUERIES = {"op8_cover_tree": op8_cover_tree}

ORACLE = {"op8_cover_tree": """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as double)) as w
  from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select q.vec_id as query_id, c.vec_id, cast(list_dot_product(q.w, c.w) as bigint) as score
  from v q join v c on q.vec_id <> c.vec_id where q.vec_id % 50 = 0)
select query_id, cast(rank as integer) as rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s) where rank <= 5
"""}
