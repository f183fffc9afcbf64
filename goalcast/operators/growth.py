"""Level-wise growth of many trees over binary features, side by side.

Rows never move: in every level each task walks its rows through the trees grown so far, and sends
the sums of two statistics per (open node, candidate feature that the row has) in packed blocks
of nodes. The sums of the rows that lack a feature follow from the node's own. A block is reduced
and its best splits are found in one task; only the chosen splits, one row a node, reach the
driver, which holds the trees (model-sized, as they are broadcast to the tasks).

Rows that are scanned hundreds of times (boosting) lie in blocks by feature (``Postings``): a tree
moves only the rows that have its split features, and the sums of a feature are taken over its row list.

Nodes whose rows fit into one task (``LOCAL_CELLS``) need no more levels: their rows are sent,
packed, to a task per bin of nodes, which grows the rest of their trees alone. Trees on sparse
features are deep and one-sided, so this saves hundreds of scans; both ways give the same trees.
Where all rows fit, tasks are sent the rows once and grow whole trees (``grow_whole``).

A split is on a feature being present (left child) or absent (right child). Whether a feature is a
candidate of a node comes from a hash of the node's key and the feature, so no candidate lists are
kept, and a node's candidates do not depend on what else is grown.
"""

from __future__ import annotations

import tempfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

U64 = np.uint64
#: (row, tree) pairs that a task handles at once, sums that it holds before it merges them, sums that
#: a block takes from one task at most (about).
PAIRS, HELD, BLOCK_SUMS = 1 << 18, 1 << 22, 1 << 16
#: (row, feature) pairs of the rows of nodes that one task finishes, and rows of them; entries a row of
#: the node up to which the row lists of its candidates are walked rather than its rows.
LOCAL_CELLS, LOCAL_ROWS, DENSE = 1 << 23, 1 << 18, 3
#: Features per (row, feature) pair of a node up to which it keeps the sums of all features, open nodes that
#: hold such sums, and trees whose statistics are taken at once.
HELD_WIDTH, HELD_NODES, AT_ONCE = 8, 64, 8
#: Multiples of LOCAL_ROWS and LOCAL_CELLS up to which a task holds all rows with their lists in files (about 50
#: bytes a row in memory, 8 a pair in files).
WHOLE_ROWS, WHOLE_CELLS = 32, 8
#: Rows whose (row, feature) pairs are laid out at once.
PIECE_ROWS = 1 << 16
#: Sums that a task keeps by (open node, feature) rather than merging those of its blocks, and open nodes of
#: a tree up to which the row lists are summed once a node.
DENSE_SUMS, FEW = 1 << 23, 4
#: Nodes that one growth may hold (they are broadcast, about 24 bytes each).
MAX_NODES = 8_000_000


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser; wraps on purpose."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in [0, 1) from hashes."""
    return (x >> U64(11)).astype(np.float64) * 2.0 ** -53


def feature_hashes(width: int) -> np.ndarray:
    return mix(np.arange(width, dtype=U64) + U64(0x9E3779B97F4A7C15))


@dataclass
class Trees:
    """Nodes of all trees in one numbering; ``right`` is ``left + 1``, a leaf has feature -1."""

    root: np.ndarray                                           # of each tree
    tree: np.ndarray
    feature: np.ndarray
    left: np.ndarray
    a: np.ndarray                                              # first statistic (rows, or hessian)
    b: np.ndarray                                              # second one (positives, or gradient)
    gain: np.ndarray
    depth: np.ndarray
    key: np.ndarray = field(repr=False, default=None)
    by_tree: bool = False                                      # all nodes of a tree share its key

    def __len__(self) -> int:
        return len(self.feature)

    @staticmethod
    def planted(keys: np.ndarray, by_tree: bool = False) -> Trees:
        n = len(keys)
        zero = np.zeros(n)
        return Trees(np.arange(n), np.arange(n, dtype=np.int32), np.full(n, -1, np.int32), np.full(n, -1, np.int32), zero.copy(), zero.copy(),
                     zero.copy(), np.zeros(n, np.int32), keys.astype(U64), by_tree)

    def split(self, nodes: np.ndarray, feature: np.ndarray, gain: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Split nodes; ``a`` and ``b`` belong to the left children. Returns the new nodes."""
        n = len(self)
        self.feature[nodes], self.gain[nodes] = feature, gain
        self.left[nodes] = n + 2 * np.arange(len(nodes))
        pair = lambda x, y: np.stack([x, y], axis=1).ravel()
        empty = np.full(2 * len(nodes), -1, np.int32)
        keys = self.key[nodes]
        self.tree = np.append(self.tree, np.repeat(self.tree[nodes], 2))
        self.depth = np.append(self.depth, np.repeat(self.depth[nodes] + 1, 2).astype(np.int32))
        self.feature, self.left = np.append(self.feature, empty), np.append(self.left, empty)
        self.gain = np.append(self.gain, np.zeros(2 * len(nodes)))
        self.key = np.append(self.key, np.repeat(keys, 2) if self.by_tree else pair(mix(keys * U64(2) + U64(1)), mix(keys * U64(2) + U64(2))))
        self.a, self.b = np.append(self.a, pair(a, self.a[nodes] - a)), np.append(self.b, pair(b, self.b[nodes] - b))
        return np.arange(n, len(self))


class Batch:
    """Feature lists of some rows."""

    def __init__(self, features: pa.Array):
        if isinstance(features, pa.ChunkedArray):
            features = features.combine_chunks()
        self.lens = features.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        self.flat = features.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        self.start = np.cumsum(self.lens) - self.lens
        self.n = len(self.lens)

    def part(self, lo: int, hi: int) -> Batch:
        """The rows ``lo .. hi - 1``."""
        out = object.__new__(Batch)
        a = self.start[lo] if lo < self.n else len(self.flat)
        b = self.start[hi] if hi < self.n else len(self.flat)
        out.lens, out.flat, out.start, out.n = self.lens[lo:hi], self.flat[a:b], self.start[lo:hi] - a, hi - lo
        return out

    def expand(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place in ``rows``, feature) of all features of ``rows``."""
        lens = self.lens[rows]
        at = np.repeat(np.arange(len(rows)), lens)
        first = np.cumsum(lens) - lens
        return at, self.flat[np.arange(len(at)) - first[at] + self.start[rows][at]]


class Lists(Batch):
    """Feature lists of many rows, and by feature the rows that have it (``owner`` from ``first``, ``count`` of
    them). Both lie in unnamed files of the task, mapped into memory, 4 bytes a (row, feature) pair."""

    def __init__(self, parts: Iterator[pa.Array], width: int):
        held, lens, cells = tempfile.TemporaryFile(), [], 0
        for x in parts:
            part = Batch(x)
            held.write(part.flat.astype(np.int32).tobytes())
            lens.append(part.lens.astype(np.int32))
            cells += len(part.flat)
        held.flush()
        self.lens = np.concatenate(lens) if lens else np.zeros(0, np.int32)
        self.n, self.start = len(self.lens), np.cumsum(self.lens, dtype=np.int64) - self.lens
        self.flat = np.memmap(held, np.int32, "r", shape=cells) if cells else np.zeros(0, np.int32)
        self.count, self.twice = np.zeros(width, dtype=np.int64), False
        pieces = [(lo, self.part(lo, min(self.n, lo + PIECE_ROWS))) for lo in range(0, self.n, PIECE_ROWS)]
        for _, part in pieces:
            self.count += np.bincount(part.flat, minlength=width)
        self.first = np.cumsum(self.count) - self.count
        self.owner, to = np.memmap(tempfile.TemporaryFile(), np.int32, "w+", shape=cells) if cells else self.flat, self.first.copy()
        for lo, part in pieces:
            order = np.argsort(part.flat, kind="stable")
            f, row = part.flat[order], (lo + np.repeat(np.arange(part.n), part.lens))[order]
            start = np.flatnonzero(np.append(True, f[1:] != f[:-1])) if len(f) else np.zeros(0, np.int64)
            size = np.diff(start, append=len(f))
            self.owner[to[f] + np.arange(len(f)) - np.repeat(start, size)] = row
            to[f[start]] += size
            self.twice |= bool(((f[1:] == f[:-1]) & (row[1:] == row[:-1])).any())


class Postings:
    """Rows ``0 .. n - 1`` by feature: ``feature`` (sorted, each once), how many entries it has, and the
    rows of all entries, one feature after another."""

    def __init__(self, n: int, feature: np.ndarray, count: np.ndarray, owner: np.ndarray):
        self.n, self.feature, self.count, self.owner = n, feature, count.astype(np.int64), owner.astype(np.int64)
        self.first = np.cumsum(self.count) - self.count

    @staticmethod
    def of(rows: Batch) -> Postings:
        order = np.argsort(rows.flat, kind="stable")
        f = rows.flat[order]
        first = np.flatnonzero(np.append(True, f[1:] != f[:-1])) if len(f) else np.zeros(0, np.int64)
        return Postings(rows.n, f[first], np.diff(first, append=len(f)), np.repeat(np.arange(rows.n), rows.lens)[order])

    def lists(self) -> Batch:
        """The feature lists of the rows."""
        order = np.argsort(self.owner.astype(np.min_scalar_type(max(0, self.n - 1))), kind="stable")
        lens = np.bincount(self.owner, minlength=self.n)
        return Batch(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lens)).astype(np.int32)),
                                              pa.array(np.repeat(self.feature, self.count)[order].astype(np.int32))))

    def walk(self, root: np.ndarray, feature: np.ndarray, left: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(tree, mark of each row, node that each mark ends at) by tree. Rows keep the mark of their
        chain of right children, so only rows that have a split feature are moved."""
        at = np.searchsorted(self.feature, feature)
        if len(self.feature):
            at = np.minimum(at, len(self.feature) - 1)
            known = (self.feature[at] == feature) & (feature >= 0)
        else:
            known = np.zeros(len(feature), dtype=bool)
        lo = np.where(known, self.first[at] if len(self.feature) else 0, 0)
        hi = np.where(known, lo + (self.count[at] if len(self.feature) else 0), 0)
        lo, hi, feature, left = lo.tolist(), hi.tolist(), feature.tolist(), left.tolist()
        ends = np.arange(len(feature))
        for t, r in enumerate(root.tolist()):
            mark, todo = np.full(self.n, r, dtype=np.int64), [r]
            while todo:
                own = node = todo.pop()
                while feature[node] >= 0:
                    if hi[node] > lo[node]:
                        has = self.owner[lo[node]:hi[node]]
                        has = has if own == r == node else has[mark[has] == own]
                        if len(has):
                            mark[has] = left[node]
                            todo.append(left[node])
                    node = left[node] + 1
                ends[own] = node
            yield t, mark, ends


    def leaves(self, feature: np.ndarray, left: np.ndarray) -> np.ndarray:
        """Node of one tree (root 0) that each row ends at."""
        if not len(self.feature):
            return np.full(self.n, self._last(feature, left, 0), dtype=np.int64)
        at = np.minimum(np.searchsorted(self.feature, feature), len(self.feature) - 1)
        known = self.feature[at] == feature
        lo = np.where(known, self.first[at], 0)
        hi = np.where(known, lo + self.count[at], 0).tolist()
        lo, inner, down = lo.tolist(), (feature >= 0).tolist(), left.tolist()
        mark, todo, ends = np.zeros(self.n, dtype=np.int64), [0], np.arange(len(feature))
        while todo:
            own = node = todo.pop()
            while inner[node]:
                if hi[node] > lo[node]:
                    has = self.owner[lo[node]:hi[node]]
                    if own != 0 or node != 0:
                        has = has[mark[has] == own]
                    if len(has):
                        mark[has] = down[node]
                        todo.append(down[node])
                node = down[node] + 1
            ends[own] = node
        return ends[mark]

    @staticmethod
    def _last(feature: np.ndarray, left: np.ndarray, node: int) -> int:
        while feature[node] >= 0:
            node = left[node] + 1
        return node


class Walker:
    """Walks rows through trees. Trees on sparse features are long chains of right children, so pairs
    do not step through them: a pair leaves its chain at the first node whose feature its row has."""

    def __init__(self, root: np.ndarray, feature: np.ndarray, left: np.ndarray):
        n = len(feature)
        self.root, self.left = root.astype(np.int64), left.astype(np.int64)
        inner = np.flatnonzero(feature >= 0)
        self.used = np.unique(feature[inner]).astype(np.int64)
        up = np.arange(n)                                      # towards the head of a node's chain
        up[self.left[inner] + 1] = inner
        place = (up != np.arange(n)).astype(np.int64)          # nodes above it in its chain
        while True:
            further = up[up]
            if (further == up).all():
                break
            place, up = place + place[up], further
        self.head, self.place = up, place
        self.end = np.arange(n)                                # last node of the chain of a head
        ends = np.flatnonzero(feature < 0)
        self.end[up[ends]] = ends
        # nodes by (chain, feature): where a row with the feature leaves the chain
        keys = up[inner] * (len(self.used) + 1) + np.searchsorted(self.used, feature[inner])
        order = np.argsort(keys)
        self.keys, self.exits = keys[order], inner[order]

    def features(self, rows: Batch) -> np.ndarray:
        """Places in ``used`` of each row's features, side by side (past the last one: none)."""
        at, f = np.repeat(np.arange(rows.n), rows.lens), rows.flat
        place = np.minimum(np.searchsorted(self.used, f), max(0, len(self.used) - 1))
        known = self.used[place] == f if len(self.used) else np.zeros(len(f), dtype=bool)
        at, place = at[known], place[known]
        lens = np.bincount(at, minlength=rows.n)
        out = np.full((rows.n, max(1, int(lens.max(initial=0)))), len(self.used), dtype=np.int64)
        out[at, np.arange(len(at)) - np.repeat(np.cumsum(lens) - lens, lens)] = place
        return out

    def stops(self, stop: np.ndarray) -> np.ndarray:
        """Last node of each chain if nodes marked in ``stop`` are ends too."""
        out = self.end.copy()
        at = np.flatnonzero(stop)
        at = at[np.argsort(-self.place[at], kind="stable")]    # the first of a chain is written last
        out[self.head[at]] = at
        return out

    def down(self, has: np.ndarray, rows: np.ndarray, nodes: np.ndarray, ends: np.ndarray | None = None) -> np.ndarray:
        """Where the pairs (row of ``features``, node) end; ``ends`` are the chains' last nodes (``stops``)."""
        ends = self.end if ends is None else ends
        out = nodes.copy()
        live = np.arange(len(nodes))
        while len(live):
            cur = out[live]
            head = self.head[cur]
            to = ends[head]
            least = self.place[to]                             # of the nodes where a pair leaves its chain
            go = self.place[cur] < least                       # others are at an end
            live, head, to, least = live[go], head[go], to[go], least[go]
            base, own, left = head * (len(self.used) + 1), rows[live], np.zeros(len(live), dtype=bool)
            for c in range(has.shape[1]) if len(live) else ():
                key = base + has[own, c]
                at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                node = self.exits[at]
                first = np.flatnonzero((self.keys[at] == key) & (self.place[node] < least))
                least[first], to[first], left[first] = self.place[node[first]], self.left[node[first]], True
            out[live] = to
            live = live[left]
        return out


def slices(n: int, walker: Walker) -> Iterator[tuple[int, int]]:
    """Row ranges of at most about ``PAIRS`` (row, tree) pairs."""
    step = max(1, PAIRS // max(1, len(walker.root)))
    return ((lo, min(n, lo + step)) for lo in range(0, n, step))


_PARTIAL = pa.schema([("block", pa.int32()), ("key", pa.binary()), ("a", pa.binary()), ("b", pa.binary())])
_SPLIT = "node int, feature int, gain double, a double, b double"


def _merge(keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    known, inverse = np.unique(keys, return_inverse=True)
    return known, np.bincount(inverse, a, len(known)), np.bincount(inverse, b, len(known))


def _partial_sums(shared, stats: Callable, blocks: int) -> Callable:
    """Sums of a task per (open node, feature); feature ``width`` stands for the node itself."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        walker, width, place = Walker(level["root"], level["feature"], level["left"]), level["width"], level["place"]
        hashes = feature_hashes(width)
        state = stats(level)
        held, size = [], 0

        def merged():
            return _merge(*(np.concatenate(x) for x in zip(*held)))
        for batch in batches:
            for rows, a, b in _listed(batch, walker, state):
                r, t = np.nonzero(a)
                node = walker.down(walker.features(rows), r, walker.root[t])
                q = place[node]
                open_ = q >= 0
                r, t, node, q = r[open_], t[open_], node[open_], q[open_]
                at, f = rows.expand(r)
                seen = mix(level["key"][q][at] ^ hashes[f]) <= level["limit"][t][at]
                at, f = at[seen], f[seen]
                keys, sa, sb = q[at] * (width + 1) + f, a[r, t][at], b[r, t][at]
                if level["totals"]:
                    keys = np.append(keys, q * (width + 1) + width)
                    sa, sb = np.append(sa, a[r, t]), np.append(sb, b[r, t])
                held.append(_merge(keys, sa, sb))
                size += len(held[-1][0])
                if size > HELD:
                    held = [merged()]
                    size = len(held[0][0])
        if held:
            yield _by_block(*merged(), level, blocks)
    return run


def _by_block(keys: np.ndarray, a: np.ndarray, b: np.ndarray, level: dict, blocks: int) -> pa.RecordBatch:
    """Sums with sorted keys, packed by block of nodes."""
    block = keys // (level["width"] + 1) * blocks // max(1, level["open"])
    cuts = np.searchsorted(block, np.arange(blocks + 1))
    rows = [(i, keys[x:y].tobytes(), a[x:y].tobytes(), b[x:y].tobytes()) for i, (x, y) in enumerate(zip(cuts, cuts[1:])) if y > x]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 4, _PARTIAL)], schema=_PARTIAL)


def _posting_sums(shared, stats: Callable, blocks: int) -> Callable:
    """``_partial_sums`` of packed rows: sums over the row lists of the features."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        width, place, state = level["width"], level["place"], stats(level)
        hashes = feature_hashes(width)
        own = [np.flatnonzero(level["tree"] == t) for t in range(len(level["root"]))]   # open nodes of each tree
        dense = level["open"] * (width + 1) <= DENSE_SUMS
        total = np.zeros((2, level["open"] * (width + 1) if dense else 0))
        held, size = [], 0

        def merged():
            return _merge(*(np.concatenate(x) for x in zip(*held)))
        for batch in batches:
            for rows, a, b in state(batch):
                listed = np.arange(len(rows.feature))
                for t, mark, ends in rows.walk(level["root"], level["feature"], level["left"]):
                    k = len(own[t])
                    if not k:
                        continue
                    q = place[ends][mark]
                    live = (q >= 0) & (a[t] > 0)
                    slot = np.searchsorted(own[t], q) if k > 1 else np.zeros(rows.n, np.int64)
                    slot[~live] = k                            # the last place takes the other rows
                    nodes = [np.bincount(slot, x[t], k + 1)[:k] for x in (a, b)]
                    if not len(listed):
                        sums = [np.zeros((0, k))] * 2
                    elif k <= FEW:
                        sums = [np.stack([np.add.reduceat(np.where(slot == i, x[t], 0.0).take(rows.owner), rows.first) for i in range(k)], axis=1)
                                for x in (a, b)]
                    else:
                        cell = np.repeat(listed * (k + 1), rows.count) + slot.take(rows.owner)
                        sums = [np.bincount(cell, x[t].take(rows.owner), len(listed) * (k + 1)).reshape(-1, k + 1)[:, :k] for x in (a, b)]
                    f, s = np.nonzero(sums[0] > 0)
                    seen = mix(level["key"][own[t][s]] ^ hashes[rows.feature[f]]) <= level["limit"][t]
                    f, s = f[seen], s[seen]
                    keys, sa, sb = own[t][s] * (width + 1) + rows.feature[f], sums[0][f, s], sums[1][f, s]
                    if level["totals"]:
                        some = np.flatnonzero(nodes[0] > 0)
                        keys = np.append(keys, own[t][some] * (width + 1) + width)
                        sa, sb = np.append(sa, nodes[0][some]), np.append(sb, nodes[1][some])
                    if dense:
                        total[0, keys] += sa
                        total[1, keys] += sb
                        continue
                    held.append((keys, sa, sb))
                    size += len(keys)
                    if size > HELD:
                        held = [merged()]
                        size = len(held[0][0])
        if dense:
            keys = np.flatnonzero(total[0] > 0)
            yield _by_block(keys, *total[:, keys], level, blocks)
        elif held:
            yield _by_block(*merged(), level, blocks)
    return run


def _best_splits(shared, gain: Callable) -> Callable:
    """The best split of each node of a block (ties: the smallest feature); node totals as
    feature -1."""
    def run(table: pa.Table) -> pa.Table:
        level = shared.value
        width = level["width"]
        keys, a, b = _merge(*(np.frombuffer(b"".join(table[c].to_pylist()), dtype=d)
                              for c, d in (("key", np.int64), ("a", np.float64), ("b", np.float64))))
        q, f = keys // (width + 1), keys % (width + 1)
        total = f == width
        if level["totals"]:
            node_a, node_b = np.zeros(level["open"]), np.zeros(level["open"])
            node_a[q[total]], node_b[q[total]] = a[total], b[total]
        else:
            node_a, node_b = level["a"], level["b"]
        g = np.where(total, -np.inf, gain(node_a[q], node_b[q], a, b))
        some = np.flatnonzero(g > level["least_gain"])
        order = some[np.lexsort((f[some], -g[some], q[some]))]
        good = order[np.append(True, q[order][1:] != q[order][:-1])] if len(order) else order
        rows = [q[good], f[good], g[good], a[good], b[good]]
        if level["totals"]:
            rows = [np.append(x, y) for x, y in zip(rows, (q[total], np.full(total.sum(), -1), np.zeros(total.sum()), a[total], b[total]))]
        kinds = [pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.float64()]
        return pa.table({c: pa.array(x, k) for c, x, k in zip(("node", "feature", "gain", "a", "b"), rows, kinds)})
    return run


_PACKED = pa.schema([("bin", pa.int32()), *[(c, pa.binary()) for c in ("lens", "flat", "row", "node", "a", "b")]])
_KINDS = {"lens": np.int32, "flat": np.int32, "row": np.int32, "node": np.int32, "a": np.float64, "b": np.float64}
_GROWN = pa.schema([("node", pa.int32()), *[(c, pa.binary()) for c in ("feature", "left", "gain", "a", "b", "depth")]])


def _listed(batch: pa.RecordBatch, walker: Walker, state: Callable) -> Iterator[tuple[Batch, np.ndarray, np.ndarray]]:
    """Feature lists of some rows at a time, and their statistics (rows, trees)."""
    for lo, hi in slices(batch.num_rows, walker):
        part = batch.slice(lo, hi - lo)
        rows = Batch(part.column("features"))
        yield rows, *state(part, rows)


def _unpacked(batch: pa.RecordBatch, walker: Walker, state: Callable) -> Iterator[tuple[Batch, np.ndarray, np.ndarray]]:
    """``_listed`` of packed rows."""
    for block, a, b in state(batch):
        rows = block.lists()
        for lo, hi in slices(rows.n, walker):
            yield rows.part(lo, hi), a[:, lo:hi].T, b[:, lo:hi].T


def _send_rows(shared, stats: Callable, packed: bool) -> Callable:
    """Rows of the open nodes, packed by bin: feature lists of the rows, and (row, node, statistics)."""
    parts = _unpacked if packed else _listed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        walker, place, bins = Walker(level["root"], level["feature"], level["left"]), level["place"], level["bin"]
        state = stats(level)
        for batch in batches:
            for rows, a, b in parts(batch, walker, state):
                r, t = np.nonzero(a)
                q = place[walker.down(walker.features(rows), r, walker.root[t])]
                r, t, q = r[q >= 0], t[q >= 0], q[q >= 0]
                order = np.argsort(bins[q], kind="stable")
                r, t, q = r[order], t[order], q[order]
                found, out = bins[q], []
                cuts = np.append(np.flatnonzero(np.append(True, found[1:] != found[:-1])), len(q)) if len(q) else []
                for x, y in zip(cuts[:-1], cuts[1:]):
                    own, local = np.unique(r[x:y], return_inverse=True)
                    values = {"lens": rows.lens[own], "flat": rows.expand(own)[1], "row": local, "node": q[x:y],
                              "a": a[r[x:y], t[x:y]], "b": b[r[x:y], t[x:y]]}
                    out.append((int(found[x]), *[values[c].astype(k).tobytes() for c, k in _KINDS.items()]))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _PACKED)], schema=_PACKED)
    return run


def _candidates(key: np.ndarray, hashes: np.ndarray, limit: U64, piece: int = 1 << 13) -> np.ndarray:
    """Features whose hash with the key is at most the limit, some at a time so that they stay in the processor's cache."""
    return np.concatenate([(mix(key ^ hashes[lo:lo + piece]) <= limit).nonzero()[0] + lo for lo in range(0, len(hashes), piece)])


class _Alone:
    """Growth of single nodes in one task, over rows held as feature lists and, by feature, as row
    lists. The rows that have the split feature leave with a new mark and the others keep theirs,
    so a split costs as many steps as its feature has rows, not as the node has."""

    def __init__(self, rows: Batch, width: int, gain: Callable, splittable: Callable, least_gain: float, by_tree: bool):
        self.rows, self.width, self.gain, self.splittable = rows, width, gain, splittable
        self.least_gain, self.by_tree, self.hashes = least_gain, by_tree, feature_hashes(width)
        order = np.argsort(rows.flat, kind="stable")
        self.owner = np.repeat(np.arange(rows.n), rows.lens)[order]   # rows of each feature
        same = self.owner[1:] == self.owner[:-1]
        self.twice = bool((same & (rows.flat[order][1:] == rows.flat[order][:-1])).any())   # a row has a feature twice
        self.count = np.bincount(rows.flat, minlength=width)
        self.first = np.cumsum(self.count) - self.count
        self.mean = len(rows.flat) / max(1, rows.n)
        longest = int(rows.lens.max(initial=0))
        self.padded = None                                            # feature lists side by side, where about as long
        if rows.n * longest <= 4 * len(rows.flat):
            self.padded = np.full((rows.n, longest), width, dtype=np.int64)
            self.padded[np.repeat(np.arange(rows.n), rows.lens), np.arange(len(rows.flat)) - np.repeat(rows.start, rows.lens)] = rows.flat
        self.mark = np.full(rows.n, -1, dtype=np.int64)               # of the open node that holds each row
        self.a, self.b = np.zeros(rows.n), np.zeros(rows.n)

    @classmethod
    def over(cls, lists: Lists, width: int, gain: Callable, splittable: Callable, least_gain: float, by_tree: bool) -> _Alone:
        """Over rows and row lists that lie in files."""
        out = object.__new__(cls)
        out.rows, out.width, out.gain, out.splittable, out.least_gain, out.by_tree = lists, width, gain, splittable, least_gain, by_tree
        out.hashes, out.owner, out.count, out.first, out.twice = feature_hashes(width), lists.owner, lists.count, lists.first, lists.twice
        out.mean, out.padded = len(lists.flat) / max(1, lists.n), None
        out.mark, out.a, out.b = np.full(lists.n, -1, dtype=np.int32), np.zeros(lists.n), np.zeros(lists.n)
        return out

    def _sums(self, cand: np.ndarray, mark: int, pool: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the node's rows that have each candidate, from the row lists of the candidates or from
        the feature lists of the rows, whichever are shorter."""
        lens = self.count[cand]
        total = int(lens.sum())
        if total <= DENSE * size:
            at = np.repeat(np.arange(len(cand)), lens)
            row = self.owner[np.arange(total) + np.repeat(self.first[cand] - (np.cumsum(lens) - lens), lens)]
            here = self.mark[row] == mark
            at, row = at[here], row[here]
            return np.bincount(at, self.a[row], len(cand)), np.bincount(at, self.b[row], len(cand))
        own = pool[self.mark[pool] == mark]
        if self.padded is None:
            at, f = self.rows.expand(own)
            a, b = self.a[own][at], self.b[own][at]
        else:
            f = self.padded[own].ravel()
            a, b = (np.repeat(x[own], self.padded.shape[1]) for x in (self.a, self.b))
        return np.bincount(f, a, self.width)[cand], np.bincount(f, b, self.width)[cand]

    def _held(self, size: int) -> bool:
        """Whether a node of so many rows keeps the sums of all features: its right child has them by
        subtraction. Exact: statistics are counts, or multiples of one step."""
        return self.width <= HELD_WIDTH * size * self.mean

    def _all(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of the rows (each once) by feature."""
        if self.padded is not None:
            f = self.padded[rows].ravel()
            a, b = (x[rows].repeat(self.padded.shape[1]) for x in (self.a, self.b))
            return np.bincount(f, a, self.width + 1)[:-1], np.bincount(f, b, self.width + 1)[:-1]
        sums = np.zeros((2, self.width))
        for lo in range(0, len(rows), PIECE_ROWS):
            some = rows[lo:lo + PIECE_ROWS]
            if len(rows) == self.rows.n:                       # all rows, in order: their lists lie in a row
                part = self.rows.part(lo, lo + len(some))
                f, lens = part.flat.astype(np.int64), part.lens
                a, b = (np.repeat(x[lo:lo + len(some)], lens) for x in (self.a, self.b))
            else:
                at, f = self.rows.expand(some)
                a, b = self.a[some][at], self.b[some][at]
            if len(f):
                sums[0] += np.bincount(f, a, self.width)
                sums[1] += np.bincount(f, b, self.width)
        return sums[0], sums[1]

    def grow(self, tree: int, depth: int, key: np.ndarray, limit: U64, rows: np.ndarray, a: np.ndarray, b: np.ndarray,
             leaves: bool = False) -> dict[str, np.ndarray]:
        """Nodes of the subtree, the node itself first; ``left`` counts from it. ``leaves``: also the node that
        each row ends at."""
        out = {c: [] for c in ("feature", "left", "gain", "a", "b", "depth")}

        def add(depth, sa, sb):
            for c, v in zip(out, (-1, -1, 0.0, sa, sb, depth)):
                out[c].append(v)
            return len(out["a"]) - 1
        every = len(rows) == self.rows.n and bool((rows[1:] > rows[:-1]).all())
        if every:                                              # all rows, in order
            self.a, self.b = a, b
            self.mark[:] = 0
        else:
            self.a[rows], self.b[rows], self.mark[rows] = a, b, 0
        node = add(depth, float(a.sum()), float(b.sum()))
        # pool: rows that may be the node's, at most twice too many
        todo = [(node, 0, rows, len(rows), key, None)] if self.splittable(tree, depth, out["a"][0], out["b"][0]) else []
        twice, one_two, cand = U64(2), np.array([1, 2], dtype=U64), None
        while todo:
            node, mark, pool, size, key, sums = todo.pop()
            level, sa, sb = out["depth"][node], out["a"][node], out["b"][node]
            if cand is None or not self.by_tree:               # with by_tree those of all nodes
                cand = _candidates(key, self.hashes, limit)
            held = self._held(size)
            if held and sums is None:
                sums = self._all(pool if len(pool) == size else pool[self.mark[pool] == mark])
            la, lb = (x[cand] for x in sums) if held else self._sums(cand, mark, pool, size)
            some = la.nonzero()[0]
            la, lb = la[some], lb[some]
            g = self.gain(sa, sb, la, lb)
            best = int(g.argmax()) if len(g) else -1           # ties: the smallest feature
            if best < 0 or not g[best] > self.least_gain:
                continue
            feature = int(cand[some[best]])
            has = self.owner[self.first[feature]:self.first[feature] + self.count[feature]]
            has = has[self.mark[has] == mark]
            if self.twice:
                has = has[np.append(True, has[1:] != has[:-1])]
            out["feature"][node], out["gain"][node] = feature, float(g[best])
            xa, xb = float(la[best]), float(lb[best])
            left, right = add(level + 1, xa, xb), add(level + 1, sa - xa, sb - xb)
            out["left"][node] = left
            keys = np.repeat(key, 2) if self.by_tree else mix(key * twice + one_two)
            self.mark[has] = left
            down, on = self.splittable(tree, level + 1, xa, xb), self.splittable(tree, level + 1, sa - xa, sb - xb)
            rest, own = size - len(has), None
            keep = on and held and len(todo) < HELD_NODES and self._held(rest)
            if keep or (down and self._held(len(has))):
                own = self._all(has)
            if on:
                if len(pool) > 2 * rest:
                    pool = pool[self.mark[pool] == mark]
                todo.append((right, mark, pool, rest, keys[1:], (sums[0] - own[0], sums[1] - own[1]) if keep else None))
            if down:                                           # first, so that few nodes wait with their sums
                todo.append((left, left, has, len(has), keys[:1], own if self._held(len(has)) else None))
        ends = np.arange(len(out["a"]))
        for node in range(len(ends) - 1, -1, -1) if leaves else ():   # children come after their parents
            if out["feature"][node] >= 0:
                ends[node] = ends[out["left"][node] + 1]
        found = {"leaf": ends[self.mark if every else self.mark[rows]]} if leaves else {}
        self.mark[slice(None) if every else rows] = -1
        return found | {c: np.array(v, dtype=np.float64 if c in ("gain", "a", "b") else np.int32) for c, v in out.items()}


def _finish(shared, gain: Callable, splittable: Callable) -> Callable:
    """The rest of the trees below the open nodes of a bin."""
    def run(table: pa.Table) -> pa.Table:
        level = shared.value
        parts = [{c: np.frombuffer(x, dtype=k) for (c, k), x in zip(_KINDS.items(), row)} for row in zip(*(table[c].to_pylist() for c in _KINDS))]
        first = np.cumsum([0] + [len(p["lens"]) for p in parts])
        flat, lens = np.concatenate([p["flat"] for p in parts]), np.concatenate([p["lens"] for p in parts])
        rows = Batch(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lens)).astype(np.int32)), pa.array(flat)))
        row, node = np.concatenate([p["row"] + x for p, x in zip(parts, first)]), np.concatenate([p["node"] for p in parts])
        a, b = (np.concatenate([p[c] for p in parts]) for c in ("a", "b"))
        alone = _Alone(rows, level["width"], gain, splittable, level["least_gain"], level["by_tree"])
        order, out = np.argsort(node, kind="stable"), []
        cuts = np.append(np.flatnonzero(np.append(True, np.diff(node[order]) > 0)), len(node))
        for x, y in zip(cuts[:-1], cuts[1:]):
            at = order[x:y]
            q = int(node[at[0]])
            tree = int(level["tree"][q])
            grown = alone.grow(tree, int(level["depth"][q]), level["key"][q:q + 1], level["limit"][tree], row[at], a[at], b[at])
            out.append((q, *[grown[c].tobytes() for c in ("feature", "left", "gain", "a", "b", "depth")]))
        return pa.Table.from_batches([pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _GROWN)], schema=_GROWN)])
    return run


def fits(n_rows: int, cells: int) -> bool:
    """Whether one task may hold all rows."""
    return n_rows <= LOCAL_ROWS and cells <= LOCAL_CELLS


def fits_files(n_rows: int, cells: int) -> bool:
    """Whether one task may hold all rows with their lists in files (``Lists``)."""
    return n_rows <= WHOLE_ROWS * LOCAL_ROWS and cells <= WHOLE_CELLS * LOCAL_CELLS


_WHOLE = pa.schema([("tree", pa.int32()), *[(c, pa.binary()) for c in ("feature", "left", "a", "b")]])


def grow_whole(rows: DataFrame, small: bool, width: int, keys: np.ndarray, limit: np.ndarray, stats: Callable, gain: Callable, splittable: Callable,
               least_gain: float = 1e-9) -> list[tuple[np.ndarray, ...]]:
    """The trees of ``grow`` over counted statistics, by tasks that hold all rows (in memory if ``small``, see ``fits``): per tree its
    feature, left child (its root is node 0) and both statistics, as 32-bit integers. ``stats`` gets the trees it is
    asked for as ``some``."""
    parts = min(len(keys), rows.sparkSession.sparkContext.defaultParallelism)
    names = [c for c in rows.columns if c != "features"]

    def slim(batch: pa.RecordBatch) -> pa.RecordBatch:
        """What ``stats`` reads, copied, so that the batch's features are not kept."""
        columns = [batch.column(c) for c in names]
        columns = [x.dictionary_encode() if pa.types.is_string(x.type) else pa.array(x.to_numpy(zero_copy_only=False).copy(), x.type, from_pandas=True) for x in columns]
        return pa.RecordBatch.from_arrays(columns, names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = [], []

        def lists():
            for batch in batches:
                if batch.num_rows:
                    held.append(slim(batch))
                    part[:] = [batch.column("part")[0].as_py()]
                    yield batch.column("features")
        if small:
            features = list(lists())
            alone = _Alone(Batch(pa.chunked_array(features)), width, gain, splittable, least_gain, False) if features else None
        else:
            alone = _Alone.over(Lists(lists(), width), width, gain, splittable, least_gain, False)
        if not part:
            return
        mine = np.arange(part[0], len(keys), parts)
        at_once = AT_ONCE if small else 1
        for lo in range(0, len(mine), at_once):
            some = mine[lo:lo + at_once]
            state = stats({"some": some})
            a, b = (np.concatenate(x) for x in zip(*(state(batch, None) for batch in held)))
            for k, tree in enumerate(some):
                at = np.flatnonzero(a[:, k])
                grown = alone.grow(tree, 0, keys[tree:tree + 1], limit[tree], at, a[at, k], b[at, k])
                yield pa.RecordBatch.from_arrays([pa.array([tree], pa.int32()), *[pa.array([grown[c].astype(np.int32).tobytes()], pa.binary())
                                                                                  for c in _WHOLE.names[1:]]], schema=_WHOLE)
    spread = rows.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))).repartitionById(parts, "part")
    found = spread.mapInArrow(run, "tree int, " + ", ".join(f"{c} binary" for c in _WHOLE.names[1:])).toArrow()   # the nodes of the trees
    out = [(np.full(1, -1, np.int32), np.full(1, -1, np.int32), np.zeros(1, np.int32), np.zeros(1, np.int32))] * len(keys)
    for batch in found.to_batches():
        for i, tree in enumerate(batch.column("tree").to_pylist()):
            out[tree] = tuple(np.frombuffer(batch.column(c)[i].as_py(), dtype=np.int32) for c in _WHOLE.names[1:])
    if sum(len(x[0]) for x in out) > MAX_NODES:
        raise ValueError(f"more than {MAX_NODES} nodes: grow fewer trees at a time or larger nodes")
    return out


def _bins(size: np.ndarray, n_rows: int, room: int, tasks: int) -> np.ndarray:
    """Bin of each node, by its rows at most: as many bins as keep the tasks busy, and none with more
    rows than one task may hold (all rows at most, since nodes of several trees share them)."""
    if n_rows <= room:
        return (np.arange(len(size)) * min(len(size), 4 * tasks) // max(1, len(size))).astype(np.int32)
    return ((np.cumsum(size) - size) // room).astype(np.int32)


def grow(rows: DataFrame, n_rows: int, width: int, keys: np.ndarray, limit: np.ndarray, stats: Callable, gain: Callable,
         splittable: Callable, by_tree: bool = False, least_gain: float = 1e-9, tasks: int | None = None, counted: bool = False,
         cells: int | None = None, packed: bool = False) -> Trees:
    """Grow one tree per key over the ``n_rows`` rows (``features array<int>`` below ``width`` and what
    ``stats`` reads). ``stats(level)`` returns a function of a batch that gives both statistics as
    (row, tree) matrices, where 0 in the first leaves a row out of a tree; ``counted`` says that
    the first one counts rows (1 or more each). ``gain(a, b, left a, left b)`` rates splits;
    ``splittable(tree, depth, a, b)`` says which nodes may be split; a feature is a candidate
    if its hash with the node's key (with ``by_tree`` the tree's) is at most the tree's ``limit``.
    ``tasks`` is the number of partitions of ``rows`` and ``cells`` their (row, feature) pairs, where
    known. With ``packed`` (and ``cells``) a row of ``rows`` is a block: ``stats(level)`` returns a function of a
    batch that gives, block by block, its ``Postings`` and both statistics as (tree, row) matrices."""
    context = rows.sparkSession.sparkContext
    tasks = tasks or max(1, rows.rdd.getNumPartitions())
    trees = Trees.planted(keys, by_tree)
    if cells is None:
        cells = rows.agg(F.sum(F.size("features"))).collect()[0][0] or 0   # one row
    room = min(LOCAL_ROWS, LOCAL_CELLS * max(1, n_rows) // max(1, cells, n_rows))
    open_, totals = np.arange(len(trees)), True

    def may(nodes):
        return splittable(trees.tree[nodes], trees.depth[nodes], trees.a[nodes], trees.b[nodes])
    while len(open_):
        if len(trees) > MAX_NODES:
            raise ValueError(f"more than {MAX_NODES} nodes: grow fewer trees at a time or larger nodes")
        size = trees.a[open_] if counted and not totals else np.full(len(open_), n_rows)
        small = size <= room
        if small.any() and (small.all() or n_rows > room):
            _grow_alone(context, rows, trees, open_[small], size[small], n_rows, room, width, limit, stats, gain, splittable, least_gain, tasks, packed)
            open_ = open_[~small]
            continue
        level = _level(trees, open_, width, limit, least_gain) | {"totals": totals}
        sums = len(open_) * max(1.0, min(width, float((limit / 2.0 ** 64).max()) * width))
        blocks = int(max(1, min(len(open_), max(min(tasks, sums // 2048), sums // BLOCK_SUMS))))
        shared = context.broadcast(level)
        partial = (_posting_sums if packed else _partial_sums)(shared, stats, blocks)
        found = (rows.mapInArrow(partial, "block int, key binary, a binary, b binary")
                 .repartition(blocks, "block").groupBy("block").applyInArrow(_best_splits(shared, gain), _SPLIT).toArrow())   # one row a node
        shared.unpersist()
        node, feature, g, a, b = (found[c].to_numpy() for c in ("node", "feature", "gain", "a", "b"))
        if totals:
            own = feature < 0
            trees.a[open_[node[own]]], trees.b[open_[node[own]]] = a[own], b[own]
            totals = False
            use = ~own & may(open_)[node]
            node, feature, g, a, b = (x[use] for x in (node, feature, g, a, b))
        order = np.argsort(node)
        new = trees.split(open_[node[order]], feature[order], g[order], a[order], b[order])
        open_ = new[may(new)]
    return trees


def _level(trees: Trees, open_: np.ndarray, width: int, limit: np.ndarray, least_gain: float) -> dict:
    """What tasks need of the trees and their open nodes."""
    place = np.full(len(trees), -1, dtype=np.int64)
    place[open_] = np.arange(len(open_))
    return {"root": trees.root, "feature": trees.feature, "left": trees.left, "place": place, "key": trees.key[open_], "tree": trees.tree[open_],
            "depth": trees.depth[open_], "limit": limit, "width": width, "open": len(open_), "a": trees.a[open_], "b": trees.b[open_],
            "least_gain": least_gain, "by_tree": trees.by_tree}


def _grow_alone(context, rows: DataFrame, trees: Trees, open_: np.ndarray, size: np.ndarray, n_rows: int, room: int, width: int, limit: np.ndarray,
                stats: Callable, gain: Callable, splittable: Callable, least_gain: float, tasks: int, packed: bool) -> None:
    """Finish the open nodes, each in the task of its bin, and add what they grew to the trees."""
    bins = _bins(size, n_rows, room, tasks)
    shared = context.broadcast(_level(trees, open_, width, limit, least_gain) | {"bin": bins})
    kinds = ", ".join(f"{c} binary" for c in _KINDS)
    # the bins are small to send and long to grow: a stated number of partitions keeps them apart
    found = (rows.mapInArrow(_send_rows(shared, stats, packed), f"bin int, {kinds}").repartition(2 * (int(bins.max()) + 1), "bin")
             .groupBy("bin").applyInArrow(_finish(shared, gain, splittable),
                                          "node int, feature binary, left binary, gain binary, a binary, b binary, depth binary").toArrow())
    shared.unpersist()                                         # (the nodes of the trees reached the driver)
    q = open_[found["node"].to_numpy()] if found.num_rows else np.zeros(0, np.int64)
    grown = {c: [np.frombuffer(x, dtype=np.float64 if c in ("gain", "a", "b") else np.int32) for x in found[c].to_pylist()]
             for c in ("feature", "left", "gain", "a", "b", "depth")}
    more = np.array([len(x) - 1 for x in grown["a"]], dtype=np.int64)
    first = len(trees) + np.cumsum(more) - more                # where the nodes below each open node start
    for i, node in enumerate(q):
        for c in ("feature", "gain", "a", "b"):
            getattr(trees, c)[node] = grown[c][i][0]
        if more[i]:
            trees.left[node] = first[i] + grown["left"][i][0] - 1
    if not len(q) or not more.sum():
        return
    tail = {c: np.concatenate([x[1:] for x in v]) for c, v in grown.items()}
    at = np.repeat(first, more)
    trees.left = np.append(trees.left, np.where(tail["left"] >= 0, tail["left"] - 1 + at, -1))
    trees.tree = np.append(trees.tree, np.repeat(trees.tree[q], more))
    trees.key = np.append(trees.key, np.zeros(int(more.sum()), U64))   # finished: no key is needed
    for c in ("feature", "gain", "a", "b", "depth"):
        setattr(trees, c, np.append(getattr(trees, c), tail[c]))
