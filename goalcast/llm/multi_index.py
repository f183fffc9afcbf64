"""Approximate nearest neighbours (cosine) with an inverted multi-index.

Unit vectors are cut into two halves, each quantised by its own codebook; the pair of codes is a
vector's cell. A query walks the cells by growing sum of its two half distances with a heap,
until the cells hold the wanted share of all rows, and every entry of a visited cell is ranked
by its exact cosine. The codebooks are fitted on a bounded sample; every row is indexed. Entries
are dealt in groups of about equal size (a full cell is dealt over several), and queries go to
the groups that hold cells they visit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.llm import packed
from goalcast.llm.vectors import best_rows, by_length, matrix, merge_best, valid_vectors
from goalcast.session import cut_lineage, read_table

#: Rows that fit the codebooks at most, codes per half, share of the rows that a query ranks,
#: rows that it ranks at least, entries in a group.
SAMPLE, CODES, SHARE, LEAST, GROUP = 20_000, 64, 0.55, 1024, 4096
#: Queries that meet a group in one task, about.
PART = 4096


def _unit(v: np.ndarray) -> np.ndarray:
    v = v / np.abs(v).max(axis=1, keepdims=True)               # no overflow of squares
    return v / np.sqrt((v * v).sum(axis=1, keepdims=True))


def _nearest(x: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return ((codes * codes).sum(axis=1)[None] - 2 * (x @ codes.T)).argmin(axis=1)


def _codebook(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced sample rows."""
    codes = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)].copy()
    for _ in range(rounds):
        near = _nearest(x, codes)
        sums, sizes = np.zeros_like(codes), np.bincount(near, minlength=len(codes))
        np.add.at(sums, near, x)
        codes[sizes > 0] = sums[sizes > 0] / sizes[sizes > 0, None]
    return codes


class MultiIndex:
    """Two codebooks and the number of rows in every cell."""

    def __init__(self, sample: np.ndarray):
        unit = _unit(sample)
        self.half = unit.shape[1] // 2
        self.codes = [_codebook(unit[:, :self.half], CODES), _codebook(unit[:, self.half:], CODES)]
        self.sizes: np.ndarray | None = None

    def cells(self, v: np.ndarray) -> np.ndarray:
        unit = _unit(v)
        return _nearest(unit[:, :self.half], self.codes[0]) * CODES + _nearest(unit[:, self.half:], self.codes[1])

    def deal(self, sizes: np.ndarray) -> int:
        """Deal cells, in chunks of at most ``GROUP`` rows, to groups; returns how many."""
        self.sizes = sizes
        self.parts = np.maximum(1, -(-sizes // GROUP))
        self.base = np.cumsum(self.parts) - self.parts
        expected = np.repeat(sizes / self.parts, self.parts)
        self.group = (np.cumsum(expected) - expected).astype(np.int64) // GROUP
        return int(self.group.max()) + 1

    def walk(self, v: np.ndarray, wanted: int) -> list[int]:
        """Cells by summed half distance until they hold ``wanted`` rows."""
        unit = _unit(v[None])[0]
        dist = [((c - h) ** 2).sum(axis=1) for c, h in zip(self.codes, (unit[:self.half], unit[self.half:]))]
        order = [np.argsort(d, kind="stable").tolist() for d in dist]
        a, b = ([float(d[x]) for x in o] for d, o in zip(dist, order))
        heap, done, out, held = [(a[0] + b[0], 0, 0)], [0] * len(a), [], 0
        while heap and held < wanted:
            _, i, j = heappop(heap)
            cell = order[0][i] * CODES + order[1][j]
            done[i] = j + 1                                    # row i is walked up to j
            if self.sizes[cell]:
                out.append(cell)
                held += int(self.sizes[cell])
            if i + 1 < len(a) and done[i + 1] == j:
                heappush(heap, (a[i + 1] + b[j], i + 1, j))
            if j + 1 < len(b) and (i == 0 or done[i - 1] > j + 1):
                heappush(heap, (a[i] + b[j + 1], i, j + 1))
        return out


def _assign(index: MultiIndex) -> Callable:
    schema = pa.schema([("row", pa.int64()), ("vec_id", pa.int64()), ("v", pa.list_(pa.float64())), ("cell", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cells = index.cells(matrix(b.column(2))) if b.num_rows else []
            yield packed.batch(schema, [b.column(0), b.column(1), b.column(2), cells])
    return run


def _entries(index: MultiIndex) -> Callable:
    schema = pa.schema([("g", pa.int64()), ("row", pa.int64()), ("vec_id", pa.int64()), ("v", pa.list_(pa.float64())),
                        ("cell", pa.int32())])

    def run(batches):
        for b in batches:
            cell = b.column(3).to_numpy()
            part = b.column(0).to_numpy().view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)
            chunk = index.base[cell] + part.astype(np.int64) % index.parts[cell]
            yield packed.batch(schema, [index.group[chunk], *b.columns])
    return run


def _visits(index: MultiIndex, wanted: int) -> Callable:
    schema = pa.schema([("g", pa.int64()), ("query", pa.int64()), ("query_id", pa.int64()), ("v", pa.list_(pa.float64())),
                        ("cells", pa.list_(pa.int32()))])

    def run(batches):
        for b in batches:
            rows, vectors = [], matrix(b.column(2)) if b.num_rows else []
            for query, vec_id, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), vectors):
                by_group: dict[int, list[int]] = {}
                for cell in index.walk(v, wanted):
                    for g in set(index.group[index.base[cell]:index.base[cell] + index.parts[cell]].tolist()):
                        by_group.setdefault(g, []).append(cell)
                rows += [(g, query, vec_id, v, cells) for g, cells in by_group.items()]
            yield packed.rows(schema, rows)
    return run


def _rerank(k: int) -> Callable:
    def run(entries: pa.Table, queries: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if entries.num_rows and queries.num_rows:
            row, ids, x = entries["row"].to_numpy(), entries["vec_id"].to_numpy(), _unit(matrix(entries["v"]))
            cells, cell = np.unique(entries["cell"].to_numpy(), return_inverse=True)
            own, qid = queries["query"].to_numpy(), queries["query_id"].to_numpy()
            q, visited = _unit(matrix(queries["v"])), queries["cells"].to_pylist()
            for lo in range(0, len(qid), 256):
                block = q[lo:lo + 256] @ x.T
                seen = np.zeros((len(block), len(cells)), dtype=bool)
                for r, c in enumerate(visited[lo:lo + 256]):
                    seen[r, np.searchsorted(cells, c)[np.isin(c, cells)]] = True
                block[~seen[:, cell]] = -np.inf
                block[row[None] == own[lo:lo + 256, None]] = -np.inf
                for r, scores in enumerate(block):
                    live = int((scores > -np.inf).sum())
                    if live:
                        # the matrix product rounds by place; near the k-th best, sum in one fixed order
                        least = np.partition(scores, -min(k, live))[-min(k, live)]
                        near = np.flatnonzero(scores >= least - 1e-9)
                        exact = (x[near] * q[lo + r]).sum(axis=1)
                        for p in best_rows(exact, ids[near], k):
                            out.append((int(own[lo + r]), int(qid[lo + r]), int(ids[near[p]]), float(exact[p])))
        columns = list(zip(*out)) if out else [[], [], [], []]
        return pa.table({"query": pa.array(columns[0], pa.int64()), "query_id": pa.array(columns[1], pa.int64()),
                         "vec_id": pa.array(columns[2], pa.int64()), "score": pa.array(columns[3], pa.float64())})
    return run


def nearest_neighbours(vectors: DataFrame, every: int = 50, k: int = 5, share: float = SHARE) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row whose vec_id is divisible by ``every``
    the ``k`` nearest rows found (vec_id, embedding; other columns are ignored), by cosine in
    double precision, ties to the smaller vec_id. A query ranks the entries of its nearest cells
    until these hold ``share`` of all rows (at least ``LEAST`` rows).

    Defined cases: null ids and vectors that are null, empty, all zero or hold null or
    non-finite components take no part; vectors of each length are searched by themselves, with
    their own index; repeated rows all stay, as queries and as candidates of one another; fewer
    candidates than ``k`` give fewer rows; an empty table gives no rows.
    """
    rows = cut_lineage(valid_vectors(vectors, nonzero=True), "vectors")
    return by_length(rows, lambda x: _search(x, every, k, share), "query_id long, rank int, vec_id long, score double")


def _search(rows: DataFrame, every: int, k: int, share: float) -> DataFrame:
    """The search among rows (row, vec_id, v) of one length."""
    sample = rows.orderBy(F.xxhash64("row"), "row").limit(SAMPLE).select("v").toArrow()   # bounded by SAMPLE
    index = MultiIndex(matrix(sample["v"]))
    indexed = cut_lineage(rows.mapInArrow(_assign(index), "row long, vec_id long, v array<double>, cell int"), "vector-cells")
    sizes = np.zeros(CODES * CODES, dtype=np.int64)
    for r in indexed.groupBy("cell").count().collect():        # at most CODES ** 2 rows
        sizes[r["cell"]] = r["count"]
    index.deal(sizes)
    wanted = max(LEAST, int(np.ceil(share * sizes.sum())))
    entries = indexed.mapInArrow(_entries(index), "g long, row long, vec_id long, v array<double>, cell int")
    queries = indexed.where(F.col("vec_id") % every == 0)
    visits = (queries.select("row", "vec_id", "v").repartition("row")   # the walks are Python work: spread them
              .mapInArrow(_visits(index, wanted), "g long, query long, query_id long, v array<double>, cells array<int>"))
    # a query visits half of the groups or more: parts of about PART queries bound what meets a group at once
    parts = max(1, -(-queries.count() // PART))
    part = F.explode(F.sequence(F.lit(0), F.lit(parts - 1))) if parts > 1 else F.lit(0)
    entries = entries.withColumn("part", part)
    visits = visits.withColumn("part", F.pmod(F.xxhash64("query"), F.lit(parts)).cast("int"))
    found = (entries.groupBy("g", "part").cogroup(visits.groupBy("g", "part"))
             .applyInArrow(_rerank(k), "query long, query_id long, vec_id long, score double"))
    return merge_best(found, k)


def op7_nearest(spark, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector."""
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"), every=50, k=5)


QUERIES = {"op7_nearest": op7_nearest}
