"""Linear families (L5-L7): one proximal solver for all goals and configurations of a grid.

The solver works on vector classes (``classes``) and a weight matrix with one column per
(goal, configuration). A step is one scan: each task takes the margins of its classes for all
columns at once and sends its gradient as packed blocks of features; blocks are summed, and the
driver moves the weights. Classes lie with those of their rarest feature, so most features have their
gradient from one task and the parts of all tasks are little more than one gradient. Columns that
have converged leave the matrix. Matrices are kept below
``MATRIX_BYTES`` by taking the columns in groups, and the driver moves ``SLICE`` features at a time.

Classes that fit into one task (``LOCAL_CELLS``) need no scan a step: they are sent, packed, to a task
per group of columns, which takes all steps of its columns alone. Both ways take the same steps.
No row reaches the driver.
"""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalcast.operators.classes import joined, scored
from goalcast.operators.growth import Batch
from goalcast.session import cut_lineage

ELASTIC_MIX = 0.15  # library default l1 ratio of the elastic-net penalty
PENALTY_MIX = {"l1": 1.0, "l2": 0.0, "elasticnet": ELASTIC_MIX}
PROBABILISTIC_LOSSES = {"log", "modified_huber"}
#: Weights and gradients held at once, in the driver and in a task; partial gradients of all tasks
#: together that the driver sums itself (more are summed by blocks of features in a shuffle).
MATRIX_BYTES, DIRECT_BYTES = 96 << 20, 64 << 20
#: (class, feature) pairs, and classes, that one task holds to solve columns alone; rows and columns taken
#: at once; features moved at once.
LOCAL_CELLS, LOCAL_CLASSES, ROWS, COLUMNS, SLICE = 1 << 23, 1 << 20, 1 << 17, 16, 1 << 16


def _dloss(loss: str, y: np.ndarray, m: np.ndarray) -> np.ndarray:
    """d loss / d margin with y in {-1, +1}; hinge-type losses take the subgradient
    at the threshold (z <= 1 for hinge, z <= 0 for perceptron)."""
    z = y * m
    if loss == "hinge":
        return np.where(z <= 1, -y, 0.0)
    if loss == "squared_hinge":
        return np.where(z < 1, -2.0 * y * (1 - z), 0.0)
    if loss == "perceptron":
        return np.where(z <= 0, -y, 0.0)
    if loss == "modified_huber":
        return np.where(z >= 1, 0.0, np.where(z >= -1, -2.0 * y * (1 - z), -4.0 * y))
    if loss == "log":
        return -y / (1.0 + np.exp(np.clip(z, -50, 50)))
    raise ValueError(f"unknown loss {loss}")


#: Largest second derivative of the smooth losses (per unit of squared margin).
CURVATURE = {"log": 0.25, "squared_hinge": 2.0, "modified_huber": 2.0}

_BLOCKS = pa.schema([("block", pa.int32()), ("idx", pa.binary()), ("g", pa.binary())])


class _Rows:
    """Classes of a task, held slot by slot: the k-th features of all that have so many (longest first),
    and the rest of the few long ones as (row, feature). ``order`` has their places in the batch."""

    def __init__(self, rows: Batch, width: int):
        self.order = order = np.argsort(-rows.lens, kind="stable")
        self.n, lens, start = rows.n, rows.lens[order], rows.start[order]
        self.features, flat = None, rows.flat                  # all, or those that occur where they are fewer
        if width > len(flat):
            self.features, flat = np.unique(flat, return_inverse=True)
        self.width = width if self.features is None else len(self.features)
        many = [int(np.searchsorted(-lens, -k, side="left")) for k in range(int(lens.max(initial=0)))]
        many = [x for x in many if 8 * x >= self.n]
        self.slots = [flat[start[:x] + k] for k, x in enumerate(many)]
        more = np.maximum(0, lens - len(many))
        self.owner = np.repeat(np.arange(self.n), more)
        first = np.repeat(start + len(many) - (np.cumsum(more) - more), more)
        self.rest = flat[first + np.arange(len(first))]

    def counted(self, n: np.ndarray, y: dict[str, np.ndarray]) -> _Rows:
        """With sizes and positives of the classes."""
        self.size = n[self.order].astype(np.float64)
        self.pos = {g: v[self.order].astype(np.float64) for g, v in y.items()}
        # rows of one label each need one derivative, not one a label
        self.sign = {g: np.where(v > 0, 1.0, -1.0) if ((v == 0) | (v == self.size)).all() else None for g, v in self.pos.items()}
        return self

    def gradient(self, w: np.ndarray, columns: list[tuple[str, str]], out: np.ndarray) -> None:
        """Adds the gradient at the weights to ``out``, both (features, columns); ``columns``: (goal, loss)."""
        for lo in range(0, len(columns), COLUMNS):
            some = columns[lo:lo + COLUMNS]
            for c, (m, (goal, loss)) in enumerate(zip(self.margins(w[:, lo:lo + COLUMNS]), some)):
                g = self._sums(self._slope(m, goal, loss))
                if self.features is None:
                    out[:, lo + c] += g
                else:
                    out[self.features, lo + c] += g

    def margins(self, w: np.ndarray) -> np.ndarray:
        """(columns, rows) sums of the weights of each row's features."""
        w = np.ascontiguousarray(w if self.features is None else w[self.features])
        out = np.empty((w.shape[1], self.n))
        for lo in range(0, self.n, 1 << 12):
            part = np.zeros((min(1 << 12, self.n - lo), w.shape[1]))
            for slot in self.slots:
                f = slot[lo:lo + (1 << 12)]
                part[:len(f)] += w.take(f, axis=0)
            out[:, lo:lo + len(part)] = part.T
        if len(self.rest):
            for c in range(len(out)):
                out[c] += np.bincount(self.owner, w[self.rest, c], self.n)
        return out

    def _slope(self, m: np.ndarray, goal: str, loss: str) -> np.ndarray:
        pos, sign = self.pos[goal], self.sign[goal]
        if sign is not None:
            return self.size * _dloss(loss, sign, m)
        return pos * _dloss(loss, 1.0, m) + (self.size - pos) * _dloss(loss, -1.0, m)

    def _sums(self, d: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width)
        for slot in self.slots:
            out += np.bincount(slot, d[:len(slot)], self.width)
        if len(self.rest):
            out += np.bincount(self.rest, d[self.owner], self.width)
        return out


def _classes(batch: pa.RecordBatch, goals: list[str], width: int) -> Iterator[_Rows]:
    """The classes of a batch, ``ROWS`` at a time."""
    rows, n = Batch(batch.column("features")), batch.column("n").to_numpy()
    y = {g: batch.column(g).to_numpy(zero_copy_only=False) for g in goals}
    for lo in range(0, rows.n, ROWS):
        hi = min(rows.n, lo + ROWS)
        yield _Rows(rows.part(lo, hi), width).counted(n[lo:hi], {g: v[lo:hi] for g, v in y.items()})


def _gradient(shared, goals: list[str], columns: list[tuple[str, str]], width: int, blocks: int) -> Callable:
    """Gradient sums of a task. ``columns``: (goal, loss) of each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        total, seen = np.zeros_like(w), np.zeros(width, dtype=bool)
        for batch in joined(batches, ROWS):
            for rows in _classes(batch, goals, width):
                rows.gradient(w, columns, total)
                for f in (*rows.slots, rows.rest):
                    seen[f if rows.features is None else rows.features[f]] = True
        idx = np.flatnonzero(seen)
        cuts = np.searchsorted(idx * blocks // width, np.arange(blocks + 1))
        rows = [(i, idx[x:z].tobytes(), total[idx[x:z]].tobytes()) for i, (x, z) in enumerate(zip(cuts, cuts[1:])) if z > x]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * 3, _BLOCKS)], schema=_BLOCKS)
    return run


def _sum_blocks(columns: int) -> Callable:
    def run(table: pa.Table) -> pa.Table:
        idx = [np.frombuffer(x, dtype=np.int64) for x in table["idx"].to_pylist()]
        known = np.unique(np.concatenate(idx))
        out = np.zeros((len(known), columns))
        for i, g in zip(idx, table["g"].to_pylist()):          # in any order: sums differ by rounding only
            out[np.searchsorted(known, i)] += np.frombuffer(g).reshape(len(i), columns)
        return pa.table({"idx": pa.array([known.tobytes()], pa.binary()), "g": pa.array([out.tobytes()], pa.binary())})
    return run


def _seen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of features that a task's classes have."""
    known = np.zeros(0, dtype=np.int64)
    for batch in batches:
        known = np.union1d(known, Batch(batch.column("features")).flat)
    yield pa.RecordBatch.from_arrays([pa.array([len(known)], pa.int64())], names=["seen"])


def _homes(shared, parts: int, n_classes: int) -> Callable:
    """Adds ``home``, the rarest feature of a class (ties: the smallest; -1: none), and ``salt``, which
    spreads the classes of a home that may hold more than a quarter of a part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = shared.value
        for batch in batches:
            rows = Batch(batch.column("features"))
            order = np.lexsort((rows.flat, count[rows.flat], np.repeat(np.arange(rows.n), rows.lens)))
            home, some = np.full(rows.n, -1, dtype=np.int64), np.flatnonzero(rows.lens)
            home[some] = rows.flat[order][rows.start[some]]
            size = np.where(home >= 0, count[home], n_classes)
            salt = np.arange(rows.n) % np.maximum(1, -(-4 * parts * size // n_classes))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(home), pa.array(salt.astype(np.int64))], names=[*batch.schema.names, "home", "salt"])
    return run


def _by_home(rows: DataFrame, count: np.ndarray, n_classes: int) -> DataFrame:
    """The classes, written with those of one rarest feature together."""
    context = rows.sparkSession.sparkContext
    parts = context.defaultParallelism
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    placed = rows.mapInArrow(_homes(context.broadcast(count), parts, max(1, n_classes)), f"{kinds}, home long, salt long")
    return cut_lineage(placed.repartition(parts, "home", "salt").select(*rows.columns), "linear-classes")


@dataclass
class Linear:
    """Weights (features, jobs) of all jobs, and how their fits ended: ``steps``, ``converged``,
    ``residual`` (largest violation of the optimality conditions by a feature: gradient plus
    ridge, where the weight is not 0 moved by the l1 penalty and where it is 0 beyond it; none for
    losses without a derivative)."""

    jobs: list[tuple[str, dict]]
    weights: np.ndarray
    steps: np.ndarray
    converged: np.ndarray
    residual: np.ndarray

    def score(self, rows: DataFrame, keep: list[str]) -> DataFrame:
        """Scores (``classes.scored``) of every row and job: class 1 iff the margin is above 0;
        probabilities are the sigmoid (log) or ``(clip(m, -1, 1) + 1) / 2`` (modified_huber)."""
        shared = rows.sparkSession.sparkContext.broadcast(self.weights)   # below MATRIX_BYTES
        losses = np.array([c["loss"] for _, c in self.jobs])

        def model():
            w = shared.value

            def apply(rows_: Batch):
                rows_, m = _Rows(rows_, len(w)), np.empty((rows_.n, w.shape[1]))
                for lo in range(0, w.shape[1], COLUMNS):
                    m[rows_.order, lo:lo + COLUMNS] = rows_.margins(w[:, lo:lo + COLUMNS]).T
                prob = np.full_like(m, np.nan)
                log, huber = losses == "log", losses == "modified_huber"
                prob[:, log] = 1.0 / (1.0 + np.exp(np.clip(-m[:, log], -700, 700)))
                prob[:, huber] = (np.clip(m[:, huber], -1.0, 1.0) + 1.0) / 2.0
                return prob, m > 0
            return apply
        return scored(rows, keep, [g for g, _ in self.jobs], model)

    def save(self, spark: SparkSession, job: int, path: str) -> None:
        """K8: the weight table (i, w) of one job, with its goal, loss and penalty."""
        goal, c = self.jobs[job]
        t = pd.DataFrame({"i": np.arange(len(self.weights), dtype=np.int32), "w": self.weights[:, job]})
        spark.createDataFrame(t.assign(goal=goal, loss=c["loss"], penalty=c["penalty"], alpha=float(c["alpha"]))).write.mode("overwrite").parquet(path)


def read_linear(spark: SparkSession, path: str) -> Linear:
    t = spark.read.parquet(path).toPandas().sort_values("i")   # one weight per feature
    job = (t["goal"].iloc[0], {c: t[c].iloc[0] for c in ("loss", "penalty", "alpha")})
    return Linear([job], t[["w"]].to_numpy(), np.zeros(1, int), np.ones(1, bool), np.zeros(1))


def _shrink(x: np.ndarray, by: np.ndarray) -> np.ndarray:
    return np.sign(x) * np.maximum(np.abs(x) - by, 0.0)


def fit_linear(classes: DataFrame, jobs: list[tuple[str, dict]], width: int, iterations: int = 300, step: float = 0.5,
               tolerance: float = 5e-3) -> Linear:
    """Weights that minimise, for every job (goal, {loss, penalty, alpha}), mean loss + alpha *
    penalty over the rows of ``classes`` (features, n, goal columns) without intercept. Smooth
    losses take accelerated proximal steps with a curvature bound per feature, the others
    subgradient steps of falling size. A column is done when no weight of it moves by more than
    ``tolerance`` times its largest one; ``converged`` says which of them did within
    ``iterations`` steps."""
    size = max(1, MATRIX_BYTES // (8 * max(1, width)))
    done = [_fit_columns(classes, jobs[lo:lo + size], width, iterations, step, tolerance) for lo in range(0, len(jobs), size)]
    out = Linear(jobs, *(np.concatenate([getattr(d, f) for d in done], axis=-1) for f in ("weights", "steps", "converged", "residual")))
    if not out.converged.all():
        warnings.warn(f"{int((~out.converged).sum())} of {len(jobs)} fits not within {tolerance} after {iterations} steps", stacklevel=2)
    return out


@dataclass
class _Task:
    """Columns to solve: what ``_descend`` needs of their jobs and of the features' bounds."""

    goal: list[str]
    loss: list[str]
    rho: np.ndarray
    alpha: np.ndarray
    bound: np.ndarray
    iterations: int
    step: float
    tolerance: float

    @staticmethod
    def of(jobs: list[tuple[str, dict]], *rest) -> _Task:
        return _Task([g for g, _ in jobs], [c["loss"] for _, c in jobs], np.array([PENALTY_MIX[c["penalty"]] for _, c in jobs]),
                     np.array([float(c["alpha"]) for _, c in jobs]), *rest)

    def some(self, at: np.ndarray) -> _Task:
        return _Task([self.goal[i] for i in at], [self.loss[i] for i in at], self.rho[at], self.alpha[at], self.bound, self.iterations, self.step,
                     self.tolerance)


def _descend(task: _Task, gradient: Callable) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Weights, steps, convergence and residual of the columns. ``gradient(w, at)``: mean gradient of the
    loss at weights (features, columns ``at``), a matrix of its own."""
    width, n = len(task.bound), len(task.loss)
    seen = task.bound[:, None] > 0
    safe = np.where(seen, task.bound[:, None], 1.0)
    smooth = np.isin(task.loss, list(CURVATURE))
    ridge, lasso = task.alpha * (1 - task.rho), task.alpha * task.rho
    curvature = np.array([CURVATURE.get(x, 1.0) for x in task.loss])
    parts = [slice(lo, lo + SLICE) for lo in range(0, width, SLICE)]

    def moves(at: np.ndarray, t: int, s: slice) -> np.ndarray:
        """Step sizes per feature and column."""
        bent = np.where(seen[s], 1.0 / (curvature[at] * safe[s] + ridge[at]), 0.0)
        return np.where(smooth[at], bent, np.where(seen[s], task.step / safe[s], 0.0) / np.sqrt(t))
    weights = np.zeros((width, n))
    ahead, momentum = weights.copy(), np.ones(n)
    steps, converged = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool)
    at = np.arange(n)
    for t in range(1, task.iterations + 1):
        every = len(at) == n
        g = gradient(ahead if every else ahead[:, at], at)
        moved, largest, uphill = np.zeros(len(at)), np.zeros(len(at)), np.zeros(len(at))
        for s in parts:                                        # the new weights take the gradient's place
            eta, here, w = moves(at, t, s), ahead[s][:, at], weights[s][:, at]
            new = _shrink(here - eta * (g[s] + ridge[at] * here), eta * lasso[at])
            moved = np.maximum(moved, np.abs(new - w).max(axis=0, initial=0.0))
            largest = np.maximum(largest, np.abs(new).max(axis=0, initial=0.0))
            uphill += ((here - new) * np.where(seen[s], safe[s], 0.0) * (new - w)).sum(axis=0)
            g[s] = new
        steps[at] = t
        converged[at] = moved <= task.tolerance * np.maximum(largest, 1e-12)
        old = np.where(uphill > 0, 1.0, momentum[at])          # momentum uphill: start it anew
        later = (1 + np.sqrt(1 + 4 * old * old)) / 2
        for s in parts:
            new = g[s]
            ahead[s, at] = np.where(smooth[at], new + (old - 1) / later * (new - weights[s][:, at]), new)
            weights[s, at] = new
        momentum[at] = later
        at = at[~converged[at]]
        if not len(at):
            break
    g, off = gradient(weights, np.arange(n)), np.zeros(n)
    for s in parts:
        w = weights[s]
        slope = g[s] + ridge * w
        off = np.maximum(off, np.where(w != 0, np.abs(slope + lasso * np.sign(w)), np.maximum(np.abs(slope) - lasso, 0.0)).max(axis=0, initial=0.0))
    return weights, steps, converged, np.where(smooth, off, np.nan)


_PACKED = pa.schema([(c, pa.binary()) for c in ("lens", "flat", "n", "y")])
_SOLVED = pa.schema([("part", pa.int32()), *[(c, pa.binary()) for c in ("weights", "steps", "converged", "residual")]])


def _pack(goals: list[str]) -> Callable:
    """Classes as bytes, a row a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = Batch(batch.column("features"))
            y = np.stack([batch.column(g).to_numpy(zero_copy_only=False).astype(np.float64) for g in goals])
            values = (rows.lens.astype(np.int32), rows.flat.astype(np.int32), batch.column("n").to_numpy().astype(np.int64), y.T)
            yield pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) for v in values], schema=_PACKED)
    return run


def _solve(goals: list[str], groups: list[_Task], total: int) -> Callable:
    """All steps of the columns of a group, over all classes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, held = None, []
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("part")[i].as_py()
                held.append([np.frombuffer(batch.column(c)[i].as_py(), dtype=k) for c, k in (("lens", np.int32), ("flat", np.int32), ("n", np.int64), ("y", np.float64))])
        if part is None:
            return
        lens, flat, n, y = (np.concatenate(x) for x in zip(*held))
        held, y = None, y.reshape(-1, len(goals))
        features = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lens)).astype(np.int32)), pa.array(flat))
        task = groups[part]
        batch = pa.RecordBatch.from_arrays([features, pa.array(n), *[pa.array(y[:, i]) for i in range(len(goals))]], names=["features", "n", *goals])
        rows = list(_classes(batch, goals, len(task.bound)))

        def gradient(w: np.ndarray, at: np.ndarray) -> np.ndarray:
            out = np.zeros_like(w)
            for x in rows:
                x.gradient(w, [(task.goal[i], task.loss[i]) for i in at], out)
            return out / total
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), *[pa.array([x.tobytes()], pa.binary()) for x in _descend(task, gradient)]],
                                         schema=_SOLVED)
    return run


def _solve_alone(rows: DataFrame, goals: list[str], task: _Task, total: int) -> tuple[np.ndarray, ...]:
    """Columns dealt to tasks, each with all classes; those of equal penalties, which take about as many steps, lie apart."""
    n, width = len(task.loss), len(task.bound)
    groups = min(n, 2 * rows.sparkSession.sparkContext.defaultParallelism)
    dealt = [np.argsort(task.alpha, kind="stable")[i::groups] for i in range(groups)]
    packed = rows.mapInArrow(_pack(goals), ", ".join(f"{f.name} binary" for f in _PACKED))
    packed = packed.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).repartitionById(groups, "part")
    found = packed.mapInArrow(_solve(goals, [task.some(x) for x in dealt], total), "part int, " + ", ".join(f"{f.name} binary" for f in list(_SOLVED)[1:])).toArrow()
    out = np.zeros((width, n)), np.zeros(n, dtype=np.int64), np.zeros(n, dtype=bool), np.zeros(n)
    for i, part in enumerate(found["part"].to_pylist()):
        for x, c in zip(out, ("weights", "steps", "converged", "residual")):
            x[..., dealt[part]] = np.frombuffer(found[c][i].as_py(), dtype=x.dtype).reshape(*x.shape[:-1], -1)
    return out


def _fit_columns(classes: DataFrame, jobs: list[tuple[str, dict]], width: int, iterations: int, step: float, tolerance: float) -> Linear:
    spark = classes.sparkSession
    goals = sorted({g for g, _ in jobs})
    rows = classes.select("features", F.col("n").cast("long").alias("n"), *[F.col(g).cast("long").alias(g) for g in goals])
    size = rows.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("classes")).collect()[0]   # one row
    total = max(1, size["n"] or 0)
    # per feature: rows that have it, each weighted by its width; binary rows x of width k have
    # x x' <= k diag(x), so these bound the curvature feature by feature
    widths = (rows.select((F.size("features") * F.col("n")).alias("k"), F.explode("features").alias("idx"))
              .groupBy("idx").agg(F.sum("k").alias("k"), F.count(F.lit(1)).alias("c")).toArrow())   # at most one row a feature
    bound, count = np.zeros(width), np.zeros(width, dtype=np.int64)
    bound[widths["idx"].to_numpy()] = widths["k"].to_numpy() / total
    count[widths["idx"].to_numpy()] = widths["c"].to_numpy()
    task = _Task.of(jobs, bound, iterations, step, tolerance)
    if size["classes"] and count.sum() <= LOCAL_CELLS and size["classes"] <= LOCAL_CLASSES:
        return Linear(jobs, *_solve_alone(rows, goals, task, total))
    rows = _by_home(rows, count, size["classes"])
    parts_seen = rows.mapInArrow(_seen, "seen long").agg(F.sum("seen")).collect()[0][0] or 0   # one row
    blocks = max(1, min(width, int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def gradient(w: np.ndarray, at: np.ndarray) -> np.ndarray:
        shared = spark.sparkContext.broadcast(w)
        direct = parts_seen * len(at) * 8 <= DIRECT_BYTES
        parts = rows.mapInArrow(_gradient(shared, goals, [(task.goal[i], task.loss[i]) for i in at], width, 1 if direct else blocks),
                                "block int, idx binary, g binary")
        found = parts.toArrow() if direct else (                # below DIRECT_BYTES, or MATRIX_BYTES
            parts.groupBy("block").applyInArrow(_sum_blocks(len(at)), "idx binary, g binary").toArrow())
        shared.destroy()                                       # (the sums reached the driver)
        out = np.zeros((width, len(at)))
        for batch in found.to_batches():
            for i, g in zip(batch.column("idx"), batch.column("g")):
                out[np.frombuffer(i.as_buffer(), dtype=np.int64)] += np.frombuffer(g.as_buffer()).reshape(-1, len(at))
        out /= total
        return out
    return Linear(jobs, *_descend(task, gradient))
