"""Vector classes: rows of a set with equal features, counted by label.

No model tells rows with equal features apart, so models are scored once per class, and metrics
weigh a class by its counts. ``n`` is the number of rows, each goal column the number of its
positives; a single row is a class of ``n`` 1.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.operators.growth import Batch
from goalcast.session import cut_lineage


def vector_classes(encoded: DataFrame, goals: list[str], name: str = "classes") -> DataFrame:
    """``(class_id, set, features, n, goals...)``, written once."""
    per = encoded.groupBy("set", "features").agg(F.count(F.lit(1)).alias("n"), *[F.sum(g).cast("long").alias(g) for g in goals])
    return cut_lineage(per.select(F.monotonically_increasing_id().alias("class_id"), "set", "features", "n", *goals), name)


def joined(batches: Iterator[pa.RecordBatch], at_once: int) -> Iterator[pa.RecordBatch]:
    """Batches of at least so many rows, but for the last one."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= at_once:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, n = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def scored(rows: DataFrame, keep: list[str], goals: list[str], model: Callable, numbers: list[int] | None = None, at_once: int = 0) -> DataFrame:
    """``(keep..., job, pos, neg, prob, pred)`` of every class (or row) and job. ``goals`` names
    the goal of each job; ``model()`` gives, in a task, a function from a feature batch to
    probabilities (or None) and predictions, both (rows, jobs). Rows without a goal's column have
    no counts for its jobs. ``numbers`` are the jobs' numbers (0, 1, ...); ``at_once``: rows that the function is given
    at least, where there are so many."""
    numbers = np.arange(len(goals)) if numbers is None else np.array(numbers)
    known = sorted({g for g in goals if g in rows.columns})
    size = F.col("n").cast("long") if "n" in rows.columns else F.lit(1).cast("long")
    rows = rows.select(*keep, "features", size.alias("n"), *[F.col(g).cast("long").alias(g) for g in known if g not in keep])
    kept = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name in keep]
    width = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = model()
        for batch in joined(batches, at_once) if at_once else batches:
            if not batch.num_rows:
                continue
            prob, pred = apply(Batch(batch.column("features")))
            n, jobs = pred.shape
            size_ = batch.column("n").to_numpy()
            pos = [batch.column(g).to_numpy(zero_copy_only=False) if g in known else None for g in goals]
            for lo in range(0, jobs, 64):                      # bounded output batches
                js = range(lo, min(jobs, lo + 64))
                columns = [pa.concat_arrays([batch.column(c)] * len(js)) for c in range(width)]
                none = pa.nulls(n, pa.int64())
                columns += [pa.array(np.repeat(numbers[js.start:js.stop].astype(np.int32), n)),
                            pa.concat_arrays([none if pos[j] is None else pa.array(pos[j], pa.int64()) for j in js]),
                            pa.concat_arrays([none if pos[j] is None else pa.array(size_ - pos[j], pa.int64()) for j in js]),
                            pa.nulls(n * len(js), pa.float64()) if prob is None else _nullable(prob[:, js.start:js.stop].T.ravel()),
                            pa.array(pred[:, js.start:js.stop].T.ravel().astype(np.int32))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "job", "pos", "neg", "prob", "pred"])
    return rows.mapInArrow(run, ", ".join([*kept, "job int, pos long, neg long, prob double, pred int"]))


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, mask=np.isnan(values))
