"""Evaluation: ROC AUC (M1), log loss (M2), F1/recall/precision (M3), confusion
matrix (M4), predicted-class rates (M5), all sets side by side (M6).

Every metric is an aggregation keyed by the evaluation group (goal, config, set);
nothing is collected. AUC is exact with ties counted half:

    AUC = sum over distinct scores s of pos(s) * (neg(< s) + neg(s) / 2) / (P * N)

``neg(< s)`` is a prefix sum over the distinct scores of a group. To keep one group
from landing in a single task, the distinct scores are range-partitioned by (group, score):
prefix sums run inside the sorted partition and an offset per (group, partition) is added.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goalcast.constants import LOG_LOSS_EPS
from goalcast.session import cut_lineage


def _div0(a: Column, b: Column) -> Column:
    """a / b, 0 when undefined."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def _class_counts(scored: DataFrame, y: str = "y") -> list[Column]:
    """Class counts of scored rows, or of scored vector classes (columns ``pos`` and ``neg``)."""
    pos, neg = _classes(scored, y)
    return [F.sum(pos).cast("long").alias("_pos"), F.sum(neg).cast("long").alias("_neg")]


def _classes(scored: DataFrame, y: str) -> tuple[Column, Column]:
    return (F.col("pos"), F.col("neg")) if {"pos", "neg"} <= set(scored.columns) else (F.col(y), 1 - F.col(y))


def score_table(scored: DataFrame, group: list[str], y: str = "y", score: str = "prob",
                pred: str | None = None) -> DataFrame:
    """(group..., _s, _pos, _neg): rows folded to distinct scores with class counts and, with
    ``pred``, the counts of both classes by predicted class (tn, fp, fn, tp). One
    map-side-combined aggregation over the scored rows; every metric below is computed from this
    table."""
    s = F.nanvl(F.col(score), F.lit(None).cast("double")) if score in scored.columns else F.lit(None).cast("double")
    aggs = _class_counts(scored, y)
    if pred:
        pos, neg = _classes(scored, y)
        aggs += [F.sum(F.when(F.col(pred) == cls, v).otherwise(0)).cast("long").alias(name)
                 for name, v, cls in (("tn", neg, 0), ("fp", neg, 1), ("fn", pos, 0), ("tp", pos, 1))]
    return scored.groupBy(*group, s.alias("_s")).agg(*aggs)


def _prefix_parts(group: list[str]) -> Callable:
    """Rows sorted by group and score -> (group..., _bk, _in, _bp, _bn): a row per group of the
    partition with its positives weighed by the negatives below them inside it, and both counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done, key, sums, schema = [], None, (0.0, 0, 0), None
        for batch in batches:
            if not batch.num_rows:
                continue
            schema = schema or pa.schema([*[batch.schema.field(g) for g in group], ("_bk", pa.int32()), ("_in", pa.float64()),
                                          ("_bp", pa.int64()), ("_bn", pa.int64())])
            change = np.arange(batch.num_rows) == 0
            for g in group:
                code = batch.column(g).dictionary_encode(null_encoding="encode").indices.to_numpy()
                change[1:] |= code[1:] != code[:-1]
            start = np.flatnonzero(change)
            pos, neg = (batch.column(c).fill_null(0).to_numpy() for c in ("_pos", "_neg"))
            below = np.cumsum(neg) - neg
            below = below - np.repeat(below[start], np.diff([*start, batch.num_rows]))
            inner, p, n = (np.add.reduceat(x, start) for x in (pos * (below + neg * 0.5), pos, neg))
            for k, first in enumerate(start):
                here = [batch.column(g)[first].as_py() for g in (*group, "_bk")]
                if here != key:
                    done += [] if key is None else [[*key, *sums]]
                    key, sums = here, (0.0, 0, 0)
                sums = (sums[0] + float(inner[k]) + int(p[k]) * sums[2], sums[1] + int(p[k]), sums[2] + int(n[k]))
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*done, [*key, *sums]), schema)], schema=schema)
    return run


def roc_auc_from_table(t: DataFrame, group: list[str]) -> DataFrame:
    """Exact AUC from the folded table: distinct scores are range-partitioned by (group,
    score) - boundaries come from the scores themselves, so partitions are even whatever
    their distribution -, prefix sums run inside a sorted partition, and the cross-partition part
    sum_p P_p * N(partitions before p) is computed on one row per (group, partition)."""
    dist = t.where(F.col("_s").isNotNull()).select(*group, "_s", "_pos", "_neg")
    parts = int(t.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = dist.repartitionByRange(parts, *group, "_s").sortWithinPartitions(*group, "_s").withColumn("_bk", F.spark_partition_id())
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in placed.select(*group, "_bk").schema.fields)
    # written, so a retried task cannot see other boundaries
    per_part = cut_lineage(placed.mapInArrow(_prefix_parts(group), f"{kept}, _in double, _bp long, _bn long"), "auc-ranges")
    wo = Window.partitionBy(*group).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    per_part = per_part.withColumn("_off", F.coalesce(F.sum("_bn").over(wo), F.lit(0)))
    agg = per_part.groupBy(*group).agg(F.sum(F.col("_in") + F.col("_bp") * F.col("_off")).alias("_c"),
                                       F.sum("_bp").alias("_P"), F.sum("_bn").alias("_N"))
    auc = F.when((F.col("_P") > 0) & (F.col("_N") > 0),
                 F.col("_c") / (F.col("_P").cast("double") * F.col("_N").cast("double")))
    return agg.select(*group, auc.alias("roc_auc"))


def log_loss_from_table(t: DataFrame, group: list[str]) -> DataFrame:
    p = F.least(F.greatest(F.col("_s"), F.lit(LOG_LOSS_EPS)), F.lit(1.0 - LOG_LOSS_EPS))
    total = F.col("_pos") * -F.ln(p) + F.col("_neg") * -F.ln(1.0 - p)
    agg = t.groupBy(*group).agg(F.sum(total).alias("_l"), F.sum(F.col("_pos") + F.col("_neg")).alias("_n"),
                                F.count_if(F.col("_s").isNull()).alias("_nulls"))
    return agg.select(*group, F.when(F.col("_nulls") == 0, F.col("_l") / F.col("_n")).alias("log_loss"))


def roc_auc(scored: DataFrame, group: list[str], y: str = "y", score: str = "prob") -> DataFrame:
    """(group..., roc_auc); null when a group lacks one of the classes or has no score."""
    return roc_auc_from_table(score_table(scored, group, y, score), group)


def log_loss(scored: DataFrame, group: list[str], y: str = "y", score: str = "prob") -> DataFrame:
    """(group..., log_loss): mean of -ln p(true class), p clipped to [1e-15, 1-1e-15]."""
    return log_loss_from_table(score_table(scored, group, y, score), group)


def confusion_counts(scored: DataFrame, group: list[str], y: str = "y", pred: str = "pred") -> DataFrame:
    """M4: (group..., tn, fp, fn, tp)."""
    pos, neg = _classes(scored, y)

    def c(v, cls):
        return F.sum(F.when(F.col(pred) == cls, v).otherwise(0)).cast("long")
    return scored.groupBy(*group).agg(c(neg, 0).alias("tn"), c(neg, 1).alias("fp"), c(pos, 0).alias("fn"), c(pos, 1).alias("tp"))


def prf_columns() -> list[Column]:
    """M3 on confusion counts: positive-class F1, recall, precision (0 when undefined)."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return [_div0(2 * tp, 2 * tp + fp + fn).alias("f1"),
            _div0(tp, tp + fn).alias("recall"),
            _div0(tp, tp + fp).alias("precision")]


def rate_columns() -> list[Column]:
    """M5: ``true_positive = TP/(TP+FP)``, ``false_negative = FN/(FN+TN)`` (rates by
    predicted class), both 0 unless TP > 0 and TN > 0."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    ok = (tp > 0) & (tn > 0)
    return [F.when(ok, tp / (tp + fp).cast("double")).otherwise(0.0).alias("true_positive"),
            F.when(ok, fn / (fn + tn).cast("double")).otherwise(0.0).alias("false_negative")]


METRICS = ["roc_auc", "log_loss", "f1", "recall", "precision", "true_positive", "false_negative"]


def evaluate(scored: DataFrame, group: list[str], has_prob: bool = True) -> DataFrame:
    """All metrics per group: (group..., roc_auc, log_loss, f1, recall, precision,
    true_positive, false_negative). Without probabilities AUC and log loss are null."""
    # the folded table feeds three metric branches: materialise it once (shared storage)
    t = cut_lineage(score_table(scored, group, pred="pred") if has_prob else confusion_counts(scored, group), "score-table")
    cm = t.groupBy(*group).agg(*[F.sum(c).alias(c) for c in ("tn", "fp", "fn", "tp")])
    base = cm.select(*group, *prf_columns(), *rate_columns())
    if has_prob:
        base = base.join(roc_auc_from_table(t, group), group, "left").join(log_loss_from_table(t, group), group, "left")
    else:
        base = base.withColumn("roc_auc", F.lit(None).cast("double")).withColumn("log_loss", F.lit(None).cast("double"))
    return base.select(*group, *METRICS)


def evaluate_sets(scored: DataFrame, group: list[str], sets=("train", "test"), has_prob: bool = True) -> DataFrame:
    """M6: one row per group, metrics suffixed by set name (``roc_auc_test`` ...)."""
    per = evaluate(scored, [*group, "set"], has_prob)
    aggs = [F.max(F.when(F.col("set") == s, F.col(m))).alias(f"{m}_{s}") for s in sets for m in METRICS]
    return per.groupBy(*group).agg(*aggs)
