"""U1 temporal split, U2 stratified hash split, U3 unified set."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goalcast.constants import MIN_DAYS_FOR_TEMPORAL_SPLIT, SPLIT_SEED, TRAIN_FRACTION


def day_sets(df: DataFrame, day_col: str = "day_ts") -> DataFrame:
    """(day_ts, set) for the temporal split: days sorted as integers, the first
    floor(0.75 * n_days) are train. The day table is bounded by the calendar window
    of the data (one row per day), so the single ordered window here is tiny."""
    days = df.select(F.col(day_col).alias("day_ts")).distinct().where(F.col("day_ts").isNotNull())
    w = Window.orderBy(F.col("day_ts").cast("long"))
    total = F.count(F.lit(1)).over(Window.partitionBy(F.lit(1)))
    ranked = days.select("day_ts", F.row_number().over(w).alias("_rn"), total.alias("_n"))
    n_train = F.floor(F.lit(TRAIN_FRACTION) * F.col("_n"))
    return ranked.select("day_ts", F.when(F.col("_rn") <= n_train, F.lit("train")).otherwise(F.lit("test"))
                         .alias("set"))


def hash_bucket(row_id: Column, seed: int = SPLIT_SEED) -> Column:
    """0..99 from md5 of ``seed:row_id`` (the same value in any engine with md5)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("long") % 100).cast("int")


def stratified_set(row_id: Column, seed: int = SPLIT_SEED) -> Column:
    """75/25 by a per-row hash; independent of the label, so each class is split
    in the same proportion (stratified in expectation), deterministic and shuffle-free."""
    return F.when(hash_bucket(row_id, seed) < int(TRAIN_FRACTION * 100), F.lit("train")).otherwise(F.lit("test"))


def unified(df: DataFrame) -> DataFrame:
    """Train + test as one set; other columns, so also per-set weights already
    computed, are kept as they are."""
    return df.withColumn("set", F.lit("unified"))


SPLIT_BUCKETS = 4096


def hash_order(row_id: Column, seed: int = SPLIT_SEED) -> Column:
    """Per-row pseudo-random order key from md5 (first 15 hex digits, fits a long)."""
    h = F.md5(F.concat(F.lit(f"{seed}:"), row_id.cast("string")))
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")


def stratified_exact(df: DataFrame, label: str, row_col: str = "row_id", seed: int = SPLIT_SEED,
                     buckets: int = SPLIT_BUCKETS) -> DataFrame:
    """U2 with exact per-class counts: in each class the first ``n_c - ceil(0.25 n_c)``
    rows in (hash bucket, hash, row id) order are train, the rest test.

    Distributed without a per-class sort: rows are counted per (class, bucket) - a table
    of classes x buckets rows -; cumulative counts give each class its boundary bucket;
    rows below it are train, above it test, and only the rows of the boundary bucket
    (about 1/``buckets`` of a class) are ranked, by a window partitioned by
    (class, bucket). A class holding a third of all rows is therefore never sorted in
    one task."""
    h = hash_order(F.col(row_col), seed)
    d = df.withColumn("_h", h).withColumn("_b", (F.col("_h") % buckets).cast("int"))
    per = d.groupBy(label, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    w_cls = Window.partitionBy(label)
    w_cum = Window.partitionBy(label).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("_nc", F.sum("_nb").over(w_cls))
              .withColumn("_before", F.coalesce(F.sum("_nb").over(w_cum), F.lit(0)))
              .withColumn("_ntrain", F.col("_nc") - F.ceil(F.col("_nc") * (1 - TRAIN_FRACTION)).cast("long"))
              .withColumn("_take", F.least(F.greatest(F.col("_ntrain") - F.col("_before"), F.lit(0)), F.col("_nb"))))
    # classes x buckets rows: broadcast back
    d = d.join(F.broadcast(per.select(label, "_b", "_nb", "_take")), [label, "_b"])
    full = d.where((F.col("_take") == F.col("_nb")) | (F.col("_take") == 0)) \
            .withColumn("set", F.when(F.col("_take") > 0, F.lit("train")).otherwise(F.lit("test")))
    edge = d.where((F.col("_take") > 0) & (F.col("_take") < F.col("_nb")))
    rk = F.row_number().over(Window.partitionBy(label, "_b").orderBy("_h", row_col))
    edge = edge.withColumn("set", F.when(rk <= F.col("_take"), F.lit("train")).otherwise(F.lit("test")))
    cols = [c for c in df.columns] + ["set"]
    return full.select(*cols).unionByName(edge.select(*cols))


def assign_sets(df: DataFrame, days: list, n_null_days: int, stratify_by: str, day_col: str = "day_ts",
                min_days: int = MIN_DAYS_FOR_TEMPORAL_SPLIT) -> DataFrame:
    """The flow's split from the distinct days of ``df`` (one per calendar day): U1 when there
    are at least ``min_days`` - sorted as integers, the first floor(0.75 * n) are train; the day
    table is broadcast -, else U2 stratified by one label. A row without a day has no place in
    the temporal split, so it is an error there."""
    days = sorted((d for d in days if d is not None), key=int)
    if len(days) < min_days:
        return stratified_exact(df, stratify_by)
    if n_null_days:
        raise ValueError(f"{n_null_days} rows have no {day_col}; the temporal split needs one for every row")
    n_train = math.floor(TRAIN_FRACTION * len(days))
    table = df.sparkSession.createDataFrame(
        [(d, "train" if k < n_train else "test") for k, d in enumerate(days)], f"{day_col} string, set string")
    return df.join(F.broadcast(table), day_col, "left")          # one row per day
