"""Distributed helpers: dense global index and size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goalcast.session import cut_lineage

# Broadcast a lookup side only when its known row count times the estimated row size
# stays within this many bytes.
BROADCAST_BYTES = 128 << 20


def row_bytes(df: DataFrame) -> int:
    """Estimated size of a hashed row: 8 bytes a fixed-width column, 40 a string, 160 a
    nested one, and 32 for the row and its slot."""
    size = {"string": 40, "binary": 40}
    return 32 + sum(size.get(kind, 160 if kind.startswith(("array", "map", "struct")) else 8) for _, kind in df.dtypes)


def broadcast_rows(df: DataFrame) -> int:
    """Rows of ``df`` that fit the broadcast bound."""
    return BROADCAST_BYTES // row_bytes(df)


def maybe_broadcast(df: DataFrame, n_rows: int | None, limit: int | None = None) -> DataFrame:
    """Broadcast ``df`` only behind a checked size (row count x estimated row bytes);
    otherwise leave the join to the planner (shuffle join, AQE skew splitting)."""
    if n_rows is not None and n_rows <= (broadcast_rows(df) if limit is None else limit):
        return F.broadcast(df)
    return df


def lookup_join(big: DataFrame, small: DataFrame, keys: list[str], n_small: int | None,
                freq_col: str | None = None, total_rows: int | None = None, how: str = "left",
                limit: int | None = None) -> DataFrame:
    """Join a large row-level table to a keyed lookup without a hot task.

    * lookup within the checked bound: broadcast hash join (no shuffle);
    * otherwise, when the lookup knows how often each key occurs on the big side
      (``freq_col``): keys seen at least ``H = total_rows / limit`` times are "heavy" -
      at most ``limit`` of them, so they are broadcast - and only the remaining light
      keys (each below H rows) go through a shuffle join. A key holding a third of all
      rows therefore never lands in one reduce task;
    * otherwise a plain shuffle join (AQE splits skewed partitions).
    ``small`` columns other than the keys are carried; ``how`` is "left" or "inner".
    """
    limit = broadcast_rows(small) if limit is None else limit
    if n_small is not None and n_small <= limit:
        return big.join(F.broadcast(small), keys, how)
    if freq_col is None or total_rows is None:
        return big.join(small, keys, how)
    hot = max(1, total_rows // limit + 1)
    heavy = small.where(F.col(freq_col) >= hot)
    light = small.where(F.col(freq_col) < hot)
    heavy_keys = heavy.select(*keys).withColumn("_heavy", F.lit(True))
    tagged = big.join(F.broadcast(heavy_keys), keys, "left")
    hot_rows = tagged.where(F.col("_heavy")).drop("_heavy").join(F.broadcast(heavy), keys, how)
    cold_rows = tagged.where(F.col("_heavy").isNull()).drop("_heavy").join(light, keys, how)
    return hot_rows.unionByName(cold_rows)


def dense_index(df: DataFrame, order: list[Column], idx_col: str = "idx",
                n_partitions: int | None = None) -> DataFrame:
    """Add a 0-based dense index following ``order`` without a global single-task sort.

    Range-partition by the order keys, sort within partitions, take the position in
    the partition, then add the row count of all earlier partitions (one small row per
    partition). The positioned table is checkpointed first so the positions and the
    counts come from the same materialisation.
    """
    parts = n_partitions or max(1, df.sparkSession.sparkContext.defaultParallelism)
    ranged = df.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    positioned = cut_lineage(ranged.select(
        "*", F.spark_partition_id().alias("_pid"), F.monotonically_increasing_id().alias("_mono")))
    offsets = (positioned.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
               .select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
                       .alias("_off")))
    # one row per partition: bounded by the partition count, safe to broadcast
    out = positioned.join(F.broadcast(offsets), "_pid")
    local = F.col("_mono") - F.shiftleft(F.col("_pid").cast("long"), 33)
    return out.select(*[c for c in df.columns],
                      (F.coalesce(F.col("_off"), F.lit(0)) + local).cast("int").alias(idx_col))
