"""Goals: focus (P1/P2), diversity filter (P4), case weights."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.constants import KNOWN_LABELS, MIN_EXAMPLES_PER_CLASS


def goals_long(df: DataFrame, goals: list[str], keep: list[str]) -> DataFrame:
    """(keep..., goal, y): one row per (row, goal) by a narrow generator."""
    arr = F.array(*[F.struct(F.lit(g).alias("goal"), F.col(g).cast("int").alias("y")) for g in goals])
    return df.select(*keep, F.explode(arr).alias("_g")).select(*keep, "_g.goal", "_g.y")


def focus_goal(df: DataFrame, goal: str, keep: list[str]) -> DataFrame:
    """One goal as ``y``; an unknown goal is an error."""
    if goal not in df.columns:
        raise ValueError(f"the label '{goal}' is not available in the data")
    return df.select(*keep, F.col(goal).cast("int").alias("y"))


def focus_set(df: DataFrame, name: str, sets=("train", "test")) -> DataFrame:
    """One named set; an unknown name is an error."""
    if name not in sets:
        raise ValueError(f"the data set '{name}' does not exist")
    return df.where(F.col("set") == F.lit(name))


def goal_class_counts(df: DataFrame, goals: list[str]) -> DataFrame:
    """(goal, set, zeros, ones) for all goals in one aggregation (one pass)."""
    aggs = []
    for g in goals:
        aggs += [F.sum(F.when(F.col(g) == 0, 1).otherwise(0)).cast("long").alias(f"{g}__0"),
                 F.sum(F.when(F.col(g) == 1, 1).otherwise(0)).cast("long").alias(f"{g}__1")]
    per_set = df.groupBy("set").agg(*aggs)
    arr = F.array(*[F.struct(F.lit(g).alias("goal"), F.col(f"{g}__0").alias("zeros"),
                             F.col(f"{g}__1").alias("ones")) for g in goals])
    return per_set.select("set", F.explode(arr).alias("_g")).select("_g.goal", "set", "_g.zeros", "_g.ones")


def valid_goals(df: DataFrame, requested: list[str], available: list[str] | None = None,
                sets=("train", "test")) -> DataFrame:
    """(goal, position, valid). Valid iff every set has >= 10 zeros and >= 10 ones.

    Goals are lower-cased; a goal outside the known labels is an error; a known goal
    missing from the data is invalid. Request order is kept in ``position``.
    """
    goals = [g.lower() for g in requested]
    for g in goals:
        if g not in KNOWN_LABELS:
            raise ValueError(f"unknown goal: {g}")
    present = [g for g in goals if g in (available if available is not None else df.columns)]
    spark = df.sparkSession
    req = spark.createDataFrame([(g, i) for i, g in enumerate(goals)], "goal string, position int")
    if present:
        counts = goal_class_counts(df, present)
    else:
        counts = spark.createDataFrame([], "goal string, set string, zeros long, ones long")
    ok = (F.col("zeros") >= MIN_EXAMPLES_PER_CLASS) & (F.col("ones") >= MIN_EXAMPLES_PER_CLASS)
    # every requested (goal, set) pair must exist and pass: all sets counted and all ok
    per = counts.select("goal", "set", ok.alias("_ok"))
    agg = per.groupBy("goal").agg(F.bool_and("_ok").alias("_all"), F.count_distinct("set").alias("_nsets"))
    out = req.join(F.broadcast(agg), "goal", "left").select(
        "goal", "position",
        F.coalesce(F.col("_all") & (F.col("_nsets") == len(sets)), F.lit(False)).alias("valid"))
    return out


def case_weights(df: DataFrame, y: str = "y", by: list[str] | None = None) -> DataFrame:
    """per set, ``w0 = n/(2*n0)``, ``w1 = n/(2*n1)``; row weight by class, 5 decimals.

    Class counts are one small aggregation joined back by broadcast (one row per
    (set, class)), so there is no row-sized window."""
    keys = by or ["set"]
    cnt = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                                F.sum(F.col(y)).cast("long").alias("_n1"))
    w = cnt.select(*keys,
                   F.round(F.try_divide(F.col("_n"), 2.0 * (F.col("_n") - F.col("_n1"))), 5).alias("_w0"),
                   F.round(F.try_divide(F.col("_n"), 2.0 * F.col("_n1")), 5).alias("_w1"))
    out = df.join(F.broadcast(w), keys, "left")
    weight = F.when(F.col(y) == 1, F.col("_w1")).otherwise(F.col("_w0"))
    return out.withColumn("weight", weight).drop("_w0", "_w1")
