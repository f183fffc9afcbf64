"""Grid expansion (S8), selection (M8), scores of a configuration (M9)."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from goalcast.constants import AUC_DIFF_LIMIT, AUC_EPS, AUC_TEST_MIN


def expand_grid(space: dict) -> list[dict]:
    """Cartesian product of the options, in file order; empty space -> one empty config."""
    if not space:
        return [{}]
    names = list(space)
    return [dict(zip(names, combo)) for combo in itertools.product(*[space[n] for n in names])]


def select_best(scores: DataFrame, group: list[str], order_col: str = "config_id") -> DataFrame:
    """M8: diff = |1 - auc_test / (auc_train + 1e-11)|; valid iff diff <= 0.4 and
    auc_test >= 0.5 (null/NaN -> invalid); best = highest auc_test among valid, first
    configuration on ties. The window is partitioned by goal (configs per goal are few)."""
    auc_test = F.nanvl(F.col("roc_auc_test"), F.lit(None).cast("double"))
    auc_train = F.nanvl(F.col("roc_auc_train"), F.lit(None).cast("double"))
    diff = F.abs(1.0 - auc_test / (auc_train + AUC_EPS))
    out = scores.withColumn("roc_auc_diff", diff)
    valid = F.coalesce((F.col("roc_auc_diff") <= AUC_DIFF_LIMIT) & (auc_test >= AUC_TEST_MIN), F.lit(False))
    out = out.withColumn("valid_model", valid)
    w = Window.partitionBy(*group).orderBy(F.col("valid_model").desc(), auc_test.desc_nulls_last(), F.col(order_col))
    out = out.withColumn("_rk", F.row_number().over(w))
    return out.withColumn("best", F.col("valid_model") & (F.col("_rk") == 1)).drop("_rk")
