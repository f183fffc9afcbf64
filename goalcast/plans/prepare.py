"""Build the canonical encoded impressions table.

``(row_id, day_ts, set, features array<int>, <goal columns>)``, hash-partitioned by
``row_id`` and checkpointed once per run in the shared checkpoint folder, so every
later job (counts, scoring, metrics, ML fits) reads the compact encoded rows and a
lost executor recomputes from the checkpoint, not from the raw tables.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalcast.functions import columns as C
from goalcast.operators.features import FeatureDictionary, one_hot
from goalcast.operators.splits import assign_sets
from goalcast.plans.fixtures import (FIXTURE_ATTRIBUTE_COLUMNS, FIXTURE_GOALS, FIXTURE_LIST_COLUMNS,
                                     FIXTURE_RARITY, impressions)
from goalcast.session import cut_lineage_observed


def derive_raw_features(df: DataFrame) -> DataFrame:
    """F1, F2, F3 on the raw columns (the order matters: F2 reads F1)."""
    df = df.withColumn("country_state", C.country_state())
    df = df.withColumn("country_state_city", C.country_state_city())
    return df.withColumn("HOW", C.hour_of_week("timestamp", "timezone_offset"))


@dataclass
class Prepared:
    encoded: DataFrame
    dictionary: FeatureDictionary
    goals: list[str]


def prepare_encoded(raw: DataFrame, attribute_cols: list[str], list_cols: list[str], goals: list[str],
                    threshold: int, families: list[str] | None = None,
                    constant_feature: bool = False) -> Prepared:
    derived = derive_raw_features(raw)
    carry = ["row_id", "day_ts", *goals]
    enc, dic = one_hot(derived, attribute_cols, list_cols, carry, threshold, families, constant_feature)
    # the distinct days (one entry per calendar day) come from the written day column;
    # the split is attached on read
    enc, stats = cut_lineage_observed(enc.select("row_id", "day_ts", "features", *goals), "encoded",
                                      {"days": F.collect_set("day_ts"), "no_day": F.count_if(F.col("day_ts").isNull())})
    enc = assign_sets(enc, list(stats["days"] or []), stats["no_day"], goals[0])
    return Prepared(encoded=enc.select("row_id", "day_ts", "set", "features", *goals), dictionary=dic, goals=goals)


def prepared_impressions(spark: SparkSession, sf_dir: str, threshold: int = FIXTURE_RARITY,
                         families: list[str] | None = None, constant_feature: bool = False) -> Prepared:
    raw = impressions(spark, sf_dir)
    return prepare_encoded(raw, FIXTURE_ATTRIBUTE_COLUMNS, FIXTURE_LIST_COLUMNS, FIXTURE_GOALS,
                           threshold, families, constant_feature)
