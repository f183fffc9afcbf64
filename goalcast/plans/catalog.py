"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Work shared by several queries (the encoded impressions table, the Bayes counts) is
built once per (session, data folder, parameters) and checkpointed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from goalcast.functions import columns as C
from goalcast.operators import bayes as B
from goalcast.operators import labels as L
from goalcast.operators import metrics as M
from goalcast.operators import selection as S
from goalcast.operators import splits as U
from goalcast.operators.features import feature_cells, feature_dictionary, level_counts, one_hot, rare_levels
from goalcast.constants import LOCATION_FAMILIES, HYPER_PARAMETERS
from goalcast.plans.fixtures import (FIXTURE_ATTRIBUTE_COLUMNS, FIXTURE_GOALS, FIXTURE_LIST_COLUMNS,
                                     FIXTURE_RARITY, impressions)
from goalcast.plans import training as TR
from goalcast.plans.prepare import Prepared, derive_raw_features, prepared_impressions
from goalcast.session import cut_lineage, prepare, read_table

ROUND = 6
GRID_THRESHOLDS = HYPER_PARAMETERS["POLY2BAYES"]["rarity_threshold"]
SCORE_THRESHOLD = 5
_memo: dict = {}


def _key(spark: SparkSession, *parts):
    """Memo key: the running application (a recreated context never sees tables bound
    to a stopped one) and the session."""
    return (spark.sparkContext.applicationId, spark._jsparkSession.hashCode(), *parts)


def prepared(spark: SparkSession, sf_dir: str, threshold: int = FIXTURE_RARITY,
             families: tuple | None = None, constant_feature: bool = False) -> Prepared:
    k = _key(spark, "prep", sf_dir, threshold, families, constant_feature)
    if k not in _memo:
        prepare(spark)
        _memo[k] = prepared_impressions(spark, sf_dir, threshold,
                                        list(families) if families is not None else None, constant_feature)
    return _memo[k]


def counts(spark: SparkSession, sf_dir: str, goals=tuple(FIXTURE_GOALS), scopes=("train", "unified"),
           combinations: bool = False, min_count: int = 1) -> B.BayesCounts:
    k = _key(spark, "counts", sf_dir, goals, scopes, combinations, min_count)
    if k not in _memo:
        p = prepared(spark, sf_dir)
        _memo[k] = B.fit_counts(p.encoded, list(goals), scopes, combinations, min_count)
    return _memo[k]


def r(c, n=ROUND):
    """Round half up as ``floor(x * 10^n + 0.5) / 10^n`` - plain IEEE arithmetic, so any
    engine computing the same double gets the same rounded value."""
    x = F.col(c) if isinstance(c, str) else c
    scale = float(10 ** n)
    return F.floor(x * scale + 0.5) / scale


def features_text(c="features"):
    return F.array_join(F.col(c).cast("array<string>"), " ")


# ---------------------------------------------------------------- features

def q_hour_of_week(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    return imp.select("row_id", C.hour_of_week("timestamp", "timezone_offset").alias("HOW"))


def q_location_combos(spark, sf_dir):
    d = derive_raw_features(impressions(spark, sf_dir))
    return d.select("row_id", "country_state", "country_state_city")


def q_label_extract(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    raw = F.when(F.col("row_id") % 7 == 0, F.lit(None).cast("string")).otherwise(F.col("click").cast("string"))
    return imp.select("row_id", C.label_value(raw).alias("click"))


def _levels(spark, sf_dir):
    k = _key(spark, "levels", sf_dir)
    if k not in _memo:
        d = derive_raw_features(impressions(spark, sf_dir))
        cells = feature_cells(d, FIXTURE_ATTRIBUTE_COLUMNS, FIXTURE_LIST_COLUMNS, ["row_id"])
        _memo[k] = cut_lineage(level_counts(cells))
    return _memo[k]


def q_rare_levels(spark, sf_dir):
    rl = rare_levels(_levels(spark, sf_dir), FIXTURE_RARITY)
    return rl.select("col", "value", "n", "merged", F.col("column_kept").cast("int").alias("column_kept"))


def _partial_one_hot(spark, sf_dir, attrs, lists):
    d = derive_raw_features(impressions(spark, sf_dir))
    enc, dic = one_hot(d, attrs, lists, ["row_id"], FIXTURE_RARITY)
    return enc.select("row_id", features_text().alias("features"))


def q_one_hot_attributes(spark, sf_dir):
    return _partial_one_hot(spark, sf_dir, FIXTURE_ATTRIBUTE_COLUMNS, [])


def q_one_hot_lists(spark, sf_dir):
    return _partial_one_hot(spark, sf_dir, [], FIXTURE_LIST_COLUMNS)


def _dictionary(spark, sf_dir, families=None):
    """The dictionary alone; rows are not encoded for it."""
    d = derive_raw_features(impressions(spark, sf_dir))
    return feature_dictionary(d, FIXTURE_ATTRIBUTE_COLUMNS, FIXTURE_LIST_COLUMNS, FIXTURE_RARITY, families).names


def q_feature_dictionary(spark, sf_dir):
    return _dictionary(spark, sf_dir).select("idx", "name")


def q_patch_location(spark, sf_dir):
    return _dictionary(spark, sf_dir, LOCATION_FAMILIES).select("idx", "name")


def q_constant_feature(spark, sf_dir):
    p = prepared(spark, sf_dir, constant_feature=True)
    return p.encoded.select("row_id", features_text().alias("features"))


def q_case_weights(spark, sf_dir):
    enc = prepared(spark, sf_dir).encoded
    y = L.focus_goal(enc, "click", ["row_id", "set"])
    return L.case_weights(y).select("row_id", "set", "y", "weight")


# ---------------------------------------------------------------- labels and splits

def q_focus_goal(spark, sf_dir):
    enc = prepared(spark, sf_dir).encoded
    return L.focus_goal(L.focus_set(enc, "test"), "buy", ["row_id", "set"])


def q_valid_goals(spark, sf_dir):
    enc = prepared(spark, sf_dir).encoded
    v = L.valid_goals(enc, ["CLICK", "BUY", "DOWNLOAD", "REGISTER", "VIDEO_AD_START"])
    return v.select("goal", "position", F.col("valid").cast("int").alias("valid"))


def q_temporal_split(spark, sf_dir):
    return U.day_sets(impressions(spark, sf_dir))


def q_stratified_split(spark, sf_dir):
    imp = impressions(spark, sf_dir)
    return imp.select("row_id", "click", U.hash_bucket(F.col("row_id")).alias("bucket"),
                      U.stratified_set(F.col("row_id")).alias("set"))


def q_stratified_exact(spark, sf_dir):
    imp = impressions(spark, sf_dir).select("row_id", "click")
    return U.stratified_exact(imp, "click").select("row_id", "click", "set")


def q_unified_set(spark, sf_dir):
    enc = prepared(spark, sf_dir).encoded
    both = enc.unionByName(U.unified(enc))
    return both.groupBy("set").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("click").cast("long").alias("n_click"),
                                   F.sum(F.size("features")).cast("long").alias("n_features"))


# ---------------------------------------------------------------- Bayes (L1-L4, H1)

def q_single_counts(spark, sf_dir):
    c = counts(spark, sf_dir)
    return c.keys.where(F.col("i") == F.col("j")).select(
        "i", F.col("n_train").alias("n"), F.col("pos_train_click").alias("pos")).where(F.col("n") > 0)


def q_pair_counts(spark, sf_dir):
    c = counts(spark, sf_dir, goals=("click",), scopes=("train",), combinations=True, min_count=20)
    return c.keys.select("i", "j", F.col("n_train").alias("n"), F.col("pos_train_click").alias("pos"))


def q_bayes_params(spark, sf_dir):
    c = counts(spark, sf_dir)
    p = B.key_params(c).where(F.col("n_train") >= SCORE_THRESHOLD)
    return p.select("i", r("adjp_train_click").alias("adjp"), r("adjn_train_click").alias("adjn"),
                    r("l1mp_train_click").alias("l1mp"), r("l1mn_train_click").alias("l1mn"))


def _scored(spark, sf_dir, goals, thresholds, scope="train"):
    k = _key(spark, "scored", sf_dir, tuple(goals), tuple(thresholds), scope)
    if k not in _memo:
        c = counts(spark, sf_dir)
        specs = [B.ModelSpec(f"{g}__{t}", scope, g, t) for g in goals for t in thresholds]
        enc = prepared(spark, sf_dir).encoded
        sm = B.score_models(enc, c, specs, ["row_id", "set"])
        s = sm.scores.withColumn("goal", F.split("model_id", "__").getItem(0)) \
                     .withColumn("threshold", F.split("model_id", "__").getItem(1).cast("int"))
        _memo[k] = s
    return _memo[k]


def q_bayes_score(spark, sf_dir):
    s = _scored(spark, sf_dir, ["click"], [SCORE_THRESHOLD])
    return s.select("row_id", r("l1").alias("l1"), r("l0").alias("l0"), r("prob").alias("prob"), "pred")


def q_evaluate_sets(spark, sf_dir):
    ev = M.evaluate_sets(_scored(spark, sf_dir, ["click"], [SCORE_THRESHOLD]), ["goal"])
    return ev.select("goal", *[r(c).alias(c) for c in ev.columns if c != "goal"])


def goal_list(spark, sf_dir) -> list[str]:
    """Goals with enough examples of both classes in every set (P4), in request order."""
    k = _key(spark, "goals", sf_dir)
    if k not in _memo:
        _memo[k] = TR.valid_goal_list(prepared(spark, sf_dir), FIXTURE_GOALS)
    return _memo[k]


def _grid(spark, sf_dir):
    """The training run's own grid: every valid goal x threshold, metrics as computed."""
    k = _key(spark, "grid", sf_dir)
    if k not in _memo:
        ev, _ = TR.bayes_grid(prepared(spark, sf_dir), goal_list(spark, sf_dir), GRID_THRESHOLDS, counts(spark, sf_dir))
        _memo[k] = cut_lineage(ev.withColumnRenamed("rarity_threshold", "threshold"), "grid")
    return _memo[k]


def q_grid_search_bayes(spark, sf_dir):
    ev = _grid(spark, sf_dir)
    return ev.select("goal", "config_id", "threshold",
                     *[r(c).alias(c) for c in ev.columns if c not in ("goal", "config_id", "threshold")])


def q_select_best(spark, sf_dir):
    sel = S.select_best(_grid(spark, sf_dir), ["goal"])
    return sel.select("goal", "config_id", r("roc_auc_test").alias("roc_auc_test"),
                      r("roc_auc_diff").alias("roc_auc_diff"),
                      F.col("valid_model").cast("int").alias("valid_model"), F.col("best").cast("int").alias("best"))


# ---------------------------------------------------------------- metrics on the raw score (M1-M5)

def _score_frame(spark, sf_dir):
    """Raw scores of the events (the metrics need none of the joined columns)."""
    e = read_table(spark, sf_dir, "events")
    return e.select(F.concat(F.lit("os"), (F.col("event_id") % 4).cast("string")).alias("device_os"),
                    (F.col("event_type") == "click").cast("int").alias("y"), (F.col("value") / 500.0).alias("prob"),
                    (F.col("value") > 50).cast("int").alias("pred"))


def q_roc_auc(spark, sf_dir):
    return M.roc_auc(_score_frame(spark, sf_dir), ["device_os"]).select("device_os", r("roc_auc").alias("roc_auc"))


def q_log_loss(spark, sf_dir):
    return M.log_loss(_score_frame(spark, sf_dir), ["device_os"]).select("device_os", r("log_loss").alias("log_loss"))


def q_prf(spark, sf_dir):
    cm = M.confusion_counts(_score_frame(spark, sf_dir), ["device_os"])
    return cm.select("device_os", *M.prf_columns()).select(
        "device_os", r("f1").alias("f1"), r("recall").alias("recall"), r("precision").alias("precision"))


def q_confusion_matrix(spark, sf_dir):
    return M.confusion_counts(_score_frame(spark, sf_dir), ["device_os"])


def q_confusion_rates(spark, sf_dir):
    cm = M.confusion_counts(_score_frame(spark, sf_dir), ["device_os"])
    return cm.select("device_os", *M.rate_columns()).select(
        "device_os", r("true_positive").alias("true_positive"), r("false_negative").alias("false_negative"))


QUERIES = {
    "hour_of_week": q_hour_of_week,
    "location_combos": q_location_combos,
    "label_extract": q_label_extract,
    "rare_levels": q_rare_levels,
    "one_hot_attributes": q_one_hot_attributes,
    "one_hot_lists": q_one_hot_lists,
    "feature_dictionary": q_feature_dictionary,
    "patch_location": q_patch_location,
    "constant_feature": q_constant_feature,
    "case_weights": q_case_weights,
    "focus_goal": q_focus_goal,
    "valid_goals": q_valid_goals,
    "temporal_split": q_temporal_split,
    "stratified_split": q_stratified_split,
    "stratified_exact": q_stratified_exact,
    "unified_set": q_unified_set,
    "single_counts": q_single_counts,
    "pair_counts": q_pair_counts,
    "bayes_params": q_bayes_params,
    "bayes_score": q_bayes_score,
    "evaluate_sets": q_evaluate_sets,
    "grid_search_bayes": q_grid_search_bayes,
    "select_best": q_select_best,
    "roc_auc": q_roc_auc,
    "log_loss": q_log_loss,
    "prf": q_prf,
    "confusion_matrix": q_confusion_matrix,
    "confusion_rates": q_confusion_rates,
}
