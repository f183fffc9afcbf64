"""Training runs: grid search (M7), selection (M8/M9), final refit (L11), per-goal run
(M10) and the run outputs (K4-K8).

Count-based family (pair-count Bayes): goals and configurations are columns of one
job - counts once for every goal and both fit scopes (train, unified), all
(goal, threshold) models scored in one aggregation, metrics in one grouped
aggregation. ML families: a job is a (goal, configuration); all jobs of a grid are fitted
together (one weight matrix, or one growth of all trees) and scored in one scan of the vector
classes.
"""

from __future__ import annotations

import json
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.constants import GRID_OF_FAMILY, HYPER_PARAMETERS, KNOWN_LABELS
from goalcast.operators import bayes as B
from goalcast.operators import labels as L
from goalcast.operators import linear as LN
from goalcast.operators import metrics as M
from goalcast.operators import selection as S
from goalcast.operators import splits as U
from goalcast.operators import trees as T
from goalcast.operators.classes import vector_classes
from goalcast.plans.prepare import Prepared
from goalcast.session import cut_lineage
from goalcast.sinks import writers as W


@dataclass
class RunResult:
    grid: DataFrame      # (goal, config_id, params..., metrics_train/test, valid_model, best)
    stats: DataFrame     # K6 rows
    best: DataFrame      # (goal, valid, config_id, params..., test metrics)


def valid_goal_list(prep: Prepared, requested: list[str]) -> list[str]:
    v = L.valid_goals(prep.encoded, requested)
    return [r["goal"] for r in v.where("valid").orderBy("position").collect()]  # goal list: driver-sized


#: Rows a vector class must hold on average before scoring classes pays for grouping them.
ROWS_A_CLASS = 2.0


def worth_classes(encoded: DataFrame) -> bool:
    """Whether rows with equal features are common enough to be scored as classes: a sketch of
    the distinct vectors over all rows, one row to the driver."""
    t = encoded.agg(F.count(F.lit(1)).alias("n"), F.approx_count_distinct(F.xxhash64("set", "features")).alias("d")).collect()[0]
    return t["n"] >= ROWS_A_CLASS * max(1, t["d"])


def _scored_classes(prep: Prepared, counts: B.BayesCounts, specs: list[B.ModelSpec], goals: list[str]) -> DataFrame:
    """H1 over vector classes: (set, model_id, pos, neg, prob, pred) per class and model."""
    scored = B.score_models(goal_classes(prep, goals), counts, specs, ["class_id", "set", "n"]).scores
    return scored.withColumn("pos", F.col("y")).withColumn("neg", F.col("n") - F.col("y"))


def equal_thresholds(counts: B.BayesCounts, scope: str, thresholds: list[int]) -> dict[int, int]:
    """Threshold -> smallest threshold that keeps the same keys. Key sets of thresholds are nested,
    so sets of one size are one set and their models are one model, evaluated once."""
    n = F.col(f"n_{scope}")
    kept = counts.keys.agg(*[F.count_if(n >= t).alias(str(t)) for t in thresholds]).collect()[0].asDict()  # one row
    return {t: min(u for u in thresholds if kept[str(u)] == kept[str(t)]) for t in thresholds}


def bayes_grid(prep: Prepared, goals: list[str], thresholds: list[int], counts: B.BayesCounts | None = None):
    counts = counts or B.fit_counts(prep.encoded, goals, ("train", "unified"))
    same = equal_thresholds(counts, "train", thresholds)
    specs = [B.ModelSpec(f"{g}__{t}", "train", g, t) for g in goals for t in sorted(set(same.values()))]
    scored = _scored_classes(prep, counts, specs, goals) if worth_classes(prep.encoded) else \
        B.score_models(prep.encoded, counts, specs, ["row_id", "set"]).scores
    scored = scored.withColumn("goal", F.split("model_id", "__")[0]) \
                   .withColumn("rarity_threshold", F.split("model_id", "__")[1].cast("int"))
    ev = cut_lineage(M.evaluate_sets(scored, ["goal", "rarity_threshold"]), "grid-metrics")
    every = prep.encoded.sparkSession.createDataFrame(list(same.items()), "threshold int, rarity_threshold int")
    ev = ev.join(F.broadcast(every), "rarity_threshold").drop("rarity_threshold").withColumnRenamed("threshold", "rarity_threshold")
    cid = F.array_position(F.array(*[F.lit(t) for t in thresholds]), F.col("rarity_threshold")).cast("int") - 1
    return ev.withColumn("config_id", cid), counts


def _best_rows(sel: DataFrame, param_cols: list[str]) -> DataFrame:
    anyv = sel.groupBy("goal").agg(F.max(F.col("valid_model").cast("int")).alias("_v"))
    best = sel.where("best").select("goal", "config_id", *param_cols, "roc_auc_test", "log_loss_test", "f1_test",
                                    "true_positive_test", "false_negative_test")
    return anyv.join(best, "goal", "left").withColumn("valid", F.col("_v") == 1).drop("_v")


def train_bayes(prep: Prepared, requested: list[str], out_path: str | None, family: str = "NB",
                run_params: dict | None = None) -> RunResult:
    goals = valid_goal_list(prep, requested)
    if not goals:
        raise ValueError("No valid goals found to train")
    thresholds = HYPER_PARAMETERS["POLY2BAYES"]["rarity_threshold"]
    grid, counts = bayes_grid(prep, goals, thresholds)
    # the metrics of all configurations (goals x thresholds rows) feed every output
    sel = cut_lineage(S.select_best(grid, ["goal"]), "bayes-grid")
    best = _best_rows(sel, ["rarity_threshold"])
    stats = W.run_stats(best, family)
    if out_path:
        # independent outputs: submitted as concurrent Spark jobs from a driver pool
        tasks = [lambda: W.write_grid_table(sel, f"{out_path}/grid"),
                 lambda: W.write_keymap(prep.dictionary.names, f"{out_path}/keymap"),
                 lambda: W.write_run_stats(stats, f"{out_path}/Parameters")]
        for r in best.where("valid").select("goal", "rarity_threshold").collect():  # one row per goal
            tasks.append(lambda g=r["goal"], t=r["rarity_threshold"]: W.write_bayes_model(
                counts, "unified", g, t, prep.dictionary.names, f"{out_path}/{g}/model"))
        if run_params and family.upper() == "NB":
            d = W.refresh_descriptor(best.where("valid"), run_params, family)
            tasks.append(lambda: d.select("goal", "descriptor").write.mode("overwrite")
                         .partitionBy("goal").text(f"{out_path}/refresh"))
        with ThreadPoolExecutor(min(8, len(tasks))) as pool:
            for f in [pool.submit(t) for t in tasks]:
                f.result()
    return RunResult(grid=sel, stats=stats, best=best)


def sparse_data(spark, header_path: str, set_paths: dict[str, str]) -> Prepared:
    """The sparse log as training takes it: header + one folder per set."""
    from goalcast.operators.features import FeatureDictionary
    from goalcast.sources.readers import load_data_group
    rows, header = load_data_group(spark, header_path, set_paths)
    names = header.where(~F.col("is_label")).select("idx", "name")
    size = names.count()
    return Prepared(rows, FeatureDictionary(names=names, entries=None, size=size, n_entries=size), KNOWN_LABELS)


def train_from_sparse(spark, header_path: str, set_paths: dict[str, str], requested: list[str], out_path: str | None,
                      family: str = "NB", run_params: dict | None = None, **options) -> RunResult:
    """Sparse log -> data group -> goal filter -> grid -> selection -> refit and outputs, for
    any family."""
    data = sparse_data(spark, header_path, set_paths)
    if family.lower() in ("nb", "poly2bayes"):
        return train_bayes(data, requested, out_path, family, run_params)
    return train_ml(data, family, requested, out_path, **options)


# ---------------------------------------------------------------- ML families


def family_configs(family: str) -> list[dict]:
    return S.expand_grid(HYPER_PARAMETERS[GRID_OF_FAMILY[family.lower()]])


def fit_models(family: str, rows: DataFrame, classes: DataFrame, jobs: list[tuple[str, dict]], width: int):
    """All jobs (goal, configuration) fitted together: an object with ``score(rows, keep)`` and
    ``save(spark, job, path)``. Linear families fit ``classes``, trees ``rows`` (row_id, set,
    features, goals), forests with the case weights of each row's own set (F9, U3)."""
    fam = family.lower()
    if fam in ("lasso", "sgd"):
        return LN.fit_linear(classes, jobs, width)
    if fam == "rf":
        return T.fit_forests(rows, jobs, width)
    if fam in ("xgb", "xgbf"):
        return T.fit_boosted(rows, jobs, width)
    raise ValueError(f"unknown family {family}")


def read_model(spark, family: str, path: str):
    """A saved model of one job, as ``fit_models`` gives it."""
    return {"lasso": LN.read_linear, "sgd": LN.read_linear, "rf": T.read_forest,
            "xgb": T.read_boosted, "xgbf": T.read_boosted}[family.lower()](spark, path)


def goal_classes(prep: Prepared, goals: list[str]) -> DataFrame:
    return vector_classes(prep.encoded, goals, "goal-classes")


def ml_grid(prep: Prepared, family: str, goals: list[str], configs: list[dict] | None = None,
            classes: DataFrame | None = None) -> DataFrame:
    """M7 for an ML family: ``(goal, config_id, params, converged, metrics...)`` of every goal and
    configuration, fitted on the train rows together and scored on both sets in one scan.
    ``converged`` is null for families that do not iterate towards an optimum."""
    spark = prep.encoded.sparkSession
    configs = configs if configs is not None else family_configs(family)
    classes = classes if classes is not None else goal_classes(prep, goals)
    jobs = [(g, c) for g in goals for c in configs]
    models = fit_models(family, prep.encoded.where(F.col("set") == "train"), classes.where(F.col("set") == "train"), jobs, prep.dictionary.size)
    ended = getattr(models, "converged", [None] * len(jobs))
    table = spark.createDataFrame(
        [(j, g, j % len(configs), json.dumps(c, sort_keys=True), None if e is None else bool(e)) for j, ((g, c), e) in enumerate(zip(jobs, ended))],
        "job int, goal string, config_id int, params string, converged boolean")
    ev = M.evaluate_sets(models.score(classes, ["set"]), ["job"])
    names = [f"{m}_{s}" for s in ("train", "test") for m in M.METRICS]
    return cut_lineage(table.join(F.broadcast(ev), "job", "left").select("goal", "config_id", "params", "converged", *names), "ml-grid")


def train_ml(prep: Prepared, family: str, requested: list[str], out_path: str | None,
             algorithm_name: str | None = None, configs: list[dict] | None = None) -> RunResult:
    """M10 for an ML family: grid of all valid goals (M7) -> selection (M8) -> refit of each goal's
    best configuration on the unified set with the per-set case weights (L11, U3), all goals
    together -> model, ``confusion`` rates of the best test scores (K8), importance of boosted
    trees (L10) and keymap (K4) per goal; run statistics (K6) for all goals."""
    spark = prep.encoded.sparkSession
    goals = valid_goal_list(prep, requested)
    if not goals:
        raise ValueError("No valid goals found to train")
    name = algorithm_name or family.upper()
    classes = goal_classes(prep, goals)
    grid = cut_lineage(S.select_best(ml_grid(prep, family, goals, configs, classes), ["goal"]), "ml-selected")
    best = _best_rows(grid, ["params"])
    stats = W.run_stats(best, name)
    if out_path:
        chosen = best.where("valid").orderBy("goal").collect()  # at most one row a goal
        jobs = [(r["goal"], json.loads(r["params"])) for r in chosen]
        models = fit_models(family, prep.encoded, U.unified(classes), jobs, prep.dictionary.size) if jobs else None
        for job, r in enumerate(chosen):
            path = f"{out_path}/{r['goal']}"
            models.save(spark, job, f"{path}/model")
            spark.createDataFrame([(r["goal"], r["params"], r["true_positive_test"], r["false_negative_test"])],
                                  "goal string, params string, true_positive double, false_negative double") \
                .write.mode("overwrite").json(f"{path}/confusion")
            if family.lower() in ("xgb", "xgbf"):
                imp = T.importance(spark, f"{path}/model", prep.dictionary.names, prep.dictionary.size)
                for kind in ("weight", "gain", "cover"):
                    T.importance_lines(imp, kind).write.mode("overwrite").text(f"{path}/importance_{kind}")
        W.write_grid_table(grid, f"{out_path}/grid")
        W.write_keymap(prep.dictionary.names, f"{out_path}/keymap", W.KEYMAP_FORM.get(family.lower(), "pairs"))
        W.write_run_stats(stats, f"{out_path}/Parameters")
    return RunResult(grid=grid, stats=stats, best=best)
