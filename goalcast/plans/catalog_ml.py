"""Registered queries, part 3: export sinks (K1-K3), streaming scoring (H9), ML
families (L5-L10), grid search for an ML family and the full training run (M10)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goalcast.operators import labels as L
from goalcast.operators import linear as LN
from goalcast.operators import metrics as M
from goalcast.operators import selection as S
from goalcast.operators import splits as U
from goalcast.operators import trees as T
from goalcast.operators.requests import REQUEST_SPEC
from goalcast.plans import training as TR
from goalcast.plans.catalog import SCORE_THRESHOLD, _scored, counts, prepared, r
from goalcast.plans.catalog_more import CR_RATES, CR_THRESHOLDS, request_frame, run_params, run_stats_rounded
from goalcast.plans.fixtures import FIXTURE_GOALS
from goalcast.plans.requests_flow import load_model, score_requests
from goalcast.session import cut_lineage, scratch_path
from goalcast.sinks import versions as V
from goalcast.sinks import writers as W
from goalcast.streaming import scoring as ST

# ---------------------------------------------------------------- export sinks (K1-K3)


def q_matrix_export(spark, sf_dir):
    """Matrix of every set with its header and case weights, written and read back:
    (part, set, value)."""
    p = prepared(spark, sf_dir)
    data = L.case_weights(L.focus_goal(p.encoded, "click", ["row_id", "set", "features"]))
    path = scratch_path(spark, "matrix")
    W.write_matrix(data, p.dictionary.names, path, p.dictionary.size)
    header = spark.read.text(f"{path}/header").select(F.lit("header").alias("part"), F.lit("").alias("set"), "value")
    parts = [spark.read.text(f"{path}/{x}").select(F.lit(x).alias("part"), "set", "value") for x in ("rows", "weights")]
    return header.unionByName(parts[0]).unionByName(parts[1])


def q_score_export(spark, sf_dir):
    s = _scored(spark, sf_dir, ["click"], [SCORE_THRESHOLD])
    path = scratch_path(spark, "scores")
    W.write_scores(s, path)
    schema = "row_id long, prob double, pred int, y int"
    back = spark.read.schema(schema).option("header", "true").csv(path).withColumn("set", F.input_file_name())
    back = back.withColumn("set", F.regexp_extract("set", r"set=([^/]+)", 1))
    return back.select("row_id", "set", r("prob").alias("prob"), "pred", "y")


# ---------------------------------------------------------------- streaming (H9)


def q_stream_score(spark, sf_dir):
    """Requests written as parquet files, scored as a stream with the current version of the model."""
    src, base = scratch_path(spark, "requests"), scratch_path(spark, "model-versions")
    req = request_frame(spark, sf_dir).drop("agents")
    req.repartition(8).write.mode("overwrite").parquet(src)
    p = prepared(spark, sf_dir)
    V.publish(spark, base, lambda folder: W.write_bayes_model(counts(spark, sf_dir), "train", "click", SCORE_THRESHOLD, p.dictionary.names, folder))

    def score_batch(batch, model):
        return score_requests(batch, model, "click", "request_id", "request", "ts", None, REQUEST_SPEC, [], CR_THRESHOLDS, CR_RATES)

    sink, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ckpt")
    model = V.Versioned(spark, base, lambda folder: load_model(spark, folder, "click"))
    ST.run_to_completion(ST.start_scoring_stream(spark, src, req.schema, score_batch, model, sink, ck, max_files_per_trigger=2))
    return ST.read_sink(spark, sink).select("request_id", r("prob").alias("prob"), "cr")


# ---------------------------------------------------------------- ML families


# Node sizes of the grid suit logs of about ten million rows; the fixture takes the same share of its rows.
NODE_SIZE_ROWS = 10_000_000


def forest_configs(n_rows: int) -> list[dict]:
    """The whole grid, node sizes in proportion to the rows of the log (2 at least)."""
    return [{**c, "min_target_node_size": max(2, round(c["min_target_node_size"] * n_rows / NODE_SIZE_ROWS))} for c in TR.family_configs("rf")]


def _all_goals(p) -> list[str]:
    return TR.valid_goal_list(p, [g.upper() for g in FIXTURE_GOALS])


def _fit_and_evaluate(spark, sf_dir, family: str, configs):
    """One configuration fitted on the train rows for every valid goal, metrics of both sets."""
    p = prepared(spark, sf_dir)
    ev = TR.ml_grid(p, family, _all_goals(p), configs(p) if callable(configs) else configs)
    return ev.select("goal", *[r(f"{m}_{s}").alias(f"{m}_{s}") for s in ("train", "test") for m in M.METRICS])


def q_lasso_fit(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, "lasso", [{"loss": "log", "penalty": "l1", "alpha": 1e-4}])


def q_svm_fit(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, "sgd", [{"loss": "hinge", "penalty": "l2", "alpha": 1e-4}])


def q_linear_custom_fit(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, "sgd", [{"loss": "modified_huber", "penalty": "elasticnet", "alpha": 1e-4}])


def q_forest_fit(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, "rf", lambda p: forest_configs(p.encoded.count())[:1])


def q_gbt_fit(spark, sf_dir):
    return _fit_and_evaluate(spark, sf_dir, "xgb", TR.family_configs("xgb")[:1])


def q_tree_importance(spark, sf_dir):
    """Boosted models of all valid goals (refit on the unified set) -> importance table and files."""
    p = prepared(spark, sf_dir)
    jobs = [(g, TR.family_configs("xgb")[-1]) for g in _all_goals(p)]
    models = TR.fit_models("xgb", p.encoded, p.encoded, jobs, p.dictionary.size)
    parts = []
    for job, (goal, _) in enumerate(jobs):
        path = scratch_path(spark, "boosted-model")
        models.save(spark, job, path)
        imp = T.importance(spark, path, p.dictionary.names, p.dictionary.size)
        for kind in ("weight", "gain", "cover"):
            T.importance_lines(imp, kind).write.mode("overwrite").text(f"{path}-importance/importance_{kind}")
        parts.append(imp.select(F.lit(goal).alias("goal"), "*"))
    return reduce(DataFrame.unionByName, parts)


def _grid_rows(grid):
    """Selected grid with rounded metrics."""
    t = S.select_best(grid, ["goal"])
    return t.select("goal", "config_id", "params", "converged", *[r(f"{m}_{s}").alias(f"{m}_{s}") for s in ("train", "test") for m in M.METRICS],
                    "valid_model", "best")


def q_grid_search_gbt(spark, sf_dir):
    """The whole grid of boosted trees, every valid goal."""
    p = prepared(spark, sf_dir)
    return _grid_rows(TR.ml_grid(p, "xgb", _all_goals(p)))


def q_grid_search_sgd(spark, sf_dir):
    """All 150 linear configurations, every valid goal, in one solver."""
    p = prepared(spark, sf_dir)
    return _grid_rows(TR.ml_grid(p, "sgd", _all_goals(p)))


def q_grid_search_rf(spark, sf_dir):
    """The whole forest grid, every valid goal, from one growth."""
    p = prepared(spark, sf_dir)
    return _grid_rows(TR.ml_grid(p, "rf", _all_goals(p), forest_configs(p.encoded.count())))


def _class_sizes(classes, goals):
    """(goal, n_rows, n_pos) of the rows behind the classes."""
    t = classes.agg(F.sum("n").alias("n"), *[F.sum(g).alias(g) for g in goals])
    return t.select(F.explode(F.array(*[F.struct(F.lit(g).alias("goal"), F.col("n").alias("n_rows"), F.col(g).alias("n_pos")) for g in goals]))
                    .alias("s")).select("s.*")


def q_linear_optimality(spark, sf_dir):
    """Log loss with every penalty and alpha, every valid goal, fitted to the optimum: 1 where no
    feature violates the optimality conditions by more than ``OPTIMAL``."""
    p = prepared(spark, sf_dir)
    goals = _all_goals(p)
    train = TR.goal_classes(p, goals).where(F.col("set") == "train")
    configs = [c for c in TR.family_configs("sgd") if c["loss"] == "log"]
    jobs = [(g, c) for g in goals for c in configs]
    model = LN.fit_linear(train, jobs, p.dictionary.size, iterations=1000, tolerance=1e-4)
    t = spark.createDataFrame([(g, c["penalty"], float(c["alpha"]), int(x <= OPTIMAL)) for (g, c), x in zip(jobs, model.residual)],
                              "goal string, penalty string, alpha double, optimal int")
    return t.join(F.broadcast(_class_sizes(train, goals)), "goal")


OPTIMAL = 1e-3


def q_forest_rules(spark, sf_dir):
    """Saved forests of every valid goal read back: trees, rows of the log, and how many split
    nodes break a rule (too small, pure, children that do not add up to their parent)."""
    p = prepared(spark, sf_dir)
    config, goals = forest_configs(p.encoded.count())[0], _all_goals(p)
    train = p.encoded.where(F.col("set") == "train")
    models = TR.fit_models("rf", train, train, [(g, config) for g in goals], p.dictionary.size)
    parts = []
    for job, goal in enumerate(goals):
        path = scratch_path(spark, "forest")
        models.save(spark, job, path)
        nodes = spark.read.parquet(path)
        child = nodes.select(F.col("node").alias("child"), F.col("n").alias("cn"), F.col("pos").alias("cp"))
        both = (nodes.where("feature >= 0").withColumn("child", F.explode(F.array("left", F.col("left") + 1))).join(child, "child")
                .groupBy("node", "n", "pos").agg(F.sum("cn").alias("cn"), F.sum("cp").alias("cp"), F.min("cn").alias("least")))
        broken = both.agg(F.count_if(F.col("n") < config["min_target_node_size"]).alias("too_small"),
                          F.count_if((F.col("pos") <= 0) | (F.col("pos") >= F.col("n"))).alias("pure"),
                          F.count_if((F.col("cn") != F.col("n")) | (F.col("cp") != F.col("pos")) | (F.col("least") <= 0)).alias("unequal"))
        trees = nodes.agg(F.count_distinct("tree").alias("trees"))
        parts.append(trees.join(broken).select(F.lit(goal).alias("goal"), "trees", "too_small", "pure", "unequal"))
    return reduce(DataFrame.unionByName, parts)


def q_refit_scores(spark, sf_dir):
    """Final refits (unified set) written, read back and scored: rows of the log behind each goal and
    the vector classes whose score differs from the fitted model's."""
    p = prepared(spark, sf_dir)
    goals = _all_goals(p)
    classes = TR.goal_classes(p, goals)
    parts = []
    for family, config in (("lasso", {"loss": "log", "penalty": "l1", "alpha": 1e-3}), ("rf", {**forest_configs(p.encoded.count())[-1], "ntree": 20})):
        models = TR.fit_models(family, p.encoded, U.unified(classes), [(g, config) for g in goals], p.dictionary.size)
        here = models.score(classes, ["class_id"]).select("class_id", "job", "prob", "pred")
        for job, goal in enumerate(goals):
            path = scratch_path(spark, "refit")
            models.save(spark, job, path)
            back = TR.read_model(spark, family, path).score(classes, ["class_id"])
            back = back.select("class_id", F.col("prob").alias("back_prob"), F.col("pred").alias("back_pred"))
            pair = here.where(F.col("job") == job).join(back, "class_id", "full")
            off = pair.agg(F.count_if(~(F.abs(F.col("prob") - F.col("back_prob")) <= 1e-12) | ~F.col("pred").eqNullSafe(F.col("back_pred"))
                                      | F.col("prob").isNull() | F.col("back_prob").isNull()).alias("differing"))
            parts.append(off.select(F.lit(family).alias("family"), F.lit(goal).alias("goal"), "differing"))
    return reduce(DataFrame.unionByName, parts).join(F.broadcast(_class_sizes(classes, goals)), "goal")


def q_train_all_goals(spark, sf_dir):
    p = prepared(spark, sf_dir)
    out = scratch_path(spark, "run-NB")
    TR.train_bayes(p, [g.upper() for g in FIXTURE_GOALS], out, "NB", run_params(spark, sf_dir))
    # a blank field of the file is an empty list of files
    back = spark.read.option("header", "true").csv(f"{out}/Parameters").fillna("", ["Files"])
    return run_stats_rounded(back)


def q_grid_table(spark, sf_dir):
    """The grid table of a run (K5), written as CSV and read back."""
    p = prepared(spark, sf_dir)
    res = TR.train_bayes(p, [g.upper() for g in FIXTURE_GOALS], None, "NB")
    path = scratch_path(spark, "grid-table")
    W.write_grid_table(res.grid, path)
    t = spark.read.option("header", "true").csv(path)
    return t.select("goal", F.col("config_id").cast("int").alias("config_id"), F.col("rarity_threshold").cast("int").alias("threshold"),
                    *[r(F.col(f"{m}_{s}").cast("double")).alias(f"{m}_{s}") for s in ("train", "test") for m in M.METRICS],
                    (F.col("valid_model") == "true").cast("int").alias("valid_model"), (F.col("best") == "true").cast("int").alias("best"))


def _train(spark, sf_dir, family: str, configs=None):
    p = prepared(spark, sf_dir)
    out = scratch_path(spark, f"run-{family}")
    TR.train_ml(p, family, [g.upper() for g in FIXTURE_GOALS], out, configs=configs(p) if configs else None)
    return run_stats_rounded(spark.read.option("header", "true").csv(f"{out}/Parameters").fillna("", ["Files"]))


def q_train_goal_rf(spark, sf_dir):
    """Run for the forest family over all goals and the whole grid."""
    return _train(spark, sf_dir, "rf", lambda p: forest_configs(p.encoded.count()))


def q_train_goal_lasso(spark, sf_dir):
    """Run for the LASSO family over all goals and the whole grid."""
    return _train(spark, sf_dir, "lasso")


def q_train_goal_xgb(spark, sf_dir):
    """Run for the boosted family over all goals and the whole grid."""
    return _train(spark, sf_dir, "xgb")


QUERIES_ML = {
    "matrix_export": q_matrix_export,
    "score_export": q_score_export,
    "stream_score": q_stream_score,
    "lasso_fit": q_lasso_fit,
    "svm_fit": q_svm_fit,
    "linear_custom_fit": q_linear_custom_fit,
    "forest_fit": q_forest_fit,
    "gbt_fit": q_gbt_fit,
    "tree_importance": q_tree_importance,
    "grid_search_gbt": q_grid_search_gbt,
    "grid_search_sgd": q_grid_search_sgd,
    "grid_search_rf": q_grid_search_rf,
    "linear_optimality": q_linear_optimality,
    "forest_rules": q_forest_rules,
    "refit_scores": q_refit_scores,
    "train_all_goals": q_train_all_goals,
    "train_goal_lasso": q_train_goal_lasso,
    "train_goal_rf": q_train_goal_rf,
    "train_goal_xgb": q_train_goal_xgb,
    "grid_table": q_grid_table,
}
