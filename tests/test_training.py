"""Training families, grids and runs on a small generated set; sources and sinks around them."""

import json
import math
import warnings

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from goalcast.constants import HYPER_PARAMETERS, KNOWN_LABELS
from goalcast.operators import bayes as B
from goalcast.operators import growth as G
from goalcast.operators import labels as L
from goalcast.operators import linear as LN
from goalcast.operators import metrics as M
from goalcast.operators import requests as RQ
from goalcast.operators import splits as U
from goalcast.operators import trees as T
from goalcast.operators.features import FeatureDictionary
from goalcast.plans import catalog_ml as CM
from goalcast.plans import training as TR
from goalcast.plans.prepare import Prepared
from goalcast.sinks import writers as W
from goalcast.sources import readers as RD


@pytest.fixture(scope="module")
def prep(spark):
    """240 rows: feature 0 favours clicks, 1 opposes them, 2..5 are noise."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(240):
        y = int(rng.random() < 0.4)
        f = {0 if (y == 1) == (rng.random() < 0.85) else 1, 2 + int(rng.integers(0, 4))}
        rows.append((i, "train" if i % 4 else "test", sorted(f), y, 0, 0, 0, 0))
    enc = spark.createDataFrame(rows, "row_id long, set string, features array<int>, " + ", ".join(f"{g} int" for g in KNOWN_LABELS))
    names = spark.createDataFrame([(i, f"f{i}") for i in range(6)], "idx int, name string")
    return Prepared(enc, FeatureDictionary(names=names, entries=None, size=6, n_entries=6), KNOWN_LABELS)


FAMILIES = [("lasso", {"loss": "log", "penalty": "l1", "alpha": 1e-4}), ("sgd", {"loss": "hinge", "penalty": "l2", "alpha": 1e-4}),
            ("sgd", {"loss": "squared_hinge", "penalty": "elasticnet", "alpha": 1e-4}),
            ("rf", {"ntree": 10, "fraction": 1.0, "min_target_node_size": 20}), ("xgb", {"max_depth": 2, "eta": 0.3})]


def click(prep):
    return prep.encoded.select("row_id", "set", "features", "click")


@pytest.mark.parametrize("family,configs", [("lasso", FAMILIES[:1]), ("sgd", FAMILIES[1:3]), ("rf", FAMILIES[3:4]), ("xgb", FAMILIES[4:])])
def test_families_learn_through_the_grid(prep, family, configs):
    configs = [c for _, c in configs]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        grid = TR.ml_grid(prep, family, ["click"], configs).orderBy("config_id").collect()
    assert [json.loads(r["params"]) for r in grid] == configs
    for r, c in zip(grid, configs):
        assert r["f1_test"] > 0.6 and (r["converged"] is None) == (family in ("rf", "xgb"))
        assert (r["roc_auc_train"] or 0) > 0.75 if c.get("loss", "log") == "log" else r["roc_auc_train"] is None


def dense(prep):
    rows = click(prep).orderBy("row_id").collect()
    x = np.zeros((len(rows), 6))
    for i, r in enumerate(rows):
        x[i, r["features"]] = 1
    return x, np.array([r["click"] for r in rows]), np.array([r["set"] for r in rows])


def single_fit(x, y, loss, penalty, alpha, iterations=300, step=0.5, tolerance=5e-3):
    """The same steps for one configuration over plain rows."""
    rho, smooth, n = LN.PENALTY_MIX[penalty], loss in LN.CURVATURE, len(x)
    bound = (x * x.sum(axis=1, keepdims=True)).sum(axis=0) / n
    w = ahead = np.zeros(x.shape[1])
    momentum = 1.0
    for t in range(1, iterations + 1):
        sign = np.where(y == 1, 1.0, -1.0)
        g = x.T @ LN._dloss(loss, sign, x @ ahead) / n + alpha * (1 - rho) * ahead
        eta = 1 / (LN.CURVATURE[loss] * bound + alpha * (1 - rho)) if smooth else step / bound / np.sqrt(t)
        new = ahead - eta * g
        new = np.sign(new) * np.maximum(np.abs(new) - eta * alpha * rho, 0)
        if np.abs(new - w).max() <= tolerance * max(np.abs(new).max(), 1e-12):
            return new, t, True
        if smooth:
            if ((ahead - new) * bound) @ (new - w) > 0:
                momentum = 1.0
            later = (1 + np.sqrt(1 + 4 * momentum ** 2)) / 2
            ahead, momentum = new + (momentum - 1) / later * (new - w), later
        else:
            ahead = new
        w = new
    return w, iterations, False


@pytest.mark.parametrize("direct", [0, 1 << 20])
def test_one_solver_equals_single_fits(prep, monkeypatch, direct):
    monkeypatch.setattr(LN, "DIRECT_BYTES", direct)
    x, y, _ = dense(prep)
    grid = [{"loss": a, "penalty": b, "alpha": c} for a in HYPER_PARAMETERS["SGD"]["loss"] for b in ("l2", "l1", "elasticnet") for c in (1e-4, 0.05)]
    classes = TR.goal_classes(prep, ["click"])
    monkeypatch.setattr(LN, "MATRIX_BYTES", 8 * 6 * 20)        # 20 columns at a time
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        got = LN.fit_linear(classes, [("click", c) for c in grid], 6, iterations=25)
    for j, c in enumerate(grid):
        w, steps, converged = single_fit(x, y, c["loss"], c["penalty"], c["alpha"], 25)
        assert np.allclose(got.weights[:, j], w, atol=1e-9), c
        assert (got.steps[j], got.converged[j]) == (steps, converged), c
    assert got.converged.any() and not got.converged.all()


@pytest.mark.parametrize("cells", [0, 1 << 23])
@pytest.mark.parametrize("slice_", [4, 1 << 16])
def test_columns_solved_alone_take_the_same_steps(prep, monkeypatch, cells, slice_):
    monkeypatch.setattr(LN, "LOCAL_CELLS", cells)
    monkeypatch.setattr(LN, "SLICE", slice_)
    x, y, _ = dense(prep)
    scans = []
    monkeypatch.setattr(LN, "_gradient", lambda *a, f=LN._gradient: scans.append(1) or f(*a))
    grid = [{"loss": a, "penalty": b, "alpha": c} for a in HYPER_PARAMETERS["SGD"]["loss"] for b in ("l2", "l1", "elasticnet") for c in (1e-15, 0.05)]
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        got = LN.fit_linear(TR.goal_classes(prep, ["click"]), [("click", c) for c in grid], 6, iterations=25)
    for j, c in enumerate(grid):
        w, steps, converged = single_fit(x, y, c["loss"], c["penalty"], c["alpha"], 25)
        assert np.allclose(got.weights[:, j], w, atol=1e-9), c
        assert (got.steps[j], got.converged[j]) == (steps, converged), c
    assert len(scans) == (0 if cells else 26)                  # no scan a step where the classes fit into a task


@pytest.mark.parametrize("width", [40, 10_000])
def test_slots_sum_like_a_matrix(width):
    rng = np.random.default_rng(3)
    rows = [sorted(rng.choice(40, k, replace=False).tolist()) for k in [0, 3, 5, 5, 2, 30, 4, 0, 6] * 30 + [40]]
    n, pos = np.arange(1, len(rows) + 1), np.arange(len(rows)) // 2
    x = np.zeros((len(rows), width))
    for i, r in enumerate(rows):
        x[i, r] = 1
    held = LN._Rows(LN.Batch(pa.array(rows, pa.list_(pa.int32()))), width).counted(n, {"click": pos})
    assert len(held.rest) and len(held.slots)
    w, got = rng.normal(size=(width, 3)), np.zeros((width, 3))
    held.gradient(w, [("click", k) for k in ("log", "hinge", "modified_huber")], got)
    assert np.allclose(held.margins(w).T, (x @ w)[held.order])
    for c, loss in enumerate(("log", "hinge", "modified_huber")):
        m = x @ w[:, c]
        assert np.allclose(got[:, c], x.T @ (pos * LN._dloss(loss, 1.0, m) + (n - pos) * LN._dloss(loss, -1.0, m)))


def test_optimality_takes_every_alpha_of_the_grid(prep, spark, monkeypatch):
    monkeypatch.setattr(CM, "prepared", lambda *a: prep)
    got = CM.q_linear_optimality(spark, None).collect()
    grid = HYPER_PARAMETERS["SGD"]
    assert {(r["penalty"], r["alpha"]) for r in got} == {(b, float(c)) for b in grid["penalty"] for c in grid["alpha"]}
    assert all(r["optimal"] == 1 for r in got)


def test_classes_lie_with_their_rarest_feature(spark):
    rows = [(i, [i % 3, 3 + i % 200], 1, int(i % 7 == 0)) for i in range(4000)] + [(4000, [], 1, 0)]
    df = spark.createDataFrame(rows, "class_id long, features array<int>, n long, click long").repartition(8)
    count = np.array([sum(f in r[1] for r in rows) for f in range(203)])
    placed = LN._by_home(df, count, len(rows))
    assert sorted(map(tuple, placed.collect())) == sorted(map(tuple, df.collect()))
    # few features have parts of their gradient in more than one task
    seen = sum(r[0] for r in placed.mapInArrow(LN._seen, "seen long").collect())
    assert seen <= 203 + 3 * 4 and sum(r[0] for r in df.mapInArrow(LN._seen, "seen long").collect()) > 4 * 203


def test_solver_reaches_the_optimum_and_says_so(prep):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import Vectors
    x, y, _ = dense(prep)
    jobs = [("click", {"loss": "log", "penalty": p, "alpha": a}) for p, a in (("l1", 0.05), ("l2", 0.1), ("elasticnet", 0.02))]
    jobs.append(("click", {"loss": "modified_huber", "penalty": "l2", "alpha": 0.1}))
    got = LN.fit_linear(TR.goal_classes(prep, ["click"]), jobs, 6, tolerance=1e-6)
    assert got.converged.all() and (got.residual < 1e-4).all()
    for j, (_, c) in enumerate(jobs):
        w = got.weights[:, j]
        g = x.T @ LN._dloss(c["loss"], np.where(y == 1, 1.0, -1.0), x @ w) / len(x)
        l1, l2 = c["alpha"] * LN.PENALTY_MIX[c["penalty"]], c["alpha"] * (1 - LN.PENALTY_MIX[c["penalty"]])
        assert np.allclose((g + l2 * w)[w != 0], -l1 * np.sign(w[w != 0]), atol=1e-4) and np.all(np.abs(g[w == 0]) <= l1 + 1e-4)
    df = prep.encoded.sparkSession.createDataFrame([(float(b), Vectors.dense(a)) for a, b in zip(x.tolist(), y)], ["label", "features"])
    lr = LogisticRegression(regParam=0.05, elasticNetParam=1.0, fitIntercept=False, standardization=False, maxIter=500, tol=1e-12).fit(df)
    assert np.allclose(lr.coefficients.toArray(), got.weights[:, 0], atol=2e-3)


def test_solver_warns_where_it_did_not_converge(prep):
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        got = LN.fit_linear(TR.goal_classes(prep, ["click"]), [("click", {"loss": "hinge", "penalty": "l1", "alpha": 1e-4})], 6, iterations=2)
    assert not got.converged.any() and seen and np.isnan(got.residual).all()


# ---------------------------------------------------------------- forests

FOREST = [{"ntree": n, "fraction": f, "min_target_node_size": m} for n in (4, 7) for f in (1.0, 0.3) for m in (12, 30)]


def replay_tree(rows, rates, width, seed, number, fraction, least):
    """One tree grown on the driver by the stated rules: {path: (n, pos, feature)}."""
    key = G.mix(G.mix(np.array([seed], dtype=np.uint64)) + np.uint64(number))
    draw = G.uniform(G.mix(G.mix(np.array([r["row_id"] for r in rows]).view(np.uint64)) ^ key))
    n = np.array([np.searchsorted(T.poisson_steps(rates[r["set"], "click", r["click"]] * fraction), d, side="right") for r, d in zip(rows, draw)])
    y = np.array([r["click"] for r in rows])
    x = np.zeros((len(rows), width), dtype=bool)
    for i, r in enumerate(rows):
        x[i, r["features"]] = True
    limit, hashes, out = int(1 / np.sqrt(width) * 2 ** 64), G.feature_hashes(width), {}

    def node(at, key, path):
        a, b = int(n[at].sum()), int((n[at] * y[at]).sum())
        best = (1e-9, None)
        for f in range(width) if a >= least and 0 < b < a else ():
            if int(G.mix(key ^ hashes[f:f + 1])[0]) > limit:
                continue
            left = at & x[:, f]
            g = float(T._gini_gain(a, b, float(n[left].sum()), float((n[left] * y[left]).sum())))
            if g > best[0]:
                best = (g, f)
        out[path] = (a, b, -1 if best[1] is None else best[1])
        if best[1] is not None:
            node(at & x[:, best[1]], G.mix(key * np.uint64(2) + np.uint64(1)), path + "1")
            node(at & ~x[:, best[1]], G.mix(key * np.uint64(2) + np.uint64(2)), path + "0")
    node(np.ones(len(rows), dtype=bool), key, "")
    return out


def paths(t):
    """The same form from a node table, per tree."""
    by = t.set_index("node")
    trees = {}
    for root in t[t["depth"] == 0].itertuples():
        stack, out = [(root.node, "")], {}
        while stack:
            i, path = stack.pop()
            r = by.loc[i]
            out[path] = (int(r["n"]), int(r["pos"]), int(r["feature"]))
            if r["feature"] >= 0:
                stack += [(int(r["left"]), path + "1"), (int(r["left"]) + 1, path + "0")]
        trees[root.tree] = out
    return trees


#: None of the nodes, the small ones and all are finished in one task.
LOCAL = [0, 6 * 80, 1 << 27]


@pytest.mark.parametrize("cells", LOCAL)
def test_forest_equals_trees_grown_alone(prep, spark, scratch, monkeypatch, cells):
    monkeypatch.setattr(G, "LOCAL_CELLS", cells)
    rows = click(prep)
    forests = T.fit_forests(rows, [("click", c) for c in FOREST], 6, seed=3)
    plain, rates = rows.collect(), T.draw_rates(rows, ["click"])
    for j, c in enumerate(FOREST):
        got = paths(forests.table(j))
        assert len(got) == c["ntree"]
        for t in (0, c["ntree"] - 1):
            assert got[t] == replay_tree(plain, rates, 6, 3, t, c["fraction"], c["min_target_node_size"]), (c, t)
        assert all(n >= c["min_target_node_size"] for tree in got.values() for n, _, f in tree.values() if f >= 0)
    # scores of a view are the mean share of its own leaves; a saved model scores alike
    scores = {(r["row_id"], r["job"]): r["prob"] for r in forests.score(rows, ["row_id"]).collect()}
    job = FOREST.index({"ntree": 7, "fraction": 0.3, "min_target_node_size": 30})
    trees = paths(forests.table(job))
    for r in plain[:25]:
        leaf = []
        for tree in trees.values():
            p = ""
            while tree[p][2] >= 0:
                p += "1" if tree[p][2] in r["features"] else "0"
            leaf.append(tree[p][1] / max(tree[p][0], 1))
        assert scores[r["row_id"], job] == pytest.approx(np.mean(leaf), abs=1e-12)
    path = scratch("forest")
    forests.save(spark, job, path)
    back = {r["row_id"]: r["prob"] for r in T.read_forest(spark, path).score(rows, ["row_id"]).collect()}
    assert back == pytest.approx({i: p for (i, j), p in scores.items() if j == job}, abs=1e-12)


def test_forest_groups_grow_one_by_one(prep, monkeypatch):
    """The bound on nodes holds for the trees of one goal and fraction, not for the grid."""
    def scans(*_):
        raise AssertionError("rows were sent by node")
    monkeypatch.setattr(G, "_send_rows", scans)
    rows, jobs = click(prep), [("click", {"ntree": 6, "fraction": f, "min_target_node_size": 8}) for f in (1.0, 0.3)]
    size = [sum(len(t[0]) for t in T.fit_forests(rows, [j], 6).groups[0][1]) for j in jobs]
    monkeypatch.setattr(G, "MAX_NODES", max(size))
    assert sum(len(t[0]) for _, trees in T.fit_forests(rows, jobs, 6).groups for t in trees) == sum(size) > max(size)
    monkeypatch.setattr(G, "MAX_NODES", max(size) - 1)
    with pytest.raises(ValueError):
        T.fit_forests(rows, jobs, 6)


@pytest.mark.parametrize("rows_,cells", [(1 << 18, 1 << 23), (60, 1 << 10)])
def test_whole_trees_from_files_equal_those_in_memory(prep, monkeypatch, rows_, cells):
    """Rows beyond one task's memory but not its files are not scanned level by level."""
    def levels(*_):
        raise AssertionError("a level was scanned")
    for name in ("_partial_sums", "_send_rows"):
        monkeypatch.setattr(G, name, levels)
    monkeypatch.setattr(G, "LOCAL_ROWS", rows_)
    monkeypatch.setattr(G, "LOCAL_CELLS", cells)
    rows = click(prep)
    forests, plain, rates = T.fit_forests(rows, [("click", c) for c in FOREST], 6, seed=3), rows.collect(), T.draw_rates(rows, ["click"])
    for j, c in enumerate(FOREST):
        got = paths(forests.table(j))
        assert len(got) == c["ntree"] and got[1] == replay_tree(plain, rates, 6, 3, 1, c["fraction"], c["min_target_node_size"])


@pytest.mark.parametrize("held,waiting", [(0, 64), (1, 64), (1 << 20, 64), (1 << 20, 0)])
def test_held_sums_give_the_same_trees(held, waiting, monkeypatch):
    rng = np.random.default_rng(5)
    lists = [sorted(rng.choice(60, rng.integers(0, 9), replace=False).tolist()) for _ in range(400)]
    batch, y, n = G.Batch(pa.array(lists, pa.list_(pa.int32()))), rng.integers(0, 2, 400).astype(float), rng.integers(1, 4, 400).astype(float)

    def grown():
        alone = G._Alone(batch, 60, T._gini_gain, lambda t, d, a, b: (a >= 5) & (b > 0) & (b < a), 1e-9, False)
        t = alone.grow(0, 0, np.array([9], dtype=np.uint64), np.uint64(1 << 62), np.arange(400), n, n * y)
        out, todo = [], [0]
        while todo:
            k = todo.pop()
            out.append((t["feature"][k], t["a"][k], t["b"][k], t["gain"][k], t["depth"][k]))
            todo += [t["left"][k] + 1, t["left"][k]] if t["feature"][k] >= 0 else []
        return out
    monkeypatch.setattr(G, "HELD_WIDTH", 0)
    plain = grown()
    monkeypatch.setattr(G, "HELD_WIDTH", held)
    monkeypatch.setattr(G, "HELD_NODES", waiting)
    assert grown() == plain and len(plain) > 100


def test_scores_do_not_depend_on_the_rows_at_once(prep, monkeypatch):
    forests = T.fit_forests(click(prep), [("click", c) for c in FOREST], 6, seed=3)
    scores = []
    for size in (1, 50, 1 << 16):
        monkeypatch.setattr(T, "SCORE_ROWS", size)
        scores.append({(r["row_id"], r["job"]): r["prob"] for r in forests.score(click(prep).coalesce(2), ["row_id"]).collect()})
    assert scores[0] == scores[1] == scores[2] and len(scores[0]) == 240 * len(FOREST)


def test_rows_are_drawn_by_their_weights(prep):
    rows = click(prep)
    rates = T.draw_rates(rows, ["click"])
    weights = {(r["set"], r["click"]): r["weight"] for r in L.case_weights(rows.withColumn("y", F.col("click"))).select("set", "click", "weight").distinct().collect()}
    scale = {round(rates[s, "click", y] / w, 6) for (s, y), w in weights.items()}
    assert len(scale) == 1 and abs(scale.pop() - 1) < 1e-3
    steps = T.poisson_steps(1.7)
    u = G.uniform(G.mix(np.arange(200_000, dtype=np.uint64)))
    drawn = np.searchsorted(steps, u, side="right")
    assert abs(drawn.mean() - 1.7) < 0.02 and abs(drawn.var() - 1.7) < 0.03


def test_forest_run_writes_model_and_rates(prep, scratch, spark):
    out = scratch("rf-run")
    run = TR.train_ml(prep, "rf", ["CLICK", "BUY"], out, configs=[FAMILIES[3][1]])
    assert [(r["Goal"], r["Status"]) for r in run.stats.collect()] == [("click", "success")]
    rates = spark.read.json(f"{out}/click/confusion").collect()[0]
    assert 0 < rates["true_positive"] <= 1
    lines = spark.read.text(f"{out}/keymap", wholetext=True).collect()[0][0].split("\n")
    assert lines[0] == "f0,f1,f2,f3,f4,f5" and lines[1] == "1,2,3,4,5,6"
    # the model is that of both sets, with each row weighted in its own set
    again = T.fit_forests(click(prep), [("click", FAMILIES[3][1])], 6)
    assert paths(spark.read.parquet(f"{out}/click/model").toPandas()) == paths(again.table(0))


def test_registered_forest_run_takes_the_whole_grid(prep, spark, monkeypatch):
    from goalcast.plans import catalog_ml as C
    grid = HYPER_PARAMETERS["RF"]
    configs = C.forest_configs(240)
    assert {(c["ntree"], c["fraction"]) for c in configs} == {(n, f) for n in grid["ntree"] for f in grid["fraction"]} and len(configs) == 12
    assert {c["min_target_node_size"] for c in C.forest_configs(10_000_000)} == set(grid["min_target_node_size"])
    monkeypatch.setattr(C, "prepared", lambda *_: prep)
    monkeypatch.setattr(C, "forest_configs", lambda n: [{**c, "ntree": c["ntree"] // 10, "min_target_node_size": 20} for c in configs])
    rows = C.q_grid_search_rf(spark, "").collect()
    assert len(rows) == 12 and {r["goal"] for r in rows} == {"click"} and sum(r["best"] for r in rows) <= 1


def test_wide_dictionary_and_few_rows_take_one_scan(prep, monkeypatch):
    """Rows, not the width of the dictionary, say whether one task may finish a node."""
    def levels(*_):
        raise AssertionError("a level was scanned")
    monkeypatch.setattr(G, "_partial_sums", levels)
    forests = T.fit_forests(click(prep), [("click", {"ntree": 2, "fraction": 1.0, "min_target_node_size": 60})], 1 << 21)
    assert len(forests.trees.root) == 2


@pytest.mark.parametrize("dense", [0, 3, 1 << 20])
def test_walk_along_chains_equals_steps(dense, monkeypatch):
    monkeypatch.setattr(G, "DENSE", dense)
    rng = np.random.default_rng(5)
    lists = [sorted(rng.choice(60, rng.integers(0, 5), replace=False).tolist()) for _ in range(400)]
    batch = G.Batch(pa.array(lists, pa.list_(pa.int32())))
    y = rng.integers(0, 2, 400).astype(float)
    alone = G._Alone(batch, 60, T._gini_gain, lambda t, d, a, b: (a >= 5) & (b > 0) & (b < a), 1e-9, False)
    t = alone.grow(0, 0, np.array([9], dtype=np.uint64), np.uint64(1 << 62), np.arange(400), np.ones(400), y)
    walker = G.Walker(np.array([0]), t["feature"], t["left"])
    assert t["depth"].max() > 10
    has, rows, at = walker.features(batch), np.arange(400), np.zeros(400, np.int64)
    for least in (150, 40, 0):                                 # each goes on where the one before ended
        stop, want = t["a"] < least, []
        for own in map(set, lists):
            node = 0
            while t["feature"][node] >= 0 and not stop[node]:
                node = t["left"][node] + (t["feature"][node] not in own)
            want.append(node)
        at = walker.down(has, rows, at, walker.stops(stop))
        assert at.tolist() == want
    leaf, n = np.unique(at, return_counts=True)
    assert t["a"][leaf].tolist() == n.tolist()


# ---------------------------------------------------------------- boosted trees


def replay_boosting(rows, width, depth, eta, rounds, seed=1):
    """Boosting on the driver by the stated rules: margins, and [(tree, path, feature, gain, cover)]."""
    x = np.zeros((len(rows), width), dtype=bool)
    for i, r in enumerate(rows):
        x[i, r["features"]] = True
    y, ids = np.array([r["click"] for r in rows]), np.array([r["row_id"] for r in rows]).view(np.uint64)
    margin, splits, hashes = np.zeros(len(rows)), [], G.feature_hashes(width)
    for t in range(rounds):
        key = G.mix(G.mix(np.array([seed], dtype=np.uint64)) + np.uint64(t))
        order = np.argsort(G.mix(key ^ hashes))
        columns = sorted(order[:max(1, int(0.8 * width))].tolist())
        drawn = G.uniform(G.mix(G.mix(ids) ^ G.mix(key))) < 0.8
        p = 1 / (1 + np.exp(-margin))
        g = np.round((p - y) / T.STEP) * T.STEP
        h = np.maximum(np.round(p * (1 - p) / T.STEP) * T.STEP, T.STEP)
        add = np.zeros(len(rows))

        def node(at, level, path):
            live = at & drawn
            a, b = h[live].sum(), g[live].sum()
            best = (T.LEAST_BOOST_GAIN, None)
            for f in columns if level < depth and a >= 2 else ():
                gain = float(T._boost_gain(a, b, h[live & x[:, f]].sum(), g[live & x[:, f]].sum()))
                if gain > best[0]:
                    best = (gain, f)
            if best[1] is None:
                add[at] = -b / (a + 1.0) * eta
                return
            splits.append((t, path, best[1], best[0], a))
            node(at & x[:, best[1]], level + 1, path + "1")
            node(at & ~x[:, best[1]], level + 1, path + "0")
        node(np.ones(len(rows), dtype=bool), 0, "")
        margin += add
    return margin, splits


@pytest.mark.parametrize("cells,dense", [(0, 64), (1 << 27, 64), (1 << 27, 0)])
def test_boosting_equals_brute_force(prep, spark, scratch, monkeypatch, cells, dense):
    monkeypatch.setattr(G, "LOCAL_CELLS", cells)
    monkeypatch.setattr(G, "DENSE", dense)
    monkeypatch.setattr(T, "MARGIN_ROUNDS", 3)
    rows = click(prep)
    plain = rows.collect()
    jobs = [("click", {"max_depth": d, "eta": e}) for d, e in ((2, 0.3), (4, 0.1))]
    model = T.fit_boosted(rows, jobs, 6, rounds=7)
    scores = {(r["row_id"], r["job"]): r["prob"] for r in model.score(rows, ["row_id"]).collect()}
    names = spark.createDataFrame([(i, f"f{i}") for i in range(6)], "idx int, name string")
    for job, (_, c) in enumerate(jobs):
        margin, splits = replay_boosting(plain, 6, c["max_depth"], c["eta"], 7)
        want = {r["row_id"]: 1 / (1 + math.exp(-m)) for r, m in zip(plain, margin)}
        assert {i: p for (i, j), p in scores.items() if j == job} == pytest.approx(want, abs=1e-9)
        path = scratch("boosted")
        model.save(spark, job, path)
        assert {r["row_id"]: r["prob"] for r in T.read_boosted(spark, path).score(rows, ["row_id"]).collect()} == pytest.approx(want, abs=1e-9)
        # importance: splits, mean gain and mean hessian per feature; one column sample a tree
        imp = {r["name"]: (r["weight"], r["gain"], r["cover"]) for r in T.importance(spark, path, names, 6).collect()}
        by = {f: [s for s in splits if s[2] == f] for f in {s[2] for s in splits}}
        assert set(imp) == {f"f{f}" for f in by}
        for f, s in by.items():
            assert imp[f"f{f}"] == pytest.approx((len(s), np.mean([v[3] for v in s]), np.mean([v[4] for v in s])), rel=1e-9)
        for t in range(7):
            assert len({s[2] for s in splits if s[0] == t}) <= int(0.8 * 6)


@pytest.mark.parametrize("goal_rows", [0, 32])
def test_chains_take_their_rounds_alone(prep, monkeypatch, goal_rows):
    """Where all rows fit into a task no round scans them; both ways give the same trees."""
    scans = []
    monkeypatch.setattr(G, "grow", lambda *a, f=G.grow, **k: scans.append(1) or f(*a, **k))
    monkeypatch.setattr(G, "WHOLE_ROWS", goal_rows)
    monkeypatch.setattr(T, "MARGIN_ROUNDS", 2)
    monkeypatch.setattr(G, "PIECE_ROWS", 7)
    rows, plain = click(prep), click(prep).collect()
    jobs = [("click", {"max_depth": d, "eta": e}) for d, e in ((2, 0.3), (4, 0.1), (6, 0.3), (2, 0.1), (6, 0.1))]
    model = T.fit_boosted(rows, jobs, 6, rounds=5)
    assert len(scans) == (0 if goal_rows else 5)
    scores = {(r["row_id"], r["job"]): r["prob"] for r in model.score(rows, ["row_id"]).collect()}
    for job, (_, c) in enumerate(jobs):
        margin, splits = replay_boosting(plain, 6, c["max_depth"], c["eta"], 5)
        assert {i: p for (i, j), p in scores.items() if j == job} == pytest.approx({r["row_id"]: 1 / (1 + math.exp(-m)) for r, m in zip(plain, margin)}, abs=1e-9)
        assert int((model.table(job)["feature"] >= 0).sum()) == len(splits)


def test_lists_in_files_hold_rows_and_features(monkeypatch):
    monkeypatch.setattr(G, "PIECE_ROWS", 16)
    rng = np.random.default_rng(2)
    rows = [sorted(rng.choice(50, rng.integers(0, 7), replace=False).tolist()) for _ in range(300)] + [None, []]
    batches = [pa.array(rows[lo:lo + 90], pa.list_(pa.int32())) for lo in range(0, len(rows), 90)]
    lists = G.Lists(iter(batches), 60)
    for f in range(60):
        assert lists.owner[lists.first[f]:lists.first[f] + lists.count[f]].tolist() == [i for i, r in enumerate(rows) if f in (r or [])]
    assert [lists.flat[x:x + k].tolist() for x, k in zip(lists.start, lists.lens)] == [r or [] for r in rows] and not lists.twice
    alone = G._Alone.over(lists, 60, T._gini_gain, None, 0.0, True)
    alone.a, alone.b = rng.random(302), rng.random(302)
    for some in (np.arange(302), np.arange(0, 302, 3)):
        for got, x in zip(alone._all(some), (alone.a, alone.b)):
            assert np.allclose(got, [sum(x[i] for i in some if f in (rows[i] or [])) for f in range(60)])
    assert G.Lists(iter([pa.array([[3, 3]], pa.list_(pa.int32()))]), 4).twice and G.Lists(iter([]), 4).n == 0


def test_rows_by_feature_walk_and_sum_like_lists():
    """Null and empty lists, features that stand twice, trees with chains on both sides, absent features."""
    rng = np.random.default_rng(3)
    lists = [None if i % 50 == 0 else sorted(rng.integers(0, 9, rng.integers(0, 6)).tolist()) for i in range(300)]
    batch = G.Batch(pa.array(lists, pa.list_(pa.int32())))
    rows = G.Postings.of(batch)
    back = rows.lists()
    assert back.lens.tolist() == batch.lens.tolist() and back.flat.tolist() == batch.flat.tolist()
    feature = np.array([3, 1, 5, -1, 3, 7, 99, -1, -1, -1, -1, -1, -1, 2, -1, -1])   # two trees, one of them 13..15
    left = np.array([1, 3, 5, -1, 7, 9, 11, -1, -1, -1, -1, -1, -1, 14, -1, -1])
    found = {t: ends[mark].tolist() for t, mark, ends in rows.walk(np.array([0, 13]), feature, left)}
    for t, root in enumerate((0, 13)):
        want = []
        for own in lists:
            node = root
            while feature[node] >= 0:
                node = left[node] + (feature[node] not in (own or []))
            want.append(node)
        assert found[t] == want
    none = G.Postings.of(G.Batch(pa.array([[], None], pa.list_(pa.int32()))))
    assert [ends[mark].tolist() for _, mark, ends in none.walk(np.array([0]), feature, left)] == [[12, 12]]


def test_blocks_hold_every_row_with_its_rarest_feature(prep, spark, monkeypatch):
    monkeypatch.setattr(T, "BLOCK_ROWS", 16)
    monkeypatch.setattr(T, "PIECE", 5)
    rows = [(i, "train", sorted({0, 1 + i % 2, 3 + i // 4}), i % 2) for i in range(400)] + [(400, "train", [], 1), (401, "train", None, 0)]
    df = spark.createDataFrame(rows, "row_id long, set string, features array<int>, click int").repartition(7, "row_id")
    table = T._packed(df, ["click"], 103, *T._size(df)).toArrow()
    want = {int(G.mix(np.array([i]).astype(np.uint64))[0]): (f or [], y) for i, _, f, y in rows}
    found, homes = {}, []
    for block, row, label, margin in (b for batch in table.to_batches() for b in T._blocks(batch)):
        own = block.lists()
        assert block.n <= 16 and margin is None
        homes += block.feature[block.feature >= 3].tolist()
        for i in range(block.n):
            assert int(row[i]) not in found
            found[int(row[i])] = own.flat[own.start[i]:own.start[i] + own.lens[i]].tolist(), int(label[0, i])
    assert found == want
    assert len(homes) <= 100 + table.num_rows                  # a rare feature is cut by the end of a block at most


@pytest.mark.parametrize("few,dense", [(4, 1 << 23), (0, 0)])
def test_boosting_scans_rows_by_feature(prep, monkeypatch, few, dense):
    """Levels are summed from the row lists of blocks; no scan walks the rows one by one."""
    def levels(*_):
        raise AssertionError("rows were walked one by one")
    monkeypatch.setattr(G, "_partial_sums", levels)
    for name, value in (("LOCAL_CELLS", 1), ("LOCAL_ROWS", 1), ("FEW", few), ("DENSE_SUMS", dense)):
        monkeypatch.setattr(G, name, value)
    for name, value in (("MARGIN_ROUNDS", 2), ("BLOCK_ROWS", 32), ("PIECE", 8)):
        monkeypatch.setattr(T, name, value)
    rows = click(prep)
    model = T.fit_boosted(rows, [("click", {"max_depth": 3, "eta": 0.3})], 6, rounds=3)
    plain = rows.collect()
    margin, splits = replay_boosting(plain, 6, 3, 0.3, 3)
    want = {r["row_id"]: 1 / (1 + math.exp(-m)) for r, m in zip(plain, margin)}
    assert {r["row_id"]: r["prob"] for r in model.score(rows, ["row_id"]).collect()} == pytest.approx(want, abs=1e-9)
    assert int((model.trees.feature >= 0).sum()) == len(splits)


def test_boosted_run_writes_importance(prep, scratch, spark, monkeypatch):
    monkeypatch.setattr(T.fit_boosted, "__defaults__", (6, 1, 0.8, 0.8))
    out = scratch("xgb-run")
    TR.train_ml(prep, "xgb", ["click"], out, configs=[FAMILIES[4][1]])
    weights = dict(r[0].split("$$") for r in spark.read.text(f"{out}/click/importance_weight").collect())
    assert set(weights) <= {f"f{i}" for i in range(6)} and ("f0" in weights or "f1" in weights)


def test_classes_weigh_like_rows(prep):
    classes = TR.goal_classes(prep, ["click"])
    assert classes.agg(F.sum("n")).first()[0] == 240 and classes.count() < 60
    model = T.fit_forests(click(prep), [("click", FAMILIES[3][1])], 6)
    by_row, by_class = (M.evaluate_sets(model.score(x, ["set"]), ["job"]).collect()[0] for x in (click(prep), classes))
    assert by_row.asDict() == pytest.approx(by_class.asDict(), abs=1e-12)


def test_run_from_sparse_log_equals_run_in_memory(prep, scratch, spark):
    base = scratch("sparse")
    W.write_header(prep.dictionary.names, f"{base}/header")
    for s in ("train", "test"):
        W.write_sparse(prep.encoded.where(F.col("set") == s), f"{base}/{s}", 6)
    rows, header = RD.load_data_group(spark, f"{base}/header", {s: f"{base}/{s}" for s in ("train", "test")})
    assert rows.count() == 240 and rows.select("row_id", "set").distinct().count() == 240 and header.count() == 11
    assert [tuple(r) for r in rows.sort("set", "row_id").limit(5).collect()] == [tuple(r) for r in rows.sort("set", "row_id").limit(5).collect()]
    a = TR.train_from_sparse(spark, f"{base}/header", {s: f"{base}/{s}" for s in ("train", "test")}, ["CLICK", "BUY"], f"{base}/run")
    b = TR.train_bayes(prep, ["CLICK", "BUY"], None)
    cols = ["goal", "config_id", "roc_auc_train", "roc_auc_test", "f1_test", "best"]
    assert sorted(map(tuple, a.grid.select(cols).collect())) == sorted(map(tuple, b.grid.select(cols).collect()))
    grid = spark.read.option("header", "true").csv(f"{base}/run/grid")
    assert grid.count() == len(HYPER_PARAMETERS["POLY2BAYES"]["rarity_threshold"])


def test_written_model_scores_as_in_memory(prep, scratch, spark):
    path = scratch("model")
    c = B.fit_counts(prep.encoded, ["click"], ("train",), combinations=True)
    W.write_bayes_model(c, "train", "click", 3, prep.dictionary.names, path)
    back = B.counts_from_model(RD.read_bayes_model(spark, path), "click")
    assert back.combinations
    a = B.score_models(prep.encoded, c, [B.ModelSpec("m", "train", "click", 3)], ["row_id"]).scores
    b = B.score_models(prep.encoded, back, [B.ModelSpec("m", "model", "click", 1)], ["row_id"]).scores
    assert {r["row_id"]: round(r["prob"], 9) for r in a.collect()} == {r["row_id"]: round(r["prob"], 9) for r in b.collect()}


def test_pairs_of_rare_singles_are_left_out_exactly(prep):
    a = B.fit_counts(prep.encoded, ["click"], ("train",), True, 12)
    b = B.fit_counts(prep.encoded, ["click"], ("train",), True, 12, prune_singles=False)
    assert sorted(map(tuple, a.keys.collect())) == sorted(map(tuple, b.keys.collect()))


def test_matrix_files(prep, scratch, spark):
    path = scratch("matrix")
    data = prep.encoded.select("row_id", "set", "features", F.col("click").alias("y")).withColumn("weight", F.lit(5000.0))
    W.write_matrix(data, prep.dictionary.names, path, 6)
    head = spark.read.text(f"{path}/header").collect()
    assert len(head) == 1 and head[0][0].split("\t") == [f"f{i}" for i in range(6)] + ["__label__"]
    rows = spark.read.text(f"{path}/rows").where("set = 'test'").collect()
    assert len(rows) == 60 and all(len(r["value"].split("\t")) == 7 for r in rows)
    want = sorted("\t".join(["1" if i in r["features"] else "0" for i in range(6)] + [str(r["click"])])
                  for r in prep.encoded.where("set = 'test'").collect())
    assert sorted(r["value"] for r in rows) == want
    weights = [r["value"].split("\t") for r in spark.read.text(f"{path}/weights").collect()]
    assert len(weights) == 240 and {w for _, w in weights} == {"5000.00000"}


def test_quoted_raw_log_fields(spark, scratch):
    import os
    data, head = scratch("rawlog"), scratch("rawhead")
    for p, text in ((data, '1$"a$b"$c\n2$"say ""hi"""$\\N\n3$$None\n'), (head, "x,y,z\nx,y,z\n")):
        os.makedirs(p.replace("file:", ""))
        with open(p.replace("file:", "") + "/part-00000", "w") as f:
            f.write(text)
    got = sorted(tuple(r) for r in RD.read_raw_log(spark, data, head).collect())
    assert got == [("1", "a$b", "c"), ("2", 'say "hi"', None), ("3", None, None)]


def test_prediction_files_in_many_blocks(spark, scratch):
    import os
    path = scratch("pred").replace("file:", "")
    os.makedirs(path)
    probs = [round(i / 5000, 4) for i in range(5000)]
    for name, head, line in (("a", "0 1 ", "{q} {p}"), ("b", "1 0", "{p} {q}"), ("c", "0", "1")):
        with open(f"{path}/{name}", "w") as f:
            f.write("Predictions\n" + head + "\n\n" + "".join(line.format(p=p, q=1 - p) + "\n" for p in probs))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7k")
    try:
        got = RD.read_predictions(spark, path).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    by = {}
    for r in got:
        by.setdefault(r["file"][-1], {})[r["row"]] = (r["prob"], r["pred"])
    want = {i: (p, int(p > 0.5)) for i, p in enumerate(probs)}
    assert by["a"] == want and by["b"] == want and by["c"] == {i: (0.0, 0) for i in range(5000)}


def test_split_of_the_flow(spark):
    df = spark.createDataFrame([(i, f"202401{1 + i % 20:02d}", i % 3 == 0) for i in range(400)], "row_id long, day_ts string, y boolean")
    days = [r[0] for r in df.select("day_ts").distinct().collect()]
    got = {r["day_ts"]: r["set"] for r in U.assign_sets(df, days, 0, "y").collect()}
    assert all(got[d] == ("train" if k < 15 else "test") for k, d in enumerate(sorted(days)))
    with pytest.raises(ValueError):
        U.assign_sets(df, days, 3, "y")
    few = U.assign_sets(df, days[:5], 3, "y").groupBy("y", "set").count().collect()
    for y, n in ((True, 134), (False, 266)):
        assert {r["set"]: r["count"] for r in few if r["y"] == y} == {"train": n - math.ceil(n / 4), "test": math.ceil(n / 4)}


def test_auc_of_crowded_scores_equals_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [("a" if i % 3 else "b", int(rng.random() < 0.3), float(1e-3 + 1e-7 * int(rng.integers(0, 60)))) for i in range(900)]
    rows += [("a", 1, 1.5), ("a", 0, 2.5)]                     # scores need not be probabilities
    df = spark.createDataFrame(rows, "g string, y int, prob double")
    got = {r["g"]: r["roc_auc"] for r in M.roc_auc(df, ["g"]).collect()}
    for g in "ab":
        pos, neg = ([s for h, y, s in rows if h == g and y == c] for c in (1, 0))
        pairs = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / len(pos) / len(neg)
        assert got[g] == pytest.approx(pairs, abs=1e-12)


def test_other_field_is_read_where_the_first_is_absent(spark):
    spec = [e for e in RQ.REQUEST_SPEC if e["name"] in ("HOW", "TOD")]
    rows = [(1, '{"device":{"ext":{"timezone_offset":2}},"timezone":5}'), (2, '{"timezone":5}'), (3, "{}")]
    df = spark.createDataFrame(rows, "k int, js string").withColumn("ts", F.to_timestamp(F.lit("2024-01-07 10:00:00")))
    got = {}
    for r in RQ.extract_features(df, "k", "js", "ts", spec).collect():
        got.setdefault(r["k"], set()).add(r["feature"])
    assert got == {1: {"HOW12", "TOD12"}, 2: {"HOW15", "TOD15"}}


def test_checkpoint_folder_must_be_shared_off_local(monkeypatch):
    from goalcast import session

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return type("C", (), {"get": staticmethod(lambda k, d=None: d)})()

    class Session:
        sparkContext = Context()
        conf = type("C", (), {"get": staticmethod(lambda k: None)})()
    with pytest.raises(ValueError):
        session.checkpoint_dir(Session())
