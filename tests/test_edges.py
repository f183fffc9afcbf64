"""Edge rows from FIXTURES.md §4 (hand-made, small)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from goalcast.functions import columns as C
from goalcast.operators import bayes as B
from goalcast.operators import labels as L
from goalcast.operators import metrics as M
from goalcast.operators import selection as S
from goalcast.operators import serving as SV
from goalcast.operators import splits as U
from goalcast.operators.features import build_dictionary, encode_rows, feature_cells, level_counts
from goalcast.sinks import writers as W
from goalcast.sources import readers as RD


def test_sparse_edge_lines(spark, scratch):
    hpath, dpath = scratch("h"), scratch("d")
    spark.createDataFrame([("f0\tf1\tf2\tclick\tbuy",)], "value string").coalesce(1).write.text(hpath)
    lines = ["0\t2\t3", "", "1\tx\t3", "0\t9", "2\t2\t4", "  1\t3  "]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(dpath)
    header = RD.read_header(spark, hpath)
    assert [r.name for r in header.orderBy("idx").collect()] == ["f0", "f1", "f2", "click", "buy"]
    rows = sorted((tuple(r.features), r.click, r.buy) for r in RD.read_sparse(spark, header, dpath).collect())
    # empty line and non-integer token dropped; 9 (beyond labels) ignored; duplicate index once
    assert rows == [((0,), 0, 0), ((0, 2), 1, 0), ((1,), 1, 0), ((2,), 0, 1)]


def test_header_needs_exactly_one_part(spark, scratch):
    path = scratch("h2")
    spark.createDataFrame([("a",), ("b",)], "value string").repartition(2).write.text(path)
    with pytest.raises(OSError):
        RD.read_header(spark, path)
    with pytest.raises(OSError):
        RD.read_header(spark, scratch("missing"))


def test_location_combinations_nulls(spark):
    df = spark.createDataFrame(
        [("adx", "US", None, "LA"), ("mopub", "US", None, "LA"), (None, "US", "CA", None), ("adx", "US", "CA", "SF")],
        "exchange2 string, loc_country string, loc_state string, loc_city string")
    d = df.withColumn("country_state", C.country_state()).withColumn("country_state_city", C.country_state_city())
    got = [(r.country_state, r.country_state_city) for r in d.collect()]
    assert got == [(None, "LA"), ("US:nan", "US:nan:LA"), ("US:CA", "US:CA:nan"), ("CA", "SF")]


def _dictionary(spark, rows, attrs, lists, threshold, families=None):
    df = spark.createDataFrame(rows)
    cells = feature_cells(df, attrs, lists, ["row_id"])
    lv = level_counts(cells)
    dic = build_dictionary(lv, threshold, families)
    names = [r.name for r in dic.names.orderBy("idx").collect()]
    enc = {r.row_id: list(r.features) for r in encode_rows(cells, dic, ["row_id"]).collect()}
    return names, enc


def test_one_hot_rarity_other_and_constant(spark):
    rows = [{"row_id": i, "a": v, "b": "k", "c": w, "cat": t}
            for i, (v, w, t) in enumerate([("x", "BROTHER", "u.u.v"), ("x", "BROTHER", "u"), ("y", "z", None),
                                           ("x", "z", "v.w"), (None, "z", "")])]
    names, enc = _dictionary(spark, rows, ["a", "b", "c"], ["cat"], 2)
    # a: x (3, kept at >= 2), y rare -> OTHER, null -> OTHER; b constant -> dropped;
    # c: BROTHER ends with OTHER -> dropped; z kept. cat: u counted once per row (2), v 2, w 1 rare, '' 1
    assert names == ["ax", "cz", "catu", "catv"]
    assert enc[0] == [0, 2, 3] and enc[2] == [1] and enc[4] == [1]


def test_level_exactly_at_threshold_is_kept(spark):
    rows = [{"row_id": i, "a": "p" if i < 3 else "q"} for i in range(5)]
    names, _ = _dictionary(spark, rows, ["a"], [], 3)
    assert names == ["ap"]


def test_location_patch_drops_duplicates(spark):
    rows = [{"row_id": i, "country_state": "X", "loc_country": "X"} for i in range(4)]
    rows += [{"row_id": 9, "country_state": "Y", "loc_country": "Z"}] * 1
    names, _ = _dictionary(spark, rows, ["country_state", "loc_country"], [], 1,
                           ["country_state_city", "country_state", "loc_country", "zip"])
    # both rename to locationX -> both removed; Y and Z stay
    assert names == ["locationY", "locationZ"]


def test_split_13_and_14_days(spark):
    def frame(n_days):
        base = dt.date(2024, 1, 1)
        df = spark.createDataFrame([(i, (base + dt.timedelta(days=i % n_days)).strftime("%Y%m%d"), i % 4)
                                    for i in range(200)], "row_id long, day_ts string, y int")
        return U.assign_sets(df, [r.day_ts for r in df.select("day_ts").distinct().collect()], 0, "y")
    d14 = frame(14)
    days = {r.day_ts: r.set for r in d14.select("day_ts", "set").distinct().collect()}
    assert sorted(days.items())[9][1] == "train" and sorted(days.items())[10][1] == "test"  # floor(0.75*14)=10
    d13 = frame(13)
    assert d13.where("set = 'train'").count() + d13.where("set = 'test'").count() == 200
    assert d13.select("day_ts", "set").distinct().count() > 13  # hash split mixes days


def test_goal_needs_ten_of_each_class_in_every_set(spark):
    rows = [("train", 1 if i < 10 else 0, 1 if i < 9 else 0) for i in range(30)] + \
           [("test", 1 if i < 10 else 0, 1 if i < 10 else 0) for i in range(30)]
    df = spark.createDataFrame(rows, "set string, click int, buy int")
    v = {r.goal: r.valid for r in L.valid_goals(df, ["CLICK", "BUY", "DOWNLOAD"]).collect()}
    assert v == {"click": True, "buy": False, "download": False}
    with pytest.raises(ValueError):
        L.valid_goals(df, ["nope"])


def test_auc_ties_count_half_and_nan(spark):
    df = spark.createDataFrame([("g", 1, 0.5), ("g", 0, 0.5), ("g", 1, 0.9), ("g", 0, 0.1), ("h", 1, 0.3)],
                               "grp string, y int, prob double")
    auc = {r.grp: r.roc_auc for r in M.roc_auc(df, ["grp"]).collect()}
    assert auc["g"] == pytest.approx((1 + 0.5 + 1 + 1) / 4)
    assert auc["h"] is None


def test_threshold_to_class_at_half(spark):
    from goalcast.operators.trees import score_probabilistic  # noqa: F401  (same rule)
    df = spark.createDataFrame([(0.5,), (0.5000001,)], "p double")
    assert [r.c for r in df.select((F.col("p") > 0.5).cast("int").alias("c")).collect()] == [0, 1]
    steps = [r.cr for r in df.select(SV.cr_step(F.col("p"), [0.5], [1.0, 2.0]).alias("cr")).collect()]
    assert steps == [1.0, 1.0]


def test_row_without_known_feature_scores_baseline(spark):
    enc = spark.createDataFrame([(1, "train", [0, 1], 1), (2, "train", [1], 0), (3, "train", [0], 0),
                                 (4, "test", [], 0), (5, "test", [7], 1)],
                                "row_id long, set string, features array<int>, click int")
    c = B.fit_counts(enc, ["click"], ("train",))
    sc = {r.row_id: r for r in B.score_models(enc, c, [B.ModelSpec("m", "train", "click", 1)],
                                              ["row_id"]).scores.collect()}
    assert sc[4].prob == pytest.approx(sc[5].prob)
    n, npos = 3, 1
    prior = (npos + 1) / (n + 2)
    assert 0 < sc[4].prob < 1 and sc[4].l1 != 0 and prior > 0


def test_all_configs_invalid_and_nan_auc(spark):
    grid = spark.createDataFrame([("g", 0, 0.4, 0.4), ("g", 1, 0.9, 0.45), ("h", 0, float("nan"), 0.7)],
                                 "goal string, config_id int, roc_auc_train double, roc_auc_test double")
    sel = {(r.goal, r.config_id): (r.valid_model, r.best) for r in S.select_best(grid, ["goal"]).collect()}
    assert sel[("g", 0)] == (False, False) and sel[("g", 1)] == (False, False)
    # NaN train AUC -> NaN difference -> invalid
    assert sel[("h", 0)] == (False, False)


def test_best_agent_first_on_ties(spark):
    df = spark.createDataFrame([(1, 0, 0.2), (1, 1, 0.7), (1, 2, 0.7), (2, 0, 0.1)],
                               "req int, agent int, prediction double")
    got = {r.req: r.agent for r in SV.best_agent(df, "req").collect()}
    assert got == {1: 1, 2: 0}


def test_agent_groups(spark):
    df = spark.createDataFrame([(1, ["a1", "a2", "b1", "b2"], ["r"])], "k int, ap array<string>, rp array<string>")
    rows = sorted((r.agent, tuple(r.props)) for r in SV.fan_out(df, "k", "ap", "rp", 2).collect())
    assert rows == [(0, ("r", "a1", "a2")), (1, ("r", "b1", "b2"))]
    one = SV.fan_out(df, "k", "ap", "rp", 0).collect()
    assert len(one) == 1


def test_case_weights(spark):
    df = spark.createDataFrame([("train", 1), ("train", 0), ("train", 0), ("train", 0)], "set string, y int")
    w = sorted({(r.y, r.weight) for r in L.case_weights(df).collect()})
    assert w == [(0, round(4 / 6, 5)), (1, 2.0)]


def test_keymap_and_header_lines(spark):
    names = spark.createDataFrame([(1, "b"), (0, "a")], "idx int, name string")
    assert W.header_line(names, ["click"]).collect()[0].value == "a\tb\tclick"
    assert sorted(r.value for r in W.keymap_lines(names).collect()) == ["a$$0", "b$$1"]
