"""The reference's own unit cases, as DataFrame cases."""

import pytest
from pyspark.sql import functions as F

from goalcast.constants import HYPER_PARAMETERS
from goalcast.functions import columns as C
from goalcast.operators import bayes as B
from goalcast.operators import serving as SV
from goalcast.operators.selection import expand_grid
from goalcast.sources import readers as RD


def test_hour_of_week(spark):
    df = spark.createDataFrame(
        [("2017-05-16T17:23:33.572Z", "-5"), ("2017-05-17T17:47:12.574Z", "-5"),
         ("2013-05-12T03:47:12.574Z", "0"), ("2013-05-12T03:47:12.574Z", None)], "ts string, off string")
    out = df.select(C.hour_of_week(F.to_timestamp("ts"), "off").alias("h")).collect()
    assert [r.h for r in out][:2] == ["60", "84"]
    assert out[2].h == out[3].h


def test_hour_of_week_backslash_n_is_zero(spark):
    df = spark.createDataFrame([("2013-05-12T03:47:12.574Z", "\\N"), ("2013-05-12T03:47:12.574Z", "0")],
                               "ts string, off string")
    out = [r.h for r in df.select(C.hour_of_week(F.to_timestamp("ts"), "off").alias("h")).collect()]
    assert out[0] == out[1]


PARAMS = """
From_Date=20170501
To_Date=20170607
Exchange="'Rubicon'"
Campaign="{camps}"
iOS_OSV=
Goal="'BUY','CLICK','DOWNLOAD','REGISTER'"
Algorithm="'SGD'"
"""


def _params(spark, lower):
    camps = ",".join(f"'{100000000 + i}'" for i in range(250))
    text = PARAMS.format(camps=camps)
    lines = spark.createDataFrame([("f", i, line) for i, line in enumerate(text.split("\n"))],
                                  "file string, line_no int, line string")
    rows = RD.parse_parameters(lines, lower_values=lower).collect()
    return {r.key: (r["values"] if r.is_list or r["values"] is None else r["values"][0]) for r in rows}


def test_parameters_without_lowercase(spark):
    p = _params(spark, False)
    assert p["From_Date"] == "20170501" and p["To_Date"] == "20170607"
    assert p["Exchange"] == ["Rubicon"]
    assert len(p["Campaign"]) == 250 and "100000018" in p["Campaign"]
    assert p["iOS_OSV"] is None
    assert p["Goal"] == ["BUY", "CLICK", "DOWNLOAD", "REGISTER"]
    assert p["Algorithm"] == ["SGD"]


def test_parameters_with_lowercase(spark):
    p = _params(spark, True)
    assert p["Exchange"] == ["rubicon"]
    assert p["Goal"] == ["buy", "click", "download", "register"]
    assert p["Algorithm"] == ["sgd"]
    assert p["iOS_OSV"] is None


def test_parameters_last_duplicate_wins_and_bad_line(spark):
    lines = spark.createDataFrame([("f", 0, "A=1"), ("f", 1, "A=2")], "file string, line_no int, line string")
    assert RD.parse_parameters(lines).collect()[0]["values"] == ["2"]
    bad = spark.createDataFrame([("f", 0, "A=1"), ("f", 1, "no equals")], "file string, line_no int, line string")
    try:
        RD.parse_parameters(bad)
        raise AssertionError("expected an error")
    except ValueError as ex:
        assert "line 2" in str(ex)


def test_option_space(spark, scratch):
    import json
    space = {"a": [1, 2], "b": ["h"], "c": ["A", "B", "C"]}
    path = scratch("grid")
    spark.createDataFrame([(json.dumps(space),)], "value string").write.text(path)
    g = RD.read_grid(spark, path, list(space))
    assert g.count() == 6
    assert g.where("a = 1").count() == 3
    assert g.where("c = 'A'").count() == 2
    assert g.where("b = 'h'").count() == 6
    assert sorted(r.config_id for r in g.collect()) == list(range(6))
    assert len(expand_grid(space)) == 6 and expand_grid({}) == [{}]


def test_grid_sizes():
    sizes = {k: len(expand_grid(v)) for k, v in HYPER_PARAMETERS.items()}
    assert sizes == {"SGD": 150, "LASSO": 10, "NB": 14, "POLY2BAYES": 5, "RF": 12, "XGB": 4}


def _write_pred(spark, path, lines):
    spark.createDataFrame([("\n".join(lines) + "\n",)], "value string").coalesce(1).write.text(path)


def test_load_prediction_both_orders(spark, scratch):
    body1 = ["Class predictions, one sample per row.", "0 1 ", "", "1 0", "0 1", "0.975 0.025",
             "0.999925 7.51005e-05 ", "0.666666 0.333333"]
    body2 = ["Class predictions, one sample per row.", "1 0", "", "0 1", "1 0", "0.025 0.975",
             "7.51005e-05 0.999925", "0.333333 0.666666"]
    for body in (body1, body2):
        path = scratch("pred")
        _write_pred(spark, path, body)
        rows = sorted(RD.read_predictions(spark, path).collect(), key=lambda r: r.row)
        assert [r.prob for r in rows] == pytest.approx([0.0, 1.0, 0.025, 7.51005e-05, 0.333333], rel=1e-9)
        assert [r.pred for r in rows] == [0, 1, 0, 0, 0]


def test_load_prediction_without_positive_column(spark, scratch):
    path = scratch("pred")
    _write_pred(spark, path, ["Class predictions, one sample per row.", "0", "", "1", "1"])
    rows = RD.read_predictions(spark, path).collect()
    assert [r.prob for r in rows] == [0.0, 0.0] and [r.pred for r in rows] == [0, 0]


def test_pair_keys_of_two_features(spark):
    # features a=0, c=2 -> keys (0,0), (0,2), (2,2)
    df = spark.createDataFrame([([0, 2],)], "features array<int>")
    keys = [(r.k.i, r.k.j) for r in df.select(F.explode(B.key_array(F.col("features"), True)).alias("k")).collect()]
    assert len(keys) == 3 and (0, 2) in keys


def test_cr_adapter_steps_and_fallback(spark):
    df = spark.createDataFrame([(4.0,), (2.0,), (0.0,)], "p double")
    out = [r.cr for r in df.select(SV.cr_step(F.col("p"), [3, 2, 1], [8, 7, 9, 13]).alias("cr")).collect()]
    assert out == [8.0, 7.0, 13.0]
    ident = [r.cr for r in spark.createDataFrame([(0.3,), (17.0,)], "p double")
             .select(SV.cr_step(F.col("p"), None, None).alias("cr")).collect()]
    assert ident == [0.3, 17.0]
