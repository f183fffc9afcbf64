"""Registered queries against their DuckDB oracle on the smallest data set."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()
FAST = ["hour_of_week", "location_combos", "rare_levels", "feature_dictionary", "one_hot_lists", "case_weights",
        "valid_goals", "temporal_split", "single_counts", "bayes_score", "grid_search_bayes", "sparse_scan",
        "params_scan", "request_features", "agent_fanout", "bernoulli_nb"]


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return int(v) if v == int(v) and abs(v) < 1e15 else v
    if isinstance(v, bool):
        return int(v)
    return v


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(hashlib.md5(repr(tuple(_norm(r[i]) for i in order)).encode()).hexdigest() for r in rows)


@pytest.fixture(scope="module")
def duck():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    con.execute("SET TimeZone='UTC'")
    return con


def test_every_query_has_oracle_or_is_declared_rows_only():
    rows_only = {q for q in set(E.queries()) - set(E.oracle_sql()) if not q.startswith("op") and q != "pipeline"}
    assert rows_only <= {"lasso_fit", "svm_fit", "linear_custom_fit", "forest_fit", "gbt_fit",
                         "tree_importance", "grid_search_gbt", "grid_search_sgd", "grid_search_rf", "train_goal_lasso",
                         "train_goal_rf", "train_goal_xgb"}


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _digest(df.columns, srows) == _digest(dcols, drows)
