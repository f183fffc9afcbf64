"""Random properties (hypothesis): Bayes scoring vs a direct likelihood, AUC vs the
pairwise definition, CR step monotone, splits disjoint and complete."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from goalcast.operators import bayes as B
from goalcast.operators import metrics as M
from goalcast.operators import serving as SV
from goalcast.operators import splits as U

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

rows_st = st.lists(st.tuples(st.sets(st.integers(0, 5), max_size=4), st.integers(0, 1)), min_size=4, max_size=25)


@SETTINGS
@given(rows_st, st.sets(st.integers(0, 7), max_size=4))
def test_bayes_matches_direct_likelihood(spark, rows, test_feats):
    data = [(i, "train", sorted(f), y) for i, (f, y) in enumerate(rows)] + [(999, "test", sorted(test_feats), 0)]
    enc = spark.createDataFrame(data, "row_id long, set string, features array<int>, click int")
    c = B.fit_counts(enc, ["click"], ("train",))
    got = [r for r in B.score_models(enc, c, [B.ModelSpec("m", "train", "click", 1)], ["row_id"]).scores.collect()
           if r.row_id == 999][0]
    n = len(rows)
    npos = sum(y for _, y in rows)
    keys = sorted({k for f, _ in rows for k in f})
    lp = math.log(npos + 1) - math.log(n + 2)
    ln_ = math.log(n - npos + 1) - math.log(n + 2)
    for k in keys:
        cp = sum(1 for f, y in rows if y == 1 and k in f)
        cn = sum(1 for f, y in rows if y == 0 and k in f)
        pp, pn = (cp + 1) / (npos + 2), (cn + 1) / (n - npos + 2)
        lp += math.log(pp) if k in test_feats else math.log(1 - pp)
        ln_ += math.log(pn) if k in test_feats else math.log(1 - pn)
    expect = math.exp(lp - np.logaddexp(lp, ln_))
    assert got.prob == pytest.approx(expect, rel=1e-9, abs=1e-12)
    assert got.pred == int(lp > ln_)


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 1), st.sampled_from([0.1, 0.2, 0.2, 0.5, 0.7, 0.9, 1e-9, 0.999])),
                min_size=2, max_size=40))
def test_auc_matches_pairwise(spark, rows):
    df = spark.createDataFrame([("g", y, s) for y, s in rows], "grp string, y int, prob double")
    got = M.roc_auc(df, ["grp"]).collect()[0].roc_auc
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    if not pos or not neg:
        assert got is None
        return
    pairs = sum(1.0 if p > q else 0.5 if p == q else 0.0 for p in pos for q in neg)
    assert got == pytest.approx(pairs / (len(pos) * len(neg)))


@SETTINGS
@given(st.lists(st.floats(0, 1), min_size=2, max_size=20))
def test_cr_step_is_a_step_function(spark, probs):
    thresholds, crs = [0.8, 0.5, 0.2], [0.4, 0.3, 0.2, 0.1]
    df = spark.createDataFrame([(p,) for p in probs], "p double")
    out = df.select("p", SV.cr_step(F.col("p"), thresholds, crs).alias("cr")).collect()
    for r in out:
        k = next((i for i, t in enumerate(thresholds) if r.p >= t), len(thresholds))
        assert r.cr == crs[k]


@SETTINGS
@given(st.integers(1, 500))
def test_hash_split_disjoint_and_complete(spark, n):
    df = spark.range(n).withColumnRenamed("id", "row_id").withColumn("set", U.stratified_set(F.col("row_id")))
    counts = {r.set: r["count"] for r in df.groupBy("set").count().collect()}
    assert sum(counts.values()) == n and set(counts) <= {"train", "test"}
