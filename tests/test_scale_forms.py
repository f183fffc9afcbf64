"""The forms that touch a row once (no explode, no shuffle of cells) against the joined ones."""

import gzip
import random
import zlib

import pytest
from pyspark.sql import functions as F

from goalcast.operators import bayes as B
from goalcast.operators import metrics as M
from goalcast.operators import serving as SV
from goalcast.operators.features import encode_rows, feature_cells, one_hot
from goalcast.plans import training as TR
from goalcast.sinks import writers as W

ENC = "row_id long, set string, features array<int>, click int"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _encoded(spark, n=300):
    rnd = random.Random(3)
    rows = [(i, "train" if i % 4 else "test", sorted(rnd.sample(range(40), rnd.randrange(6))), rnd.randrange(2)) for i in range(n)]
    return spark.createDataFrame([*rows, (n, "test", None, 1), (n + 1, "test", [900], 0)], ENC)


def test_encoding_touches_a_row_once_and_folds_repeated_keys(spark):
    rows = [(1, "a", "x", "t.u"), (1, "a", "y", "u"), (2, None, "x", "t..t"), (3, "b", None, None), (None, "a", "y", "u.t"), (None, "b", "x", "")]
    for some in (rows, rows[1:5]):
        df = spark.createDataFrame(some, "row_id long, p string, q string, cat string")
        enc, dic = one_hot(df, ["p", "q"], ["cat"], ["row_id"], 1)
        cells = encode_rows(feature_cells(df, ["p", "q"], ["cat"], ["row_id"]), dic, ["row_id"])
        assert sorted(map(str, enc.collect())) == sorted(map(str, cells.collect()))
        assert "Generate" not in _plan(enc)
    assert "Aggregate" not in _plan(enc)                       # no key repeats: no row is shuffled


def test_scores_need_no_shuffle_and_equal_the_joined_ones(spark, monkeypatch):
    enc = _encoded(spark)
    c = B.fit_counts(enc, ["click"], ("train", "unified"))
    specs = [B.ModelSpec(f"{s}{t}", s, "click", t) for s in ("train", "unified") for t in (1, 25, 1000)]
    here = B.score_models(enc, c, specs, ["row_id"]).scores
    per_row, _ = B._row_sums(enc, c, specs, ["row_id"], None, B.key_params(c))
    assert "Aggregate" not in _plan(per_row) and "Generate" not in _plan(per_row)
    got = {(r.row_id, r.model_id): (r.y, r.prob, r.pred) for r in here.collect()}
    monkeypatch.setattr(B, "broadcast_rows", lambda df: 0)
    joined = {(r.row_id, r.model_id): (r.y, r.prob, r.pred) for r in B.score_models(enc, c, specs, ["row_id"]).scores.collect()}
    assert got.keys() == joined.keys() and len(got) == 302 * 6
    for k, v in joined.items():
        assert got[k][::2] == v[::2] and got[k][1] == pytest.approx(v[1], abs=1e-9)


def test_names_and_indices_need_no_shuffle(spark, monkeypatch):
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "idx int, name string")
    rows = spark.createDataFrame([(1, ["c", "a", "c", "zz", None]), (2, None), (3, []), (4, ["zz"])], "row_id long, names array<string>")
    found = SV.names_to_indices(rows, "row_id", "names", names, 3)
    assert "Aggregate" not in _plan(found) and "Generate" not in _plan(found)
    want = {1: ([0, 2], ["a", "c"]), 2: ([], []), 3: ([], []), 4: ([], [])}
    assert {r.row_id: (r.features, r.known) for r in found.collect()} == want
    twice = SV.names_to_indices(rows.unionByName(rows.withColumn("names", F.array(F.lit("b")))), "row_id", "names", names, 3)
    assert {r.row_id: r.features for r in twice.collect()} == {1: [0, 1, 2], 2: [1], 3: [1], 4: [1]}
    enc = spark.createDataFrame([(1, [0, 2, 9]), (2, []), (3, None)], "row_id long, features array<int>")
    back = SV.indices_to_names(enc, "row_id", names, 3)
    assert "Aggregate" not in _plan(back)
    assert {r.row_id: r.names for r in back.collect()} == {1: ["a", "c"], 2: [], 3: []}


def test_auc_of_sorted_partitions(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice(["g", "h", None]), rnd.randrange(3), rnd.randrange(2), rnd.randrange(40) / 8.0) for _ in range(2000)]
    df = spark.createDataFrame([*rows, ("one", 0, 1, 0.5), ("g", 0, 1, None), ("g", 1, 0, float("nan"))], "a string, b int, y int, prob double")
    table = M.score_table(df, ["a", "b"])
    auc = {(r.a, r.b): r.roc_auc for r in M.roc_auc_from_table(table, ["a", "b"]).collect()}
    for key in {r[:2] for r in rows}:
        pos = [r[3] for r in rows if r[:2] == key and r[2]]
        neg = [r[3] for r in rows if r[:2] == key and not r[2]]
        want = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
        assert auc[key] == pytest.approx(want, abs=1e-12)
    assert auc["one", 0] is None and len(auc) == 10
    assert df.count() == 2003 and "Window" not in _plan(table)


def test_equal_thresholds_are_one_model(spark):
    enc = _encoded(spark)
    c = B.fit_counts(enc, ["click"], ("train", "unified"))
    least = min(r.n_train for r in c.keys.collect() if r.n_train)
    ts = [1, least, least + 1, 10_000, 20_000]
    same = TR.equal_thresholds(c, "train", ts)
    assert same[1] == same[least] == 1 and same[least + 1] == least + 1 and same[10_000] == same[20_000] == 10_000


def test_batches_without_any_feature_score_the_baseline(spark):
    enc = spark.createDataFrame([(1, "train", [], 1), (2, "train", None, 0)], ENC)
    c = B.fit_counts(enc, ["click"], ("train",))
    assert [r.prob for r in B.score_models(enc, c, [B.ModelSpec("m", "train", "click", 1)], ["row_id"]).scores.collect()] == [0.5, 0.5]


def test_matrix_rows_are_compressed_at_the_fastest_level(spark, tmp_path):
    width = 5000
    held = [(i, "train", [i % width, (37 * i) % 900 + 3000] if i % 9 else [], i % 2, 1.0) for i in range(60)]
    held = [(i, s, sorted(set(f)), y, w) for i, s, f, y, w in held]
    rows = spark.createDataFrame(held, "row_id long, set string, features array<int>, y int, weight double").coalesce(1)
    names = spark.createDataFrame([(i, f"f{i}") for i in range(width)], "idx int, name string")
    W.write_matrix(rows, names, str(tmp_path), width)
    parts = list((tmp_path / "rows" / "set=train").glob("*.gz"))
    text = b"".join(gzip.decompress(p.read_bytes()) for p in parts)
    want = ["\t".join([*("1" if j in f else "0" for j in range(width)), str(y)]) for _, _, f, y, _ in held]
    assert text.decode().splitlines() == want
    assert sum(p.stat().st_size for p in parts) > 2 * len(zlib.compress(text))   # shorter, and twice as long to write
