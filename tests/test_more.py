"""Distributed dense index, incremental mixing, zipped model import."""

import io
import os
import zipfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from goalcast.operators import bayes as B
from goalcast.plans.indexing import dense_index
from goalcast.sources import readers as RD


def test_dense_index_matches_global_rank(spark):
    df = spark.createDataFrame([(g, f"n{(k * 7919) % 1000:04d}") for g in range(3) for k in range(400)],
                               "grp int, name string").distinct()
    got = dense_index(df, [F.col("grp"), F.col("name")], n_partitions=5)
    ref = df.withColumn("idx", F.row_number().over(Window.orderBy("grp", "name")) - 1)
    a = sorted((r.grp, r.name, r.idx) for r in got.collect())
    b = sorted((r.grp, r.name, r.idx) for r in ref.collect())
    assert a == b


def test_incremental_mix_gate():
    assert B.incremental_alpha(25) == (0.5, True)
    assert B.incremental_alpha(19) == (0.5, False)


def test_mixed_scores_in_one_pass(spark):
    enc = spark.createDataFrame([(i, "train" if i < 30 else "late", [i % 3, 3 + i % 2], int(i % 5 == 0)) for i in range(40)],
                                "row_id long, set string, features array<int>, click int")
    c = B.fit_counts(enc, ["click"], ("train", "late"))
    specs = [B.ModelSpec(s, s, "click", 1) for s in ("train", "late")]
    both = {(r.row_id, r.model_id): r.prob for r in B.score_models(enc, c, specs, ["row_id"]).scores.collect()}
    mixed = B.mixed_scores(enc, c, *specs, ["row_id"], 0.4).collect()
    assert all(r.prob == pytest.approx(0.4 * both[r.row_id, "train"] + 0.6 * both[r.row_id, "late"]) for r in mixed)
    alone = B.mixed_scores(enc, c, *specs, ["row_id"], 0.5, use_recent=False).collect()
    assert all(r.prob == pytest.approx(both[r.row_id, "train"]) for r in alone)


def test_read_bayes_zip(spark, scratch):
    path = scratch("zip")
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        z.writestr("index", "a\t0\nb\t1\nc\t2\n")
        z.writestr("historical/positive_counts", "0,0\t3\n0,2\t1\n\n")
        z.writestr("historical/negative_counts", "0,0\t5\n2,2\t4\n")
        z.writestr("historical/label_counts", "positive\t10\nnegative\t90\n")
        z.writestr("thresholds", "thresholds\t3\t2\t1\ncrs\t8\t7\t9\t13\n")
    with open(os.path.join(path.replace("file:", ""), "simple.zip"), "wb") as f:
        f.write(buf.getvalue())
    m = RD.read_bayes_zip(spark, path)
    keys = sorted((r.i, r.j, r.pos, r.neg) for r in m["keys"].collect())
    assert keys == [(0, 0, 3, 5), (0, 2, 1, 0), (2, 2, 0, 4)]
    t = m["totals"].collect()[0]
    assert (t.pos, t.neg) == (10, 90)
    assert sorted((r.name, r.idx) for r in m["index"].collect()) == [("a", 0), ("b", 1), ("c", 2)]
    th = {r.row: r["values"] for r in m["thresholds"].collect()}
    assert th["thresholds"] == [3.0, 2.0, 1.0] and th["crs"] == [8.0, 7.0, 9.0, 13.0]


def test_lookup_join_heavy_light_split(spark):
    from goalcast.plans.indexing import lookup_join
    big = spark.createDataFrame([(i, "hot" if i % 3 == 0 else f"k{i % 7}") for i in range(300)], "row int, key string")
    small = big.groupBy("key").agg(F.count(F.lit(1)).alias("freq")).withColumn("val", F.length("key"))
    small = small.where(F.col("key") != "k5")  # a key missing from the lookup stays (left join)
    ref = sorted(tuple(r) for r in big.join(small, ["key"], "left").select("row", "key", "val").collect())
    got = lookup_join(big, small, ["key"], n_small=small.count(), freq_col="freq", total_rows=300, limit=2)
    assert sorted(tuple(r) for r in got.select("row", "key", "val").collect()) == ref


def test_cr_step_table_range_join(spark):
    from goalcast.operators import serving as SV
    steps = spark.createDataFrame([(0, 3.0, float("inf"), 8.0), (1, 2.0, 3.0, 7.0), (2, 1.0, 2.0, 9.0),
                                   (3, float("-inf"), 1.0, 13.0)], "ord int, lower double, upper double, cr double")
    df = spark.createDataFrame([(4.0,), (2.0,), (0.0,)], "p double")
    got = sorted((r.p, r.cr) for r in SV.cr_step_table(df, "p", steps).collect())
    assert got == [(0.0, 13.0), (2.0, 7.0), (4.0, 8.0)]


def test_bayes_with_pair_keys_matches_direct(spark):
    import math
    rows = [([0, 1], 1), ([0, 1], 0), ([0, 2], 1), ([1, 2], 0), ([0, 1, 2], 1), ([2], 0)]
    data = [(i, "train", f, y) for i, (f, y) in enumerate(rows)] + [(99, "test", [0, 1], 0)]
    enc = spark.createDataFrame(data, "row_id long, set string, features array<int>, click int")
    c = B.fit_counts(enc, ["click"], ("train",), combinations=True, min_count=1)
    got = [r for r in B.score_models(enc, c, [B.ModelSpec("m", "train", "click", 1)], ["row_id"]).scores.collect()
           if r.row_id == 99][0]
    keys = sorted({(a, b) for f, _ in rows for ia, a in enumerate(f) for b in f[ia:]})
    n, npos = len(rows), sum(y for _, y in rows)
    lp = math.log(npos + 1) - math.log(n + 2)
    ln_ = math.log(n - npos + 1) - math.log(n + 2)
    present = {(0, 0), (0, 1), (1, 1)}
    for k in keys:
        cp = sum(1 for f, y in rows if y == 1 and k[0] in f and k[1] in f)
        cn = sum(1 for f, y in rows if y == 0 and k[0] in f and k[1] in f)
        pp, pn = (cp + 1) / (npos + 2), (cn + 1) / (n - npos + 2)
        lp += math.log(pp) if k in present else math.log(1 - pp)
        ln_ += math.log(pn) if k in present else math.log(1 - pn)
    assert got.l1 == pytest.approx(lp) and got.l0 == pytest.approx(ln_)


def test_stream_takes_a_new_model_version_between_batches(spark, scratch):
    from goalcast.sinks import versions as V
    from goalcast.streaming import scoring as ST
    enc = spark.createDataFrame([(i, "train", [i % 3, 3 + i % 2], i % 2) for i in range(40)],
                                "row_id long, set string, features array<int>, click int")
    spec = [B.ModelSpec("m", "train", "click", 1)]
    src, base = scratch("stream-src"), scratch("stream-model")
    enc.repartition(4).write.parquet(src)
    first, second = enc, enc.where("row_id % 5 > 0")           # what the two versions are fitted on

    def score(batch, counts):
        return B.score_models(batch, counts, spec, ["row_id"]).scores.select("row_id", "prob")

    def publish(rows):
        return V.publish(spark, base, lambda folder: rows.write.parquet(folder))
    with pytest.raises(ValueError):
        V.Versioned(spark, base, lambda folder: None).get()
    assert publish(first) == 1
    seen = []

    def score_and_swap(batch, counts):
        out = score(batch, counts)
        if not seen:
            assert publish(second) == 2                        # while the first batch runs
        seen.append({r["row_id"] for r in batch.select("row_id").collect()})
        return out
    model = V.Versioned(spark, base, lambda folder: B.fit_counts(spark.read.parquet(folder), ["click"], ("train",)))
    sink, ck = scratch("stream-sink"), scratch("stream-ck")
    ST.run_to_completion(ST.start_scoring_stream(spark, src, enc.schema, score_and_swap, model, sink, ck, max_files_per_trigger=1))
    assert len(seen) == 4 and model.loads == 2 and model.number == 2
    got = {r.row_id: round(r.prob, 12) for r in ST.read_sink(spark, sink).collect()}
    want = [{r.row_id: round(r.prob, 12) for r in score(enc, B.fit_counts(x, ["click"], ("train",))).collect()} for x in (first, second)]
    assert want[0] != want[1]
    assert got == {i: want[0 if i in seen[0] else 1][i] for i in range(40)}


def test_day_counts_are_sums_of_days(spark, scratch):
    rows = [(i, f"202401{1 + i % 9:02d}" if i % 50 else None, "train" if i % 9 < 7 else "test", sorted({i % 5, 5 + i % 3}), int(i % 4 == 0), int(i % 6 == 0))
            for i in range(300)]
    enc = spark.createDataFrame(rows, "row_id long, day_ts string, set string, features array<int>, click int, buy int")
    recent = (F.col("set") == "train") & (F.col("day_ts") >= "20240105")
    scopes = {"train": F.col("set") == "train", "recent": recent, "unified": F.lit(True)}
    path, late = scratch("day-counts"), F.coalesce(F.col("day_ts") == "20240109", F.lit(False))
    B.write_day_counts(enc.where(~late), ["click", "buy"], path, combinations=True)
    B.write_day_counts(enc.where(late).limit(3), ["click", "buy"], path, combinations=True)
    B.write_day_counts(enc.where(late), ["click", "buy"], path, combinations=True)        # the day again: it replaces itself
    a = B.counts_of_days(spark, path, ["click", "buy"], scopes, True, 5)
    b = B.fit_counts(enc, ["click", "buy"], tuple(scopes), True, 5, predicates={"recent": recent})
    assert a.totals == b.totals and a.n_keys == b.n_keys > 10
    cols = sorted(a.keys.columns)
    assert cols == sorted(b.keys.columns)
    assert sorted(map(tuple, a.keys.select(cols).collect())) == sorted(map(tuple, b.keys.select(cols).collect()))


def test_sketch_leaves_out_rare_pairs_only(spark):
    import random
    rnd = random.Random(4)
    rows = [(i, "train", sorted(rnd.sample(range(60), 6)) if i % 3 else [1, 2, 3], i % 2) for i in range(400)]
    enc = spark.createDataFrame(rows, "row_id long, set string, features array<int>, click int")
    whole = B.fit_counts(enc, ["click"], ("train",), True, 12, sketch=0).keys
    for buckets in (7, 1 << 12):
        assert sorted(map(tuple, B.fit_counts(enc, ["click"], ("train",), True, 12, sketch=buckets).keys.collect())) == sorted(map(tuple, whole.collect()))
    pairs = enc.select(F.explode(B.key_array(F.col("features"), True)).alias("k")).select("k.i", "k.j")
    kept = B.frequent_pairs(pairs, 12, 1 << 12)
    # pairs that go through the shuffle, before and after: all frequent ones and hardly another
    n, m = pairs.distinct().count(), kept.distinct().count()
    assert whole.count() <= m < 0.2 * n


def test_bayes_grid_scores_classes_where_rows_repeat(spark, monkeypatch):
    from goalcast.operators.features import FeatureDictionary
    from goalcast.plans import training as TR
    from goalcast.plans.prepare import Prepared
    rows = [(i, "train" if i % 4 else "test", [i % 3, 3 + i % 2], int(i * 7 % 10 < 3), int(i % 2)) for i in range(300)]
    enc = spark.createDataFrame(rows, "row_id long, set string, features array<int>, click int, buy int")
    prep = Prepared(enc, FeatureDictionary(names=None, entries=None, size=5, n_entries=5), ["click", "buy"])
    assert TR.worth_classes(enc) and not TR.worth_classes(enc.limit(7))
    seen = []
    score = B.score_models
    monkeypatch.setattr(B, "score_models", lambda rows, *a, **k: (seen.append(rows.count()), score(rows, *a, **k))[1])
    a = TR.bayes_grid(prep, ["click", "buy"], [1, 20])[0]
    monkeypatch.setattr(TR, "ROWS_A_CLASS", 1e9)
    b = TR.bayes_grid(prep, ["click", "buy"], [1, 20])[0]
    assert seen == [9, 300]
    cols = sorted(a.columns)
    norm = lambda t: sorted([tuple(round(v, 12) if isinstance(v, float) else v for v in r) for r in t.select(cols).collect()], key=str)
    assert norm(a) == norm(b)


def test_stratified_exact_counts(spark):
    import math
    from goalcast.operators import splits as U
    df = spark.createDataFrame([(i, 1 if i % 7 == 0 else 0) for i in range(700)], "row_id long, y int")
    out = U.stratified_exact(df, "y", buckets=16)
    counts = {(r.y, r.set): r["count"] for r in out.groupBy("y", "set").count().collect()}
    for cls, n in ((0, 600), (1, 100)):
        assert counts[(cls, "train")] == n - math.ceil(0.25 * n)
        assert counts[(cls, "train")] + counts[(cls, "test")] == n
    assert out.select("row_id").distinct().count() == 700


@pytest.mark.parametrize("loss,penalty", [("hinge", "l1"), ("perceptron", "elasticnet"), ("squared_hinge", "l2")])
def test_proximal_solver_separates(spark, loss, penalty):
    from goalcast.operators import linear as LN
    rows = [(i, [0, 2] if i % 2 else [1, 2], i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, "row_id long, features array<int>, click int")
    model = LN.fit_linear(df.withColumn("n", F.lit(1)), [("click", {"loss": loss, "penalty": penalty, "alpha": 1e-4})], 3, iterations=40, step=1.0)
    assert model.weights[0, 0] > 0 > model.weights[1, 0]
    preds = {r.row_id: r.pred for r in model.score(df, ["row_id"]).collect()}
    assert all(preds[i] == i % 2 for i in range(60))


def test_release_tables(spark):
    from goalcast.session import checkpoint_dir, cut_lineage, release_tables
    t = cut_lineage(spark.range(3), "probe")
    assert t.count() == 3
    release_tables(spark)
    base = checkpoint_dir(spark).replace("file:", "").rstrip("/")
    assert not os.path.exists(f"{base}/goalcast-tables")


def test_linear_models_are_saved_and_read_back(spark, scratch):
    from goalcast.plans.training import fit_models, read_model
    df = spark.createDataFrame([(i, [0, 2] if i % 2 else [1, 2], i % 2, 1) for i in range(20)] + [(20, [], 0, 1), (21, None, 1, 1)],
                               "row_id long, features array<int>, click int, n int")
    path = scratch("model")
    model = fit_models("sgd", df, df, [("click", {"loss": "modified_huber", "penalty": "l2", "alpha": 1e-4})], 3)
    model.save(spark, 0, path)
    w = {r.i: r.w for r in spark.read.parquet(path).collect()}
    assert set(w) == {0, 1, 2} and w[0] > w[1]
    a, b = ({r.row_id: (r.prob, r.pred, r.pos, r.neg) for r in m.score(df, ["row_id"]).collect()} for m in (model, read_model(spark, "sgd", path)))
    assert a == b and a[20] == (0.5, 0, 0, 1) and a[21] == (0.5, 0, 1, 0)
