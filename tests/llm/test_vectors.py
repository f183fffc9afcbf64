"""Vector searches against brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from goalcast.llm import cover_tree, multi_index
from goalcast.llm.cover_tree import top_inner_products
from goalcast.llm.multi_index import nearest_neighbours


def make(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(3)
    for c in ("v", "cell", "score", "rank", "b", "part", "g"):
        df = df.withColumn(c, F.lit(1))
    return df


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8)).astype(np.float32)
    x[100:300] = x[100]                                        # one vector many times
    x[400:450] = np.round(x[400:450])                          # ties
    out = [(int(i * 3), [float(c) for c in v]) for i, v in enumerate(x)]
    nan, inf = float("nan"), float("inf")
    return out + [(10_000, None), (10_050, []), (10_100, [nan] * 8), (10_150, [inf] + [0.0] * 7), (10_200, [0.0] * 8),
                  (10_250, [1.0, None] + [0.0] * 6), (10_300, [1.0, 2.0]), (None, [1.0] * 8), out[7], out[7]]


def valid(rows, nonzero):
    return [(i, v) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all() and (any(v) or not nonzero)]


def brute(rows, every, k, score):
    """Every row is a query and a candidate of its own; lengths do not mix."""
    out = []
    for a, (q, v) in enumerate(rows):
        if q % every == 0:
            s = sorted([(-score(v, w), c) for b, (c, w) in enumerate(rows) if a != b and len(v) == len(w)])[:k]
            out += [(q, r + 1, c, -x) for r, (x, c) in enumerate(s)]
    return sorted(out)


def whole_product(v, w):
    v, w = ([math.floor(256 * x) if abs(x) < 1e300 else 256 * int(x) for x in y] for y in (v, w))
    return sum(x * y for x, y in zip(v, w))


def test_top_inner_products(spark, rows):
    want = brute(valid(rows, False), 50, 5, whole_product)
    assert sorted(tuple(r) for r in top_inner_products(make(spark, rows), 50, 5).collect()) == want
    assert {len(v) for i, v in valid(rows, False) if i % 50 == 0} == {2, 8}


@pytest.mark.parametrize("size", [1e3, 1e7, 1e9, 1e150, 1e300])
def test_inner_products_of_large_components(spark, size):
    rng = np.random.default_rng(int(np.log10(size)))
    x = rng.normal(size=(400, 3)) * size
    x[50:90] = x[50] + np.round(rng.normal(size=(40, 3)) * 2)  # nearly equal
    x[90:100] = x[90]
    x[200:260] = rng.normal(size=(60, 3))                      # small ones beside them
    rows = [(int(i), [float(c) for c in v]) for i, v in enumerate(x)] + [(50, [float(c) for c in x[50]]), (50, [1e9, 1.0]), (7, [2e9, 1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    top = 2 ** 63 - 1
    want = sorted((q, r, c, max(-top, min(top, s))) for q, r, c, s in brute(rows, 5, 5, whole_product))
    assert sorted(tuple(r) for r in top_inner_products(df, 5, 5).collect()) == want


def test_keys_sort_like_scores():
    scores = [s * n for n in (2 ** 63 - 1, 2 ** 63, 10 ** 25, 10 ** 25 + 1, 3 ** 900) for s in (1, -1)]
    assert sorted(scores) == sorted(scores, key=cover_tree._key) and cover_tree._key(2 ** 63 - 2) is None


def test_dual_tree_prunes_and_is_exact():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 6)) * 300
    x = np.floor(centres[rng.integers(0, 12, 3000)] + rng.normal(size=(3000, 6)) * 5)
    q = x[::30]
    seen = []
    search = cover_tree._Search(q, np.arange(0, 3000, 30), x, np.arange(3000), np.arange(3000), 5)
    leaves = search._leaves
    search._leaves = lambda a, b: (seen.append(len(a.index) * len(b.index)), leaves(a, b))
    search.run()
    assert sum(seen) < 0.5 * len(q) * len(x)
    for r, i in enumerate(range(0, 3000, 30)):
        s = x @ q[r]
        want = sorted([(-s[j], j) for j in range(3000) if j != i])[:5]
        assert [(-a, b) for a, b in search.results(r)] == want


def test_cover_tree_nets():
    x = np.random.default_rng(0).normal(size=(500, 3))

    def check(node):
        assert np.sqrt(((x[node.index] - node.centre) ** 2).sum(axis=1)).max() <= node.radius + 1e-12
        if node.children:
            assert sorted(i for c in node.children for i in c.index) == sorted(node.index)
            far = max(c.radius for c in node.children)
            centres = [c.centre for c in node.children]
            assert all(np.linalg.norm(a - b) >= far - 1e-9 for i, a in enumerate(centres) for b in centres[:i])
            for c in node.children:
                check(c)
    check(cover_tree.Node(x, np.arange(500), 0))


def cosine(a, b):
    a, b = np.array(a, float), np.array(b, float)
    return float(a @ b / np.sqrt((a @ a) * (b @ b)))


def test_nearest_with_all_cells_is_exact(spark, rows):
    rows = rows + [(10_350, [3.0, -1.0]), (7, [2.0, 2.5]), (50, [-1.0]), (51, [4.0])]
    got = nearest_neighbours(make(spark, rows), 50, 5, share=1.0).collect()
    want = brute(valid(rows, True), 50, 5, lambda a, b: round(cosine(a, b), 9))
    assert sorted((r[0], r[1], r[2], round(r[3], 9)) for r in got) == want and (50, 1, 51, -1.0) in want


def test_nearest_recall_and_full_cells(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "GROUP", 50)
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    pdf = df.toPandas()
    keep = [(int(i), [float(x) for x in v]) for i, v in zip(pdf.vec_id, pdf.embedding)]
    got = {(r[0], r[2]) for r in nearest_neighbours(df, 5, 5).collect()}
    want = {(q, c) for q, _, c, _ in brute(keep, 5, 5, cosine)}
    assert len(got & want) >= 0.9 * len(want)


def test_walk_visits_cells_by_growing_distance():
    rng = np.random.default_rng(2)
    index = multi_index.MultiIndex(rng.normal(size=(300, 8)))
    index.sizes = np.ones(multi_index.CODES ** 2, dtype=int)
    v = rng.normal(size=8)
    cells = index.walk(v, multi_index.CODES ** 2)
    u = multi_index._unit(v[None])[0]
    d = [((c - h) ** 2).sum(1) for c, h in zip(index.codes, (u[:4], u[4:]))]
    sums = [d[0][c // multi_index.CODES] + d[1][c % multi_index.CODES] for c in cells]
    assert len(set(cells)) == len(d[0]) * len(d[1]) and np.all(np.diff(sums) >= -1e-12)


def test_queries_of_a_group_come_in_parts(spark, monkeypatch):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    whole = sorted(tuple(r) for r in nearest_neighbours(df, 2, 5).collect())
    n, rerank = df.where("vec_id % 2 = 0").count(), multi_index._rerank

    def bounded(k):
        run = rerank(k)

        def check(entries, queries):
            if queries.num_rows > 60:
                raise ValueError(f"{queries.num_rows} queries at once")
            return run(entries, queries)
        return check
    monkeypatch.setattr(multi_index, "_rerank", bounded)
    monkeypatch.setattr(multi_index, "PART", 20, raising=False)
    assert n > 100 and sorted(tuple(r) for r in nearest_neighbours(df, 2, 5).collect()) == whole


def test_searches_of_little(spark):
    for f in (nearest_neighbours, top_inner_products):
        assert f(make(spark, [(1, [1.0, 2.0])]).limit(0)).collect() == []
        assert f(make(spark, [(50, None), (100, [])])).collect() == []
        assert f(make(spark, [(50, [1.0, 0.0])])).collect() == []
        got = f(make(spark, [(50, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 1.0])])).collect()
        assert [(r[0], r[1], r[2]) for r in got] == [(50, 1, 1), (50, 2, 2)]
