"""Fast similarity sketches and their near-duplicates against brute force."""

import random
import re

import numpy as np
import pytest
from test_pairs import brute_components, key

from goalcast.llm import families, similarity_sketch as S


@pytest.mark.parametrize("k,num,den", [(3, 17, 20), (5, 4, 5)])
def test_components_equal_brute_force(table, corpus, k, num, den):
    got = [tuple(r) for r in S.near_duplicates(table(corpus), k, num, den).drop("first").collect()]
    want, _, _ = brute_components(corpus, k, num, den)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_chunked_families_small_slices_and_no_broadcast(table, corpus, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 3)
    monkeypatch.setattr(S, "SLICE", 50)
    monkeypatch.setattr(families, "PIVOT_ROUNDS", 1)
    got = [tuple(r) for r in S.near_duplicates(table(corpus), 3, 17, 20, id_limit=0).drop("first").collect()]
    assert sorted(got, key=key) == sorted(brute_components(corpus, 3, 17, 20)[0], key=key)


@pytest.mark.parametrize("first", [1, 31])
def test_bands_may_come_in_any_shares(table, corpus, monkeypatch, first):
    monkeypatch.setattr(S, "FIRST_BANDS", first)
    got = [tuple(r) for r in S.near_duplicates(table(corpus), 3, 17, 20).drop("first").collect()]
    assert sorted(got, key=key) == sorted(brute_components(corpus, 3, 17, 20)[0], key=key)


def test_one_first_row_of_each_component(table, corpus):
    rows = S.near_duplicates(table(corpus)).collect()
    groups = {}
    for r in rows:
        if r["n_shingles"]:
            groups.setdefault(r["component_id"], []).append(r)
        else:
            assert r["first"]
    assert all(sum(r["first"] for r in g) == 1 for c, g in groups.items() if c is not None)
    assert all(r["doc_id"] == r["component_id"] for r in rows if r["first"])


def test_query_columns(spark, table, corpus, scratch):
    folder = scratch("sketch")
    table(corpus).write.parquet(f"{folder}/documents.parquet")
    got = [tuple(r) for r in S.op11_sketch(spark, folder).collect()]
    want = [(*w, w[0] == w[2]) for w in brute_components(corpus, 3, 17, 20)[0]]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_nothing(table):
    assert S.near_duplicates(table([])).collect() == []
    got = {tuple(r) for r in S.near_duplicates(table([(1, None), (2, ""), (3, "a"), (4, "A")])).collect()}
    assert got == {(1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True), (4, 1, 3, False)}


def test_every_coordinate_is_filled_and_copies_agree():
    rnd = np.random.default_rng(1)
    sets = [np.unique(rnd.integers(0, 2 ** 63, n, dtype=np.uint64)) for n in (1, 2, 3, 10, 100, 5000)] + [np.zeros(0, np.uint64)]
    a = S.sketches(sets, 128)
    assert (a[:6] != S._EMPTY).all() and (a[6] == S._EMPTY).all()
    assert (a[:6] == S.sketches(sets[:6], 128)).all()
    # a sketch does not depend on the sets beside it
    assert all((S.sketches([x], 128)[0] == a[i]).all() for i, x in enumerate(sets[:6]))


@pytest.mark.parametrize("n", [20, 200, 2000])
@pytest.mark.parametrize("j", [0.3, 0.85])
def test_agreement_estimates_similarity(n, j):
    rnd, found = np.random.default_rng(n), []
    for _ in range(60):
        both = round(n * j)
        rest = (n - both + 1) // 2
        x = rnd.integers(0, 2 ** 63, both + 2 * rest, dtype=np.uint64)
        a, b = S.sketches([np.sort(x[:both + rest]), np.sort(np.concatenate([x[:both], x[both + rest:]]))], 128)
        found.append((a == b).mean() - both / len(x))
    # mean error of 60 sketches, and no sketch far off
    assert abs(np.mean(found)) < 4 * 0.05 / 60 ** 0.5 and max(map(abs, found)) < 0.25


def test_bands_of_all_rows_are_joined_once(table, monkeypatch):
    plans, cut = {}, S.cut_lineage

    def seen(df, name):
        plans.setdefault(name, []).append(df._jdf.queryExecution().optimizedPlan().toString())
        return cut(df, name)
    monkeypatch.setattr(S, "cut_lineage", seen)
    rows = [(i, f"a b c d e f g h i {i % 3}") for i in range(6)]
    got = [tuple(r) for r in S.near_duplicates(table(rows), 3, 4, 5, id_limit=0).drop("first").collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows, 3, 4, 5)[0], key=key)
    wide = [name for name, found in plans.items() for x in found if "LeftSemi" in x and re.search(r"Project \[.*bands#", x)]
    assert wide == ["sketch-reps"]
