"""Families of rows that may match: exact components, and work that follows the members."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from goalcast.llm import families as FA


def brute(groups, link):
    root = {r: r for g in groups.values() for r in g}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for g in groups.values():
        for i, a in enumerate(g):
            for b in g[:i]:
                if link(a, b):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {r: find(r) for r in root if any(find(x) == find(r) for x in root if x != r)}


def components(spark, groups, link, chunk):
    df = spark.createDataFrame([(k, r) for k, g in groups.items() for r in g], "leader long, rid long").repartition(3)
    dealt = []

    def payload(rows):
        dealt.append(rows.count())
        return rows

    def check(table, a, b, cand):
        rid = table["rid"].to_numpy()
        return cand & np.array([[link(int(rid[i]), int(rid[j])) for j in b] for i in a], dtype=bool).reshape(len(a), len(b))
    out = FA.family_components(df, payload, check, chunk, "test-families")
    return {r["node"]: r["root"] for r in out.collect()}, dealt


@pytest.mark.parametrize("rounds", [0, 2])
@pytest.mark.parametrize("share", [0.0, 0.02, 0.3])
def test_components_are_exact(spark, monkeypatch, rounds, share):
    monkeypatch.setattr(FA, "PIVOT_ROUNDS", rounds)
    rnd = random.Random(int(share * 100) + rounds)
    groups = {g: sorted(rnd.sample(range(400), rnd.choice([1, 2, 9, 40, 90]))) for g in range(12)}

    def link(a, b):
        return ((a * 2654435761 ^ b * 2654435761) % 997) / 997 < share
    got, _ = components(spark, groups, link, 8)
    assert got == brute(groups, link)


def test_dealt_rows_of_a_dense_family_follow_its_members(spark):
    """A few members link with nobody; the others with most others."""
    total = {}
    for size in (1000, 4000):
        groups = {0: list(range(size))}

        def link(a, b):
            return a % 500 and b % 500 and (a * 31 + b * 31) % 10 < 9
        got, dealt = components(spark, groups, link, 64)
        assert len(set(got.values())) == 1 and len(got) == size - size // 500
        total[size] = sum(dealt)
    assert total[1000] <= 6 * 1000 and total[4000] <= 6 * 4000


def test_no_families(spark):
    got, _ = components(spark, {}, lambda a, b: True, 4)
    assert got == {}


def test_links_known_before_are_not_compared_again(spark):
    df = spark.createDataFrame([(0, r) for r in range(40)], "leader long, rid long")
    known = spark.createDataFrame([(r, 20 * (r // 20)) for r in range(40)], "node long, root long")
    seen = spark.sparkContext.accumulator(0)

    def check(table, a, b, cand):
        seen.add(int(cand.sum()))
        rid = table["rid"].to_numpy()
        return cand & ((rid[a][:, None] == 3) & (rid[b][None, :] == 25))
    out = FA.family_components(df, lambda x: x, check, 64, "test-known", known)
    assert {r["node"]: r["root"] for r in out.collect()} == {r: 0 for r in range(40)}
    assert 0 < seen.value <= 20 * 20


def test_components_with_more_edges(spark):
    from goalcast.llm.components import joined_components
    roots = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (9, 9), (10, 9)], "node long, root long")
    more = spark.createDataFrame([(2, 6), (6, 7), (11, 12), (1, 2)], "a long, b long")
    got = {r["node"]: r["root"] for r in joined_components(roots, more).collect()}
    assert got == {1: 1, 2: 1, 5: 1, 6: 1, 7: 1, 9: 9, 10: 9, 11: 11, 12: 11}
    same = joined_components(roots, more.where("a = 1"))
    assert {r["node"]: r["root"] for r in same.collect()} == {1: 1, 2: 1, 5: 5, 6: 5, 9: 9, 10: 9}
