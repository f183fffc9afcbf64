"""Periodic runs against brute force."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest
from conftest_llm import SPACED
from hypothesis import given, settings
from hypothesis import strategies as st

from goalcast.llm import periodic_runs as P

key = lambda r: tuple((x is None, x) for x in r)


def brute_runs(x, least, periods):
    out = []
    for q in range(1, len(x) // periods + 1):
        j = 0
        while j + q < len(x):
            if x[j] != x[j + q]:
                j += 1
                continue
            end = j
            while end + q < len(x) and x[end] == x[end + q]:
                end += 1
            size = end - j + q
            part = x[j:j + size]
            if size >= max(least, periods * q) and not any(part[:-p] == part[p:] for p in range(1, q)):
                out.append((j, size, q))
            j = end
    return sorted(out)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=7), st.integers(1, 6)), max_size=12),
       st.sampled_from([3, 5, 24]), st.sampled_from([3, 4]))
def test_runs_of_sequences_equal_brute_force(parts, least, periods):
    x = [w for part, times in parts for w in part * times]
    got = P.find_runs(np.array(x, dtype=np.int64), len(x), least, periods)
    assert [tuple(r) for r in got.tolist()] == brute_runs(x, least, periods)


def test_long_runs_and_long_periods():
    rnd = random.Random(5)
    root = [rnd.randrange(50) for _ in range(700)]
    x = [7] * 5000 + root * 3 + root[:11] + [1, 2] * 3000 + [rnd.randrange(9) for _ in range(500)]
    got = [tuple(r) for r in P.find_runs(np.array(x), len(x), 24, 3).tolist()]
    assert (5000, 2111, 700) in got or any(q == 700 and length >= 2111 for _, length, q in got)
    assert got[0][1] >= 5000 and any(q == 2 and length >= 6000 for _, length, q in got)
    for start, length, q in got:
        assert x[start:start + length - q] == x[start + q:start + length]
        assert start == 0 or x[start - 1] != x[start - 1 + q]
        assert start + length == len(x) or x[start + length] != x[start + length - q]


def planted(doc_id, words):
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def digest(doc_id, text, least=24):
    w = planted(doc_id, SPACED.findall(text or ""))
    runs = brute_runs(w, least, 3)
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2])) if runs else (None, None, None)
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(" ".join(x for i, x in enumerate(w) if i not in gone).encode()).hexdigest())


def rows_with_runs(corpus):
    rnd = random.Random(11)
    rows = [(d, t) for d, t in corpus if len(t or "") < 9000]
    for i in range(40):
        root = [rnd.choice("abc") + rnd.choice("xy") for _ in range(rnd.randint(1, 9))]
        text = [rnd.choice("abcdef") for _ in range(rnd.randint(0, 30))] + root * rnd.randint(2, 9)
        rows.append((9000 + i, rnd.choice([" ", "\n", " \t"]).join(text)))
    rows += [(9100, "é " * 30), (9101, "É é " * 14 + " "), (9102, " ".join(["a b"] * 30 + ["c d"] * 30)), (9102, "a " * 24),
             (9103, "a " * 23), (None, "z " * 50), (9104, "a b " * 30)]
    return rows


def test_query_equals_brute_force(spark, table, corpus, scratch):
    rows = rows_with_runs(corpus)
    folder = scratch("runs")
    table(rows).write.parquet(f"{folder}/documents.parquet")
    got = sorted([tuple(r) for r in P.op12_runs(spark, folder).collect()], key=key)
    assert got == sorted([digest(d, t) for d, t in rows], key=key)
    assert sum(r[1] > 0 for r in got) > 20 and any(r[1] > 1 for r in got)


@pytest.mark.parametrize("words", [1, 1 << 17])
def test_operator_returns_runs_and_texts_whatever_the_slices(table, corpus, monkeypatch, words):
    monkeypatch.setattr(P, "SLICE_WORDS", words)
    rows = rows_with_runs(corpus)
    want = []
    for d, t in rows:
        w = SPACED.findall(t or "")
        runs = brute_runs(w, 6, 3)
        gone = {i for s, length, q in runs for i in range(s + q, s + length)}
        want.append((d, runs, " ".join(x for i, x in enumerate(w) if i not in gone)))
    got = [(r["doc_id"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in P.periodic_runs(table(rows), 6, 3).collect()]
    assert sorted(got, key=lambda r: (r[0] is None, r)) == sorted(want, key=lambda r: (r[0] is None, r))


def test_nothing_and_refusal(table):
    assert P.periodic_runs(table([])).collect() == []
    assert [tuple(r) for r in P.periodic_runs(table([(1, None)])).collect()] == [(1, [], "")]
    with pytest.raises(ValueError):
        P.periodic_runs(table([]), periods=2)
