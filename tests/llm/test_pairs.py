"""Similarity join and passage removal against brute force."""

import hashlib

import pyarrow as pa
import pytest
from conftest_llm import SPACED, lower_ascii

from goalcast.llm import families, jaccard_join
from goalcast.llm.jaccard_join import jaccard_components, keep_one
from goalcast.llm.shingles import class_id, full_sets, shingle_sets
from goalcast.llm.substring_dedup import remove_repeats, repeat_digest


def shingles(text, k):
    w = SPACED.findall(lower_ascii(text or ""))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute_components(rows, k, num, den):
    sets = [shingles(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return [(d, len(s), best.get(find(i))) for i, ((d, _), s) in enumerate(zip(rows, sets))], sets, find


key = lambda r: tuple((x is None, x) for x in r)


@pytest.mark.parametrize("k,num,den", [(3, 9, 10), (5, 4, 5), (2, 1, 2)])
def test_components_equal_brute_force(table, corpus, k, num, den):
    got = [tuple(r) for r in jaccard_components(table(corpus), k, num, den).collect()]
    want, _, _ = brute_components(corpus, k, num, den)
    assert sorted(got, key=key) == sorted(want, key=key)


@pytest.mark.parametrize("rounds", [0, 1, 4])
def test_components_with_chunked_families_and_shuffled_ids(table, corpus, monkeypatch, rounds):
    monkeypatch.setattr(jaccard_join, "CHUNK", 3)
    monkeypatch.setattr(families, "PIVOT_ROUNDS", rounds)
    got = [tuple(r) for r in jaccard_components(table(corpus), 3, 9, 10, id_limit=0).collect()]
    assert sorted(got, key=key) == sorted(brute_components(corpus, 3, 9, 10)[0], key=key)


def test_components_of_nothing(table):
    assert jaccard_components(table([])).collect() == []
    got = {tuple(r) for r in jaccard_components(table([(1, None), (2, ""), (3, "a")])).collect()}
    assert got == {(1, 0, 1), (2, 0, 2), (3, 1, 3)}


def test_one_row_of_each_component_stays(table, corpus):
    docs = table(corpus)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = sorted([(r["doc_id"], r["text"]) for r in kept.collect()], key=key)
    _, sets, find = brute_components(corpus, 5, 4, 5)
    groups = {}
    for i, (d, t) in enumerate(corpus):
        groups.setdefault(find(i) if sets[i] else ("alone", i), []).append(((d is None, d), d, t))
    assert len(got) == len(groups)
    allowed = [{(d, t) for x, d, t in g if x == min(y[0] for y in g)} for g in groups.values()]
    assert all(any((d, t) in a for a in allowed) for d, t in got)
    assert sorted([d for d, _ in got], key=lambda x: (x is None, x)) == sorted(
        [min(g)[1] if all(y[1] is not None for y in g) else sorted(g, key=lambda y: y[0])[0][1] for g in groups.values()],
        key=lambda x: (x is None, x))


def brute_repeats(rows, span):
    words = [SPACED.findall(t or "") for _, t in rows]
    first = {}
    for (d, _), w in zip(rows, words):
        if d is not None:
            for i in range(len(w) - span + 1):
                x = tuple(w[i:i + span])
                first[x] = min(first.get(x, d), d)
    out = []
    for (d, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - span + 1 if d is not None else 0):
            if first[tuple(w[i:i + span])] < d:
                gone.update(range(i, i + span))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("span,seed", [(50, 20), (8, 3)])
def test_repeats_equal_brute_force(table, corpus, span, seed):
    want = brute_repeats(corpus, span)
    got = [tuple(r) for r in repeat_digest(table(corpus), span, seed).collect()]
    assert sorted(got, key=key) == sorted([w[:4] for w in want], key=key)
    assert any(w[2] for w in want)


def test_removed_texts_keep_all_columns(table, corpus):
    docs = table(corpus)
    out = remove_repeats(docs)
    assert out.columns == docs.columns
    want = sorted([(d, kept if n else t, len(kept) if n else len(t or ""))
                   for (d, t), (_, _, n, _, kept) in zip(corpus, brute_repeats(corpus, 50))], key=key)
    assert sorted([(r["doc_id"], r["text"], r["n_chars"]) for r in out.collect()], key=key) == want


def test_repeats_of_nothing(table):
    assert repeat_digest(table([])).collect() == []
    empty = hashlib.sha256(b"").hexdigest()
    assert {tuple(r) for r in repeat_digest(table([(1, None), (2, "a b")])).collect()} == {
        (1, 0, 0, empty), (2, 2, 0, hashlib.sha256(b"a b").hexdigest())}


def test_without_broadcasts(table, corpus):
    """The shuffle joins beyond the bound on ids give the same rows."""
    from goalcast.llm.substring_dedup import find_repeats
    docs = table(corpus)
    a, b = (sorted([(r["doc_id"], r["text"]) for r in keep_one(docs, id_limit=n).collect()], key=key) for n in (0, 10 ** 6))
    assert a == b
    a, b = (sorted(map(tuple, find_repeats(docs, id_limit=n)[1].collect())) for n in (0, 10 ** 6))
    assert a == b and a


def test_groups_of_a_token_or_passage_that_very_many_rows_share_are_bounded(table, corpus, monkeypatch):
    """A third of the rows share one passage; groups follow the counts, results stay."""
    from goalcast.llm import packed, substring_dedup
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(d, t) for d, t in corpus if len(t or "") < 4000][:60]
    rows += [(10_000 + i, f"own{i} " * 3 + passage) for i in range(60)]
    monkeypatch.setattr(packed, "ENTRIES", 24)
    monkeypatch.setattr(packed, "BLOCK", 64)

    def watched(kind, judge, column):
        def run(here, known):
            if here.num_rows:
                size = sum(len(x) for x in here[column].to_pylist()) // 8
                if size > 24 * 4 + 64:
                    raise ValueError(f"{kind}: {size} entries in a group")
            return judge(here, known)
        return run
    monkeypatch.setattr(jaccard_join, "_look_up", watched("sets", jaccard_join._look_up, "rid"))
    monkeypatch.setattr(substring_dedup, "_judge_units", watched("units", substring_dedup._judge_units, "rid"))
    monkeypatch.setattr(substring_dedup, "_judge_windows", watched("windows", substring_dedup._judge_windows, "rid"))
    got = [tuple(r) for r in jaccard_components(table(rows), 3, 9, 10).collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows, 3, 9, 10)[0], key=key)
    got = [tuple(r) for r in repeat_digest(table(rows), 50, 20).collect()]
    assert sorted(got, key=key) == sorted([w[:4] for w in brute_repeats(rows, 50)], key=key)


def test_full_sets_are_not_shuffled_unless_a_class_comes_more_than_once(table):
    rows = [(1, "a b c d"), (2, "e f g h")]

    def full(rows):
        docs = table(rows).select("doc_id", "text")
        ids = [(10 * i, i, class_id(next(shingle_sets(pa.array([t]), 3)))) for i, t in dict(rows).items()]
        return full_sets(docs, docs.sparkSession.createDataFrame(ids, "rid long, doc_id long, cid binary"), 3, 100, "test-full")
    once, twice = full(rows), full(rows + rows[:1])
    assert "Exchange" not in once._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in twice._jdf.queryExecution().executedPlan().toString()
    assert [sorted(r["rid"] for r in x.collect()) for x in (once, twice)] == [[10, 20], [10, 20]]


def test_a_round_of_comparisons_joins_the_sets_once(table, monkeypatch):
    plans, cut = {}, families.cut_lineage

    def seen(df, name):
        plans[name] = df._jdf.queryExecution().optimizedPlan().toString()
        return cut(df, name)
    monkeypatch.setattr(families, "cut_lineage", seen)
    rows = [(i, f"a b c d e f g h i {i % 3}") for i in range(6)] + [(0, "a b c d e f g h i 0")]
    got = [tuple(r) for r in jaccard_components(table(rows), 3, 4, 5).collect()]
    assert sorted(got, key=key) == sorted(brute_components(rows, 3, 4, 5)[0], key=key)
    assert plans["jaccard-edges-0"].count("Join Inner") == 1
