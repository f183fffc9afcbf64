"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import pytest
from conftest_llm import lower_ascii

from goalcast.llm import spelling as S


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_groups(count, factor=2):
    form, rows = {}, []
    for w, n in count.items():
        others = [x for x in count if near(w, x)]
        best = min(others, key=lambda x: (-count[x], x), default=None)
        form[w] = best if best is not None and count[best] >= factor * n else None
        rows.append([w, n, len(others), form[w], count[form[w]] if form[w] is not None else None])
    for r in rows:
        root = r[0]
        while form[root] is not None:
            root = form[root]
        r.append(root)
    return sorted(map(tuple, rows))


def brute_words(rows):
    count = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = lower_ascii(run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    return {w: n for w, n in count.items() if len(w) >= 5 and n >= 3}


def groups(spark, count):
    df = spark.createDataFrame(list(count.items()), "word string, n long").repartition(3)
    return sorted(map(tuple, S.spelling_groups(df).select("word", "n", "n_near", "form", "form_n", "root").collect()))


@pytest.mark.parametrize("letters,seed", [("ab", 1), ("abc", 2), ("aé", 3), ("abcdÀ", 4)])
def test_groups_equal_brute_force(spark, letters, seed):
    rnd = random.Random(seed)
    count = {"".join(rnd.choice(letters) for _ in range(rnd.randint(1, 7))): 2 ** rnd.randint(0, 12) for _ in range(150)}
    assert groups(spark, count) == brute_groups(count)


def test_long_chain_and_ties(spark):
    chain = {"a" * (5 + i): 2 ** i for i in range(20)}
    ties = {"zebra": 3, "zebre": 6, "zebru": 6, "zabra": 6, "zebr": 5, "zebraa": 6, "aaaaax": 1}
    assert groups(spark, chain | ties) == brute_groups(chain | ties)


def test_query_equals_brute_force(spark, table, scratch):
    rnd = random.Random(9)
    words = ["color", "colour", "Colour", "flavor", "flavour", "théâtre", "THéÂTRE", "ÀÉÎõü", "ÀÉÎõÿ", "aaaaa", "aaaaaa", "xx", "naïve", "naive"]
    rows = [(i, rnd.choice([" ", "-", "1", "\n"]).join(rnd.choice(words) for _ in range(rnd.randint(0, 60)))) for i in range(120)]
    rows += [(500, None), (501, ""), (502, "colour " * 3000), (None, "colour colr " * 5), (503, "colour"), (503, "colour"), (504, "×÷×÷× ①②③④⑤")]
    folder = scratch("spelling")
    table(rows).write.parquet(f"{folder}/documents.parquet")
    out = S.op13_spelling(spark, folder)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    got = sorted((r["word"], r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in out.collect())
    assert got == brute_groups(brute_words(rows))
    assert any(r[3] for r in got)


def test_defined_cases(spark):
    empty = spark.createDataFrame([], "word string, n long")
    assert S.spelling_groups(empty).collect() == []
    df = spark.createDataFrame([(None, 5, 1), ("alone", 2, 1), ("alone", None, 1), ("alonee", 4, 1), ("", 9, 1), ("é", 1, 1)], "word string, n long, root int")
    got = {r["word"]: (r["n"], r["n_near"], r["form"], r["root"]) for r in S.spelling_groups(df).collect()}
    assert got == {"alone": (2, 1, "alonee", "alonee"), "alonee": (4, 1, None, "alonee"), "": (9, 1, None, ""), "é": (1, 1, "", "")}
    with pytest.raises(ValueError):
        S.spelling_groups(spark.createDataFrame([("a$b", 1)], "word string, n long"))
    with pytest.raises(ValueError):
        S.spelling_groups(empty, factor=1)
