"""The pipeline stage by stage, and the registered queries with SQL."""

import math
import os

import corpus_pipeline
import duckdb
import pytest
from test_pairs import brute_components, brute_repeats

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
NEW = [f"op{n}_" for n in range(1, 11)]


def test_one_query_of_each_operator():
    names = list(E.queries())
    assert all(sum(n.startswith(p) for n in names) == 1 for p in NEW) and "pipeline" in names


@pytest.mark.parametrize("name", ["op3_jaccard_join", "op4_substring_dedup", "op8_cover_tree"])
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
    want = con.execute(E.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    got = E.queries()[name](spark, SF).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(want.fetchall())


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    extra = spark.createDataFrame([(90001, "12345 -- 678", None, "s", 12), (90002, None, "en", "s", None), (90003, rows[5][1], None, "s", 1)], docs.schema)
    docs = docs.unionByName(extra)
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "repeated_passages", "packing"]
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = os.path.join(tmp_path, name)
        stage(spark, docs, SF).write.parquet(path)
        out[name] = docs = spark.read.parquet(path)
        if name != "packing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    texts = {n: sorted((r["doc_id"], r["text"]) for r in out[n].collect()) for n in names[:3]}
    assert texts["language_id"] == sorted(rows + [(90003, rows[5][1])])     # clean documents stay
    _, sets, find = brute_components(texts["language_id"], 5, 4, 5)
    first = {}
    for i, row in enumerate(texts["language_id"]):
        first.setdefault(find(i) if sets[i] else ("alone", i), row)
    assert texts["near_duplicates"] == sorted(first.values()) and len(first) < len(rows)
    want = [(d, kept if n else t) for (d, t), (_, _, n, _, kept) in zip(texts["near_duplicates"], brute_repeats(texts["near_duplicates"], 50))]
    assert texts["repeated_passages"] == sorted(want) and want != texts["near_duplicates"]
    pieces = out["packing"].collect()
    assert {r["doc_id"] for r in pieces} == {d for d, _ in want}
    whole = E.queries()["pipeline"](spark, SF)
    assert whole.columns == out["packing"].columns and math.isclose(whole.count(), len(pieces), abs_tol=3)


def test_stages_on_little(spark, table):
    """Empty tables, null texts and languages, repeated rows, extra columns: rows keep their columns."""
    odd = [(1, None), (2, ""), (3, "12 3"), (None, "words of a text that has no id"), (8, "a text " * 40), (8, "a text " * 40), (7, "A TEXT " * 40)]
    for rows, stays in (([], None), (odd, {"language_id": 4, "near_duplicates": 5, "repeated_passages": 7})):
        docs = table(rows, lang={8: "en", 7: "en", None: "en"})
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name == "packing":
                assert out.agg({"length": "sum"}).first()[0] == (None if not rows else sum(
                    r["doc_tokens"] for r in out.where("start = 0").collect()))
                continue
            assert out.columns == docs.columns
            assert out.count() == (stays[name] if stays else 0)
