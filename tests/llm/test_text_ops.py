"""License scan, language ID and HTML extraction against brute force and labelled rows."""

import random
import re

import pytest
from conftest_llm import lower_ascii
from pyspark.sql import functions as F

from goalcast.llm import html_text, langid, license_scan

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"


def brute_base(text):
    w, found = WORDS.findall(lower_ascii(text or "")), []
    for phrase, label in license_scan.PHRASES:
        p = phrase.split()
        found += [(i, label) for i in range(len(w)) if w[i:i + len(p)] == p]
    return len(w), len(found), min(found)[0] if found else None, max(found)[0] if found else None, ",".join(sorted({x for _, x in found}))


def test_base_columns_and_labels(table, corpus):
    extra = [(7000, "See the MIT license. MIT\nLicense, again; apache  LICENSE"), (7001, "GNU General-Public License (v3)"),
             (7002, "Licensed under CC BY-NC 4.0."), (7003, "foo all rights bar reserved"), (7004, "some mit licenses mit"),
             (7005, "All rights reserved."), (7006, "This work is really licensed under the GNU public License, version 3"),
             (7007, "mit"), (7008, "license mit license"), (None, "MIT License"), (7009, "Permission is hereby granted, free of charge, "
              "to any person who obtains a copy of this software and associated documentation files, to deal in the Software")]
    extra += [extra[0]]
    rows = corpus + extra
    got = license_scan.scan_licenses(table(rows)).collect()
    assert len(got) == len(rows)
    assert sorted([tuple(r[:6]) for r in got], key=repr) == sorted([(d, *brute_base(t)) for d, t in rows], key=repr)
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[7000] == "apache,mit" and labels[7001] == "gpl" and labels[7002] == "cc-by-nc" and labels[7003] == ""
    assert labels[7005] == "proprietary" and labels[7006] == "gpl" and labels[7009] == "mit" and labels[7007] == ""
    assert all(0 <= r["score"] <= 1 and (r["score"] > 0) == bool(r["labels"]) for r in got)
    assert all(set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) for r in got)


def test_license_scan_of_nothing(table):
    assert license_scan.scan_licenses(table([])).collect() == []


def test_language_on_held_out_rows(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify_language(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    n, right = got.agg(F.count(F.lit(1)), F.sum((F.col("lang") == F.col("lang_pred")).cast("int"))).first()
    assert n > 40 and right >= 0.95 * n


def test_language_spans_scripts_and_edges(spark):
    rnd = random.Random(5)
    make = {"aa": lambda: "".join(rnd.choice(["ka", "lo", "mi"]) for _ in range(3)),
            "bb": lambda: "".join(rnd.choice(["thr", "sch", "ent"]) for _ in range(2)),
            "el": lambda: "".join(rnd.choice(["και", "λογ", "μην"]) for _ in range(2))}
    rows = [(i, " ".join(make[lang]() for _ in range(30)), lang) for lang in make for i in range(100 * (1 + len(lang) + ord(lang[0])), 100 * (1 + len(lang) + ord(lang[0])) + 60)]
    mixed = " ".join([make["aa"]() for _ in range(20)] + [make["bb"]() for _ in range(30)])
    odd = [(1, mixed, None), (2, None, "aa"), (3, "12 -- !?", "aa"), (4, "", None), (5, make["el"]() + " 12", None), (None, mixed, "aa"),
           (6, "漢字漢字 " + " ".join(make["bb"]() for _ in range(9)), None), (7, " ".join(make["aa"]() for _ in range(20000)), None), (7, "x", None)]
    docs = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string").withColumn("score", F.lit(1)).repartition(3)
    out = langid.identify_language(docs).collect()
    assert len(out) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in out}
    assert [(s["lang"], s["first_word"], s["n_words"]) for s in by[1]["spans"]] == [("aa", 0, 20), ("bb", 20, 30)]
    assert by[1]["lang_pred"] == "bb" and 0.4 < by[1]["score"] < 1
    assert all(by[x]["lang_pred"] == "und" and by[x]["score"] == 0 for x in (2, 3, 4))
    assert by[5]["lang_pred"] == "el" and by[5]["score"] == 1 and by[6]["lang_pred"] == "bb"
    assert {r["lang_pred"] for r in out if r["doc_id"] is None} == {"bb"}
    import zlib
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in out)
    kept = langid.keep_identified(docs)
    assert kept.columns == docs.columns and kept.count() == len(out) - 3


def test_keep_identified_judges_learned_scripts(spark):
    rnd = random.Random(5)
    words = {"aa": ["ka", "lo", "mi"], "bb": ["thr", "sch", "ent"], "cc": ["qui", "gue", "dos"]}
    make = lambda lang, n: " ".join("".join(rnd.choice(words[lang]) for _ in range(3)) for _ in range(n))
    rows = [(100 * k + i, make(lang, 30), lang) for k, lang in enumerate(words, 1) for i in range(60)]
    cases = [(1, "ภาษาไทย เป็นภาษา ราชการ", False), (2, "漢字漢字 漢字", False), (3, "漢字漢字漢字漢字 " + make("aa", 1), False),
             (4, "漢字 " + make("aa", 9), True), (5, " ".join(make(x, 30) for x in ("aa", "bb", "cc")), True), (6, "12 !", False), (7, "я ты он", False)]
    docs = spark.createDataFrame(rows + [(i, t, None) for i, t, _ in cases], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in langid.keep_identified(docs).collect()}
    assert {i for i, _, _ in cases if i in kept} == {i for i, _, keep in cases if keep}
    assert len(kept) == len(rows) + 2


def test_language_without_training_rows(spark):
    docs = spark.createDataFrame([(1, "abc", None), (2, None, "en")], "doc_id long, text string, lang string")
    assert {r["lang_pred"] for r in langid.identify_language(docs).collect()} == {"und"}
    assert langid.identify_language(docs.limit(0)).collect() == []


def test_viterbi_equals_brute_force():
    import itertools

    import numpy as np
    rng = np.random.default_rng(1)
    words = np.array([0, 5, 1, 0, 4, 6])
    scores = rng.normal(size=(words.sum(), 3)).astype(np.float32)
    got, at = langid._viterbi(scores, words, 0.7), 0
    for w in words:
        s = scores[at:at + w]
        worth = lambda p: sum(s[i, x] for i, x in enumerate(p)) - 0.7 * sum(a != b for a, b in zip(p, p[1:]))
        best = max(itertools.product(range(3), repeat=int(w)), key=worth, default=())
        assert tuple(got[at:at + w]) == best
        at += w


def brute_cut(unary, edges):
    n = len(unary)
    cost = {}
    for mask in range(1 << n):
        side = [bool(mask >> i & 1) for i in range(n)]
        cost[mask] = (sum(max(0, -u) if s else max(0, u) for u, s in zip(unary, side))
                      + sum(w for a, b, w in edges if side[a] != side[b]))
    return min(cost.values()), cost


def test_minimum_cut_equals_brute_force():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randint(1, 8)
        unary = [rnd.randint(-9, 9) for _ in range(n)]
        edges = [(a, b, rnd.randint(0, 6)) for a in range(n) for b in range(a) if rnd.random() < 0.5]
        best, cost = brute_cut(unary, edges)
        assert cost[sum(1 << i for i, s in enumerate(html_text.minimum_cut(unary, edges)) if s)] == best


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<div id="cookie-notice">We use cookies. <a href=x>Fine</a></div><header class="site-header"><a href=/>Home</a></header><nav><ul><li><a href=1>A</a><li><a href=2>B</a></ul></nav>
<!-- <p>not this</p> --><article><h1>A &lt;good&gt; title</h1><p>First paragraph with <b>bold text</b> and a
 <a href="q">link</a>, &amp; more words that make it long.<p>Unclosed.<br>Next   line.<ul><li>point one</li><li>point two</li></ul>
<aside>Aside words here.</aside><div class="ad">Buy now, it is cheap!</div><form>Your mail <input value="x"></form><p>Last paragraph, &eacute; and &#8364;.</p></article>
<div class="sidebar"><h3>Related</h3><p>Something else that you could also read today, if you like.</p></div>
<section id="comments"><div class="comment"><p>Great article, I liked reading it a lot, thank you for it.</p></div></section>
<footer>&copy; 2020 Example</footer></body></html>"""


def test_page_text():
    assert html_text.main_text(PAGE) == "\n\n".join([
        "A <good> title", "First paragraph with bold text and a link, & more words that make it long.",
        "Unclosed. Next line.", "point one", "point two", "Last paragraph, é and €."])


LONG = "This paragraph is long enough to be the text of an article, and it ends as a sentence does."


@pytest.mark.parametrize("mark", ['href="/hidden-costs"', 'title="The hidden valley"', 'data-title="Hidden gems"', "data-hidden", 'data-id="sidebar"',
                                  "title=' id=sidebar hidden '", 'x-class="ad" alt=hidden', 'title = "a" data-style="display:none"'])
def test_only_whole_attribute_names_count(mark):
    assert html_text._attributes(mark) == html_text._attributes('title="x hidden') == {}
    assert html_text.main_text(f"<body><section {mark}><p>{LONG}</p></section>") == LONG
    link = f"<article><p>{LONG} See <a {mark}>the costs</a> of it.</p></article>"
    assert "See the costs of it." in html_text.main_text(link)


WRAPPERS = ['class="layout has-sidebar"', 'class="overflow-hidden"', 'class="search-page"', 'class="with-comments"', 'id="site-header-wrap"',
            'class="search"', 'class="hasSidebar noToc" id="overflow-x-hidden"', 'role="form"']


@pytest.mark.parametrize("mark", WRAPPERS)
@pytest.mark.parametrize("inner", ["article", "main", 'div itemprop="articleBody"'])
def test_an_inner_article_recovers_from_its_wrapper(mark, inner):
    page = f"<body><div {mark}><{inner}><h1>The title</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p></{inner.split()[0]}></div></body>"
    assert html_text.main_text(page).split("\n\n") == ["The title", LONG, "Short.", LONG]
    assert html_text.main_text(page.replace("div", "form") if inner[0] != "d" else page).count(LONG) == 2


@pytest.mark.parametrize("mark", WRAPPERS)
def test_long_text_outweighs_a_wrapper_name(mark):
    more = f"{LONG} {LONG} {LONG}"
    page = f"<body><nav><a href=1>Home</a></nav><div {mark}><div><p>{more}</p><p>{more}</p></div></div><footer>Imprint and more</footer></body>"
    assert html_text.main_text(page) == f"{more}\n\n{more}"


def test_furniture_stays_out_beside_an_article():
    article = f"<article><h1>The title</h1><p>{LONG}</p></article>"
    for other in (f'<div id="comments"><div class="comment"><p>{LONG}</p></div><article class="comment-body"><p>{LONG} So I say.</p></article></div>',
                  f"<aside><article><h3><a href=1>Other</a></h3><p>{LONG}</p></article></aside>", '<div class="related"><article><h3><a href=1>Another title</a></h3></article></div>',
                  f'<div class="sidebar"><div class="widget"><p>{LONG}</p></div></div>', '<div class="cookie-notice">We use cookies here.</div>'):
        assert html_text.main_text(f"<body><div class='layout has-sidebar'>{article}{other}</div></body>") == f"The title\n\n{LONG}"


@pytest.mark.parametrize("start", ["<body>", "", "<body class=x>\n", "</head>", "</head><body>", "<header><a href=1>Home</a></header>", "<noscript><img src=1></noscript><body>",
                                   "<template><b><body>", "<nav><a href=1>Home</a></nav>", "<iframe src=1></iframe>", "<img src=1>"])
@pytest.mark.parametrize("html", ["<html>", ""])
def test_a_head_without_its_end_tag(start, html):
    head = f"<!DOCTYPE html>{html}<head>\n<meta charset=utf-8><title>x</title><link href=1><style>p{{}}</style>\n{start}"
    assert html_text.main_text(f"{head}<p>{LONG}<p>{LONG}") == f"{LONG}\n\n{LONG}"
    assert html_text.main_text(f"{head}<article><h1>The title</h1><p>{LONG}</p></article></body></html>") == f"The title\n\n{LONG}"
    assert html_text.main_text(head + LONG) == LONG
    assert html_text.main_text(f"{head}<article><p>{LONG}</p><head><p>{LONG}</p></article>") == f"{LONG}\n\n{LONG}"


def test_what_stands_in_a_head_is_not_text():
    head = f"<html><head><noscript><p>{LONG} Noscript.</p></noscript><template><p>{LONG} Template.</p></template><title>{LONG} Title.</title>"
    assert html_text.main_text(f"{head}<p>{LONG}") == html_text.main_text(f"{head}</head><body><p>{LONG}</body>") == LONG


@pytest.mark.parametrize("mark", ["hidden", "HIDDEN", "title=x hidden", "hidden=''", 'aria-hidden="true"', "style='color:red; display : none'", 'a="b"hidden'])
def test_hidden_elements_are_dropped(mark):
    assert html_text.main_text(f"<article><p>{LONG}</p><div {mark}><p>{LONG} Not seen.</p></div></article>") == LONG


@pytest.mark.parametrize("page", ["", "<", "</", "<p", "<!--", "<script>", "a < b", "<p title='x>y", "&am", "<div>" * 3000, "</p></div>", "<a \"" * 500])
def test_broken_pages_do_not_fail(page):
    assert isinstance(html_text.main_text(page), str)


def test_extraction_over_a_table(spark):
    rows = [(1, "u", PAGE), (2, None, None), (3, "u", ""), (None, "u", PAGE), (1, "u", PAGE),
            (4, "u", "<article>" + "<p>A paragraph that is not very long.</p>" * 3000 + "</article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", F.lit(1)).withColumn("n_chars", F.lit(2))
    out = html_text.extract_main_text(df).collect()
    assert len(out) == 6 and all(r["n_chars"] == len(r["text"]) for r in out)
    assert {r["text"] for r in out if r["page_id"] in (2, 3)} == {""}
    assert next(r["text"] for r in out if r["page_id"] == 4).count("\n\n") == 2999
    assert html_text.extract_main_text(df.limit(0)).collect() == []


def test_pages_of_the_tables(spark):
    """Every page's article, and nothing else, by the pages' own markup."""
    import html
    for r in spark.read.parquet(f"{SF}/pages.parquet").collect():
        inner = r["html"].split("<article>")[1].split("</article>")[0]
        parts = [" ".join(html.unescape(re.sub(r"</?b>|<br>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert html_text.main_text(r["html"]) == "\n\n".join(p for p in parts if p)


@pytest.mark.parametrize("kind", ["<b>x ", "</i>x ", "<p><b>y", "<div><b>", "<table><tr><td><b>", "</div><b>", "<li><i>z", "<head><b>", "<a>x"])
def test_broken_pages_take_time_in_proportion(kind):
    import time
    took = []
    for n in (5_000, 40_000):
        t = time.process_time()
        html_text.main_text("<html><body>" + kind * n + "</body></html>")
        took.append(time.process_time() - t)
    assert took[1] < 24 * max(took[0], 0.02)


def test_rows_of_a_table_with_short_cells_are_text():
    row = "<tr><td>Part {0}</td><td>The engine number {0} was built in the northern works and ran for many years.</td></tr>"
    page = "<nav><a href=x>Home</a></nav><table>" + "".join(row.format(i) for i in range(6)) + "</table><footer>Contact us</footer>"
    text = html_text.main_text(f"<html><body>{page}</body></html>")
    assert text.count("The engine number") == 6 and "Part 5" in text and "Home" not in text and "Contact" not in text
