import numpy as np
import pytest

from tallychain.llm import html_text, licenses, packing
from tallychain.llm.queries import QUERIES
from tests.llm.conftest import rows_of


def test_packing_round_trip(make_docs, texts, tmp_path, spark):
    rows = rows_of(texts) + [(None, "null id", None, None, None, "", "", "")]
    packed = packing.pack(make_docs(rows), length=64, gathered=3000)
    packing.write_packed(packed, str(tmp_path / "packed"))
    pieces = {}
    for r in spark.read.parquet(str(tmp_path / "packed")).collect():
        assert len(r.input_ids) == 64 and r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and r.resets == r.cu_seqlens[:-1]
        assert set(r.input_ids[r.n_tokens:]) <= {packing.END}
        at = packing.positions(r.cu_seqlens, 64)
        assert [i for i in range(r.n_tokens) if at[i] == 0] == r.resets
        for doc, piece, a, b in zip(r.doc_ids, r.pieces, r.cu_seqlens, r.cu_seqlens[1:]):
            assert (doc, piece) not in pieces
            pieces[doc, piece] = r.input_ids[a:b]
    with open(packing.VOCABULARY, "rb") as f:
        encoding = packing._encoder(f.read())
    for doc, text in [(r[0], r[1]) for r in rows]:
        ids = [x for n in range(sum(d == doc for d, _ in pieces)) for x in pieces[doc, n]]
        assert ids[-1] == packing.END and encoding.decode(ids[:-1]) == (text or "")
    assert packing.pack(make_docs([])).count() == 0


def test_best_fit_decreasing_equals_brute_force():
    rnd = np.random.default_rng(1)
    for _ in range(30):
        sizes = rnd.integers(1, 21, size=rnd.integers(0, 60))
        got = packing.best_fit_decreasing(sizes, 20)
        left, want = [], np.zeros(len(sizes), dtype=int)
        for i in np.argsort(-sizes, kind="stable"):
            fits = [s for s in left if s >= sizes[i]]
            want[i] = 1
            if fits:
                left[left.index(min(fits))] -= sizes[i]
            else:
                left.append(20 - sizes[i])
        used = np.bincount(got, weights=sizes) if len(sizes) else np.zeros(0)
        assert sorted(20 - used) == sorted(left) and (used <= 20).all()


def test_license_notices_are_found_with_gaps_and_changes(make_docs):
    mit = dict(licenses.TEMPLATES)["MIT"]
    words = mit.split()
    changed = " ".join(w for i, w in enumerate(words) if i % 9)
    cases = ["text " * 30 + "Released under the MIT License. " + "more " * 9, mit.upper(), f"x {changed} y", "mit released license the under",
             "All rights\nreserved, all rights reserved", None, "", "Lizenz mit allem", "Licensed under the Apache Licence, Version 2.0"]
    got = {r.doc_id: r for r in licenses.scan(make_docs(rows_of(cases))).collect()}
    assert got[0].licenses == ["MIT-notice"] and [(n.begin, n.end) for n in got[0].notices] == [(30, 35)] and got[0].best_coverage == 1
    assert "MIT" in got[1].licenses and got[1].best_license == "MIT"
    assert got[2].licenses == ["MIT"] and 0.8 <= got[2].best_coverage < 1
    assert [(n.begin, n.end) for n in got[4].notices] == [(0, 3), (3, 6)]
    assert all(got[i].licenses == [] for i in (3, 5, 6, 7)) and got[8].licenses == ["Apache-2.0-notice"]
    assert licenses.scan(make_docs([])).count() == 0


@pytest.mark.parametrize("name", ["MIT", "ISC", "BSD", "GPL-3.0-or-later"])
def test_a_long_notice_after_prose_is_aligned_whole(name):
    notice = dict(licenses.TEMPLATES)[name]
    scanner, n = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE), len(licenses.license_words(notice))
    for before in range(0, n):
        prose = [("the", "of", f"x{i}", "any", "to", f"y{i}")[i % 6] for i in range(before)]
        found = scanner.scan(f"{' '.join(prose)} {notice} and so on")
        assert (name, 1.0, before + n) in [(f[0], f[1], f[3]) for f in found], before
    pieces = licenses.license_words(notice)
    twice = scanner.scan(b" ".join(pieces[:-(n // 10)] + pieces).decode())
    assert [f[0] for f in twice].count(name) == 2


HEADER = ("This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind} as published by the Free "
          "Software Foundation, either version {version} of the License, or (at your option) any later version.")


@pytest.mark.parametrize("text, names", [
    (HEADER.format(what="program", kind="Affero General Public License", version="3"), ["AGPL-3.0-or-later"]),
    (HEADER.format(what="program", kind="General Public License", version="2"), ["GPL-2.0-or-later"]),
    (HEADER.format(what="program", kind="General Public License", version="3"), ["GPL-3.0-or-later"]),
    (HEADER.format(what="library", kind="Lesser General Public License", version="2.1"), ["LGPL-2.1-or-later"]),
    (HEADER.format(what="library", kind="Lesser General Public License", version="3"), ["LGPL-3.0-or-later"]),
    (HEADER.format(what="library", kind="Lesser General Public License", version="7"), []),
    ("Licensed under CC BY 4.0.", ["CC-BY-4.0-line"]),
    ("Licensed under CC BY-NC 4.0.", ["CC-BY-NC-4.0-notice"]),
    ("Licensed under CC BY-NC-SA 4.0.", ["CC-BY-NC-SA-4.0-line"]),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", ["CC-BY-4.0-notice"]),
    ("This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.", ["CC-BY-ND-4.0-notice"]),
    ("Released under the BSD License.", ["BSD-notice"]),
    ("Released under the Zope License.", []),
    ("Licensed under the Apache License, Version 1.1", []),
    ("Licensed under the Apache License, Version 2", ["Apache-2.0-notice"]),
    ("Released under the MIT License. Released under the BSD License.", ["BSD-notice", "MIT-notice"]),
])
def test_relatives_of_a_license_are_told_apart(text, names):
    scanner = licenses.Scanner(licenses.TEMPLATES, licenses.COVERAGE)
    for around in ("{}", "we like the software of this work {} and any other license of the public"):
        assert sorted({f[0] for f in scanner.scan(around.format(text))}) == names


def test_every_template_is_found_in_itself_whole_and_best(make_docs):
    got = {r.doc_id: r for r in licenses.scan(make_docs(rows_of([text for _, text in licenses.TEMPLATES]))).collect()}
    for n, (name, text) in enumerate(licenses.TEMPLATES):
        (whole,) = [x for x in got[n].notices if x.license == name]
        assert (whole.coverage, whole.share, whole.begin, whole.end) == (1, 1, 0, len(licenses.license_words(text)))
        assert got[n].best_coverage == 1


def test_license_query_equals_a_search_for_the_notices(spark, sf_dir):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: set(r.licenses) for r in QUERIES["op6_licenses"](spark, sf_dir).collect()}
    assert set(got) == set(texts)
    for name, notice in licenses.TEMPLATES[:7]:
        plain = b" ".join(licenses.license_words(notice))
        for i, text in texts.items():
            if f" {plain.decode()} " in f" {b' '.join(licenses.license_words(text)).decode()} ":
                assert name in got[i], (name, i)


def brute_increasing(pairs):
    best = [0] * len(pairs)
    for i in range(len(pairs)):
        best[i] = 1 + max([best[j] for j in range(i) if pairs[j][1] < pairs[i][1]], default=0)
    return max(best, default=0)


def test_patience_alignment_is_ascending_and_longest_over_anchors():
    rnd = np.random.default_rng(2)
    for _ in range(50):
        order = rnd.permutation(12)
        pairs = list(enumerate(order.tolist()))
        run = licenses.increasing(pairs)
        assert len(run) == brute_increasing(pairs) and all(a < c and b < d for (a, b), (c, d) in zip(run, run[1:]))
        a, b = rnd.integers(0, 9, 15).tolist(), rnd.integers(0, 9, 15).tolist()
        found = licenses.patience(a, b)
        assert all(a[i] == b[j] for i, j in found) and all(i < k and j < m for (i, j), (k, m) in zip(found, found[1:]))


PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var x="</p>";</script></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/a">a</a><li>b</ul></nav>{notice}<{box}><h1>Head &amp; {n}</h1><p>First   <b>bold<br>line</b> &lt;x&gt; {n}<p>Second &#233;&nbsp;{n}</p>
<ul><li>one {n}<li>two {n}</ul><aside>side</aside><form>Name <input></form></{end}><div class="comments"><p>Nice {n}!</p></div>
<div class="ad">Buy {n}</div><footer>&copy; site</footer></body></html>"""
WANT = "Head & {n}\nFirst bold line <x> {n}\nSecond é {n}\none {n}\ntwo {n}"


@pytest.mark.parametrize("box", ["article", "main", 'div class="c7"', "div"])
def test_article_is_found_with_and_without_its_marks(spark, box):
    rows = [(n, f"https://www.h{n % 2}.example/{n}", PAGE.format(n=n, box=box, end=box.split()[0], notice="<div class='cookie-notice'>We use</div>")) for n in range(10)]
    rows += [(10, None, None), (11, "https://h0.example/e", ""), (None, "x", "<p>alone &amp; short"), (3, rows[3][1], rows[3][2]), (12, "https://h1.example", "a < b <!-- c")]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    by = {}
    for r in got:
        by.setdefault(r.page_id, []).append(r.text)
    assert {n: by[n] for n in range(10)} == {n: [WANT.format(n=n)] * (2 if n == 3 else 1) for n in range(10)}
    assert by[10] == by[11] == [""] and by[None] == ["alone & short"] and by[12] == ["a < b"]
    assert html_text.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_large_hosts_are_dealt_to_groups(spark, monkeypatch):
    monkeypatch.setattr(html_text, "GROUP", 4)
    rows = [(n, f"https://h.example/{n}", PAGE.format(n=n, box="div", end="div", notice="")) for n in range(30)]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in got} == {n: WANT.format(n=n) for n in range(30)}


def main_text_of(spark, htmls, host="h.example"):
    rows = [(n, f"https://{host}/{n}", html) for n, html in enumerate(htmls)]
    got = html_text.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()
    return [r.text for r in sorted(got, key=lambda r: r.page_id)]


def prose(n, words=30):
    rnd = np.random.default_rng(n)
    return " ".join(f"w{x}" for x in rnd.integers(0, 9999, words))


def test_template_text_inside_an_article_is_no_text(spark):
    page = "<body><article><p>{0}</p><div>Share this page with all of your friends</div></article></body>"
    assert main_text_of(spark, [page.format(prose(n)) for n in range(8)]) == [prose(n) for n in range(8)]


def test_an_article_element_beside_the_text_does_not_win(spark):
    page = '<body><article><p>teaser {0}</p></article><div class="text"><p>{1}</p><p>{2}</p></div></body>'
    assert main_text_of(spark, [page.format(n, prose(n), prose(n + 50)) for n in range(8)]) == [f"{prose(n)}\n{prose(n + 50)}" for n in range(8)]


@pytest.mark.parametrize("wrapper", ['class="layout has-sidebar"', 'class="page no-sidebar"', 'class="content-with-comments"', 'id="search-results"', 'class="share-enabled"'])
@pytest.mark.parametrize("pages", [1, 6])
def test_a_doubtful_name_around_the_article_loses_nothing(spark, wrapper, pages):
    page = f"<body><div {wrapper}><article><h1>Head {{0}}</h1><p>{{1}}</p></article></div><div class='ad'>Buy {{0}}</div></body>"
    assert main_text_of(spark, [page.format(n, prose(n)) for n in range(pages)]) == [f"Head {n}\n{prose(n)}" for n in range(pages)]


def test_lists_of_records_are_slots_of_their_own(spark):
    record = "<div class='e'><b>by {0}</b><div class='t'>said {0} here</div></div>"
    page = "<body><div class='text'><p>{0}</p><div class='x'>{1}</div><p>{2}</p></div></body>"
    pages = [page.format(prose(n), "".join(record.format(n * 10 + k) for k in range(1 + n % 4)), prose(n + 50)) for n in range(9)]
    assert main_text_of(spark, pages) == [f"{prose(n)}\n{prose(n + 50)}" for n in range(9)]


def test_near_copies_do_not_make_their_text_a_template(spark):
    page = "<body><div class='menu1'>Our pages and our shop</div><div class='text'><p>{0}</p><p>{1}</p><i>{2}</i></div></body>"
    articles = [0] * 40 + [1, 2, 3, 4, 5]
    got = main_text_of(spark, [page.format(prose(a), prose(a + 50), n) for n, a in enumerate(articles)])
    assert got == [f"{prose(a)}\n{prose(a + 50)}\n{n}" for n, a in enumerate(articles)]


def test_the_template_is_that_of_the_whole_host(spark):
    """A notice that 3 of 4 pages have is template, however a host of 200 pages is dealt."""
    page = "<body><div class='text'><p>{0}</p>{1}</div></body>"
    pages = [page.format(prose(n), "<h6>All of our notices</h6>" if n % 4 else "") for n in range(200)]
    assert main_text_of(spark, pages) == [prose(n) for n in range(200)]


def test_pages_of_the_table(spark, sf_dir):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    got = {r.page_id: r for r in QUERIES["op7_html"](spark, sf_dir).collect()}
    assert set(got) == set(pages) and all(r.n_chars == len(r.text) for r in got.values())
    assert all("<" not in r.text.replace("<", "", 0) or "&lt;" in pages[i] for i, r in got.items())


@pytest.mark.parametrize("name", ['id="post-{0}"', 'id="a-long-way-from-page-{1}"', 'id="entry"'])
def test_ids_of_single_pages_hide_no_slot(spark, name):
    page = "<body><div class='story' " + name + "><p>{2}</p><p>{3}</p></div><div class='below'><p>Reader {0} says {1}</p></div></body>"
    pages = [page.format(n, f"w{n}x", prose(n), prose(n + 50)) for n in range(12)]
    assert main_text_of(spark, pages) == [f"{prose(n)}\n{prose(n + 50)}" for n in range(12)]


def test_a_host_may_have_two_layouts(spark):
    one = "<body><div class='story'><p>{0}</p><p>{1}</p></div><div class='below'><p>Reader {2} says so</p></div></body>"
    two = "<body><div class='wide'><div class='text'><p>{0}</p><p>{1}</p></div><div class='talk'><p>{2} was first</p></div></div></body>"
    pages = [(one, two)[n % 2].format(prose(n), prose(n + 50), n) for n in range(12)]
    assert main_text_of(spark, pages) == [f"{prose(n)}\n{prose(n + 50)}" for n in range(12)]


@pytest.mark.parametrize("name", ["discussion", "related-work", "skip-list", "box7"])
def test_parts_of_an_article_stay_whatever_their_names(spark, name):
    page = "<body><div class='story'><p>{1}</p><section class='" + name + "'><h2>More of {0}</h2><p>{2}</p></section></div><div class='below'><p>Reader {0}</p></div></body>"
    pages = [page.format(n, prose(n), prose(n + 50, 12)) for n in range(12)]
    assert main_text_of(spark, pages) == [f"{prose(n)}\nMore of {n}\n{prose(n + 50, 12)}" for n in range(12)]


def test_vague_names_count_where_links_fill_them(spark):
    page = "<body><div class='story'><p>{1}</p><p>{2}</p><div class='related'><p><a href='/x'>other text {0}</a></p></div></div></body>"
    pages = [page.format(n, prose(n), prose(n + 50)) for n in range(12)]
    assert main_text_of(spark, pages) == [f"{prose(n)}\n{prose(n + 50)}" for n in range(12)]
