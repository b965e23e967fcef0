"""Learned partitions, licence scan and site templates: recall, SQL, fixtures and defined cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as se
from dealflow.llm import learned_partitions as lp
from dealflow.llm import license_scan as lic
from dealflow.llm import license_templates as lt
from dealflow.llm import site_template as site


def clustered(n, d, seed):
    r = np.random.default_rng(seed)
    centres = r.standard_normal((40, d))
    return centres[r.integers(0, 40, n)] + 0.35 * r.standard_normal((n, d))


def exact(x, ids, q, k):
    s = x @ x[q]
    order = [i for i in np.lexsort((ids, -np.round(s, 10))) if ids[i] != ids[q]]
    return [int(ids[i]) for i in order[:k]]


# ---- nearest neighbours

def test_recall_against_brute_force(spark, rows):
    x = clustered(4000, 24, 1)
    x[1000:2300] = x[7]                                       # one vector that a third of the rows share
    ids = np.arange(len(x))
    d = rows("vec_id long, embedding array<double>, part int", [(int(i), v.tolist(), 1) for i, v in zip(ids, x)])
    got = {}
    for r in lp.search(d, F.col("vec_id") % 20 == 0, k=10, fit=lp.Fit(sample_size=1024, block=300)).collect():
        got.setdefault(r.query_id, []).append(r)
    assert set(got) == set(range(0, 4000, 20))
    hit = 0
    for q, found in got.items():
        found.sort(key=lambda r: r.rank)
        assert [r.rank for r in found] == list(range(1, 11)) and q not in {r.vec_id for r in found}
        assert np.allclose([r.score for r in found], [x[r.vec_id] @ x[q] for r in found], rtol=1e-13)
        pairs = [(-r.score, r.vec_id) for r in found]
        assert pairs == sorted(pairs)
        hit += len({r.vec_id for r in found} & set(exact(x, ids, q, 10)))
    assert hit / (10 * len(got)) >= 0.9


def test_vectors_that_take_no_part(rows):
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, None), (3, [0.0, 0.0]), (4, [1.0, None]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (7, []), (8, [1.0, 2.0, 3.0]), (9, [0.5, 4.0]), (20, [-0.0, 1.0])]
    d = rows("vec_id long, embedding array<double>", data)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in lp.search(d, F.col("vec_id") % 20 == 0, k=3).collect())
    assert got == [(0, 1, 1, 1.0), (0, 2, 9, 0.5), (0, 3, 20, 0.0), (20, 1, 9, 4.0), (20, 2, 0, 0.0), (20, 3, 1, 0.0)]
    assert lp.search(d.limit(0), F.col("vec_id") % 20 == 0).count() == 0


def test_balanced_parts_of_a_neighbour_graph():
    x = clustered(800, 16, 3)
    graph = lp.nearest(x, x, 8, same=True)
    label = lp.balanced_parts(graph, 8)
    sizes = np.bincount(label, minlength=8)
    assert sizes.max() - sizes.min() <= 3
    assert (label[graph] == label[:, None]).mean() > 0.5       # a random cut keeps an eighth


# ---- licences

def test_scan_matches_sql(spark, sf_small):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{sf_small}/documents.parquet')")
    cols = "doc_id, path, license, score, origin, from_path"
    want = con.execute(f"SELECT {cols} FROM ({se.oracle_sql()['op2_license_scan']})").fetchall()
    got = se.queries()["op2_license_scan"](spark, sf_small).selectExpr(*cols.split(", ")).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, want), key=str)


def test_inheritance_from_the_nearest_ancestor(rows):
    mit, apache, gpl = "Released under the MIT License.", lt.APACHE_HEADER, (
        "This work is licensed under the GNU General Public License, version 3.")
    data = [(1, "r/LICENSE", mit), (2, "r/a/b/code.c", "some code here\nand more"), (3, "r/a/LICENSE", apache),
            (4, "r/a/b/own.c", "/* " + gpl + " */\n" + "many other words in this file " * 40), (5, "r/x.c", "text"),
            (6, "other/y.c", "text"), (7, "top.c", None), (8, None, ""), (9, "r/a/b/code.c", "some code here\nand more"),
            (10, "r/a/b/c/d.c", "license is a word that alone proves nothing")]
    d = rows("file_id long, path string, text string", data).withColumn("license", F.lit("clash"))
    got = {r.file_id: (r.license, r.origin, r.from_path) for r in lic.scan(d).collect()}
    assert got[1] == ("MIT", "own", "r/LICENSE") and got[3] == ("Apache-2.0", "own", "r/a/LICENSE")
    assert got[2] == got[9] == ("Apache-2.0", "inherited", "r/a/LICENSE")
    assert got[4] == ("GPL-3.0", "own", "r/a/b/own.c") and got[5] == ("MIT", "inherited", "r/LICENSE")
    assert got[6] == got[7] == got[8] == (None, "none", None) and got[10][0] == "Apache-2.0"
    assert lic.scan(d.limit(0)).count() == 0


def wrapped(text, mark=" * ", width=64):
    import textwrap

    return "/*\n" + "\n".join(mark + x for x in textwrap.wrap(text, width)) + "\n */\n"


CODE = "\n\nint main(void)\n{\n    return frob(table, row, column);\n}\n" + "value = other + more;\n" * 200
GPL = lt.GNU_HEADER.format(name="GNU General Public License", version="2")
LGPL = lt.GNU_HEADER.format(name="GNU Lesser General Public License", version="2.1")
HOLDER = "Copyright (c) 2021 Some Person and Others. All rights reserved.\n\n"
#: text of a file: its own licence
LICENSED = {
    "MIT License\n\n" + HOLDER + lt.MIT_GRANT + "\n\n" + lt.MIT_REST: "MIT",
    wrapped(lt.MIT_GRANT) + CODE: "MIT",
    "ISC License\n\n" + HOLDER + lt.ISC_GRANT + "\n\n" + lt.ISC_REST: "ISC",
    HOLDER + "\n".join((lt.BSD_GRANT, lt.BSD_TWO, lt.BSD_REST)): "BSD-2-Clause",
    HOLDER + "\n".join((lt.BSD_GRANT, lt.BSD_TWO, lt.BSD_THIRD, lt.BSD_REST)): "BSD-3-Clause",
    wrapped(lt.APACHE_HEADER, "# ") + CODE: "Apache-2.0",
    wrapped(lt.MPL_HEADER, "// ") + CODE: "MPL-2.0",
    wrapped(GPL) + CODE: "GPL-2.0", wrapped(LGPL) + CODE: "LGPL-2.1",
    "Intro.\n\nThis is licensed under the GNU Affero General Public License, version 3.\n" + CODE: "AGPL-3.0",
    "// SPDX-License-Identifier: Apache-2.0" + CODE: "Apache-2.0",
    "# SPDX-License-Identifier: GPL-2.0-or-later" + CODE: "GPL-2.0",
    "# SPDX-License-Identifier: CC-BY-NC-SA-4.0" + CODE: "CC-BY-NC-SA-4.0",
    "Licensed under CC BY 4.0." + CODE: "CC-BY-4.0", "Licensed under CC BY-NC 4.0." + CODE: "CC-BY-NC-4.0",
    "text\nThis project is licensed under the terms of the MIT license. See LICENSE.\nmore" + CODE: "MIT",
    "This software is released under the MIT License, see the LICENSE file for details." + CODE: "MIT",
    "Copyright 2024 Example Corp. All rights reserved." + CODE: "proprietary",
    "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\n" + "a long body of terms " * 900: "GPL-3.0",
}
#: near misses
UNLICENSED = [
    "Mozilla Public License, version 1.1" + CODE, "Licensed under the Apache License, Version 1.1." + CODE,
    "# SPDX-License-Identifier: EUPL-1.2" + CODE, "GNU General Public License, version 1" + CODE,
    "Licensed under CC BY." + CODE, "They fuhren mit dem Zug, a license to drive in hand" + CODE,
    "We never liked how the MIT license came up again and again in talks about dinner" + CODE,
    "All seats reserved for members with rights" + CODE, "License", "", None,
]


def test_licences_found_and_near_misses_refused(rows):
    import duckdb

    texts = [*LICENSED, *UNLICENSED]
    data = [(i, f"d{i}/file", t) for i, t in enumerate(texts)]
    d = rows("doc_id long, path string, text string", data)
    got = {r.doc_id: r.license for r in lic.scan(d, id_col="doc_id").collect()}
    assert {texts[i]: x for i, x in got.items() if i < len(LICENSED)} == LICENSED
    assert [texts[i] for i, x in got.items() if i >= len(LICENSED) and x] == []
    frame = d.toPandas()  # noqa: F841
    con = duckdb.connect()
    con.register("frame", frame)
    want = con.execute(lic.oracle_sql("SELECT doc_id AS id, path, text FROM frame")).fetchall()
    assert sorted((r[0], r[2]) for r in want) == sorted(got.items())


def test_a_licence_file_speaks_for_its_directory(rows):
    title = "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\n" + "a long body of terms " * 900
    data = [(1, "a/COPYING", title), (2, "a/b/c/x.c", "int x;" + CODE), (3, "m/LICENSE", HOLDER + lt.MIT_GRANT + "\n" + lt.MIT_REST),
            (4, "m/y.c", "int y;"), (5, "n/README", "words of a manual " * 300 + "\nReleased under the MIT License.\n"), (6, "n/z.c", "int z;")]
    d = rows("file_id long, path string, text string", data)
    got = {r.file_id: (r.license, r.origin) for r in lic.scan(d).collect()}
    assert got == {1: ("GPL-3.0", "own"), 2: ("GPL-3.0", "inherited"), 3: ("MIT", "own"), 4: ("MIT", "inherited"),
                   5: ("MIT", "own"), 6: (None, "none")}


def test_templates_require_words_of_theirs():
    for t in lic.TEMPLATES:
        assert set(t.required.split()) <= set(lic.words(t.text)), t


def test_scan_is_native(spark, sf_small):
    plan = se.queries()["op2_license_scan"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan


# ---- pages

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header><h2>Site</h2></header><nav><ul><li><a href="/1">One</a></li></ul></nav><!-- c --><div class="ad">Buy</div>
<div class="cookie-notice">We use</div><article><h1>Head &amp; tail</h1><p>First <b>bold</b>&nbsp; text<br>goes
 on</p><p>Second <i>one<p>Third &lt;p&gt; &am 3 < 5</p><div class="share">Share</div><form><p>Name</p></form>
<aside>Side</aside><section class="comments"><p>Reader</p></section></article><footer>&copy; x</footer></body></html>"""


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def test_article_text(rows):
    data = [(1, "http://h.org/a", PAGE), (2, None, None), (3, "http://h.org/b", ""), (4, "x", "just text &amp; more"),
            (5, "http://h.org/c", "<p>open<p>again <span class='ad'>no</span> yes"), (5, "http://h.org/c", "<p>open<p>again"),
            (6, "http://h.org/d", "<main><p>in</main><p>out"), (7, "u", "<script>never closed <p>x"), (8, "u", "<p>a</div>b</p>c")]
    d = rows("page_id long, url string, html string", data).withColumn("host", F.lit(1))
    out = site.extract(d)
    got = texts(out.where("page_id <> 5"))
    assert got[1] == "Head & tail\n\nFirst bold text goes on\n\nSecond one\n\nThird <p> &am 3 < 5"
    assert got[2] == got[3] == got[7] == "" and got[4] == "just text & more" and got[6] == "in"
    assert got[8] == "ab\n\nc" and out.where("page_id = 5").count() == 2
    assert {r.n_chars == len(r.text) for r in out.collect()} == {True}
    assert site.extract(d.limit(0)).count() == 0


def test_templates_of_a_host_go(rows):
    """Without an article element only recurrence tells a host's furniture from its text."""
    page = "<div><div>Welcome to <b>site</b></div><div><p>All about {}</p></div><div><p>Links</p><p>More</p></div></div>"
    data = [(i, f"http://a.org/{i}", page.format(f"topic {i}")) for i in range(8)]
    data += [(100 + i, f"http://b.org/{i}", page.format(f"theme {i}")) for i in range(2)]
    data += [(200, "http://a.org/3", page.format("topic 3"))] * 6            # one page often is not many pages
    got = texts(site.extract(rows("page_id long, url string, html string", data)))
    assert [got[i] for i in range(8)] == [f"All about topic {i}" for i in range(8)]
    assert got[100] == "Welcome to site\n\nAll about theme 0\n\nLinks\n\nMore" and got[200] == "All about topic 3"
    counted = site.templates(site.parsed(rows("page_id long, url string, html string", data)), 5)
    assert {r.n_pages for r in counted.collect()} == {9}


def test_copied_articles_stay(rows):
    page = "<body><nav>N</nav><article><h1>Same</h1><p>Copied passage</p></article></body>"
    data = [(i, f"http://a.org/{i}", page) for i in range(9)]
    assert set(texts(site.extract(rows("page_id long, url string, html string", data))).values()) == {"Same\n\nCopied passage"}


@pytest.mark.parametrize("wrap", ["div class='layout has-sidebar'", "div class=\"no-comments\"", "div id='page-with-menu'"])
@pytest.mark.parametrize("inner", ["article", "main", "main><div class='with-sidebar'><article", "div"])
def test_layout_names_around_the_article(wrap, inner):
    html = f"<body><p>Short</p><{wrap}><{inner}><p>The story itself</p><div class='share'>Share</div>"
    html = html if inner != "div" else html.replace("<p>Short</p>", "")
    assert [b[0] for b in site._main(site.parse(html)[0])] == ["The story itself"]
    teaser = "<article><p>Story</p></article><div class='related'><article><p>A longer teaser</p></article></div>"
    assert [b[0] for b in site._main(site.parse(teaser)[0])] == ["Story"]
    comments = "<main><p>Story</p><div id='comments'><article><p>A longer comment</p></article></div></main>"
    assert [b[0] for b in site._main(site.parse(comments)[0])] == ["Story"]


@pytest.mark.parametrize("wrap", ["<article><div><p>{}</p></div></article>", "<article><section><h2>{}</h2></section></article>",
                                  "<article><ul><li>{}</ul><blockquote>{}</blockquote></article>", "<div><p>{}</p></div>",
                                  "<main><table><tr><td>{}</table></main>"])
def test_copied_pages_stay_however_wrapped(rows, wrap):
    html = wrap.replace("{}", sentence(7, 12))
    data = [(i, f"http://a.org/{i}", f"<body><nav>{i}</nav>{html}</body>") for i in range(9)]
    assert set(texts(site.extract(rows("page_id long, url string, html string", data))).values()) == {
        "\n\n".join([sentence(7, 12)] * wrap.count("{}"))}


def sentence(i, n=60):
    r = np.random.default_rng(i)
    return " ".join(f"w{x}" for x in r.integers(0, 4000, n))


def test_furniture_inside_the_article_goes(rows):
    """A notice without a telling name, in the article of every page, is found by counting alone."""
    page = "<body><article><h1>{}</h1><p>Read our new app today</p><p>{}</p></article></body>"
    data = [(i, f"http://a.org/{i}", page.format(f"head {i}", sentence(i))) for i in range(6)]
    data += [(10 + i, f"http://b.org/{i}", page.format(f"head {i}", sentence(i))) for i in range(4)]
    got = texts(site.extract(rows("page_id long, url string, html string", data)))
    assert [got[i] for i in range(6)] == [f"head {i}\n\n{sentence(i)}" for i in range(6)]
    assert all("Read our new app today" in got[10 + i] for i in range(4))


def test_near_copies_are_one_article(rows):
    """Copies of an article with a word changed somewhere keep heading and paragraphs."""
    data, want = [], {}
    for i in range(40):
        parts = [sentence(900), sentence(901), sentence(902)]
        changed = parts[i % 3].split()
        changed[i] = f"changed{i}"
        parts[i % 3] = " ".join(changed)
        data.append((i, f"http://a.org/{i}", "<article><h1>Same head</h1>" + "".join(f"<p>{x}</p>" for x in parts) + "</article>"))
        want[i] = "\n\n".join(["Same head", *parts])
    assert texts(site.extract(rows("page_id long, url string, html string", data))) == want


@pytest.mark.parametrize("html", ["<" * 3000, "<a " * 3000, "<div>" * 3000 + "x", "<p class='" + "x" * 9000, "<!--" * 500, "</p>" * 900])
def test_hostile_html_ends(html):
    blocks, _ = site.parse(html)
    assert isinstance(blocks, list)


def plain_extract(pages, min_pages=site.MIN_PAGES, min_share=site.MIN_SHARE):
    """Site template removal by plain counting: texts by page id of rows ``(page_id, url, html)``."""
    import re
    from collections import defaultdict

    own, host_of, article, bands = {}, {}, {}, defaultdict(set)
    for i, url, html in pages:
        m = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
        host_of[i] = m[1].lower() if m else ""
        blocks, found = site.parse(html or "")
        own[i] = site._main(blocks), set(found)
        node = host_of[i], "\n".join(b[0] for b in own[i][0])
        if node not in article:
            article[node] = node
            s = site.sketch(node[1])
            for b in range(site.BANDS if s else 0):
                bands[node[0], b, tuple(s[b * site.BAND_ROWS:(b + 1) * site.BAND_ROWS])].add(node)
        host_of[i] = node

    def root(n):
        while article[n] != n:
            n = article[n]
        return n

    for same in bands.values():
        same = sorted(same)
        for a in same:
            for b in same:
                x, y = site.sketch(a[1]), site.sketch(b[1])
                if a < b and sum(p == q for p, q in zip(x, y)) >= site.NEAR * len(x):
                    article[root(a)] = root(b)
    seen, total = defaultdict(set), defaultdict(set)
    for i, (_, found) in own.items():
        total[host_of[i][0]].add(root(host_of[i]))
        for subtree in found:
            seen[host_of[i][0], subtree].add(root(host_of[i]))
    dead = {k for k, arts in seen.items() if len(arts) >= min_pages and len(arts) >= min_share * len(total[k[0]])}
    return {i: "\n\n".join(b[0] for b in blocks if not any((host_of[i][0], o) in dead for o in b[3]))
            for i, (blocks, _) in own.items()}, dead


@pytest.mark.parametrize("min_share", [site.MIN_SHARE, 0.0])
def test_extract_against_plain_counting(spark, sf_small, min_share):
    pages = spark.read.parquet(f"{sf_small}/pages.parquet")
    some = [(r.page_id, r.url, r.html) for r in pages.collect()]
    want, dead = plain_extract(some, 2, min_share)
    assert texts(site.extract(pages, min_pages=2, min_share=min_share)) == want and dead


def test_a_line_that_recurs_on_a_large_host_stays(rows):
    data = [(i, "http://h.org/%d" % i, "<article><p>Article %d about %d things and %d more</p>%s<p>Subscribe now</p></article>"
             % (i, i * 7, i * 13, "<p>Introduction</p>" if i % 10 == 0 else "")) for i in range(100)]
    got = texts(site.extract(rows("page_id long, url string, html string", data)))
    want, _ = plain_extract(data)
    assert got == want and got[10] == "Article 10 about 70 things and 130 more\n\nIntroduction"


def test_ties_beyond_a_block_go_to_smaller_ids(rows):
    """More distinct vectors with the border's score than an answer holds."""
    data = [(0, [1.0] + [0.0] * 63)] + [(i, [2.0] + [float(i >> j & 1) for j in range(63)]) for i in range(1, 400)]
    d = rows("vec_id long, embedding array<double>", data)
    got = lp.search(d, F.col("vec_id") == 0, k=20, fit=lp.Fit(sample_size=16, block=64)).orderBy("rank").collect()
    assert [r.vec_id for r in got] == list(range(1, 21)) and {r.score for r in got} == {2.0}
