"""Neighbours and page texts on small tables."""

import numpy as np
from pyspark.sql import functions as F

from vintage.llm import neighbours, pages
from vintage.llm.layouts import labelled_pages


def test_neighbours(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 16))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[40:70] = x[40]  # ties
    rows = [(k, v.tolist(), 1, 0.0) for k, v in enumerate(x)]
    rows += [(1000, None, 1, 0.0), (1020, [0.0] * 16, 1, 0.0), (1040, [float("nan")] * 16, 1, 0.0), (1060, [None] + [1.0] * 15, 1, 0.0), (1080, [1.0] * 3, 1, 0.0), (None, [1.0] * 16, 1, 0.0), (0, x[0].tolist(), 1, 0.0)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score double")
    got = neighbours.nearest(table, table.where("vec_id % 20 = 0"), k=5, rerank=1.0).collect()
    found = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert set(found) == set(range(0, 300, 20))
    for q, own in found.items():
        s = (x * x[q]).sum(1)
        order = sorted((k for k in range(300) if k != q), key=lambda k: (-s[k], k))[:5]
        assert [k for k, _ in own] == order
        assert np.allclose([v for _, v in own], s[order])


def _recall(spark, n, dims):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(n, dims)) * rng.uniform(0.5, 2, (n, 1))
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>")
    hits = {}
    for r in neighbours.nearest(table, table.where("vec_id % 20 = 0"), k=10).collect():
        hits.setdefault(r.query_id, set()).add(r.vec_id)
    assert set(hits) == set(range(0, n, 20))
    total = 0
    for q, own in hits.items():
        s = x @ x[q]
        s[q] = -1e9
        total += len(own & set(np.argsort(-s)[:10].tolist()))
    return total / (10 * len(hits)), table


def test_neighbours_recall_and_few_rows(spark):
    assert _recall(spark, 12000, 24)[0] >= 0.9
    recall, table = _recall(spark, 1500, 24)
    assert recall >= 0.9
    few = table.where("vec_id < 4")
    assert neighbours.nearest(few, few.where("vec_id = 0"), k=10).count() == 3
    assert neighbours.nearest(few.limit(0), few).count() == 0
    assert neighbours.nearest(few, few.limit(0)).count() == 0


def test_footrule_is_that_of_whole_lists():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(200, 8))
    index = neighbours.PermutationIndex(x[:90], float(np.linalg.norm(x, axis=1).max()))
    near, m = index.nearest(x), index.prefix
    assert m == neighbours.PREFIX < 90
    probes = index.nearest(x[:5], query=True)
    posts = index.postings(x)
    for probe in probes:
        got = index.footrule(probe, posts, len(x))
        asked = {p: a for a, p in enumerate(probe)}
        want = [sum(abs(asked.get(p, m) - at.get(p, m)) for p in range(90)) for at in ({p: a for a, p in enumerate(row)} for row in near)]
        assert np.array_equal(2 * got + m * (m + 1), want)


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";x(1<2)</script></head>
<body><nav><ul><li><a href="/a">Home</a></li><li><a href="/b">More</a></li></ul></nav><!-- <p>no</p> -->
<div class="ad">Buy now and save a lot.</div><article><h1>Title &amp;  more</h1><p><b>First   line<br>goes on.<p>Second
&lt;one&gt; &eacute;.</p><form><p>Sign up here</p></form><section class="comments"><p>Nice post, thanks a lot.</p></section></article>
<aside><p>See also this one.</p></aside><footer>&copy; us</footer></body></html>"""


def test_pages(spark):
    rows = [(1, "u", PAGE, "a", 1), (2, None, None, "b", 2), (3, "v", "", "c", 3), (4, "w", "only &amp; text", "d", 4), (None, "x", "<p", "e", 5), (1, "u", PAGE, "a", 1), (6, "z", "<div>" * 5000 + "deep", "f", 6)]
    table = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars int")
    model = pages.fit(table)
    got = pages.extract(table, model).collect()
    assert len(got) == len(rows)
    by_id = {r.page_id: r for r in got}
    assert by_id[1].text == "Title & more\nFirst line goes on.\nSecond <one> é."
    assert by_id[1].n_chars == len(by_id[1].text) and by_id[1].url == "u"
    assert by_id[2].text == by_id[3].text == by_id[None].text == ""
    assert by_id[4].text == "only & text"
    assert pages.extract(table.limit(0), pages.fit(table.limit(0))).count() == 0


def test_text_outside_the_body_and_pages_of_few_elements(spark):
    article = PAGE.replace("</article>", "</article></body></html><article><p>After the end of the body, there is a paragraph.</p></article>")
    cases = {
        1: ("Some <b>bold</b> text", "Some bold text"),
        2: ("<body><p>One paragraph.</p></body>", "One paragraph."),
        3: ("<html><head><title>T</title><meta charset=x><p>One. <p>Two.", "One.\nTwo."),
        4: ("<body>Bare <i>words</i><div class='ad'>Buy</div></body>", "Bare words"),
        5: ("<body><nav><a href=x>Home</a></nav><footer>us</footer></body>", ""),
        6: ("</body></html><p>Late", "Late"),
        7: ("<head></head>Text<body class=x><p>More", "Text\nMore"),
    }
    model = pages.fit(spark.createDataFrame([(1, "u", PAGE)], "page_id long, url string, html string"))
    table = spark.createDataFrame([(k, "u", v[0]) for k, v in cases.items()] + [(9, "u", article)], "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.extract(table, model).collect()}
    assert {k: got[k] for k in cases} == {k: v[1] for k, v in cases.items()}
    assert got[9].startswith("Title & more\n") and got[9].endswith("After the end of the body, there is a paragraph.")


def test_marginals_are_exact():
    """Messages give what summing over all states gives."""
    import itertools
    import math

    model = pages.train([(p, pages.labels(p)) for p in map(pages.parse, labelled_pages(3))])
    page = pages.parse('<div class="menu"><a>x</a></div><div class="post"><p>Some words here.</p><p>y</p></div><p>z</p>')
    n = len(page.tag)
    total, content = 0.0, [0.0] * n
    for states in itertools.product((0, 1), repeat=n - 1):
        y = [1, *states]  # the page itself is not content; 0 stands for content
        weight = math.exp(sum(model.potential(page, k)[2 * y[page.parent[k]] + y[k]] for k in range(1, n)))
        total += weight
        for k in range(1, n):
            content[k] += weight * (y[k] == 0)
    got = model.marginals(page)
    assert all(abs(got[k] - content[k] / total) < 1e-9 for k in range(1, n))


def test_held_out_layouts():
    model = pages.train([(p, pages.labels(p)) for p in map(pages.parse, labelled_pages())])
    right = total = 0
    for page in map(pages.parse, labelled_pages(5, seed=77)):
        label, found = pages.labels(page), model.marginals(page)
        for n, _ in page.blocks:
            total += 1
            right += (found[n] >= 0.5) == label[n]
    assert right / total >= 0.95
