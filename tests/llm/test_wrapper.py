"""Tree matching against brute force, templates of a host, and broken pages."""

import random
import time
import tracemalloc
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F
from riskloom.llm import wrapper as W

PAGE = "page_id long, url string, html string"


def random_tree(rng, n):
    labels, parents = ["r"], [-1]
    for i in range(1, n):
        labels.append(rng.choice("abc"))
        parents.append(rng.randrange(max(0, i - 4), i))
    # document order: children after parents, subtrees together
    kids = W._children(parents)
    order, todo = [], [0]
    while todo:
        x = todo.pop()
        order.append(x)
        todo += reversed(kids[x])
    place = {x: i for i, x in enumerate(order)}
    return [labels[x] for x in order], [place.get(parents[x], -1) for x in order]


def plain_size(la, pa, lb, pb):
    ca, cb = W._children(pa), W._children(pb)

    @lru_cache(None)
    def size(u, v):
        if la[u] != lb[v]:
            return 0
        x, y = ca[u], cb[v]
        t = [[0] * (len(y) + 1) for _ in range(len(x) + 1)]
        for i, p in enumerate(x):
            for j, q in enumerate(y):
                t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + size(p, q))
        return 1 + t[-1][-1]

    return size(0, 0)


def test_matching_is_largest_and_keeps_order():
    rng = random.Random(1)
    for _ in range(200):
        a, b = random_tree(rng, rng.randrange(1, 14)), random_tree(rng, rng.randrange(1, 14))
        pairs = W.match(*a, *b)
        assert len(pairs) == plain_size(*a, *b)
        assert len({u for u, _ in pairs}) == len(pairs) == len({v for _, v in pairs})
        place = dict(pairs)
        for u, v in pairs:
            assert a[0][u] == b[0][v] and (a[1][u] == -1 or place[a[1][u]] == b[1][v])
        by_u = [v for _, v in sorted(pairs)]
        assert by_u == sorted(by_u)


def page(body, head=""):
    return f"<!DOCTYPE html><html><head><title>t</title>{head}</head><body>{body}</body></html>"


MENU = '<header class="top"><a href="/">Home</a></header><nav><ul><li>One<li>Two</ul></nav>'
REST = (
    '<aside>side</aside><div class="cookie-notice">We use cookies</div><form><p>Mail</p><button>Go</button></form>'
    '<section id="comments"><article class="comment"><p>First!</p></article></section><footer>&copy; us</footer>'
)


def read(spark, rows, **how):
    return {r.page_id: r.main_text for r in W.main_text(spark.createDataFrame(rows, PAGE).repartition(3), **how).collect()}


def test_article_without_its_surroundings(spark):
    body = '<h1>A &amp; B</h1><p>one <b>two</b>\n three<br>four<p>&lt;five&gt; &eacute;<div class="ad">buy</div><ul><li>x<li>y</ul><script>if (a<b) "</p>"</script><style>p{}</style><!-- no --><p>end'
    for outer in (f"{MENU}<article>{body}</article>{REST}", f"{MENU}<main><div>{body}</div></main>{REST}", f"{MENU}<div id=content>{body}</div>{REST}"):
        got = read(spark, [(1, "http://h.x/1", page(outer))])
        assert got[1] == "A & B\n\none two three four\n\n<five> é\n\nx\n\ny\n\nend"


def test_templates_of_a_host_go_and_slots_stay(spark):
    def made(i):
        return page(f"<article><h1>Title {i}</h1><p>Read this {'' if i % 3 else 'twice '}first of all</p><p>body {i}</p><p>Thank you for reading</p>{'<p>more</p>' if i % 2 else ''}</article>")

    rows = [(i, f"http://same.host/{i}", made(i)) for i in range(9)] + [(20 + i, "http://copies.host/", made(1)) for i in range(9)]
    rows += [(40 + i, f"http://few.host/{i}", made(i)) for i in range(3)]
    got = read(spark, rows)
    for i in range(9):
        assert "Thank you" not in got[i] and f"Title {i}" in got[i] and f"body {i}" in got[i] and "first of all" in got[i]
        assert "Thank you" in got[20 + i]
    assert all("Thank you" in got[40 + i] for i in range(3))


def test_edges(spark):
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    long = "<article>" + "<p>word</p>" * 30000 + "</article>"
    rows = [(1, None, None), (1, "", ""), (None, "x", "plain & text"), (3, "http://a.b/", "<article><p>open <b>bold"), (4, "http://a.b/", "</p></div><p>x"), (5, "http://a.b/", deep),
            (6, "http://a.b/", long), (7, "http://a.b/", "<" * 2000), (8, "http://a.b/", "<p a='"), (9, "http://a.b/", "<script>never closed"), (3, "http://a.b/", "<article><p>open <b>bold")]
    df = spark.createDataFrame(rows, PAGE).withColumn("host", F.lit("h")).withColumn("labels", F.lit(1)).withColumn("text", F.lit("t"))
    got = W.main_text(df)
    assert got.columns == [*df.columns, "main_text"]
    texts = sorted((r.page_id or 0, r.main_text) for r in got.collect())
    by = dict(texts)
    assert len(texts) == len(rows) and by[1] == "" and by[0] == "plain & text" and by[3] == "open bold" and by[4] == "x" and by[5] == "deep" and by[9] == ""
    assert by[6].count("word") == 30000
    assert W.main_text(spark.createDataFrame([], PAGE)).collect() == []
    with pytest.raises(ValueError):
        W.main_text(df, name="HOST")


def test_all_sections_of_a_page_without_article(spark):
    bodies = {
        1: "<div id=content><div>short one</div><div>the longest paragraph of this page</div><div>another</div></div>",
        2: "<section><h2>A</h2><p>one</p><p>two</p></section><section><h2>B</h2><p>a much longer section than the first</p></section><section>last</section>",
        3: "<table><tr><td>cell one<td>cell two, with more text</table><blockquote>said</blockquote>",
    }
    got = read(spark, [(i, f"http://h{i}.x/", page(f"{MENU}{body}{REST}")) for i, body in bodies.items()])
    assert got[1] == "short one\n\nthe longest paragraph of this page\n\nanother"
    assert got[2] == "A\n\none\n\ntwo\n\nB\n\na much longer section than the first\n\nlast"
    assert got[3] == "cell one\n\ncell two, with more text\n\nsaid"


def test_clashing_columns(docs):
    names = ["own host", "own layout", "layout", "rule", "outside", "wrapper host", "wrapper rule", "host", "labels", "parents", "template", "page", "s"]
    kind = "page_id long, url string, html string" + "".join(f", `{n}` string" for n in names)
    df = docs([(i, "http://a.b/x", f"<p>text number {i}</p>", *names) for i in range(6)], kind)
    rows = W.main_text(df).collect()
    assert {tuple(r)[3:-1] for r in rows} == {tuple(names)} and {r.main_text for r in rows} == {f"text number {i}" for i in range(6)}


def plain_lists(a, b, weight):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = max(t[i][j + 1], t[i + 1][j], t[i][j] + weight(i, j))
    return t[-1][-1]


def test_long_lists_align_as_well_as_short_ones():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(0, 12))] for _ in range(2))
        shape_a, shape_b = ([x * 10 + rng.randrange(2) for x in side] for side in (a, b))
        sizes = [1 + 4 * (s % 2) for s in shape_a]
        weight = lambda i, j: (a[i] == b[j]) + (shape_a[i] == shape_b[j]) * (sizes[i] - 1)
        pairs = W._wide(*(np.array(x, dtype=np.int64) for x in (a, b, shape_a, shape_b, sizes)))
        assert sum(weight(i, j) for i, j in pairs) == plain_lists(a, b, weight) and all(a[i] == b[j] for i, j in pairs)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(pairs, pairs[1:]))


def test_long_lists_are_matched_like_short_ones(monkeypatch):
    rng = random.Random(7)
    sides = [(random_tree(rng, rng.randrange(1, 60)), random_tree(rng, rng.randrange(1, 60))) for _ in range(300)]
    item = lambda i: "".join(rng.choice(["<li>one", "<li><p>x<p>y", "<li><h2>h</h2>"]) for _ in range(i % 4))
    pages = [W.parse("<body>" + "".join(f"<ul>{item(i)}</ul>" for i in range(510))) for _ in range(2)]
    sides.append(tuple((t.labels, t.parents) for t in pages))  # by its length a long list
    monkeypatch.setattr(W, "WIDE", 10**9)
    short = [W.match(*a, *b) for a, b in sides]
    monkeypatch.undo()
    assert sorted(W.match(*sides[-1][0], *sides[-1][1])) == sorted(short[-1])
    monkeypatch.setattr(W, "WIDE", 0)
    assert [sorted(W.match(*a, *b)) for a, b in sides] == [sorted(p) for p in short]


def mixed_siblings(n, seed):
    rng = random.Random(seed)
    tree = W.parse("<body>" + "".join(rng.choice(["<p>text</p>", "<ul><li>one<li>two</ul>", "<h2>head</h2>", "<table><tr><td>cell</table>"]) for _ in range(n)))
    return tree.labels, tree.parents


def test_many_mixed_siblings():
    sides = *mixed_siblings(20_000, 3), *mixed_siblings(20_000, 4)
    began = time.process_time()
    pairs = W.match(*sides)
    assert time.process_time() - began < 60
    assert len(pairs) > 30_000 and len({u for u, _ in pairs}) == len(pairs) == len({v for _, v in pairs})


def test_mixed_siblings_take_linear_memory():
    peaks = []
    for n in (1_000, 4_000):
        sides = *mixed_siblings(n, 3), *mixed_siblings(n, 4)
        tracemalloc.start()
        W.match(*sides)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 6 * peaks[0]


@pytest.mark.parametrize("part", ["<p a=1 ", "<p a='", '<p a=\'"> x ', "<!-- ", "<", "</p", "<a href=x>"])
def test_broken_markup_is_linear(part):
    began = time.time()
    W.parse(part * 100_000)
    assert time.time() - began < 10


def test_a_quote_that_never_ends_protects_nothing():
    tree = W.parse("<p title=\"a > b\">one</p><p title='open>two</p><p>three <b>four</b>")
    assert [t for t in tree.texts if t] == ["one", "two", "three four"]


def plain_div_page(i, rng, kinds):
    """A page without any meaning in tags and classes: menu, advert, article of several paragraphs, notice, footer."""
    say = lambda n: " ".join(rng.choice("abcdefghij") * 3 + str(rng.randrange(1000)) for _ in range(n))
    menu = "".join(f"<div><a href=/{j}>{say(1)}</a></div>" for j in range(rng.randrange(4, 8)))
    text = [say(5), *[say(rng.randrange(10, 60)) for _ in range(rng.randrange(3, 9))]]
    body = "".join(f"<div class=q{i}>{t}</div>" for t in text)
    parts = [f"<div class=u7>{menu}</div>", f"<div class=k2>{say(8)}</div>", f"<div class=z{i} id=n-{i}>{body}</div>", f"<div class=w>Copyright {say(3)}</div>"]
    if kinds == 2:
        parts = [parts[1], parts[0], "<div class=v><div>We use cookies</div><div>Read the rules</div><div>All rights</div></div>", parts[2], parts[3]]
    return f"<html><body>{''.join(parts)}</body></html>", "\n\n".join(text)


@pytest.mark.parametrize("markup", [True, False])
def test_wrapper_alone_finds_content_in_two_layouts(spark, markup):
    rng, rows, want = random.Random(5), [], {}
    for i in range(60):
        html, want[i] = plain_div_page(i, rng, 2 if i % 3 == 0 else 1)
        rows.append((i, f"http://scrambled.host/{i}", html))
    got = read(spark, rows, markup=markup)
    assert got == want
    without = read(spark, rows, markup=markup, least_pages=10**9)
    assert all(without[i] != want[i] for i in want)


def test_parts_with_several_paragraphs_and_headings_stay(spark):
    def made(i):
        section = "".join(f"<p>paragraph {j} of page {i}</p>" for j in range(3 + i % 3))
        return page(f"<div class=all><div class=one><h1>Title {i}</h1></div><p>lead {i}</p><div class=two>{section * 3}</div><div class=three>{section}</div><div class=four><a>link {i}</a></div></div>")

    got = read(spark, [(i, f"http://parts.x/{i}", made(i)) for i in range(12)], markup=False)
    for i, text in got.items():
        assert text.split("\n\n")[:2] == [f"Title {i}", f"lead {i}"] and text.count("paragraph") == 4 * (3 + i % 3) and "link" not in text
