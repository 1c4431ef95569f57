import html
import random
import re
import time

import pytest

from clustertrace.llm.html_text import ARTICLE, CHROME, OPEN, common_lines, main_text, page_lines
from clustertrace.llm.queries import op10_html_text

SCHEMA = "page_id bigint, url string, html string, text string, host int"


def longest(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("most_bits", [10**9, 3])
def test_common_lines(most_bits):
    rnd = random.Random(3)
    for _ in range(1500):
        a, b = ([rnd.randrange(6) for _ in range(rnd.randrange(14))] for _ in range(2))
        found = [x for x, f in zip(a, common_lines(a, b, most_bits), strict=True) if f]
        rest = iter(b)
        assert len(found) == longest(a, b) and all(any(x == y for y in rest) for x in found)


def test_markup():
    source = """<!DOCTYPE html><html class="has-sidebar"><head><title>No</title><style>p{}</style></head><body>
    <!-- no --><header><h1>Site</h1></header><nav>Menu <a href="x>y">a</a></nav><div class="cookie-notice">No <b>no</b></div>
    <main><header><h1>Title &amp; more</h1></header><p>One<br>two <b>th</b>ree<p>Four&nbsp;five &copy; &#x41;
    <script>var t="</p><p>no</p>";</script><form>no <input value=">"> no</form><ul><li>six<li>seven</ul>
    <div id="comments"><p>no</p></div><aside>no</aside><p hidden>no</p>a < b</main><footer>no</footer>"""
    kept = [t for t, kind in page_lines(source) if kind == ARTICLE]
    assert kept == ["Title & more", "One", "two three", "Four five © A", "six", "seven", "a < b"]
    assert not [t for t, kind in page_lines(source) if kind == OPEN]


def test_broken_markup():
    assert page_lines("") == [] and page_lines("   ") == [] and page_lines("plain") == [("plain", OPEN)]
    assert page_lines("<div class=ad>x<article><p>y</article>z") == [("x", CHROME), ("y", ARTICLE), ("z", CHROME)]
    assert page_lines("a</div></p>b<script>c") == [("a", OPEN), ("b", OPEN)]
    assert page_lines("a<!-- b") == [("a", OPEN)] and page_lines("a<p class='x") == [("a", OPEN)]
    assert page_lines("a<p class='x>b</p>c") == [("a", OPEN), ("b", OPEN), ("c", OPEN)]
    assert page_lines('<p class="ad"><a><b><i><u>x<div>y') == [("x", CHROME), ("y", OPEN)]
    assert page_lines('<p class="ad">x<td><div>y') == [("x", CHROME), ("y", CHROME)]
    assert page_lines('<p role="navigation">a</p>b') == [("a", CHROME), ("b", OPEN)]
    deep = "<div>" * 20_000 + "x" + "</div>" * 10_000 + "</span>" * 20_000
    assert page_lines(deep) == [("x", OPEN)]


HOSTILE = {
    "quotes": lambda n: '<a "' * n + "'",
    "hidden ends": lambda n: '<a ">" ' * n + "'",
    "nested": lambda n: "<div>x" * n + "</div>" * n,
    "paragraphs": lambda n: "<p><b>" * n + "<div>" * n,
    "raw": lambda n: "<script>" + "</script " * n,
    "inside": lambda n: "<nav>" + "<p>x<i>" * n + "</nav>",
}


@pytest.mark.parametrize("name", HOSTILE)
def test_time_in_proportion_to_length(name):
    def seconds(n):
        page, took = HOSTILE[name](n), []
        for _ in range(3):
            began = time.perf_counter()
            page_lines(page)
            took.append(time.perf_counter() - began)
        return min(took)

    assert seconds(80_000) < 20 * seconds(10_000) + 0.05


def plain_pages(n=60):
    """Pages without telling markup: lines that every page of a host shares around lines of its own."""
    rows = []
    for k in range(n):
        host = f"h{k % 7 if k % 3 else 0}.net"
        own = [f"story {k} line {x} of {host}" for x in range(4)]
        rest = [f"top of {host}", "same everywhere"], [f"end of {host}"]
        lines = [*rest[0], *own[:2], f"between on {host}", *own[2:], *rest[1]]
        body = "".join(f"<div>{x}</div>" for x in lines)
        rows.append((k, f"http://{host}/{k % 4}/{k}", body, "x", 1, " ".join(own)))
    return rows


def test_lines_shared_with_the_nearest_page_go(spark):
    rows = plain_pages()
    frame = spark.createDataFrame([r[:5] for r in rows], SCHEMA).repartition(5)
    got = {r["page_id"]: r["text"] for r in main_text(frame).collect()}
    assert got == {r[0]: r[5] for r in rows}


def test_copies_are_no_neighbours(spark):
    rows = plain_pages(12)
    copies = [(100 + r[0], r[1] + "?copy", *r[2:]) for r in rows]
    frame = spark.createDataFrame([r[:5] for r in rows + copies], SCHEMA)
    got = {r["page_id"]: r["text"] for r in main_text(frame).collect()}
    # A page whose neighbours are one copy and one other page is settled by the other page.
    for r in rows:
        if "h0.net" in r[1]:
            assert got[r[0]] == got[100 + r[0]] == r[5]


@pytest.mark.parametrize("one_slice", [True, False])
def test_partners_beyond_a_run_of_near_copies(spark, one_slice):
    """Articles of a host in runs of one to nine near copies under neighbouring paths."""
    rows, n = [], 0
    for host in ("a.net", "b.net"):
        for article, copies in enumerate([6, 1, 9, 2, 5, 7]):
            for copy in range(copies):
                own = [f"article {article} of {host}, sentence {x}, as long as they are" for x in range(8)] + [f"copy {copy} of {article}"]
                lines = [f"menu of {host}", *own[:4], "all rights", *own[4:], "end"]
                rows.append((n, f"http://{host}/{article}/{copy}", "".join(f"<div>{x}</div>" for x in lines), "x", 1, " ".join(own)))
                n += 1
    rows += [(n + k, f"http://c.net/{k}", "<div>the only article of this host</div>" + f"<div>{k}</div>", "x", 1, None) for k in range(7)]
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, str(one_slice).lower())
    try:
        got = main_text(spark.createDataFrame([r[:5] for r in rows], SCHEMA).repartition(5), counts=True).collect()
    finally:
        spark.conf.set(name, before)
    text = {r["page_id"]: r["text"] for r in got}
    assert text == {r[0]: r[5] or f"the only article of this host {r[0] - n}" for r in rows}
    assert {(r["n_chrome"], r["n_article"], r["n_shared"], r["n_open"]) for r in got if r["page_id"] < n} == {(0, 0, 3, 9)}


def test_marked_articles_keep_what_they_share(spark):
    body = "<nav>menu</nav><article><p>shared words</p><p>own {}</p></article><div>foot</div>"
    frame = spark.createDataFrame([(k, f"http://a/{k}", body.format(k), "x", 1) for k in range(3)], SCHEMA)
    assert {r["text"] for r in main_text(frame).collect()} == {f"shared words own {k}" for k in range(3)}


def test_odd_pages(spark):
    rows = [
        (1, None, None, "x", 1), (2, "", "", "x", 1), (3, "no host", "<p>alone here</p>", "x", 1), (None, None, "<p>a</p><p>b</p>", "x", 1),
        (4, "http://b.net/1", "<p>t</p>" * 30_000 + "<p>own 4</p>", "x", 1), (5, "http://b.net/2", "<p>t</p>" * 30_000 + "<p>own words 5</p>", "x", 1),
        (6, "http://c.net/1", "<p>same page</p>", "x", 1), (6, "http://c.net/1", "<p>same page</p>", "x", 1), (7, "http://c.net/2", "<p>same page</p>", None, None),
    ]
    frame = spark.createDataFrame(rows, SCHEMA)
    got = main_text(frame).collect()
    assert sorted(((r["page_id"], r["url"]) for r in got), key=repr) == sorted(((r[0], r[1]) for r in rows), key=repr)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == text[2] == "" and text[3] == "alone here" and text[6] == text[7] == "same page" and text[None] == "a b"
    assert main_text(frame.filter("page_id = -1")).collect() == []


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    result = op10_html_text(spark, sf_dir)
    assert result.columns == ["page_id", "url", "text", "n_chars"]
    got = {r["page_id"]: (r["url"], r["text"], r["n_chars"]) for r in result.collect()}
    for p in pages:
        article = re.search(r"<article>(.*)</article>", p["html"], re.S)[1]
        text = " ".join(html.unescape(re.sub(r"</?(?:p|br|h1)>|</?b>", lambda m: "" if "b>" in m[0] else " ", article)).split())
        assert got[p["page_id"]] == (p["url"], text, len(text))
