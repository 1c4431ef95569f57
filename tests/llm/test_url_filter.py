import re

import pytest

from clustertrace.llm.queries import URL_RULES, op4_url_filter
from clustertrace.llm.url_filter import judge_urls

URLS = [
    None, "", "no scheme", "://", "http://", "http://EXAMPLE.net", "http://example.net/", "http://example.net/en/x",
    "http://a.b.example.net/en/x?q=/de/#f", "https://example.com/de/", "https://m.Example.com/de/1", "https://example.com/den",
    "http://notexample.com/de/x", "http://example.com:80/de/x", "http://example.org/fr/1", "http://org/fr/", "ftp://x.net?/en/",
    "http://net/\n/x", "a://b.net/://c.org/fr/", "http://example.net/en", "http://x..net/y", "http://.net/y",
    "http://example.org/" + "fr/" * 5000, "http://example.org/fr/" * 3,
]
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def brute(url, rules, default="allow"):
    found = re.search(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
    host, path = ("", "") if found is None else found.groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fitting = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fitting, key=lambda r: (len(r[0] + r[1]), len(r[0]), r[2] == "block"), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


@pytest.mark.parametrize("limit", [100, 0], ids=["broadcast", "shuffled"])
def test_odd_urls(spark, limit):
    extra = [("b.org", "/fr/", "block"), ("b.org", "/fr/", "allow"), ("org", "", "block"), ("example.org", "/f", "block")]
    rules = RULES + extra
    rows = [(k, u, "h", 1) for k, u in enumerate(URLS)] + [(None, URLS[8], "h", 1), (3, URLS[3], "h", 2)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string, rule int")
    table = spark.createDataFrame(rules + [(None, "/", "block"), ("", "/", "block"), ("x", None, "block")], "host string, path string, verdict string")
    got = judge_urls(pages, table, broadcast_rules=limit).select("page_id", "url", "host", "path", "rule", "verdict")
    expected = [(k, u, *brute(u, rules)) for k, u, *_ in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected, key=repr)


def test_without_pages_or_rules(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id bigint, url string")
    rules = spark.sql(URL_RULES)
    assert judge_urls(pages.filter("page_id = 2"), rules).collect() == []
    [row] = judge_urls(pages, rules.filter("host = 'none'"), default="block").collect()
    assert (row["rule"], row["verdict"]) == (None, "block")


def test_pages(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").collect()
    got = {r["page_id"]: tuple(r)[1:] for r in op4_url_filter(spark, sf_dir).collect()}
    assert got == {p["page_id"]: brute(p["url"], RULES) for p in pages}


def test_hosts_of_many_labels(spark):
    """Only suffixes of as many labels as some rule has are built, whatever the host's length."""
    host = "a." * 100_000 + "b.net"
    rows = [(1, f"http://{host}/en/x"), (2, f"http://{'.' * 50_000}/"), (3, "http://b.net.:80/")]
    rules = [("b.net", "/en/", "block"), ("net", "/", "allow"), ("a.a.b.net", "/en/x", "block")]
    frame = spark.createDataFrame(rows, "page_id int, url string")
    got = judge_urls(frame, spark.createDataFrame(rules, "host string, path string, verdict string"))
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in got.select("page_id", "rule", "verdict").collect()}
    assert found == {1: ("a.a.b.net/en/x", "block"), 2: (None, "allow"), 3: (None, "allow")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
