import re
import time

import pytest

from monthmill.llm import urls

ODD = [None, "", "no scheme", "http://", "://x", "HTTP://WWW.Example.COM/en/?x://y", "http://example.com", "http://com/", "ftp://a.net/es",
       "http://a.net/es/#f", "http://xnet/es/", "http://net/fr/x", "http://www.example.com?q/en/", "http://a..com//", "http://example.com:80/en/"]


def expected(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    best = None
    for verdict, h, p in rules:
        if (host == h or host.endswith("." + h)) and path.startswith(p) and (best is None or len(h + p) > len(best[1])):
            best = (verdict, h + p)
    return host, path, best[1] if best else None, best[0] if best else "allow"


def rows(found):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}


def test_rules_on_pages_and_odd_urls(spark, space, given):
    odd = spark.createDataFrame(list(enumerate(ODD, 10**6)), "page_id bigint, url string")
    pages = given("pages").select("page_id", "url").unionByName(odd)
    wanted = {r.page_id: expected(r.url, urls.RULES) for r in pages.collect()}
    assert rows(urls.judge(pages, urls.rule_table(spark), space)) == wanted
    # the way for rule tables of any size
    assert rows(urls.judge(pages, urls.rule_table(spark), space, broadcast_rules=0)) == wanted


def test_rules_without_final_slash(spark, space):
    rules = [("block", "a.com", "/x/se"), ("allow", "a.com", "/x/"), ("block", "com", "")]
    pages = spark.createDataFrame(
        [(1, "http://a.com/x/secret"), (2, "http://a.com/x/so"), (3, "http://b.com"), (4, "http://b.org/"), (4, "http://b.org/")],
        "page_id bigint, url string")
    found = urls.judge(pages, urls.rule_table(spark, rules), space)
    assert rows(found) == {r.page_id: expected(r.url, rules) for r in pages.collect()}
    assert found.count() == 5


def test_empty_tables(spark, space):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert urls.judge(pages, urls.rule_table(spark), space).count() == 0
    some = spark.createDataFrame([(1, "http://a.com/")], "page_id bigint, url string")
    none = spark.createDataFrame([], "verdict string, host string, path string")
    assert rows(urls.judge(some, none, space)) == {1: ("a.com", "/", None, "allow")}


def test_columns_of_any_name_are_carried(spark, space):
    names = ["_piece", "_turn", "_pieces", "_u_rows", "_u_host", "_u_best", "_u_page", "a.b", "_s_mark"]
    schema = "page_id bigint, url string, HOST string, " + ", ".join(f"`{n}` int" for n in names)
    pages = spark.createDataFrame([(1, "http://a.net/es/", "h", *range(9)), (2, None, None, *[None] * 9)], schema)
    for limit in (urls.BROADCAST_RULES, 0):
        found = urls.judge(pages, urls.rule_table(spark), space, broadcast_rules=limit)
        assert found.columns == ["page_id", "url", *names, "host", "path", "rule", "verdict"]
        got = {r.page_id: r for r in found.collect()}
        assert [got[1][n] for n in names] == list(range(9)) and got[1].rule == "net/es/" and got[2].host == ""


@pytest.mark.parametrize("limit", [urls.BROADCAST_RULES, 0])
def test_long_urls_cost_their_length(spark, space, limit):
    long = ["http://" + "a." * 100_000 + "net/es/" + "b/" * 100_000, "http://www.example.com/en/" + "/" * 200_000]
    pages = spark.createDataFrame(list(enumerate(long)), "page_id bigint, url string")
    warm = spark.createDataFrame([(0, "http://a.net/es/")], "page_id bigint, url string")
    took = []
    for table in (warm, pages):
        started = time.time()
        found = urls.judge(table, urls.rule_table(spark), space, broadcast_rules=limit)
        rules = {r.page_id: r.rule for r in found.select("page_id", "rule").collect()}
        took.append(time.time() - started)
    assert rules == {0: "net/es/", 1: "www.example.com/en/"}
    assert took[1] < took[0] + 5
