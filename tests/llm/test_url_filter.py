from tablework.llm import url_filter
from tablework.llm.queries import QUERIES, URL_RULES

URLS = [
    "http://www.example.com/en/1?x=/fr/", "https://a.b.example.com/en/", "http://example.com/en", "http://example.com", "http://EXAMPLE.com/en/x#y",
    "http://xexample.com/en/x", "http://x.net/es/1", "http://net/fr/", "http://net/FR/", "http://a.com:80/x", "ftp://u@h.org?q=://b.com/", "://com/", "nothing", "",
    None, "http://" + "a." * 3000 + "com/" + "p/" * 3000, "http://x.org/a\nb://c.com/", "http://a..com/",
]


def plain(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), r[2] == "block", r[0] + r[1]), default=(None, None, "allow"))
    return host, path, best[0] and best[0] + best[1], best[2]


def test_against_plain_rules(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").selectExpr("*", "'x' as host", "'y' as rule_")
    more = [*URL_RULES, ("com", "/p", "block"), ("org", "", "block"), ("org", "", "block"), ("org", "", "allow")]
    for rules in (URL_RULES, more):
        table = spark.createDataFrame(rules, "host string, path string, verdict string")
        found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, table).collect()}
        assert found == {i: plain(u, rules) for i, u in enumerate(URLS)}


def test_no_rules_no_pages_and_all_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.com/"), (1, "http://a.com/")], "page_id long, url string")
    none = spark.createDataFrame([], "host string, path string, verdict string")
    rules = spark.createDataFrame([(None, None, None), ("com", "/", "block")], "host string, path string, verdict string")
    assert [r.verdict for r in url_filter.judge(pages, none).collect()] == ["allow", "allow"]
    assert url_filter.judge(pages.limit(0), rules).count() == 0
    both = url_filter.with_verdicts(pages, rules).collect()
    assert [(r.page_id, r.url, r.rule, r.verdict) for r in both] == [(1, "http://a.com/", "com/", "block")] * 2


def test_no_python_in_the_plan(spark, plan):
    text = plan(QUERIES["op8_url_filter"](spark, "/root/testdata/sf0.001"))
    assert "Python" not in text and "Arrow" not in text
