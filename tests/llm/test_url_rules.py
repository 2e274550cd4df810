from __future__ import annotations

import re

from trafficlens.llm import url_rules


def brute(url):
    host = path = ""
    if url and "://" in url:
        host, path = re.match(r"([^/?#]*)([^?#]*)", url.split("://", 1)[1]).groups()
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for verdict, rule in url_rules.LISTED:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    if fits:
        return host, path, *max(fits)[1:]
    blocked = any(re.search(p, (url or "").lower()) for _, p in url_rules.PATTERNS)
    return host, path, None, "block" if blocked else "allow"


URLS = [
    None, "", "no scheme", "://", "http://", "http://org", "http://org/", "http://ORG/x", "http://a.Org/login", "https://xorg/",
    "http://example.org/en/17", "http://example.org/en/2", "http://a.b.example.org/es/", "http://example.org/es", "http://EXAMPLE.org/ES/x",
    "http://notexample.org/es/x", "http://shop.com/fr/1", "http://shop.com/de/1?x=://y", "http://shop.com?/de/", "http://shop.com#/fr/",
    "http://com/de/", "http://a.com/login", "http://a.net/login?x=1", "http://a.net/wp-admin/", "http://a.net/search?a=1&q=2",
    "http://a.net/search?a=1#q=2", "http://my-casino.net/", "http://mycasino.net/", "http://a.net/cart.html", "http://a.net/carte",
    "http://u:p@org:80/x", "http://é.org/ü", "http://a.com/fr/\nx", "http://a.com/" + "de/" * 20_000, "ftp://x.example.org/en/1/../",
]


def judged(df):
    return sorted((tuple(r[c] for c in ("url", "host", "path", "rule", "verdict")) for r in url_rules.judge(df).collect()), key=repr)


def test_equals_brute_force(spark):
    urls = URLS + URLS[5:9]
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string").repartition(3)
    assert judged(df) == sorted([(u, *brute(u)) for u in urls], key=repr)


def test_other_columns_and_names(spark):
    df = spark.createDataFrame([(1, "http://org/x", "q", "mine")], "page_id long, address string, verdict string, url string")
    row = url_rules.judge(df, "address").first()
    assert (row["verdict"], row["rule"], row["url"]) == ("allow", "org/", "mine")
    kept = url_rules.judge(df.withColumnRenamed("address", "host"), "host")
    assert kept.count() == 1


def test_rules_are_fetched_by_their_rarest_token():
    rule = url_rules.listed_rule("block", "example.org/en/1")
    assert set(rule.tokens) == {"example", "org", "en"}
    index, width = url_rules.rule_index([rule], {"example": 5, "org": 9, "en": 2})
    assert width >= 16 and "en" in index._jc.toString() if hasattr(index, "_jc") else True


def test_rule_without_tokens_is_tried_on_all(spark):
    rules = [url_rules.Rule("any digit", "block", r"[0-9]", False)]
    df = spark.createDataFrame([("http://a/1",), ("http://a/b",)], "url string")
    assert {r["url"]: r["verdict"] for r in url_rules.judge(df, rules=rules).collect()} == {"http://a/1": "block", "http://a/b": "allow"}


def test_many_rules(spark):
    rules = [url_rules.listed_rule("block", f"site{k}.net/p{k}/") for k in range(800)]
    df = spark.range(800).selectExpr("concat('http://www.site', id, '.net/p', id, '/x') AS url").union(spark.createDataFrame([("http://site5.net/p6/",)], "url string"))
    got = url_rules.judge(df, rules=rules).groupBy("verdict").count().collect()
    assert {r["verdict"]: r["count"] for r in got} == {"block": 800, "allow": 1}


def test_empty_table(spark):
    assert url_rules.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
