import re

import pytest

from tillwright.llm.url_filters import RULES, Rule, filter_urls, rule_index

URLS = [
    None, "", "no scheme", "http://", "http://EXAMPLE.com", "http://example.com/", "https://www.example.com/en/x?q=/es/",
    "https://a.www.example.com/en/", "https://example.com/en/1", "https://example.com/EN/1", "http://x.net/es/1",
    "http://net/fr/", "http://xnet/fr/", "http://a.net/en", "http://a.net/fr#x", "http://b.com?x=/en/", "x://y://z.com/q",
    "http://example.com:80/en/", "http://münchen.com/en/", "http://example.com/en/1", "//example.com/en/",
]


def brute(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"(?:/[^?#]*)?", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = [
        r for r in rules
        if (host == r.host or host.endswith("." + r.host))
        and re.match("(?s)" + ".*".join(map(re.escape, r.path.split("*"))), path)
    ]
    best = max(fits, key=lambda r: (len(r.text), len(r.host), r.verdict, r.text), default=None)
    return host, path, best and best.text, best.verdict if best else "allow"


def pages(spark, urls):
    return spark.createDataFrame(
        [(i, u, "<p>", "clash", 5) for i, u in enumerate(urls)],
        "page_id long, url string, html string, rule string, _best int",
    )


@pytest.mark.parametrize("inline", [0, 100])
@pytest.mark.parametrize("rules", [
    RULES, (), (Rule("com", "/", "block"), Rule("com", "/", "allow")),
    (Rule("example.com", "/e*/1", "block"), Rule("net", "", "block"), Rule("b.com", "", "block")),
])
def test_every_url_gets_the_longest_rule(spark, inline, rules):
    found = filter_urls(pages(spark, URLS), rules, inline_rules=inline).orderBy("page_id").collect()
    expected = [(i, *brute(u, rules)) for i, u in enumerate(URLS)]
    if any(not r.path for r in rules):  # a rule without a path fits any path
        assert [r["verdict"] for r in found] == [e[4] for e in expected]
    assert [tuple(r) for r in found] == expected


def test_empty_and_repeated_rows(spark):
    empty = pages(spark, URLS).limit(0)
    assert filter_urls(empty).count() == 0
    twice = pages(spark, ["http://a.com/"]).union(pages(spark, ["http://a.com/"]))
    assert [r["rule"] for r in filter_urls(twice, inline_rules=0).collect()] == ["com/", "com/"]


def test_rules_are_indexed_by_their_rarest_token():
    index = rule_index(RULES)
    assert {token: [r["rule"] for r in rules] for token, rules in index.items()} == {
        "com": ["com/"], "example": ["example.com/en/"], "www": ["www.example.com/en/"],
        "es": ["net/es/"], "fr": ["net/fr/"],
    }
    assert list(rule_index([Rule("com", "/a*", "block"), Rule("com", "/b", "block")])) == ["com"]
