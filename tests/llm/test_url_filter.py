import random
from collections import Counter

from newsflow.llm.url_filter import url_verdicts

URLS = ["http://example.org/es/1", "https://A.Example.ORG/es/", "http://www.example.org/en/12#x", "http://notexample.org/es/",
        "http://org/", "http://org", "http://x.com/de/a?b", "http://com/fr/", "ftp://y.com/fr", "no scheme", "", None,
        "://host/path", "http://a.b.c.example.org/en/1", "http://example.org?es/", "http://example.org/ES/", "a://b://c/d",
        "http://x.net/", "http://é.org/ü", "http://x.com/de/" + "p" * 5000, "http://multi\nline.org/a\nb?c"]


def brute(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:at]), rest[at:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [(-len(h + p), h + p, v) for h, p, v in rules
            if host and (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *(min(fits)[1:] if fits else (None, default)))


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "host?", "rule?", "verdict?") for i, u in enumerate(urls)],
                                  "page_id long, url string, host string, rule string, verdict string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_verdicts(pages, table).collect()}
    assert got == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_rules_of_the_query(spark):
    from newsflow.llm.queries import URL_RULES
    check(spark, URLS + [URLS[0]] * 50, URL_RULES)


def test_random_nested_rules(spark):
    rng = random.Random(3)
    labels, hosts = ["a", "b", "c", "org"], set()
    while len(hosts) < 12:
        hosts.add(".".join(rng.choice(labels) for _ in range(rng.randint(1, 4))))
    paths = ["", "/", "/a", "/a/", "/ab", "/a/b", "/b"]
    rules = sorted({(h, p): (h, p, rng.choice(["allow", "block"])) for h in hosts for p in rng.sample(paths, 3)}.values())
    urls = [f"http://{'.'.join(rng.choice(labels) for _ in range(rng.randint(1, 5)))}"
            f"{''.join(rng.choice(['/', 'a', 'b']) for _ in range(rng.randint(0, 4)))}" for _ in range(400)]
    check(spark, urls, rules)


def test_empty_tables(spark):
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    got = url_verdicts(pages, rules).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in got] == [("a.org", "/", None, "allow")]
    assert url_verdicts(pages.limit(0), rules).count() == 0


def test_repeated_pages_stay(spark):
    rules = spark.createDataFrame([("org", "/", "block")], "host string, path string, verdict string")
    pages = spark.createDataFrame([(None, "http://a.org/"), (None, "http://a.org/"), (1, None)], "page_id long, url string")
    got = Counter((r.page_id, r.verdict) for r in url_verdicts(pages, rules).collect())
    assert got == {(None, "block"): 2, (1, "allow"): 1}
