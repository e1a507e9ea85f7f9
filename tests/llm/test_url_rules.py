import random

from pressledger.llm.queries import QUERIES, URL_RULES
from pressledger.llm.tables import ready
from pressledger.llm.url_rules import judge, rule_table


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def judged(url, rules):
    host, path = parts(url)
    best = None
    for action, rule in rules:
        at = rule.find("/")
        own, start = (rule, "") if at < 0 else (rule[:at], rule[at:])
        if (host == own or host.endswith("." + own)) and path.startswith(start):
            best = max(best or (-1,), (len(own) + len(start), len(own), action == "allow", rule, action))
    return host, path, *((best[3], best[4]) if best else (None, "allow"))


URLS = [None, "", "no scheme", "http://", "HTTP://A.Example.NET/en/x?y", "https://example.net", "https://example.net/en", "https://example.net/en/",
        "http://notexample.net/en/1", "ftp://x.example.com/de/1#t", "http://example.com/de", "http://org/fr/", "http://a.org/fr/?q", "http://a.org?x/fr/",
        "x://y://net/", "http://b.net/" + "p/" * 5000, "http://user@host.net/", "http://É.net/é"]


def test_rules_equal_brute_force(spark):
    ready(spark)
    rng = random.Random(2)
    rules = URL_RULES + [("allow", "net/e"), ("block", "a.b.c"), ("allow", "a.b.c"), ("block", "b.c/x/y"), ("allow", "c/x/y/zz")]
    urls = URLS + [f"http://{'.'.join(rng.choices(['a', 'b', 'c', 'net', 'example', 'org'], k=rng.randint(1, 5)))}/{'/'.join(rng.choices(['x', 'y', 'zz', 'en', 'fr'], k=3))}"
                   for _ in range(300)]
    rows = [(i, u, "h", "clash") for i, u in enumerate(urls)]
    pages = spark.createDataFrame(rows + rows[:3] + [(None, "http://x.net/", "h", "clash")], "page_id long, url string, html string, host string")
    got = judge(pages, rule_table(spark, rules)).collect()
    assert len(got) == len(rows) + 4
    for r in got:
        wanted = judged(urls[r.page_id] if r.page_id is not None else "http://x.net/", rules)
        assert (r.host, r.path, r.rule, r.verdict) == wanted


def test_no_rules_and_no_pages(spark):
    ready(spark)
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    empty = rule_table(spark, URL_RULES).where("false")
    assert [(r.rule, r.verdict) for r in judge(pages, empty).collect()] == [(None, "allow")]
    assert judge(pages.where("false"), rule_table(spark, URL_RULES)).count() == 0


def test_query(spark):
    for r in QUERIES["op9_url_filters"](spark, "/root/testdata/sf0.001").collect():
        assert r.verdict in ("allow", "block") and (r.rule is not None or r.verdict == "allow")
