import random

import pytest

from numprep.llm.url_filter import judge, rule_table

RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
    ("EXAMPLE.com", "/de/x", "allow"),
    ("a.example.com", "/de", "block"),
    ("a.example.com", "/de", "allow"),
    ("com", "", "allow"),
    (None, "/", "block"),
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, rest = rest[:end], rest[end:]
    end = min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), rest[:end]


def brute(url, rules):
    host, path = parts(url)
    best = None
    for rule_host, rule_path, verdict in rules:
        if rule_host is None:
            continue
        rule_host = rule_host.lower()
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            rank = (len(rule_host) + len(rule_path), len(rule_host), rule_host + rule_path, verdict)
            best = rank if best is None else max(best, rank)
    return (host, path, best[2], best[3]) if best else (host, path, None, "allow")


URLS = [None, "", "x", "://", "a://net", "http://net/", "http://NET/x?y#z", "http://a.net", "http://anet/", "http://x.example.net/en",
    "http://example.net/en/", "http://example.net//en/", "http://example.com/de/xy", "http://a.example.com/dex/1", "http://org/fr/#",
    "http://org:80/fr/", "http://b.org/fr/?://net/", "net://org/fr/a/b/c", "http://é.net/é", "http://a.example.com?/de/",
    "http://" + "a." * 2000 + "net/" + "x/" * 2000, "http://a\n.net/b", "http://.net/", "http://net./"]


@pytest.mark.parametrize("rules", [RULES, RULES[:4], [("net", "/", "block")], []])
def test_against_brute_force(spark, rules):
    draw = random.Random(3)
    hosts, paths = ["net", "example.net", "a.example.com", "x.org", "org", "com"], ["", "/", "/en/", "/de", "/de/", "/de/x/y", "/fr/"]
    urls = URLS + [f"http://{draw.choice(hosts)}{draw.choice(paths)}{draw.choice(['', '?q', '#f', 'z'])}" for _ in range(300)]
    pages = spark.createDataFrame(list(enumerate(urls)) + [(5, urls[5])], "page_id long, url string")
    got = judge(pages, rule_table(spark, rules)).collect()
    assert len(got) == len(urls) + 1
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == brute(r.url, rules), r.url


def test_clashing_columns_and_empty_table(spark):
    pages = spark.createDataFrame([(1, "http://net/", "x", "y", "z")], "page_id long, url string, host string, best string, rule_host string")
    got = judge(pages, rule_table(spark, RULES)).collect()
    assert [(r.host, r.best, r.rule_host, r.rule) for r in got] == [("net", "y", "z", "net/")]
    assert judge(pages.limit(0), rule_table(spark, RULES)).collect() == []


def test_native_plan(spark):
    pages = spark.createDataFrame([(1, "http://net/")], "page_id long, url string")
    plan = judge(pages, rule_table(spark, RULES))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
