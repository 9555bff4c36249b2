import random

import pytest

from lagloom.llm.queries import ORACLES, op12_url_filters
from lagloom.llm.url_rules import MAX_RULE_PATH, judge_urls

RULES = "host string, path string, verdict string"


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute(url, rules, default="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = lower(rest[:cut])
        end = min([rest.find(c, cut) for c in "?#" if rest.find(c, cut) >= 0], default=len(rest))
        path = rest[cut:end]
    best = (-1, -1, "", None)
    for rule_host, rule_path, verdict in rules:
        rule_host, rule_path = lower(rule_host or ""), rule_path or ""
        if verdict is None or any(c in rule_host for c in "/?#"):
            continue
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            best = max(best, (len(rule_host + rule_path), len(rule_host), verdict, rule_host + rule_path))
    return host, path, best[3], best[2] or default


def judged(spark, urls, rules, **kinds):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").selectExpr("*", "'x' as host", "1 as _short", "2 as rule")
    rows = judge_urls(pages, spark.createDataFrame(rules, RULES), **kinds).collect()
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in rows}


def test_random_urls_agree_with_every_rule_tried(spark):
    pick = random.Random(3)
    names, parts = ["com", "b", "example", "www", "", "É", "x:80", "A"], ["en", "e", "", "fr", "é", "long segment", "en.html", "."]

    def host():
        return ".".join(pick.choice(names) for _ in range(pick.randint(1, 5)))

    def path():
        return "".join("/" + pick.choice(parts) for _ in range(pick.randint(0, 4)))

    urls = [None, "", "no scheme/en/", "://", "http://", "http://com", "http://com?/en/", "HTTP://WWW.Example.COM/en/#x", "a://b://c/d"]
    urls += ["http://" + "a." * 3000 + "com/" + "en/" * 3000, "http://com/" + "x" * 100_000, "http://com\n/en/"]
    urls += [pick.choice(["http://", "x://", "//"]) + host() + path() + pick.choice(["", "?q=/en/", "#/fr/"]) for _ in range(600)]
    rules = [(host(), path() + pick.choice(["", "/", "/e"]), pick.choice(["allow", "block"])) for _ in range(120)]
    rules += [(None, "/en/", "block"), ("com", None, "allow"), ("com", "/", None), ("a/b", "", "block"), rules[0], (*rules[1][:2], "block")]
    found = judged(spark, urls, rules)
    assert len(found) == len(urls)
    for i, url in enumerate(urls):
        assert found[i] == brute(url, rules), url
    assert sum(rule is not None for _, _, rule, _ in found.values()) > 100


def test_edge_tables(spark):
    assert judged(spark, ["http://a.com/", None], []) == {0: ("a.com", "/", None, "allow"), 1: ("", "", None, "allow")}
    assert judged(spark, ["http://a.com/"], [], default="block")[0][3] == "block"
    assert judged(spark, [], [("com", "/", "allow")]) == {}
    twice = spark.createDataFrame([(None, "http://com/"), (None, "http://com/"), (3, "http://com/")], "page_id long, url string")
    rows = judge_urls(twice, spark.createDataFrame([("com", "/", "block")], RULES)).collect()
    assert [tuple(r) for r in sorted(rows, key=lambda r: r.page_id or 0)] == [(i, "com", "/", "com/", "block") for i in (None, None, 3)]
    with pytest.raises(ValueError, match="more than"):
        judged(spark, ["http://com/"], [("com", "/" * (MAX_RULE_PATH + 1), "block")])


def test_plan_is_native(spark, capsys):
    op12_url_filters(spark, "/root/testdata/sf0.001").explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    assert "ReadSchema: struct<page_id:bigint,url:string>" in plan


def test_query_agrees_with_sql(spark, agrees):
    agrees("op12_url_filters", op12_url_filters, ORACLES)
