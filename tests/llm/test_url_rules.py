import random

import pytest

from ordermill.llm import url_rules as U

RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
         ("a.b.c", "", "block"), ("b.c", "/x", "allow"), ("c", "/x/y", "block"), ("dup.net", "/", "allow"), ("dup.net", "/", "block"),
         ("", "/local", "block"), ("wrong.com", "no-slash", "block"), ("wrong.com", "/q?x", "block"), ("wrong.com", "/", "hide"), ("UPPER.Net", "/A", "block")]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] + [len(rest)])
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path] + [len(path)])]


def verdict(url, rules, default):
    host, path = parts(url)
    fitting = []
    for own, start, judged in rules:
        own, start = (own or "").lower(), start or ""
        usable = judged in ("allow", "block") and (not start or start[0] == "/") and not set("?#") & set(start) and not set("/?#") & set(own)
        if usable and (host == own or own and host.endswith("." + own)) and path.startswith(start):
            fitting.append((len(own) + len(start), len(own), own + start, judged))
    best = max(fitting, default=None)
    return (host, path, best[2] if best else None, best[3] if best else default)


def some_urls():
    rng = random.Random(2)
    hosts = ["example.org", "m.example.org", "notexample.org", "x.com", "com", "a.b.c", "z.a.b.c", "b.c", "q.b.c", "c", "dup.net", "www.DUP.net", "upper.net",
             "wrong.com", "x.com:80", "user@example.org", "", "org", "example.org.", "..", "日本.org"]
    paths = ["", "/", "/es/", "/es", "/en/1", "/en/12.html", "/en/2", "/fr/a", "/de/", "/x", "/x/y", "/x/yz", "/local/1", "/A", "/a", "no-slash", "/q", "/é"]
    urls = [rng.choice(["http://", "https://", "", "x://y://"]) + rng.choice(hosts) + rng.choice(paths) + rng.choice(["", "?a=1", "#top", "?u=http://x.com/fr/", "\n"]) for _ in range(1500)]
    return [(i, u) for i, u in enumerate(urls)] + [(3, urls[3]), (None, urls[4]), (9001, None), (9002, ""), (9003, "://"), (9004, "http://" + "a." * 30000 + "org/" + "p" * 200000)]


@pytest.mark.parametrize("sent", [U.BROADCAST_BYTES, 0])
@pytest.mark.parametrize("default", ["allow", "block"])
def test_verdicts_are_those_of_brute_force(spark, monkeypatch, sent, default, rows):
    monkeypatch.setattr(U, "BROADCAST_BYTES", sent)
    urls = some_urls()
    pages = spark.createDataFrame([(*u, "x", 1, "b") for u in urls], "page_id long, url string, rule string, `_row` int, verdict string").repartition(5)
    rules = spark.createDataFrame([*RULES, (None, None, None)], "host string, path string, verdict string")
    found = U.judge_urls(pages, rules, default)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert rows(found) == sorted(((i, *verdict(u, RULES, default)) for i, u in urls), key=repr)


def test_digests_decide_when_short_prefixes_collide(spark, monkeypatch, rows):
    monkeypatch.setattr(U, "SHORT", 1)
    urls = some_urls()
    pages = spark.createDataFrame(urls, "page_id long, url string")
    found = U.judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))
    assert rows(found) == sorted(((i, *verdict(u, RULES, "allow")) for i, u in urls), key=repr)


def test_empty_tables(spark):
    pages, rules = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string"), spark.createDataFrame(RULES, "host string, path string, verdict string")
    assert U.judge_urls(pages.limit(0), rules).count() == 0
    assert [tuple(r) for r in U.judge_urls(pages, rules.limit(0), "block").collect()] == [(1, "a.org", "/", None, "block")]


def test_one_row_for_each_url_is_shuffled(spark):
    pages = spark.range(1000).selectExpr("id AS page_id", "'http://one.example.org/en/12' AS url")
    found = U.judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") <= 2 and "BroadcastHashJoin" in plan  # the rows once; the rules, to have each once
    assert found.groupBy("rule", "verdict").count().collect()[0]["count"] == 1000
