"""URL filter cascade against a plain search of all rules, by both ways."""

import random

from pyspark.sql import functions as F

from ledgerline.llm import url_filter as U

RULES = U.RULES


def parts(url):
    at = (url or "").find("://")
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    host = rest
    for c in "/?#":
        host = host.split(c)[0]
    path = rest[len(host):].split("?")[0].split("#")[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def brute(url, rules):
    host, path = parts(url)
    best = None
    for rule, verdict in rules:
        rule_host, _, tail = rule.partition("/")
        rule_path = rule[len(rule_host):]
        if (host == rule_host or host.endswith("." + rule_host)) and path.startswith(rule_path):
            if best is None or len(rule) > len(best[0]):
                best = (rule, verdict)
    return (host, path, best[0] if best else None, best[1] if best else "allow")


URLS = [None, "", "no scheme", "http://", "https://EXAMPLE.org/es/1?q#f", "http://a.example.org/en/123",
        "http://example.org/en/2", "http://xorg/", "http://org/", "http://a.com/fr/x", "http://b.com/de/",
        "ftp://c.com?x=/de/", "http://c.com#/de/", "http://com/de/y", "x://y://z.org/", "http://Ünï.ORG/é",
        "http://example.org", "http://ex.org:80/", "http://example.org/es", "http://a.b.c.d.example.org/es/"]


def check(spark, rows, rules):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in rows],
                               "page_id long, url string, host string, rule string")
    r = spark.createDataFrame(rules, "rule string, verdict string")
    for row in U.judge(df, r).collect():
        url = dict(rows)[row.page_id]
        assert tuple(row)[1:] == brute(url, rules), url


def test_contract_rules(spark):
    check(spark, list(enumerate(URLS)), RULES)


def test_many_random_rules(spark):
    r = random.Random(6)
    hosts = [f"{a}{b}.{c}" for a in "abcdefgh" for b in "xyz" for c in ("com", "net", "org")]
    rules = list({f"{r.choice(hosts)}/{r.choice(['', 'a/', 'b/', 'a/c'])}": r.choice(["allow", "block"])
                  for _ in range(150)}.items())
    urls = [(i, f"http://{r.choice(['', 'www.', 'm.n.'])}{r.choice(hosts)}/{r.choice(['', 'a/c/d', 'b/1', 'zz'])}")
            for i in range(2000)]
    check(spark, urls, rules)


def test_way_beyond_the_size_bound(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_FILTER_BYTES", 0)
    check(spark, list(enumerate(URLS)), RULES)


def test_members_are_exact_over_the_universe(spark):
    universe = spark.range(20000).select(F.col("id").cast("string").alias("key"))
    listed = universe.where("key % 37 = 0")
    cascade = U.build(listed, universe, "test")
    assert len(cascade.levels) > 1
    wrong = universe.where(cascade.member(F.col("key")) != (F.col("key") % 37 == 0))
    assert wrong.count() == 0


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(none).count() == 0
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    got = U.judge(df, spark.createDataFrame([], "rule string, verdict string")).first()
    assert (got.rule, got.verdict) == (None, "allow")


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, "http://a.org/")], "page_id long, url string")
    plan = U.judge(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Join" not in plan
