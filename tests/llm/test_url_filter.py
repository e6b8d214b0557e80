"""Operator 8: against a plain loop over all rules; key collisions; edge cases."""

import numpy as np
import pytest

from relaysql.llm import url_filter as u

RULES = u.RULES + [("b.org/x", "block"), ("a.b.org/", "allow"), ("Org/xy", "allow"), ("b.org/x", "allow"), (None, "block"), ("", "allow")]
URLS = [None, "", "no scheme", "http://", "http://example.com", "http://example.com/en", "HTTP://EXAMPLE.com/en/x?q",
        "http://www.example.com/en/1", "http://sub.www.example.com/en/1#f", "http://x.net/es/?a", "http://xnet/es/",
        "http://net/fr/1", "https://b.org/x", "https://a.b.org/xy", "https://c.org/xyz", "ftp://spam-farm.example.org/",
        "http://www.spam-farm.example.org/a", "http://notspam-farm.example.org/a", "a://b://com/", "http://com/#/",
        "http://adult-x.example.com/de/", "http://adult-x.example.com?x", "http://example.com/" + "e" * 50000, "http://a..com/"]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, rest = rest[:cut].lower(), rest[cut:]
    path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = []
    for rule, verdict in RULES:
        if rule:
            h, p = rule.split("/", 1)
            h = h.lower()
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append((len(rule), len(h), verdict, h + "/" + p))
    if fits:
        return host, path, max(fits)[3], max(fits)[2]
    bad = any(host == b or host.endswith("." + b) for b in u.BLOCKED_HOSTS)
    return host, path, None, "block" if bad else "allow"


# one array, several in one pass, and several passes
@pytest.mark.parametrize("limit,step", [(u.BLOCK_BYTES, u.STEP_BYTES), (120, u.STEP_BYTES), (120, 300)])
def test_against_brute_force(spark, limit, step):
    pages = spark.createDataFrame([(i, x, "clash", "k") for i, x in enumerate(URLS)],
                                  "page_id bigint, url string, rule string, kind string")
    rules = spark.createDataFrame(RULES, "rule string, verdict string")
    hosts = spark.createDataFrame([(h,) for h in u.BLOCKED_HOSTS] + [(None,)], "host string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in
           u.judge_urls(pages, rules, hosts, block_bytes=limit, step_bytes=step).collect()}
    assert got == {i: brute(x) for i, x in enumerate(URLS)}


def test_colliding_keys_are_told_apart():
    array = u.DigestArray([("a", u.ALLOW), ("b", u.BLOCK)])
    mapped = u.MappedArray(array.image, array.n)
    key = mapped.keys[0]
    mapped.keys = np.array([key, key], np.uint64)            # both strings under one key
    found = mapped.find([b"a", b"b", b"c"], np.array([key] * 3, np.uint64))
    assert list(found) == [u.ALLOW, u.BLOCK, -1]


def test_empty_tables_and_repeated_rows(spark):
    rules = spark.createDataFrame([], "rule string, verdict string")
    hosts = spark.createDataFrame([], "host string")
    pages = spark.createDataFrame([(1, "http://x/"), (1, "http://x/"), (None, None)], "page_id bigint, url string")
    assert [r.verdict for r in u.judge_urls(pages, rules, hosts).collect()] == ["allow"] * 3
    assert u.judge_urls(pages.limit(0), rules, hosts).count() == 0


def test_a_long_list_takes_one_pass(spark):
    n = 200_000
    hosts = spark.range(n).selectExpr("concat('host', id, '.example.org') AS host")
    rules = spark.createDataFrame(u.RULES, "rule string, verdict string")
    pages = spark.range(0, 2 * n, 1000).selectExpr("id AS page_id", "concat('http://a.host', id, '.example.org/x') AS url")
    got = u.judge_urls(pages, rules, hosts, block_bytes=1 << 20)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    assert {r.page_id for r in got.collect() if r.verdict == "block"} == set(range(0, n, 1000))
