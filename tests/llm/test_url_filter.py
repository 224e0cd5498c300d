"""URL rules against plain Python, and the cascade against sets."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tripfold.llm import url_filter
from tripfold.llm.queries import URL_RULES

PAGE = "page_id bigint, url string, html string"


def plain(url, rules):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        ends = [i for i, c in enumerate(rest) if c in "/?#"] + [len(rest)]
        host, after = rest[: ends[0]], rest[ends[0] :]
        ends = [i for i, c in enumerate(after) if c in "?#"] + [len(after)]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = after[: ends[0]]
    fitting = [
        (len(h + p), len(h), h + p, verdict == "block")
        for h, p, verdict in rules
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fitting:
        return host, path, None, "allow"
    _, _, rule, block = max(fitting)
    return host, path, rule, "block" if block else "allow"


def check(spark, urls, rules):
    pages = spark.createDataFrame([(i, url, None) for i, url in enumerate(urls)], PAGE)
    for name in ("host", "path", "rule", "verdict", "key", "block", "best", "Block_No", "allow"):
        pages = pages.withColumn(name, F.lit("x"))
    judged = url_filter.judge(pages, url_filter.rule_frame(spark, rules))
    assert judged.columns == ["page_id", "host", "path", "rule", "verdict"]
    found = {r.page_id: tuple(r)[1:] for r in judged.collect()}
    assert found == {i: plain(url, rules) for i, url in enumerate(urls)}


URLS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "http://example.org",
    "http://example.org/",
    "HTTP://WWW.EXAMPLE.ORG/es/1?x#y",
    "https://a.b.example.org/en/1",
    "https://a.b.example.org/en/12",
    "https://a.b.example.org/en/21",
    "https://notexample.org/es/1",
    "https://example.org?/es/",
    "https://example.org#/es/",
    "https://example.com/fr/x",
    "https://example.com/FR/x",
    "https://com/de/x",
    "https://.com/de/x",
    "https://com./de/x",
    "https://x..com/de/x",
    "https://example.com:80/de/x",
    "https://user@example.com/de/x://y.org/",
    "https://exämple.com/fr/ü",
    "https://EXÄMPLE.com/fr/ü\nnext?line",
    "https://" + "a." * 3000 + "com/de/" + "p" * 50_000,
    "https://example.net/fr/1",
    "https://example.net/fr/1",
]


def test_rules_of_the_query(spark):
    check(spark, URLS, URL_RULES)


def test_ties_both_verdicts_and_rules_without_a_path(spark):
    rules = [
        ("b.org", "/", "allow"),
        ("org", "/xx", "block"),  # as long as the one above
        ("c.org", "", "block"),
        ("d.org", "/", "allow"),
        ("d.org", "/", "block"),
        ("Upper.ORG", "/A", "block"),
    ]
    rules_lowered = [(h.lower(), p, v) for h, p, v in rules]
    urls = ["h://b.org/xx", "h://c.org", "h://x.c.org?q", "h://d.org/1", "h://upper.org/A", "h://upper.org/a"]
    pages = spark.createDataFrame([(i, url, None) for i, url in enumerate(urls)], PAGE)
    judged = url_filter.judge(pages, url_filter.rule_frame(spark, rules))
    assert {r.page_id: tuple(r)[1:] for r in judged.collect()} == {
        i: plain(url, rules_lowered) for i, url in enumerate(urls)
    }


@pytest.mark.parametrize("keys_per_block, blocks_per_pass", [(1_000_000, 8), (60, 2)])
def test_many_rules_in_blocks(spark, monkeypatch, keys_per_block, blocks_per_pass):
    monkeypatch.setattr(url_filter, "KEYS_PER_BLOCK", keys_per_block)
    monkeypatch.setattr(url_filter, "BLOCKS_PER_PASS", blocks_per_pass)
    rng = random.Random(5)
    hosts = [f"{a}.h{i}.{t}" for i in range(60) for t in ("com", "org") for a in ("www", "a.b")]
    rules = []
    for host in rng.sample(hosts, 150):
        cut = rng.choice([host, host.split(".", 1)[1]])
        rules.append((cut, rng.choice(["/", "/a", "/ab/", ""]), rng.choice(["allow", "block"])))
    rules = [rule for rule in rules if (rule[0], rule[1]) not in [(r[0], r[1]) for r in rules if r[2] != rule[2]]]
    urls = [f"http://{rng.choice(hosts)}{rng.choice(['', '/', '/a', '/ab/c', '/b'])}" for _ in range(600)]
    check(spark, urls, rules)


def test_no_rules_and_no_pages(spark):
    check(spark, URLS[:8], [])
    check(spark, [], URL_RULES)


def test_a_cascade_is_exact_where_one_filter_errs(spark):
    keys = spark.range(20_000).select(
        F.concat(F.lit("key"), "id").alias("key"), (F.col("id") % 20 == 0).alias("listed")
    )
    cascade = url_filter.cascade_of(keys)
    first = cascade.levels[0].may_contain(F.col("key"))
    row = keys.agg(
        F.count_if(first & ~F.col("listed")).alias("erring"),
        F.count_if(cascade.contains(F.col("key")) != F.col("listed")).alias("wrong"),
    ).first()
    assert len(cascade.levels) > 2 and row.erring > 0 and row.wrong == 0
    assert all(len(level.bits) <= 1000 * url_filter.BITS_PER_KEY // 8 + 8 for level in cascade.levels)


def test_no_join_no_shuffle_and_no_python_when_judging(spark):
    pages = spark.createDataFrame([(1, URLS[7], None)], PAGE)
    judged = url_filter.judge(pages.select("page_id", "url"), url_filter.rule_frame(spark, URL_RULES))
    plan = judged._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Join", "Exchange", "Python", "Arrow", "Pandas"))
