"""Url rules against a plain scan of all rules, and the query against its SQL."""

from __future__ import annotations

import random

import duckdb
import pytest

from chartweave.llm.url_query import OP11_SQL, op11_url_rules
from chartweave.llm.url_rules import LOWER, UPPER, judge_urls

DATA = "/root/testdata/sf0.001"
RULES = "host STRING, path STRING, verdict STRING"
ASCII_LOWER = str.maketrans(UPPER, LOWER)


def cut(text: str, marks: str) -> int:
    return min([text.find(m) for m in marks if m in text], default=len(text))


def judged(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host, path = rest[: cut(rest, "/?#")].translate(ASCII_LOWER), rest[cut(rest, "/?#") :]
        path = path[: cut(path, "?#")]
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in ((h.translate(ASCII_LOWER), p or "", v) for h, p, v in rules if h is not None and v)
        if (host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    if not fits:
        return host, path, None, default
    longest = max(f[:3] for f in fits)
    return host, path, longest[2], min(f[3] for f in fits if f[:3] == longest)


def compare(spark, urls, rules, **options):
    pages = spark.createDataFrame(urls, "page_id BIGINT, url STRING, key STRING, row INT, host STRING")
    found = judge_urls(pages, spark.createDataFrame(rules, RULES), **options)
    assert found.columns == ["page_id", "host", "path", "rule", "verdict"]
    want = [(u[0], *judged(u[1], rules, options.get("default", "allow"))) for u in urls]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(want, key=repr)


@pytest.mark.parametrize("ranges", [1, 7, 40])
def test_nested_rules_on_odd_urls(spark, ranges):
    rng = random.Random(ranges)

    def host():
        return ".".join(rng.choice(["a", "b", "", "\x00", "é", "A"]) for _ in range(rng.randrange(1, 5)))

    def path():
        return "/".join(rng.choice(["", "x", "xy", "\x00", "z\n", "ÿ", "\U0010ffff"]) for _ in range(rng.randrange(5)))

    rules = [(host(), path(), rng.choice(["allow", "block"])) for _ in range(80)]
    rules += [(None, "/", "block"), ("q", None, None), ("b", None, "block")]
    odd = [None, "", "x", "a://", "h://A.b", "h://a?/x", "://a.a/x/xy#b://b", "h://" + "a." * 3000 + "b/" + "x/" * 3000]
    urls = [f"h://{host()}/{path()}{rng.choice(['', '?q', '#/x'])}" for _ in range(300)]
    compare(spark, [(rng.choice([None, 1, i]), u, "k", 1, "a") for i, u in enumerate(odd + urls)], rules, ranges=ranges)


def test_one_host_over_all_ranges(spark):
    """A third and more of all rows under one host, many under one url, rules that begin and end in other ranges."""
    rules = [("com", "/", "block"), ("com", "/a/", "allow"), ("x.com", "/a/5", "block"), ("x.com", "/a/5/5", "allow")]
    urls = [(i, f"http://www.x.com/a/{i % 60}/{i % 7}", None, None, None) for i in range(900)]
    urls += [(5, "http://x.com/a/5/5", None, None, None)] * 300
    compare(spark, urls, rules, ranges=25, default="block")


def test_empty_tables(spark):
    compare(spark, [], [("com", "/", "block")])
    compare(spark, [(1, "http://a.com/x", None, None, None), (1, None, None, None, None)], [])


def test_only_native_functions(spark):
    plan = op11_url_rules(spark, DATA)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW pages AS SELECT * FROM '{DATA}/pages.parquet'")
    got = sorted((tuple(r) for r in op11_url_rules(spark, DATA).collect()), key=repr)
    assert got == sorted(con.sql(OP11_SQL).fetchall(), key=repr)
    assert {r[3] for r in got} >= {"org/", "com/fr/", "com/de/", "example.org/es/", None}
