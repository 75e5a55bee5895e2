from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from kpiloom.llm import urls

PAGES = "page_id long, url string, html string"


def plain(url, rules=urls.RULES, strict=urls.STRICT, soft=urls.SOFT, hits=urls.SOFT_HITS):
    """Every rule and every term tried on its own."""
    found = re.search(r"(?s)://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), found[1]), found[2]) if found else ("", "")
    fits = [(len(r), len(r.split("/")[0]), r, a) for a, r in rules for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    text = re.sub("[A-Z]", lambda x: x[0].lower(), url or "")
    has = lambda t: re.search(rf"(?<![a-z0-9\x80-\U0010ffff]){re.escape(t)}(?![a-z0-9\x80-\U0010ffff])", text) is not None
    a, b = sum(map(has, strict)), sum(map(has, soft))
    rule, verdict = max(fits)[2:] if fits else (None, "block" if hits * a + b >= hits else "allow")
    return host, path, rule, verdict, a, b


def check(spark, given):
    frame = spark.createDataFrame([(i, u, "") for i, u in enumerate(given)], PAGES)
    rows = {r[0]: tuple(r)[1:] for r in urls.judged(frame).collect()}
    assert rows == {i: plain(u) for i, u in enumerate(given)}
    return rows


def test_rules_and_terms(spark):
    rows = check(spark, [
        "http://a.example.com/en/1", "http://WWW.example.com/en/1", "http://x.www.example.com/en/1", "http://example.com/de/1", "http://com/x", "http://a.com", "http://a.com?x=/en/",
        "https://b.net/es/", "https://b.net/esx", "https://b.net/fr/?q", "http://notexample.com/en/", "http://example.com:80/en/", "http://u@example.com/en/1", None, "", "no scheme casino", "x://", "a://b://c/d",
        "http://free.example.org/win/", "http://free.example.org/free", "http://freewin.org/", "http://casino.org/", "http://casinos.org/", "http://CASINO.org/", "http://écasino.org/", "http://free-free.org/x", "http://spam-farm.org", "http://a.org/" + "win/" * 5000 + "ads", "http://a.org/\n?free\twin",
    ])
    assert rows[1][2:4] == ("www.example.com/en/", "allow") and rows[0][2:4] == ("example.com/en/", "block") and rows[5][2] is None and rows[11][2] is None
    assert [rows[k][3] for k in (18, 19, 20, 21, 22, 23, 24, 25, 26)] == ["block", "allow", "allow", "block", "allow", "block", "allow", "allow", "block"]


def test_random_urls(spark):
    rng = random.Random(5)
    parts = ["www.", "example", ".com", ".net", ".", "/", "/en/", "/es/", "?", "#", "://", "-", "free", "win", "casino", "ads", "A", "é", "1", "http://", "com", "\n", " "]
    check(spark, ["http://" * (rng.random() < 0.8) + "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))) for _ in range(3000)])


def test_columns_repeats_and_empty(spark):
    frame = spark.createDataFrame([(1, "http://a.org/", "h", "x", 3)] * 2 + [(None, None, None, "y", 4)], "page_id long, url string, html string, host string, rule int")
    rows = urls.judged(frame).collect()
    assert len(rows) == 3 and rows[0] == rows[1] and rows[2].asDict() == {"page_id": None, "host": "", "path": "", "rule": None, "verdict": "allow", "strict_terms": 0, "soft_terms": 0}
    assert urls.judged(frame.where("false")).collect() == []
    assert [r.verdict for r in urls.judged(frame, rules=(), strict=(), soft=()).collect()] == ["allow"] * 3
    assert {r.verdict for r in urls.judged(frame.where("page_id = 1"), strict=("org",)).collect()} == {"block"}
    with pytest.raises(ValueError):
        urls.judged(frame, soft=[str(k) for k in range(urls.MOST_ENTRIES + 1)])


def test_sql(spark, tmp_path):
    given = ["http://a.example.com/en/1", "HTTP://WWW.EXAMPLE.COM/en/1", None, "", "x", "http://free-bets.example.net/de/1?x#y", "https://b.net/fr/", "http://écasino.org/", "a://\nb/c"]
    frame = spark.createDataFrame([(i, u, "") for i, u in enumerate(given)], PAGES)
    want = duckdb.sql(urls.SQL.replace("FROM pages", "FROM (VALUES " + ", ".join(f"({i}, {'NULL' if u is None else chr(39) + u + chr(39)})" for i, u in enumerate(given)) + ") pages(page_id, url)")).fetchall()
    assert sorted(map(tuple, urls.judged(frame).orderBy(F.col("page_id")).collect())) == sorted(want)
