"""URL filters against plain Python."""

import random

import pytest

from trolley.llm import url_filters


def brute(url, rules):
    host, path = "", ""
    if "://" in (url or ""):
        rest = url.split("://", 1)[1]
        end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end]), rest[end:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [
        (len(h.split(".")) if h else 0, len(p), verdict == "block", h + p, verdict)
        for h, p, verdict in rules
        if (not h or host == h or host.endswith("." + h)) and path.startswith(p)
    ]
    best = min(fits, key=lambda f: (-f[0], -f[1], f[2]), default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


@pytest.fixture(scope="module")
def rules():
    rnd = random.Random(1)
    labels, ends = ["a", "b", "c", "net"], ["", "/", "/x", "/x/", "/x/y", "/xy", "//", "/x/y/z/"]
    made = {
        (".".join(rnd.choices(labels, k=rnd.randint(1, 3))), rnd.choice(ends), rnd.choice(["allow", "block"]))
        for _ in range(60)
    }
    return sorted(made) + [("", "/x/only", "block"), ("net", "/x/", "block"), ("net", "/x/", "allow")]


@pytest.fixture(scope="module")
def urls():
    rnd = random.Random(2)
    hosts = [".".join(rnd.choices(["a", "b", "c", "net", "NET", "xnet"], k=rnd.randint(1, 4))) for _ in range(60)]
    paths = ["", "/", "/x", "/x/", "/x/y", "/xyz", "/x/y/z/w", "//", "/X/", "/x/only/1", "?q=/x/", "#/x", "/x?y://z"]
    made = [f"http://{host}{path}" for host in hosts for path in paths]
    odd = [None, "", "://", "net/x/", "http:/net/x/", "http://", "http:///x/only", "a://b://net/x/", "http://.net/x/",
           "http://net./x/", "http://user@net:80/x/", "http://a.net/" + "x" * 2_000_000, "http://" + "a." * 200_000 + "net/x/"]
    return made + odd + made[:50]


def test_judge(spark, rules, urls):
    rows = [(i, url, "path", "rule") for i, url in enumerate(urls)]
    pages = spark.createDataFrame(rows, "page_id long, url string, path string, RULE string").repartition(3)
    frame = spark.createDataFrame(rules + rules[:5], "host string, path string, verdict string")
    expected = [(i, *brute(url, rules)) for i, url in enumerate(urls)]
    assert {verdict for *_, verdict in expected} == {"allow", "block"}
    for part_bytes in (1 << 20, 700):  # one trie, and several passes
        judged = url_filters.judge(pages, frame, part_bytes=part_bytes)
        assert judged.columns == ["page_id", "url", "path", "RULE", "host", "path_", "rule_", "verdict"]
        got = sorted((r[0], r[4], r[5], r[6], r[7]) for r in judged.collect())
        assert got == expected
    kept = url_filters.allowed(pages, frame)
    assert kept.schema == pages.schema
    assert sorted(r.page_id for r in kept.collect()) == [i for i, *_, v in expected if v == "allow"]


def test_rules_may_be_null_in_upper_case_or_missing(spark):
    pages = spark.createDataFrame([(1, "http://A.net/x"), (None, None)], "page_id long, url string")
    rules = spark.createDataFrame([(None, "/x", "block"), ("NET", None, "block")], "host string, path string, verdict string")
    got = {(r.page_id, r.rule, r.verdict) for r in url_filters.judge(pages, rules).collect()}
    assert got == {(1, "net", "block"), (None, None, "allow")}
    none = url_filters.judge(pages, rules.limit(0), default="block")
    assert [r.verdict for r in none.collect()] == ["block"] * 2
    assert url_filters.judge(pages.limit(0), rules).count() == 0
    with pytest.raises(ValueError, match="1 rules have a verdict"):
        url_filters.judge(pages, spark.createDataFrame([("a", "", "no")], rules.schema))
    with pytest.raises(ValueError, match="default"):
        url_filters.judge(pages, rules, default="maybe")


def test_urls_are_not_shuffled(spark, rules):
    pages = spark.range(10).selectExpr("id AS page_id", "'http://net/' AS url")
    frame = spark.createDataFrame(rules, "host string, path string, verdict string")
    assert "Exchange" not in url_filters.judge(pages, frame)._jdf.queryExecution().executedPlan().toString()
