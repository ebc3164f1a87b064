from tillroll.llm.queries import URL_RULES
from tillroll.llm.url_filters import Rule, filter_urls

SCHEMA = "page_id long, url string, html string"


def judge(spark, urls, listed, rules=URL_RULES, **kw):
    pages = spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], SCHEMA)
    rows = filter_urls(pages, rules, spark.createDataFrame([(x,) for x in listed], "url string"), **kw).collect()
    assert sorted(r["page_id"] for r in rows) == list(range(len(urls)))
    return {urls[r["page_id"]]: r for r in rows}


def test_rules_longest_wins_and_subdomains(spark):
    cases = {
        "http://a.example.net/en/1": ("example.net/en/", "allow"),
        "http://a.example.net/de/1": ("net/", "block"),
        "https://EXAMPLE.com/de/x?q": ("example.com/de/", "block"),
        "https://notexample.com/de/x": (None, "allow"),
        "https://x.org/fr/": ("org/fr/", "allow"),
        "https://net": (None, "allow"),           # empty path does not start with /
        "https://net/": ("net/", "block"),
        "https://a.net:80/": (None, "allow"),     # the port is part of the host
        "no scheme.net/": (None, "allow"),
        "x://y://z.net/": (None, "allow"),        # first :// counts
        "": (None, "allow"), None: (None, "allow"),
    }
    got = judge(spark, list(cases), [])
    assert {u: (r["rule"], r["verdict"]) for u, r in got.items()} == cases
    assert got["https://EXAMPLE.com/de/x?q"]["host"] == "example.com"
    assert got["no scheme.net/"]["host"] == got[None]["path"] == ""


def test_list_is_exact_with_and_without_broadcast(spark):
    listed = [f"bad{i}.xyz/p/{i}" for i in range(300)] + ["bad1.xyz/p/1", "", None]
    urls = [f"http://bad{i}.xyz/p/{i}/?q#f" for i in range(0, 300, 3)] + [f"http://ok{i}.xyz/p" for i in range(2000)]
    for kw in ({}, {"broadcast_bytes": 0}, {"bits_per_url": 1}):
        got = judge(spark, urls, listed, **kw)
        assert {u for u, r in got.items() if r["verdict"] == "block"} == {u for u in urls if "bad" in u}
        assert all(r["maybe_listed"] for u, r in got.items() if "bad" in u)  # no false negatives
        if kw.get("bits_per_url") == 1:
            assert any(r["maybe_listed"] for u, r in got.items() if "ok" in u)  # the exact join removed these


def test_rule_beats_list_and_ties(spark):
    got = judge(spark, ["http://a.b/x"], ["a.b/x"], [Rule("allow", "b", "/x"), Rule("block", "b", "/x")])
    assert got["http://a.b/x"]["verdict"] == "allow"


def test_empty_tables_and_clashing_columns(spark):
    pages = spark.createDataFrame([], SCHEMA)
    listed = spark.createDataFrame([], "url string")
    assert filter_urls(pages, URL_RULES, listed).count() == 0
    pages = spark.createDataFrame([(1, "http://a.b/c", "h", 5, "r")],
                                  "page_id long, url string, host string, block int, rule string")
    row, = filter_urls(pages, URL_RULES, listed).collect()
    assert (row["host"], row["path"], row["rule"], row["verdict"]) == ("a.b", "/c", None, "allow")


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c", "")], SCHEMA)
    out = filter_urls(pages, URL_RULES, spark.createDataFrame([("a.b/c",)], "url string"))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_only_possible_hits_are_shuffled_to_a_large_list(spark):
    pages = spark.createDataFrame([(i, f"http://h{i}.xyz/p", "") for i in range(400)], SCHEMA)
    listed = spark.createDataFrame([(f"h{i}.xyz/p",) for i in range(0, 400, 8)], "url string")
    out = filter_urls(pages, URL_RULES, listed, broadcast_bytes=200)  # the filter's two blocks fit, the list doesn't
    rows = out.collect()
    assert len(rows) == 400 and {r["page_id"] for r in rows if r["verdict"] == "block"} == set(range(0, 400, 8))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" in plan and "Python" not in plan


def test_the_query_lists_urls_by_their_digest(spark):
    from hashlib import md5

    from tillroll.llm.queries import listed_urls
    pages = spark.createDataFrame([(i, f"http://H{i}.xyz/p/?q", "") for i in range(200)] + [(900, None, ""), (901, "x", "")], SCHEMA)
    urls = [f"h{i}.xyz/p" for i in range(200)]
    want = [u for u in urls if md5(u.encode()).hexdigest()[0] == "0"] + [f"{u}/listed" for u in urls if md5(u.encode()).hexdigest()[0] == "1"]
    assert sorted(r["url"] for r in listed_urls(pages).collect()) == sorted(want) and len(want) > 10
