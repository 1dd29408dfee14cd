"""URL verdicts: the join's keys, very long hosts, pages that share one pair."""

import time

from dayloom.llm import url_filter


def test_rules_meet_expressions_by_short_prefix(spark):
    pages = spark.createDataFrame([(1, "http://a.example.net/en/x")], "page_id long, url string")
    seen = []
    written, url_filter.written = url_filter.written, lambda df, name: seen.append(df._jdf.queryExecution().optimizedPlan().toString()) or written(df, name)
    try:
        found = url_filter.url_verdicts(pages, url_filter.rules_table(spark)).collect()
    finally:
        url_filter.written = written
    join = next(line for line in seen[0].split("\n") if "Join Inner" in line)
    assert "prefix" in join and "StartsWith(digest" in join.replace("startswith(digest", "StartsWith(digest") and "(digest" not in join.split("StartsWith")[0].split("startswith")[0]
    assert [tuple(r) for r in found] == [(1, "a.example.net", "/en/x", "example.net/en/", "allow")]


def test_long_hosts_and_broken_urls(spark):
    long = "http://" + "a." * 100_000 + "Example.COM/de/x"
    rows = [(1, long), (2, "http://" + "." * 1000 + "net/"), (3, "http://net"), (4, None), (5, "nothing"), (6, "http://.net/"), (None, "x://y.org/fr/")] + [(9, None)] * 500
    begun = time.time()
    found = {r["page_id"]: (r["rule"], r["verdict"]) for r in url_filter.url_verdicts(spark.createDataFrame(rows, "page_id long, url string"), url_filter.rules_table(spark)).collect()}
    assert time.time() - begun < 30
    assert found == {1: ("example.com/de/", "block"), 2: ("net/", "block"), 3: (None, "allow"), 4: (None, "allow"), 5: (None, "allow"), 6: ("net/", "block"),
                     None: ("org/fr/", "allow"), 9: (None, "allow")}
