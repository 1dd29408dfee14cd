"""Every operator on awkward rows, clashing extra columns and empty tables."""

import pytest

import cases
from dayloom.llm import decontaminate, html_text, mixing, quality_rules, secret_scan, simhash, suffix_dedup, token_count, url_filter, weak_label


def vocabulary():
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def bench(spark, rows=((1, "one two three"), (2, None), (3, ""), (None, "jumps over the lazy dog and runs away from it all day long"))):
    return spark.createDataFrame(list(rows), "item_id long, text string")


OPERATORS = {
    "token_count": lambda s, d: token_count.token_counts(d, vocabulary()),
    "quality_rules": lambda s, d: quality_rules.quality_rules(d),
    "weak_label": lambda s, d: weak_label.classify(d),
    "decontaminate": lambda s, d: decontaminate.contamination(d, bench(s)),
    "simhash": lambda s, d: simhash.near_duplicates(d),
    "secret_scan": lambda s, d: secret_scan.secret_spans(d),
    "mixing": lambda s, d: mixing.mix(d, shards=3),
    "suffix_dedup": lambda s, d: suffix_dedup.remove_repeats(d, group_bytes=200_000),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_awkward_rows(spark, name):
    docs = cases.documents(spark, cases.awkward_rows())
    plain = cases.rows_of(OPERATORS[name](spark, docs))
    assert [r[0] for r in plain] == [r[0] for r in plain] and len(plain) == docs.count()
    assert sorted((r[0] for r in plain), key=repr) == sorted((r[0] for r in cases.awkward_rows()), key=repr)
    again = cases.rows_of(OPERATORS[name](spark, cases.clashing(docs).repartition(5)))
    if name == "weak_label":  # floating sums over another order of parts
        again = [r[:2] for r in again]
        plain = [r[:2] for r in plain]
    assert again == plain


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table(spark, name):
    assert OPERATORS[name](spark, cases.documents(spark, [])).collect() == []


def test_empty_benchmark(spark):
    docs = cases.documents(spark, cases.awkward_rows())
    found = decontaminate.contamination(docs, bench(spark, ())).collect()
    assert len(found) == docs.count() and not any(r["contaminated"] or r["n_hit"] for r in found)


PAGES = [(1, "http://a.net/x", "<p>Hi there.</p>"), (1, "http://a.net/x", "<p>Hi there.</p>"), (None, None, None), (2, "", ""),
         (3, "no scheme", "<"), (4, "://", "<a"), (5, "http://?#", "<!-- x"), (6, "HTTP://Ä.NET\n/", "a" * 200_000 + "<p" * 2000)]


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_pages(spark):
    from pyspark.sql import functions as F
    docs = pages(spark, PAGES)
    wide = docs.select("*", *(F.lit(0).alias(c) for c in ("URL", "text", "host", "path", "rule", "verdict", "n_chars", "prefix", "best")))
    for run in (lambda d: html_text.extract(d), lambda d: url_filter.url_verdicts(d, url_filter.rules_table(spark))):
        plain = cases.rows_of(run(docs))
        assert len(plain) == len(PAGES) and cases.rows_of(run(wide)) == plain
        assert run(pages(spark, [])).collect() == []
