"""URL filters by host-suffix and path-prefix expressions.

A rule is (host, path, verdict): it fits its host and all subdomains, for every
path that starts with the rule's path; of the fitting rules the longest wins.
Each distinct (host, path) is expanded into expressions `host suffix` + `path
prefix`, one for every number of host labels and every path length that
occur among the rules.  Expressions meet the rules in an equi-join on the
first four bytes of their SHA-256; the full digest confirms a match.

Scale: a verdict depends on host and path alone, so expansion works on the
distinct pairs (partial aggregation; a hot host collapses map-side), and what they match is written
before it meets the pages, so a pair that many pages share (broken URLs, say) can be split.  The rules
are broadcast only while their counted rows stay under `BROADCAST_RULES`, else
the join shuffles; the side of the rules has one row for each digest, so Spark
can split a skewed prefix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import pick, written

#: Rules up to this number are broadcast (under 100 bytes each).
BROADCAST_RULES = 200_000
#: Bytes of the digest that the equi-join uses.
PREFIX_BYTES = 4

#: The rules of op9: fixed values.
RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
DEFAULT_VERDICT = "allow"


def split_url(df: DataFrame, url: str = "url") -> DataFrame:
    """Add `host` and `path`; null or no `://`: both empty.

    Host: from the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased
    (other letters stay).  Path: from there up to `?`, `#` or the end.
    """
    rest = F.regexp_extract(F.col(url), r"(?s)^.*?://(.*)$", 1)
    return (df.withColumn("_rest", F.coalesce(rest, F.lit("")))
            .withColumn("host", F.translate(F.regexp_extract("_rest", r"(?s)^([^/?#]*)", 1),
                                            "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
            .withColumn("path", F.regexp_extract("_rest", r"(?s)^[^/?#]*([^?#]*)", 1))
            .drop("_rest"))


def rules_table(spark, rules=None) -> DataFrame:
    return spark.createDataFrame(rules or RULES, "host string, path string, verdict string")


def url_verdicts(pages: DataFrame, rules: DataFrame, default: str = DEFAULT_VERDICT,
                 key: str = "page_id", url: str = "url") -> DataFrame:
    """One row per row of `pages`: key, host, path, rule, verdict.

    `rule` is host + path of the longest fitting rule (by its characters; ties:
    the longer host, then block before allow), null if none fits, and then the
    verdict is `default`.  Null or broken URLs have an empty host and path and
    fit no rule with a host.  Repeated rows and null keys are kept as they are;
    an empty table gives an empty result; other columns are not looked at.
    Rules that repeat with another verdict: block wins.  Rules with a null host or path
    never fit.
    """
    spark = pages.sparkSession
    parts = split_url(pick(pages, key, url)).select(key, "host", "path")

    ruled = (pick(rules, "host", "path", "verdict").dropna(subset=["host", "path"])
             .groupBy("host", "path").agg(F.max("verdict").alias("verdict"))  # 'block' > 'allow'
             .withColumn("rule", F.concat("host", "path"))
             .withColumn("digest", F.sha2(_expression(F.col("host"), F.col("path")), 256))
             .withColumn("prefix", F.substring("digest", 1, 2 * PREFIX_BYTES)))
    sizes = ruled.agg(F.count(F.lit(1)), F.collect_set(F.length("path")), F.collect_set(_labels("host"))).first()
    # what occurs among the rules: at most as many path lengths and numbers of labels as the longest rule has characters
    lengths, depths = sorted(sizes[1]) or [0], sorted(sizes[2]) or [1]
    side = ruled.select("prefix", F.col("digest").alias("rule_digest"), "rule", F.col("verdict").alias("rule_verdict"),
                        F.length("host").alias("host_chars"))
    if sizes[0] <= BROADCAST_RULES:
        side = F.broadcast(side)

    distinct = parts.select("host", "path").distinct()
    suffixes = F.transform(F.filter(F.array(*(F.lit(n) for n in depths)), lambda n: n <= F.col("labels")),
                           lambda n: F.call_function("substring_index", F.col("host"), F.lit("."), -n))
    wanted = F.filter(F.array(*(F.lit(n) for n in lengths)), lambda n: n <= F.length("path"))
    expressions = (distinct
                   .withColumn("labels", _labels("host")).select("host", "path", F.explode(suffixes).alias("suffix"))
                   .select("host", "path", "suffix", F.explode(wanted).alias("n"))
                   .select("host", "path", F.sha2(_expression(F.col("suffix"), F.expr("substring(path, 1, n)")), 256)
                           .alias("digest"))
                   .withColumn("prefix", F.substring("digest", 1, 2 * PREFIX_BYTES)))
    best = (expressions.join(side, "prefix")
            .where(F.startswith("digest", "rule_digest"))  # of equal lengths; an equality would become a key of the join
            .groupBy("host", "path")
            .agg(F.max(F.struct(F.length("rule").alias("n"), "host_chars", "rule_verdict", "rule")).alias("best")))
    best = written(best, "url-matches")
    return (parts.alias("p").join(best.alias("b"), ["host", "path"], "left")
            .select(key, "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.rule_verdict"), F.lit(default)).alias("verdict")))


def _labels(host: str) -> Column:
    return F.length(host) - F.length(F.replace(F.col(host), F.lit("."))) + 1


def _expression(host: Column, path: Column) -> Column:
    """Host and path with a separator that no host contains."""
    return F.concat(host, F.lit("/"), path)
