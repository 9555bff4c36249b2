"""URL filters: every URL's host suffixes and path prefixes are looked up among the rules by short hash prefixes.

A rule (host, path, verdict) fits its host and all subdomains if the URL's path starts with the rule's path. Of the
rules that fit, the one with the most characters wins, then the one with the longer host, then a block.

What a verdict depends on is short: as many labels at the host's end as the longest rule host has, and as many
characters of the path as the longest rule path. URLs are reduced to these sites first, so a host with a third of all
rows is a few sites. A site is expanded into expressions, host suffix + path prefix, where prefixes end at a "/" or at
a length that the last, open segment of some rule has. Expressions meet the rules by the first 32 bits of their
SHA-256, all 256 are confirmed, and an aggregate keeps the winning rule of a site. Rules are one row per
expression, so a lookup adds no rows but for chance hits of the 32 bits.

All of it is DataFrame functions. Which side of a join is broadcast is left to Spark, which knows real sizes; where
rules are many, the joins are shuffled by hash prefix and site, and adaptive execution splits a frequent site.

Defined results: a URL that is null or has no "://" has an empty host and path, fits no rule but an empty one, and
gets the default verdict; hosts are lower-cased A-Z in URLs and rules; repeated rows are judged each; a null or
repeated id is an id like others; extra columns are ignored. Rules: a null host or path is empty, a rule without a
verdict or with a host that holds "/", "?" or "#" is none; without rules all get the default.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Hexadecimal digits of a digest that expressions and rules are joined on.
PREFIX_DIGITS = 8
#: Longest rule path, which bounds the lengths of open last segments.
MAX_RULE_PATH = 2048


def _after_scheme(url: str) -> str:
    return f"case when instr({url}, '://') > 0 then substring({url}, instr({url}, '://') + 3) end"


def url_host(url: str) -> Column:
    """What lies between the first "://" and "/", "?", "#" or the end; lower case; empty without "://"."""
    host = F.regexp_extract(F.expr(_after_scheme(url)), "^[^/?#]*", 0)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def url_path(url: str) -> Column:
    """What lies between the host and "?", "#" or the end; empty without "://"."""
    return F.coalesce(F.regexp_extract(F.expr(_after_scheme(url)), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rule_table(rules: DataFrame) -> DataFrame:
    """One row per expression: the rule's text, its digest and verdict; a block beats an allow of the same text."""
    host = F.translate(F.coalesce("host", F.lit("")), UPPER, LOWER).alias("host")
    own = rules.where("verdict is not null").select(host, F.coalesce("path", F.lit("")).alias("path"), "verdict")
    own = own.where(~F.col("host").rlike("[/?#]"))
    return own.groupBy("host", "path").agg(F.max("verdict").alias("rule_verdict"))


def _expressions(labels: int, tails: list[int]) -> Column:
    """Host suffixes of up to ``labels`` labels, each with all path prefixes, of the columns host and path."""
    hosts = f"transform(sequence(1, least(size(split(host, '[.]')), {labels})), n -> substring_index(host, '.', -n))"
    # the parts between slashes, and the place each begins at
    starts = "filter(sequence(0, length(path)), i -> i = 0 or substring(path, i, 1) = '/')"
    ends = ", ".join(map(str, tails))
    # an open segment reaches no further than the next slash
    prefixes = (
        f"array_distinct(flatten(transform({starts}, s -> transform(filter(array({ends}), n -> n <= "
        "length(substring_index(substring(path, s + 1), '/', 1))), n -> substring(path, 1, s + n)))))"
    )
    return F.expr(f"flatten(transform({hosts}, h -> transform({prefixes}, p -> struct(h as host, p as path))))")


def judge_urls(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """key, host, path, rule (the winning rule's text or null) and verdict of every row of ``pages``.

    ``rules`` has the columns host, path and verdict ("allow" or "block").
    """
    parsed = pages.select(F.col(key), F.col(url).alias("_url"))
    parsed = parsed.select(F.col(key).alias("_key"), url_host("_url").alias("host"), url_path("_url").alias("path"))
    known = _rule_table(rules)
    # numbers that follow the longest rule, not the count of rules
    bounds = known.agg(
        F.max(F.size(F.split("host", "[.]"))).alias("labels"),
        F.max(F.length("path")).alias("reach"),
        F.array_sort(F.collect_set(F.length(F.substring_index("path", "/", -1)))).alias("tails"),
    ).first()
    if bounds.labels is None:
        nothing = parsed.select("_key", "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
        return nothing.withColumnRenamed("_key", key)
    if bounds.reach > MAX_RULE_PATH:
        raise ValueError(f"a rule's path has {bounds.reach} characters, more than {MAX_RULE_PATH}")
    sited = parsed.withColumn("_host", F.substring_index("host", ".", -bounds.labels)).withColumn("_path", F.substring("path", 1, bounds.reach))
    sites = sited.select(F.col("_host").alias("host"), F.col("_path").alias("path")).distinct()
    wanted = sites.select(F.col("host").alias("_host"), F.col("path").alias("_path"), F.explode(_expressions(bounds.labels, bounds.tails)).alias("e"))
    digest = F.sha2(F.concat("host", "path"), 256)
    wanted = wanted.select("_host", "_path", "e.host", "e.path").withColumn("_digest", digest)
    wanted = wanted.withColumn("_short", F.substring("_digest", 1, PREFIX_DIGITS)).drop("host", "path")
    listed = known.withColumn("digest", digest).withColumn("_short", F.substring("digest", 1, PREFIX_DIGITS))
    fitting = wanted.join(listed, "_short").where("_digest = digest")
    rank = F.struct(F.length(F.concat("host", "path")).alias("size"), F.length("host").alias("host_size"), "rule_verdict", F.concat("host", "path").alias("rule"))
    judged = fitting.groupBy("_host", "_path").agg(F.max(rank).alias("best"))
    found = sited.join(judged, ["_host", "_path"], "left")
    verdict = F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict")
    return found.select(F.col("_key").alias(key), "host", "path", F.col("best.rule").alias("rule"), verdict)
