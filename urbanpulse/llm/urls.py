"""URL filters: stated rules, and empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and suffix.
Each level's rate of bad pages is shrunk towards its parent's by a beta prior
whose strength is estimated from how much rates differ between siblings (method
of moments).  A host is blocked when even the lower bound of its posterior rate
is above a threshold.  All steps are DataFrame functions.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from urbanpulse.llm.common import table
from urbanpulse.operators.joins import HOT_SHARE, split_hot_join
from urbanpulse.session import stage_table

# The rules of the query (verdict, host and path beginning).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)

# Suffixes of two labels under which domains are registered; any other suffix
# is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.kr", "com.br", "com.mx", "co.in", "co.za")

#: A host is blocked when the lower bound of its rate of bad pages is over this
#: many times the overall rate, or over BAD_ABOVE if that is less.
TIMES_OVERALL = 2.0
BAD_ABOVE = 0.5
Z = 1.96
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, ASCII lower
    case; null or no ``://``: empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def longest_rule(rules, host_: str = "host", path_: str = "path") -> tuple[Column, Column]:
    """The longest fitting rule and its verdict (null if none fits; equally
    long ones: the first in the alphabet).  A rule fits its host and all
    subdomains where the path starts with the rule's.  For rule lists of a few
    hundred at most: they become one CASE expression."""
    rule = verdict = F.lit(None).cast("string")
    for word, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        at = text.index("/")
        own, start = text[:at], text[at:]
        fits = (((F.col(host_) == own) | F.col(host_).endswith("." + own)) & F.col(path_).startswith(start))
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(word)).otherwise(verdict)
    return rule, verdict


def bare_host(host_: Column) -> Column:
    """The host without user name, port and a dot at its end."""
    return F.regexp_replace(F.regexp_replace(host_, r"^.*@", ""), r"\.?(:[0-9]*)?$", "")


def registered_domain(host_: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a bare host.  An address (IPv4, or IPv6 in
    brackets) is its own domain, under an empty suffix."""
    address = host_.rlike(r"^([0-9]{1,3}(\.[0-9]{1,3}){3}|\[.*\])$")
    labels = F.split(host_, r"\.")
    last_two = F.substring_index(host_, ".", -2)
    long_suffix = last_two.isin(*TWO_LABEL_SUFFIXES) & (F.size(labels) > 2)
    suffix = F.when(long_suffix, last_two).otherwise(F.substring_index(host_, ".", -1))
    domain = F.when(long_suffix, F.substring_index(host_, ".", -3)).otherwise(last_two)
    return F.when(address, host_).otherwise(domain), F.when(address, "").otherwise(suffix)


def _strength(level: DataFrame, parent_rate: str) -> float:
    """Beta strength by moments: how far the rates of siblings are from their
    parent's, beyond what sampling alone would make."""
    n, k, p = F.col("n"), F.col("bad"), F.col(parent_rate)
    got = (level.filter("n > 0")
           .agg(F.sum((k - n * p) ** 2 / n).alias("spread"), F.sum(p * (1 - p)).alias("noise"),
                F.sum(n * p * (1 - p)).alias("weight"))).first()
    if not got or not got["weight"] or got["weight"] <= 0:
        return MOST_STRENGTH
    # spread's expectation is sum p (1 - p) (1 + (n - 1) / (strength + 1))
    inside = (got["spread"] - got["noise"]) / max(got["weight"] - got["noise"], 1e-9)
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, 1 / inside - 1)) if inside > 0 else MOST_STRENGTH


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """host, pages, n, bad, rate (posterior mean), bound (lower bound), overall
    (rate of all labelled pages) for every host of ``outcomes`` (host, bad: 1, 0
    or null if the page isn't labelled).

    Hosts without labelled pages have their domain's rate, domains their
    suffix's, and all the overall rate (one half if no page is labelled).
    Rows without a host form a host of their own.  Only three numbers and a
    total reach the driver.
    """
    domain, suffix = registered_domain(F.col("host"))
    hosts = (outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
                                           F.count(F.lit(1)).alias("pages"))
             .withColumns({"domain": domain, "suffix": suffix}))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    overall = (total["bad"] + 1) / (total["n"] + 2) if total and total["n"] else 0.5

    def shrunk(level: DataFrame, prior: str, name: str) -> DataFrame:
        s = _strength(level, prior)
        return level.withColumns({
            name: (F.col("bad") + s * F.col(prior)) / (F.col("n") + s), f"{name}_weight": F.col("n") + s})

    suffixes = shrunk(suffixes.withColumn("overall_rate", F.lit(float(overall))), "overall_rate", "suffix_rate")
    domains = shrunk(domains.join(suffixes.select("suffix", "suffix_rate"), "suffix"), "suffix_rate", "domain_rate")
    hosts = shrunk(hosts.join(domains.select("domain", "suffix", "domain_rate"), ["domain", "suffix"]),
                   "domain_rate", "rate")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("rate_weight") + 1))
    return hosts.select("host", "pages", "n", "bad", "rate", F.greatest(F.lit(0.0), F.col("rate") - Z * deviation).alias("bound"),
                        F.lit(float(overall)).alias("overall"))


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, bad_above: float | None = None) -> DataFrame:
    """page_id, host, path, rule, verdict, rate, bound for every row of
    ``pages`` (page_id, url).

    ``outcomes`` (page_id, bad): labelled pages; one labelled twice is bad if
    any label says so; null ids and outcomes are left out.  A fitting rule
    decides; else the host is blocked if the lower bound of its rate is over
    ``bad_above`` (default: TIMES_OVERALL times the overall rate, BAD_ABOVE at
    most).  Hosts count without user name and port.  Null urls and urls without
    ``://`` have empty host and path.  Repeated rows are judged one by one; other
    columns are not read.

    The hosts are stored; those of more than one in 10,000 pages, fewer than
    10,000 therefore, meet their pages without a shuffle.
    """
    pages = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    pages = pages.withColumn("bare", bare_host(F.col("host")))
    known = (outcomes.filter(F.col("page_id").isNotNull() & F.col("bad").isNotNull())
             .groupBy("page_id").agg(F.max(F.col("bad").cast("int")).alias("bad")))
    hosts = stage_table(host_reputation(pages.select("page_id", F.col("bare").alias("host")).join(known, "page_id", "left"))
                        .withColumnRenamed("host", "bare"), "hosts")
    total = hosts.agg(F.sum("pages")).first()[0] or 0
    hot = hosts.filter(F.col("pages") > HOT_SHARE * total).select("bare")
    rule, ruled = longest_rule(rules)
    limit = F.lit(bad_above) if bad_above is not None else F.least(F.lit(BAD_ABOVE), TIMES_OVERALL * F.col("overall"))
    own = F.when(F.col("bound") > limit, "block").otherwise("allow")
    return (split_hot_join(pages, hosts.select("bare", "rate", "bound", "overall"), "bare", hot)
            .select("page_id", "host", "path", rule.alias("rule"), F.coalesce(ruled, own).alias("verdict"),
                    F.round("rate", 4).alias("rate"), F.round("bound", 4).alias("bound")))


def op9_url_filters(spark, sf_dir: str) -> DataFrame:
    """Labelled outcomes: pages whose id has a quality label; quality 0 is bad."""
    outcomes = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (F.col("quality") == 0).cast("int").alias("bad"))
    return filter_urls(table(spark, sf_dir, "pages"), outcomes)
