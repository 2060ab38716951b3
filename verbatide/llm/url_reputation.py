"""URL filtering by rules and by empirical-Bayes host reputation.

Labelled page outcomes (bad or not) are counted per host, registered domain and
suffix. Each level's rate is shrunk towards its parent's through a beta-binomial
prior: suffix to the whole table, domain to its suffix, host to its domain. A
level's prior strength comes from the spread of its rates (method of moments). A
host is blocked if the lower bound of its posterior bad rate is above a limit, so
a host without evidence of its own follows its domain, and unknown ones pass.

Only columns and joins: counts are combined before each shuffle, and what is
joined back to the pages has one row per host, so that adaptive execution can
split a host with a third of all pages.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from verbatide.storage import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Suffixes of two labels below which names are registered; all others have one.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")


@dataclass(frozen=True)
class Reputation:
    """Prior strength's limits; the bound is mean + z deviations below zero."""

    limit: float = 0.5
    z: float = 1.645
    least_strength: float = 1.0
    most_strength: float = 1000.0


def url_host(url) -> Column:
    """What stands between the first ``://`` and ``/``, ``?``, ``#`` or the end, with
    A-Z lower-cased; empty for null and for a url without ``://``."""
    found = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    return F.translate(F.coalesce(found, F.lit("")), UPPER, LOWER)


def url_path(url) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty as for the host."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffix(host) -> Column:
    labels = F.split(host, r"\.")
    two = F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.element_at(labels, -1))


def host_domain(host) -> Column:
    """The suffix and one label more; the host itself if it has no more."""
    labels = F.split(host, r"\.")
    kept = F.size(F.split(host_suffix(host), r"\.")) + 1
    start = F.greatest(F.size(labels) - kept + 1, F.lit(1))
    return F.array_join(F.slice(labels, start, kept), ".")


def matching_rule(host, path, rules) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls.

    A rule is (``allow`` or ``block``, host and path in one string). It fits its
    host and all subdomains, if the path starts with the rule's.
    """
    rule = verdict = F.lit(None).cast("string")
    for action, pattern in sorted(rules, key=lambda r: len(r[1])):
        cut = pattern.find("/") if "/" in pattern else len(pattern)
        on_host, on_path = pattern[:cut], pattern[cut:]
        fits = ((host == on_host) | host.endswith("." + on_host)) & path.startswith(on_path)
        rule = F.when(fits, F.lit(pattern)).otherwise(rule)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _strength(counts: DataFrame, parent: str, options: Reputation) -> DataFrame:
    """One row: the prior strength of a level, from (n, bad, parent's rate) of its groups."""
    scale = F.greatest(F.col(parent) * (1 - F.col(parent)), F.lit(1e-9))
    spread = F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col(parent), 2) / scale
    moments = counts.agg(
        F.coalesce(F.sum(spread), F.lit(0.0)).alias("s"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"),
        F.coalesce(F.sum(F.col("n") * F.col("n")), F.lit(0)).alias("n2"),
        F.count("*").alias("k"),
    )
    free = F.col("n") - F.col("n2") / F.greatest("n", F.lit(1)) - (F.col("k") - 1)
    share = F.when(free > 0, (F.col("s") - (F.col("k") - 1)) / free).otherwise(0.0)
    strength = 1 / F.greatest(share, F.lit(1e-6)) - 1
    bounded = F.least(
        F.greatest(strength, F.lit(options.least_strength)), F.lit(options.most_strength)
    )
    return moments.select(bounded.alias("strength"))


def reputations(outcomes: DataFrame, options: Reputation = Reputation()) -> dict[str, DataFrame]:
    """By level (suffix, domain, host) a table (<level>, n, bad, mean, bound) of every one
    with labelled pages, from (host, bad).

    Each level's rates are shrunk towards those of the level above. ``bound`` is the
    posterior mean less z deviations. Rows with a null host or outcome count nowhere. An
    empty table gives empty tables.
    """
    # One row per host, stored: every level is derived from it.
    hosts = cut_lineage(
        outcomes.filter(F.col("host").isNotNull() & F.col("bad").isNotNull())
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad"))
        .withColumn("domain", host_domain(F.col("host")))
        .withColumn("suffix", host_suffix(F.col("host")))
    )
    domains = cut_lineage(
        hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    )
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    # Single numbers reach the driver: the overall rate and each level's strength.
    whole = hosts.agg(F.sum("bad") / F.sum("n")).first()[0] or 0.0
    level = cut_lineage(suffixes.withColumn("parent", F.lit(whole)))
    found = {}
    for name, narrower, key in (
        ("suffix", domains, "suffix"), ("domain", hosts, "domain"), ("host", None, None)
    ):
        strength = F.lit(_strength(level, "parent", options).first()[0])
        total = strength + F.col("n")
        level = level.withColumn("mean", (strength * F.col("parent") + F.col("bad")) / total)
        deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1))
        bound = F.col("mean") - options.z * deviation
        found[name] = level.select(name, "n", "bad", "mean", bound.alias("bound"))
        if narrower is not None:
            above = level.select(key, F.col("mean").alias("parent"))
            level = cut_lineage(narrower.join(above, key))
    return found


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules=(),
    options: Reputation = Reputation(),
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """(key, host, path, rule, verdict, bound) for every page, repeated rows included.

    Rules come first; where none fits, the verdict is ``block`` if the bound of the
    posterior bad rate is above the limit: the host's, or that of its registered domain
    if the host has no labelled pages, or else its suffix's. What no outcome speaks for
    is allowed, as are a null url and one without a host, unless a rule fits.
    ``outcomes`` holds (host, bad).
    """
    located = pages.select(
        F.col(key).alias(key), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path")
    )
    known = reputations(outcomes.filter(F.col("host") != ""), options)
    # Bounds are found once for each host; a hot one is one row.
    hosts = located.select("host").distinct().select(
        "host", host_domain(F.col("host")).alias("domain"), host_suffix(F.col("host")).alias("suffix")
    )
    for name, table in known.items():
        hosts = hosts.join(table.select(name, F.col("bound").alias(f"of_{name}")), name, "left")
    bounds = hosts.select("host", F.coalesce("of_host", "of_domain", "of_suffix").alias("bound"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bound") > options.limit, "block").otherwise("allow")
    return located.join(bounds, "host", "left").select(
        key,
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, learned).alias("verdict"),
        "bound",
    )
