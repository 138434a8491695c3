"""URL filtering by rules and by host reputation with empirical-Bayes shrinkage.

Pages that a rule judges are the labelled outcomes (1 for block). A host's block rate is
beta-binomial: its prior has the posterior mean of the registered domain, whose prior has
that of the suffix, whose prior has the rate of all labelled pages (one page of each
outcome added). The strength of each prior, in pages, is estimated from the labelled
pages by moments: from how much more the children's rates vary around the common rate
than chance alone makes them. A page without a rule is blocked if the lower bound
mean - z * deviation of its host's posterior exceeds the threshold.

The registered domain is the last two labels of a host and the suffix the last one; no
list of public suffixes is used. An empty host has an empty domain and suffix.

Null urls and urls without ``://`` have an empty host and path. No pages give no rows; of
rules of equal length that fit, the later one counts; a bound equal to the threshold allows.
Repeated rows are judged
each, and count as often as they occur. A host that holds most pages is one row of the
reputation table, summed before the shuffle.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Z = 1.645
THRESHOLD = 0.5
#: Bounds of a prior's strength in pages.
STRENGTH = (1.0, 1000.0)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """Struct of the rule and verdict that fit; of several the longest. ``rules``: (verdict, host/path)."""
    fitting = F.lit(None)
    for verdict, rule in sorted(rules, key=lambda x: len(x[1])):
        own, slash, start = rule.partition("/")
        fits = ((host == own) | host.endswith(f".{own}")) & path.startswith(slash + start)
        named = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        fitting = F.when(fits, named).otherwise(fitting)
    return fitting


def _strength(children: DataFrame) -> Column:
    """Prior strength by moments over children with labelled pages: columns n and bad."""
    low, high = STRENGTH
    n, bad = F.sum("n"), F.sum("bad")
    rate = bad / n
    # sum of n (r - rate)**2 with r = bad / n, and its expectation without any true difference
    spread = F.sum(F.col("bad") * F.col("bad") / F.col("n")) - bad * bad / n
    chance = rate * (1 - rate)
    between = (spread - (F.count(F.lit(1)) - 1) * chance) / (n - F.sum(F.col("n") * F.col("n")) / n)
    room = n * n > F.sum(F.col("n") * F.col("n"))
    found = F.when(room & (chance > 0) & (between > 0), F.greatest(F.lit(low), F.least(F.lit(high), chance / between - 1)))
    return F.coalesce(found, F.lit(high))


def reputation(pages: DataFrame, z: float = Z) -> DataFrame:
    """(host, n, bad, mean, bound) of every host; ``pages`` has host and outcome (1 bad, 0 good, null unknown)."""
    outcome = F.col("outcome")
    hosts = pages.groupBy("host").agg(F.count(outcome).cast("double").alias("n"), F.coalesce(F.sum(outcome), F.lit(0)).cast("double").alias("bad"))
    domain = F.substring_index("host", ".", -2)
    hosts = hosts.select("host", domain.alias("domain"), F.substring_index("host", ".", -1).alias("suffix"), "n", "bad")
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    root = suffixes.agg(*sums).select(((F.coalesce("bad", F.lit(0.0)) + 1) / (F.coalesce("n", F.lit(0.0)) + 2)).alias("above"))

    def shrunk(level: DataFrame, above: Column, strength: Column) -> DataFrame:
        """Posterior by a prior of ``strength`` pages with mean ``above``."""
        shrunk = level.withColumn("_s", strength).withColumn("total", F.col("n") + F.col("_s"))
        return shrunk.withColumn("mean", (F.col("bad") + F.col("_s") * above) / F.col("total")).drop("_s")

    labelled = F.col("n") > 0
    # One row each, read as scalar subqueries.
    strengths = [x.where(labelled).agg(_strength(x).alias("s")).scalar() for x in (suffixes, domains, hosts)]
    by_suffix = shrunk(suffixes, root.scalar(), strengths[0]).select("suffix", F.col("mean").alias("above"))
    by_domain = shrunk(domains.join(by_suffix, "suffix"), F.col("above"), strengths[1])
    by_domain = by_domain.select("domain", F.col("mean").alias("above"))
    by_host = shrunk(hosts.join(by_domain, "domain"), F.col("above"), strengths[2])
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("total") + 1))
    return by_host.select("host", "n", "bad", "mean", (F.col("mean") - z * deviation).alias("bound"))


def judge(pages: DataFrame, rules: list[tuple[str, str]], url_column: str = "url", z: float = Z, threshold: float = THRESHOLD) -> DataFrame:
    """All columns of ``pages`` (but those named here) with host, path, rule, verdict, rate and bound."""
    added = ("host", "path", "rule", "verdict", "rate", "bound")
    url = F.col(url_column)
    kept = [c for c in pages.columns if c not in added]
    parsed = pages.select(*kept, host_of(url).alias("host"), path_of(url).alias("path"))
    fitting = rule_of(F.col("host"), F.col("path"), rules)
    parsed = parsed.select(*kept, "host", "path", fitting.alias("_fit"))
    outcome = (F.col("_fit.verdict") == "block").cast("int")
    rated = reputation(parsed.select("host", outcome.alias("outcome")), z)
    rated = rated.select("host", F.col("mean").alias("rate"), "bound")
    verdict = F.coalesce("_fit.verdict", F.when(F.col("bound") > threshold, "block").otherwise("allow"))
    return parsed.join(rated, "host").select(*kept, "host", "path", F.col("_fit.rule").alias("rule"), verdict.alias("verdict"), "rate", "bound")
