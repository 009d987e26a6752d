"""URL verdicts: explicit rules first, empirical-Bayes host reputation for the rest.

Each labelled page outcome (bad or not) is a Bernoulli draw of its host. Host rates are shrunk through
beta-binomial priors: a host towards its registered domain, the domain towards its suffix, the suffix towards
all pages. The strength of each prior is estimated from the spread between siblings (method of moments), so
a host with few labels is judged by its domain and one with many by itself. A host is blocked where the lower
posterior bound of its bad rate has more than ``odds`` times the odds of all labelled pages: the limit moves with the base
rate, so a host is judged by what sets it apart. Where hosts don't differ beyond chance, none is blocked.

The suffix is the last label, or two where a country's label follows a second-level one such as ``co`` (SECOND_LEVEL). An
address in digits or brackets is its own domain, under the suffix ``ip``.

Everything is DataFrame expressions. Counts are pre-aggregated by (host, outcome key) before any shuffle, so a
host with a third of all pages costs one row per task. The reputation table goes back to the pages through the
shared folder; Spark broadcasts it only where its size on disk is below the session's threshold, else it joins
by shuffle and adaptive execution splits a hot host.

Defined results: null url or no ``://`` gives empty host and path, which match no rule and share one reputation;
no labels at all leave every host at the prior mean; repeated rows are judged row by row; extra columns pass by.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tilewright.session import materialize

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Labels that registries put before a country's own.
SECOND_LEVEL = "ac co com edu go gob gov mil ne net nom or org".split()
LONG_SUFFIX = rf"[^.]+\.({'|'.join(SECOND_LEVEL)})\.[a-z][a-z]\z"
ADDRESS = r"^([0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|\[.*)\z"


@dataclass(frozen=True)
class Reputation:
    """odds: block above so many times the odds of all pages; z: standard deviations below the posterior mean; strength: limits of a prior's pseudo-counts."""

    odds: float = 2.0
    z: float = 1.645
    strength: tuple[float, float] = (2.0, 2000.0)


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.regexp_extract(_rest(url), r"^[^/?#]*", 0), UPPER, UPPER.lower())


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def registered_domain(host: Column) -> Column:
    """The suffix and the label before it, without user, port and closing dots; the whole of an address."""
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r"\.*(:[0-9]*)?\z", "")
    return F.when(bare.rlike(ADDRESS), bare).when(bare.rlike(LONG_SUFFIX), F.regexp_extract(bare, LONG_SUFFIX, 0)).otherwise(F.substring_index(bare, ".", -2))


def suffix_of(domain: Column) -> Column:
    """What follows the first dot of a registered domain; the whole where it has none; ip for an address."""
    return F.when(domain.rlike(ADDRESS), "ip").when(F.instr(domain, ".") > 0, F.regexp_extract(domain, r"\.(.*)", 1)).otherwise(domain)


def match_rules(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule, else nulls. rules: (verdict, "host/path prefix"); a list given by the caller, compiled into one expression."""
    rule = verdict = F.lit(None).cast("string")
    for say, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, prefix = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + prefix)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(say)).otherwise(verdict)
    return rule, verdict


def _strength(children: DataFrame, p: Reputation) -> float:
    """Pseudo-counts of the prior: how far children (n, bad, parent_n, parent_bad) stray from their parent's rate beyond sampling noise."""
    low, high = p.strength
    m = F.col("parent_bad") / F.col("parent_n")
    n, rate, open_ = F.col("n"), F.col("bad") / F.col("n"), 1 - F.col("n") / F.col("parent_n")
    sums = children.where("n > 0").agg(
        F.sum(n * (rate - m) * (rate - m)).alias("spread"), F.sum(open_ * m * (1 - m)).alias("noise"), F.sum(n * open_).alias("weight"), (F.sum(n * m * (1 - m)) / F.sum(n)).alias("binomial")
    ).first()  # one row of four sums
    between = (sums.spread - sums.noise) / sums.weight if sums.weight else 0.0
    return min(high, max(low, sums.binomial / between - 1)) if between > 0 else high


def host_reputation(hosts: DataFrame, p: Reputation = Reputation()) -> DataFrame:
    """hosts(host, n, bad), a row per host -> host, n, bad, rate (posterior mean), bound (its lower bound), blocked."""
    base = hosts.withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix_of(F.col("domain")))
    base = materialize(base, "hosts")
    add = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = base.groupBy("suffix", "domain").agg(*add)
    suffixes = domains.groupBy("suffix").agg(*add)
    every = base.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()

    def under(children: DataFrame, parents: DataFrame, key: str) -> DataFrame:
        return children.join(parents.select(key, F.col("n").alias("parent_n"), F.col("bad").alias("parent_bad")), key)

    of_suffix = _strength(suffixes.withColumns({"parent_n": F.lit(every.n), "parent_bad": F.lit(every.bad)}), p) if every.n else p.strength[1]
    of_domain = _strength(under(domains, suffixes, "suffix"), p)
    of_host = _strength(under(base, domains, "domain"), p)

    def shrunk(strength: float, prior: Column | float) -> Column:
        return (F.col("bad") + strength * prior) / (F.col("n") + strength)

    top = (every.bad + 0.5) / (every.n + 1)  # without labels every host has this rate and none is beyond the limit
    limit = p.odds * top / (1 - top + p.odds * top)
    suffix_rates = suffixes.select("suffix", shrunk(of_suffix, top).alias("suffix_rate"))
    domain_rates = domains.join(suffix_rates, "suffix").select("domain", shrunk(of_domain, F.col("suffix_rate")).alias("domain_rate"))
    a = F.col("bad") + of_host * F.col("domain_rate")
    b = F.col("n") - F.col("bad") + of_host * (1 - F.col("domain_rate"))
    bound = a / (a + b) - p.z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return base.join(domain_rates, "domain").select("host", "n", "bad", (a / (a + b)).alias("rate"), bound.alias("bound"), (bound > limit).alias("blocked"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], outcome_key: Column, p: Reputation = Reputation()) -> DataFrame:
    """pages(page_id, url), outcomes(key, bad) -> page_id, host, path, rule, verdict.

    outcome_key: what a page's row in outcomes is found by, an expression over page_id, host and path; the worst of repeated outcomes counts.
    """
    parts = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    seen = parts.select("host", outcome_key.alias("key")).groupBy("host", "key").agg(F.count("*").alias("pages"))
    worst = outcomes.where("key is not null and bad is not null").groupBy("key").agg(F.max("bad").cast("long").alias("bad"))
    hosts = seen.join(worst, "key", "left").groupBy("host").agg(
        F.coalesce(F.sum(F.when(F.col("bad").isNotNull(), F.col("pages"))), F.lit(0)).alias("n"), F.coalesce(F.sum(F.col("pages") * F.col("bad")), F.lit(0)).alias("bad")
    )
    judged = materialize(host_reputation(hosts, p).select("host", "blocked"), "reputation")
    rule, verdict = match_rules(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("blocked"), "block").otherwise("allow")
    return parts.join(judged, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))
