"""URL filters: explicit rules, and empirical-Bayes reputation of hosts. DataFrame functions only."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from installarc.llm.common import fresh, lower_ascii, stage_for

#: Common public suffixes of two labels; any other last label is a suffix by itself.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "co.za", "com.cn")

#: Fixed value: trial values of the likeness in a row.
TRIALS = 33


@dataclass(frozen=True)
class Rule:
    """A verdict for a host, its subdomains and every path that starts with ``path``."""

    verdict: str
    host: str
    path: str


@dataclass(frozen=True)
class Prior:
    """Settings of the shrinkage.

    A host is blocked when even the low end of its bad share, ``z`` posterior deviations under the
    mean, is above ``max_bad``. ``likeness`` bounds the estimated correlation of outcomes within a
    group; ``likeness_unknown`` stands in where no group has two outcomes.
    """

    max_bad: float = 0.5
    z: float = 1.645
    likeness: tuple[float, float] = (0.0001, 0.5)
    likeness_unknown: float = 0.1


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), "^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3))


def _site(host: Column) -> Column:
    """The host without user and port."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def registered_domain(host: Column) -> Column:
    """The label before the public suffix, and the suffix; an address of digits as it is."""
    two = F.substring_index(host, ".", -2)
    domain = F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)
    return F.when(host.rlike("^[0-9.]*$"), host).otherwise(domain)


def public_suffix(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    last = F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))
    return F.when(host.rlike("^[0-9.]*$"), F.lit("")).otherwise(last)


def _log_gamma(x: Column) -> Column:
    """For x > 0, by Stirling's series at x + 8; within 1e-9 besides rounding."""
    y, below = x + 8, x
    for k in range(1, 8):
        below = below * (x + k)
    series = 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(below)


def _likeness(groups: DataFrame, prior: Prior) -> float:
    """The correlation of outcomes within groups under which the counts of all groups are likeliest.

    Beta-binomial likelihood, summed over the groups for a row of trial values at once, then for a finer row around
    the best one. However many outcomes a group has, it adds about the logarithm of their number at most for
    agreeing with its parent, so one large group can't settle the value for all.
    """
    told = groups.filter((F.col("n") > 1) & F.col("parent_mean").between(1e-12, 1 - 1e-12))
    told = told.groupBy("n", "bad", "parent_mean").agg(F.count(F.lit(1)).alias("times"))
    (low, high), best = prior.likeness, None
    for _ in range(2):
        trials = [low * (high / low) ** (k / (TRIALS - 1)) for k in range(TRIALS)]
        tried = told.withColumn("trial", F.explode(F.array(*[F.lit(k) for k in range(TRIALS)])))
        weight = 1 / F.element_at(F.array(*[F.lit(x) for x in trials]), F.col("trial") + 1) - 1
        tried = tried.withColumn("w", weight).withColumn("a", F.col("w") * F.col("parent_mean"))
        a, w, n, bad = (F.col(c) for c in ("a", "w", "n", "bad"))
        ups = [(bad + a, 1), (a, -1), (n - bad + w - a, 1), (w - a, -1), (n + w, -1), (w, 1)]
        log_likelihood = sum((_log_gamma(x) * sign for x, sign in ups), F.lit(0.0))
        rows = tried.groupBy("trial").agg(F.sum(log_likelihood * F.col("times")).alias("log")).collect()
        if not rows:
            return prior.likeness_unknown
        at = max(rows, key=lambda r: (round(r["log"], 6), -r["trial"]))["trial"]
        best, low, high = trials[at], trials[max(at - 1, 0)], trials[min(at + 1, TRIALS - 1)]
    return best


def _shrunk(groups: DataFrame, prior: Prior) -> DataFrame:
    """Posterior of each group's bad share under a beta prior around its parent's mean.

    In: ``n``, ``bad``, ``parent_mean``. The prior's weight fits all groups of the level: outcomes as alike within
    groups as the counts show. Adds ``mean`` and ``sd``.
    """
    n, bad, m = F.col("n"), F.col("bad"), F.col("parent_mean")
    alike = _likeness(groups, prior)
    weight = 1.0 / alike - 1.0
    mean = (F.lit(weight) * m + bad) / (F.lit(weight) + n)
    return groups.withColumn("mean", mean).withColumn(
        "sd", F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.lit(weight) + n + 1))
    )


def host_reputation(hosts: DataFrame, prior: Prior = Prior()) -> DataFrame:
    """Adds the posterior ``mean``, ``sd`` and ``low`` bound of the bad share to rows of (host, n, bad).

    ``n`` labelled pages of a host, ``bad`` of them bad. Suffixes shrink to the share of all pages,
    registered domains to their suffix, hosts to their registered domain. A host without labels has its domain's mean
    with the prior's deviation.
    """
    site = _site(F.col("host"))
    placed = hosts.withColumn("domain", registered_domain(site)).withColumn("suffix", public_suffix(site))
    total = placed.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    root = ((total["bad"] or 0) + 1.0) / ((total["n"] or 0) + 2.0)

    def summed(*keys: str) -> DataFrame:
        return placed.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    suffixes = _shrunk(summed("suffix").withColumn("parent_mean", F.lit(root)), prior)
    suffixes = suffixes.select("suffix", F.col("mean").alias("parent_mean"))
    domains = _shrunk(summed("suffix", "domain").join(suffixes, "suffix"), prior)
    domains = domains.select("domain", "suffix", F.col("mean").alias("parent_mean"))
    return _shrunk(placed.join(domains, ["domain", "suffix"]), prior).withColumn(
        "low", F.col("mean") - F.lit(prior.z) * F.col("sd")
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    prior: Prior = Prior(),
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """Adds ``host``, ``path``, ``rule``, ``verdict``, ``basis`` and ``bad_low`` to every page.

    ``outcomes`` holds (page_id, bad 0/1) of labelled pages; of several outcomes of a page the worst counts, NULLs do not.
    The longest rule that fits (ties: block) gives the verdict; else the host's reputation: block if the lower
    posterior bound of its bad share is above ``prior.max_bad``.

    A NULL url, or one without ``://``, has an empty host and path; empty hosts share one
    reputation. Repeated rows are judged one by one. Empty tables give an empty result.
    Columns called like the added ones are replaced.
    """
    stage = stage_for(pages)
    added = ["host", "path", "rule", "verdict", "basis", "bad_low"]
    kept = [c for c in pages.columns if c.lower() not in added]
    parsed = pages.select(*kept, url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    labelled, bad, own, fit, low = (fresh(f"_{name}", pages.columns) for name in ("labelled", "bad", "own_host", "fit", "low"))
    known = (
        outcomes.filter(F.col(page_id).isNotNull() & F.col("bad").isNotNull())
        .groupBy(F.col(page_id).alias(labelled))
        .agg(F.max(F.col("bad").cast("long")).alias(bad))
    )
    hosts = stage(
        parsed.select(page_id, "host")
        .join(known, F.col(page_id) == F.col(labelled), "left")
        .groupBy("host")
        .agg(F.count(bad).alias("n"), F.coalesce(F.sum(bad), F.lit(0)).alias("bad"))
    )
    fits = [
        F.when(
            ((F.col("host") == r.host) | F.col("host").endswith("." + r.host)) & F.col("path").startswith(r.path),
            F.struct(
                F.lit(len(r.host + r.path)).alias("length"),
                F.lit(r.verdict).alias("verdict"),
                F.lit(r.host + r.path).alias("rule"),
            ),
        )
        for r in rules
    ]
    best = F.array_max(F.array(*fits)) if fits else F.lit(None).cast("struct<length:int,verdict:string,rule:string>")
    judged = host_reputation(hosts, prior).select(F.col("host").alias(own), F.col("low").alias(low))
    by_host = F.when(F.col(low) > prior.max_bad, "block").otherwise("allow")
    return (
        parsed.join(judged, F.col("host") == F.col(own))
        .withColumn(fit, best)
        .select(
            *kept,
            "host",
            "path",
            F.col(fit)["rule"].alias("rule"),
            F.coalesce(F.col(fit)["verdict"], by_host).alias("verdict"),
            F.when(F.col(fit).isNull(), "reputation").otherwise("rule").alias("basis"),
            F.col(low).alias("bad_low"),
        )
    )
