"""Operator 6: URL filter by rules and by empirical-Bayes host reputation.

Rules block or allow a host with its subdomains below a path prefix; the longest that fits decides.  What rules decide
are the labelled page outcomes (block: 1, allow: 0) from which hosts without a fitting rule are judged: a host's bad
rate is shrunk by a beta-binomial prior whose mean is its registered domain's shrunk rate, which in turn is shrunk to
its suffix's, and that to the rate of all labelled pages.  The priors' strength is estimated from the spread of the
hosts' rates (method of moments).  A page is blocked when the lower bound of its host's bad rate, a quantile of the beta
posterior, is over a threshold, so hosts about which little is known stay allowed unless their domain or suffix is bad.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is judged as the host
''.  Without labelled pages every page is allowed.  Equal urls get equal verdicts; an empty table gives an empty one;
input columns named like output columns are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    verdict: str  # block or allow
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


#: A suffix has two labels where the last is a country's (two letters) and the one before names a kind of registrant.
KINDS = ("ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "id", "ltd", "me", "mil", "ne", "net", "nom", "or", "org", "plc", "sch")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host with A-Z lower-cased, and path; both empty where the url is null or has no ``://``."""
    rest = F.when(url.contains("://"), F.substring(url, F.instr(url, "://") + F.lit(3), F.length(url)))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + F.lit(1), F.length(rest)), r"^[^?#]*", 0)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.coalesce(F.translate(host, letters, letters.lower()), F.lit("")), F.coalesce(path, F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as a struct of rule and verdict, or null; of equally long ones the first given."""
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for r in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        chosen = F.when(fits, F.struct(F.lit(r.text).alias("rule"), F.lit(r.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def suffix_and_domain(host: Column) -> tuple[Column, Column]:
    labels = F.split(F.regexp_replace(host, r":\d*$", ""), r"\.")
    n = F.size(labels)
    last = lambda k: F.array_join(F.slice(labels, F.greatest(n - k + 1, F.lit(1)), k), ".")
    long = (n > 1) & (F.length(last(1)) == 2) & F.element_at(labels, F.when(n > 1, -2).otherwise(-1)).isin(*KINDS)
    return F.when(long, last(2)).otherwise(last(1)), F.when(long, last(3)).otherwise(last(2))


def prior_strength(hosts: DataFrame, mean: float) -> float:
    """Pseudo-counts of the beta prior: by moments from the spread of labelled hosts' rates, between 1 and 1000."""
    row = hosts.where("n > 0").agg(F.count("*").alias("k"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"), F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - mean, 2)).alias("s")).first()
    if not row.k or row.k < 2 or not 0 < mean < 1 or (spare := row.n - row.nn / row.n) <= 0:
        return 10.0
    rho = (row.s / (mean * (1 - mean)) - (row.k - 1)) / (spare - (row.k - 1)) if spare > row.k - 1 else 1.0
    return min(1000.0, max(1.0, (1 - rho) / rho)) if rho > 0 else 1000.0


def beta_fraction(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The continued fraction of the regularised incomplete beta function, for x below (a + 1) / (a + b + 2)."""
    tiny = 1e-300
    c, d = np.ones_like(x), 1 / np.maximum(np.abs(1 - (a + b) * x / (a + 1)), tiny)
    out = d.copy()
    for m in range(1, 400):
        for top in (m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)), -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))):
            d = 1 + top * d
            d = 1 / np.where(np.abs(d) < tiny, tiny, d)
            c = 1 + top / c
            c = np.where(np.abs(c) < tiny, tiny, c)
            out = out * d * c
        if np.all(np.abs(d * c - 1) < 1e-14):
            break
    return out


def beta_cdf(x: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """P(rate <= x) of beta distributions."""
    log_gamma = np.vectorize(math.lgamma, otypes=[float])
    x = np.clip(x, 1e-300, 1 - 1e-16)
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    front = np.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + p * np.log(y) + q * np.log1p(-y)) / p
    part = front * beta_fraction(y, p, q)
    return np.where(swap, 1 - part, part)


def beta_quantile(level: float, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    low, high = np.zeros_like(a), np.ones_like(a)
    for _ in range(50):
        middle = (low + high) / 2
        below = beta_cdf(middle, a, b) < level
        low, high = np.where(below, middle, low), np.where(below, high, middle)
    return (low + high) / 2


def quantile_column(a: Column, b: Column, level: float) -> Column:
    """The quantile of a beta distribution; 0 and 1 stand for distributions at one end."""

    @F.arrow_udf("double")
    def quantile(a: pa.Array, b: pa.Array) -> pa.Array:
        x, y = (c.to_numpy(zero_copy_only=False).astype(float) for c in (a, b))
        out = np.where(x <= 0, 0.0, 1.0)
        inside = (x > 0) & (y > 0)
        out[inside] = beta_quantile(level, x[inside], y[inside])
        return pa.array(out)

    return quantile(a, b)


def host_reputations(labelled: DataFrame, *, level: float = 0.05) -> DataFrame:
    """host, n, bad, the posterior's mean, and its ``level`` quantiles from below and above, of each host.

    ``labelled``: host and outcome (1 bad, 0 good, null unknown) of each page.  Counts are summed before any shuffle,
    so a host with a large share of the pages is one row per task there; domains and suffixes are summed from hosts.
    """
    hosts = labelled.groupBy("host").agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).cast("long").alias("bad"))
    suffix, domain = suffix_and_domain(F.col("host"))
    hosts = hosts.withColumns({"suffix": suffix, "domain": domain})
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    if not total.n:
        return hosts.select("host", "n", "bad", *(F.lit(0.0).alias(c) for c in ("mean", "lower", "upper")))
    mean = total.bad / total.n
    kappa = prior_strength(hosts, mean)
    shrunk = lambda prior: (F.col("bad") + kappa * prior) / (F.col("n") + kappa)
    sums = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = hosts.groupBy("suffix").agg(*sums).select("suffix", shrunk(F.lit(mean)).alias("suffix_rate"))
    domains = hosts.groupBy("suffix", "domain").agg(*sums).join(suffixes, "suffix").select("domain", shrunk(F.col("suffix_rate")).alias("domain_rate"))
    posterior = hosts.join(domains, "domain").withColumns({"a": F.col("bad") + kappa * F.col("domain_rate"), "b": F.col("n") - F.col("bad") + kappa * (1 - F.col("domain_rate"))})
    bound = lambda q: quantile_column(F.col("a"), F.col("b"), q)
    return posterior.select("host", "n", "bad", (F.col("a") / (F.col("a") + F.col("b"))).alias("mean"), bound(level).alias("lower"), bound(1 - level).alias("upper"))


def judge_urls(pages: DataFrame, rules: Sequence[Rule], *, url: str = "url", threshold: float = 0.5) -> DataFrame:
    """The rows with host, path, rule and verdict, and the host's posterior lower bound."""
    host, path = host_and_path(F.col(url))
    judged = pages.drop("host", "path", "rule", "verdict", "lower").withColumns({"host": host, "path": path})
    judged = judged.withColumn("_fit", fitting_rule(F.col("host"), F.col("path"), rules))
    outcome = F.when(F.col("_fit.verdict") == "block", 1).when(F.col("_fit.verdict") == "allow", 0)
    reputations = host_reputations(judged.select("host", outcome.alias("outcome"))).select("host", "lower")
    verdict = F.coalesce(F.col("_fit.verdict"), F.when(F.col("lower") > threshold, "block").otherwise("allow"))
    return judged.join(reputations, "host").withColumns({"rule": F.col("_fit.rule"), "verdict": verdict}).drop("_fit")
