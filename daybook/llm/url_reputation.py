"""URL filters: rules first, then an empirical-Bayes reputation of hosts.

Labelled page outcomes are counted per host, registered domain and suffix. Each level's rate of good
pages is shrunk towards the level above by a beta-binomial prior whose strength is estimated from
the spread between that level's units; a host without labels takes what its domain and suffix say. A
page is blocked where the upper bound of its host's posterior rate lies below a floor.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verdict, host and path; a rule fits its host with all subdomains, and paths that start with its path.
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
#: A host goes if its rate of good pages is below FLOOR even at BOUND standard deviations above the mean.
FLOOR, BOUND = 0.7, 1.64
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty if it is null or has no ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    rest = F.substring(after, F.length(host) + 1, F.length(after) + 1)
    return F.translate(host, _UPPER, _LOWER), F.regexp_extract(rest, "^[^?#]*", 0)


def _rule(host: Column, path: Column, rules, value) -> Column:
    """``value`` of the longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for verdict, name, start in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1:])):
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        found = F.when(fits, F.lit(value(verdict, name, start))).otherwise(found)
    return found


def _strengths(units: DataFrame) -> dict[str, float]:
    """Prior strength of each level from the spread between its units, by analysis of variance.

    ``units`` has level, n and good; what comes to the driver is one row for each of three levels.
    """
    found = {}
    for r in units.groupBy("level").agg(
            F.count("*").alias("k"), F.sum("n").alias("t"), F.sum("good").alias("g"),
            F.sum(F.col("n").cast("double") * F.col("n")).alias("nn"),
            F.sum(F.col("good").cast("double") * F.col("good") / F.col("n")).alias("gg")).collect():
        found[r.level] = 10.0  # without a second unit or repeated outcomes nothing can be told: weak pooling
        if r.k > 1 and r.t > r.k:
            between, within = (r.gg - r.g * r.g / r.t) / (r.k - 1), (r.g - r.gg) / (r.t - r.k)
            whole = between + ((r.t - r.nn / r.t) / (r.k - 1) - 1) * within
            if whole > 0:
                share = (between - within) / whole
                found[r.level] = 999.0 if share <= 0.001 else max(1 / share - 1, 1.0)
    return found


def reputation(outcomes: DataFrame, hosts: DataFrame, bound: float = BOUND) -> DataFrame:
    """(host, good_rate, upper) for every distinct host of ``hosts``.

    ``outcomes`` has host and good (0 or 1). The registered domain is the last two labels of a host,
    the suffix the last one. Without outcomes the rate is 1/2 in all places.
    """
    domain, suffix = F.substring_index("host", ".", -2), F.substring_index("host", ".", -1)
    seen = (outcomes.where("host is not null and good is not null").groupBy("host")
            .agg(F.count("*").alias("n"), F.sum("good").alias("good"))
            .withColumn("domain", domain).withColumn("suffix", suffix))
    per_domain = seen.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    per_suffix = per_domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    units = None
    for level, df in (("host", seen), ("domain", per_domain), ("suffix", per_suffix)):
        part = df.select(F.lit(level).alias("level"), "n", "good")
        units = part if units is None else units.unionByName(part)
    strength = _strengths(units)
    total = per_suffix.agg(F.sum("good"), F.sum("n")).first()
    rate = F.lit(((total[0] or 0) + 1) / ((total[1] or 0) + 2))

    def counts(df: DataFrame, name: str) -> DataFrame:
        return df.select(name, F.col("n").alias(f"n_{name}"), F.col("good").alias(f"g_{name}"))

    wanted = hosts.select("host").distinct().withColumn("domain", domain).withColumn("suffix", suffix)
    all_ = (wanted.join(counts(per_suffix, "suffix"), "suffix", "left").join(counts(per_domain, "domain"), "domain", "left")
            .join(counts(seen, "host"), "host", "left"))
    n, g = (lambda c: F.coalesce(f"n_{c}", F.lit(0))), (lambda c: F.coalesce(f"g_{c}", F.lit(0)))
    for name in ("suffix", "domain"):
        k = F.lit(strength.get(name, 10.0))
        rate = (g(name) + k * rate) / (n(name) + k)
    k = F.lit(strength.get("host", 10.0))
    good, bad = g("host") + k * rate, n("host") - g("host") + k * (1 - rate)
    found = all_.select("host", good.alias("a"), bad.alias("b"))
    mean, total = F.col("a") / (F.col("a") + F.col("b")), F.col("a") + F.col("b")
    spread = F.sqrt(mean * (1 - mean) / (total + 1))
    return found.select("host", mean.alias("good_rate"), (mean + bound * spread).alias("upper"))


def verdicts(pages: DataFrame, outcomes: DataFrame, rules=RULES, floor: float = FLOOR,
             bound: float = BOUND) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, good_rate.

    ``outcomes`` has page_id and good (0 or 1, null: unknown), one row per page; more rows of one
    page count as the worst of them. A rule that fits decides (the longest wins); else the host's
    reputation does. Urls that are null or have no ``://`` have an empty host and path, and are
    judged as one host. Repeated pages are judged each for itself; other columns are not looked at.
    """
    host, path = split(F.col("url"))
    slim = pages.select("page_id", host.alias("host"), path.alias("path"))
    worst = outcomes.where("good is not null").groupBy("page_id").agg(F.min("good").alias("good"))
    rated = reputation(slim.join(worst, "page_id"), slim, bound)
    rule = lambda value: _rule(F.col("host"), F.col("path"), rules, value)
    return slim.join(rated, "host", "left").select(
        "page_id", "host", "path", rule(lambda v, h, p: h + p).alias("rule"),
        F.coalesce(rule(lambda v, h, p: v), F.when(F.col("upper") < floor, "block").otherwise("allow")).alias("verdict"),
        F.round("good_rate", 6).alias("good_rate"))
