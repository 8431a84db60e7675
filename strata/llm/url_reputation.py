"""URL filter by empirical-Bayes host reputation, with path rules on top.

Labelled page outcomes (bad or not) are counted by host, registered domain
and suffix. Each level's rates are beta-binomial around the posterior mean of
the level above (the suffixes around the overall rate); how far units of a
level scatter (their intra-class correlation rho, prior weight
(1 - rho) / rho) is estimated by moments from all units of that level. A host
is blocked when the lower bound of its posterior bad rate (mean less
``Z`` standard deviations) is above ``BLOCK_ABOVE``: a host with few labels
stays near its domain and is blocked only if that is bad beyond doubt.

Path rules come first: a rule (host/path) fits its host and all subdomains
when the path starts with the rule's; the longest fitting rule decides.

Pages are reduced to (host, reference) counts before any join; the host table
has one row per host and is broadcast only when its count is within the
bound, else the join is a shuffle join whose skewed partitions AQE splits.

Suffix and domain are those of the host's name, without user info and port;
an IP address is a suffix of its own. Suffixes of two labels are a list
(``double_suffixes``); any other host is taken to be registered under its last
label. Hosts that differ in port are judged as hosts of one domain.

Defined cases: a null url, or one without ``://``, has an empty host and path
and belongs to the host ''; a host without labels has its domain's posterior;
several labels of one id count as bad when one does; without any label the
rate is 0 and nothing is blocked; repeated rows are judged row by row; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import Scratch, ascii_lower, hint_if_small, stage

Z = 1.645
BLOCK_ABOVE = 0.4
RHO = (0.001, 0.5)         # bounds of the estimated correlation

# Suffixes of two labels under which domains are registered, by
# country; ``judge`` takes any other list.
_SECOND_LEVEL = {
    "ar": "com edu gob net org", "au": "com edu gov net org", "br": "com edu gov net org", "cn": "ac com edu gov net org",
    "hk": "com edu gov net org", "id": "ac co go or", "il": "ac co gov org", "in": "ac co gov net org", "jp": "ac co go ne or",
    "kr": "ac co go or", "mx": "com edu gob org", "my": "com edu gov net org", "nz": "ac co govt net org", "ph": "com edu gov net org",
    "pk": "com edu gov net org", "pl": "com edu gov net org", "sg": "com edu gov net org", "th": "ac co go or", "tr": "com edu gov net org",
    "tw": "com edu gov net org", "ua": "com edu gov net org", "uk": "ac co gov ltd me net org plc", "za": "ac co gov net org"}
DOUBLE_SUFFIXES = tuple(f"{second}.{country}" for country, seconds in _SECOND_LEVEL.items() for second in seconds.split())


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_of(host: Column) -> Column:
    """The host's name: without user info (up to the last ``@``) and port."""
    return F.regexp_replace(F.substring_index(host, "@", -1), r":[0-9]*$", "")


def _is_address(site: Column) -> Column:
    return site.rlike(r"^([0-9]{1,3}\.){3}[0-9]{1,3}$") | site.startswith("[")


def suffix_of(site: Column, double=DOUBLE_SUFFIXES) -> Column:
    """The suffix under which a name is registered; an address is its own."""
    return (F.when(_is_address(site), site).when(F.substring_index(site, ".", -2).isin(*double), F.substring_index(site, ".", -2))
            .otherwise(F.substring_index(site, ".", -1)))


def domain_of(site: Column, double=DOUBLE_SUFFIXES) -> Column:
    return (F.when(_is_address(site), site).when(F.substring_index(site, ".", -2).isin(*double), F.substring_index(site, ".", -3))
            .otherwise(F.substring_index(site, ".", -2)))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule string, verdict) of the longest fitting rule, else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        at, slash, rest = text.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(slash + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(action)).otherwise(verdict)
    return rule, verdict


def _correlation(units: DataFrame, mean: Column) -> float:
    """Moment estimate of rho over units (n, bad) scattered around ``mean``."""
    spread = mean * (1 - mean)
    row = units.filter("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - mean, 2)).alias("s"),
        F.sum(spread).alias("e"), F.sum(spread * (F.col("n") - 1)).alias("w")).first()
    rho = (row["s"] - row["e"]) / row["w"] if row["w"] else RHO[0]
    return min(max(rho, RHO[0]), RHO[1])


def reputation(outcomes: DataFrame, scratch: Scratch, double_suffixes=DOUBLE_SUFFIXES) -> DataFrame:
    """``outcomes`` (host, n, bad), one row per host -> host, n, bad, mean,
    bound (of the posterior bad rate)."""
    site = site_of(F.col("host"))
    hosts = scratch.stage(outcomes.withColumns({"domain": domain_of(site, double_suffixes), "suffix": suffix_of(site, double_suffixes)}), "url-hosts")
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    rate = F.lit((total["bad"] or 0) / total["n"] if total["n"] else 0.0)
    sums = lambda df, *keys: df.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def shrink(units: DataFrame, prior: Column, name: str) -> tuple[DataFrame, float]:
        rho = _correlation(units, prior)
        weight = (1 - rho) / rho
        return units.withColumn(name, (F.col("bad") + weight * prior) / (F.col("n") + weight)), weight

    suffixes, _ = shrink(sums(hosts, "suffix"), rate, "suffix_mean")
    suffixes = scratch.stage(suffixes.select("suffix", "suffix_mean"), "url-suffixes")
    domains = scratch.stage(sums(hosts, "suffix", "domain").join(suffixes, "suffix"), "url-domains")
    domains, _ = shrink(domains, F.col("suffix_mean"), "domain_mean")
    hosts = scratch.stage(hosts.join(domains.select("suffix", "domain", "domain_mean"), ["suffix", "domain"]), "url-hosts")
    rated, weight = shrink(hosts, F.col("domain_mean"), "mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + weight + 1))
    return rated.select("host", "n", "bad", "mean", (F.col("mean") - Z * deviation).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, *, rules: list[tuple[str, str]], reference: Column, id_col="page_id",
          url_col="url", label_id="doc_id", bad: Column, block_above: float = BLOCK_ABOVE, double_suffixes=DOUBLE_SUFFIXES) -> DataFrame:
    """page_id, host, path, rule, verdict, n, bad, bound of every page.

    ``reference`` reads the labelled id from a page's path; ``bad`` (0 / 1,
    null: no label) reads a label row's outcome.
    """
    rows = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    known = labels.select(F.col(label_id).cast("long").alias("ref"), bad.cast("long").alias("bad")).dropna()
    known = known.groupBy("ref").agg(F.max("bad").alias("bad"))
    seen = rows.select("host", reference.alias("ref")).groupBy("host", "ref").agg(F.count(F.lit(1)).alias("pages"))
    outcomes = (seen.join(known, "ref", "left").groupBy("host")
                .agg(F.sum(F.when(F.col("bad").isNotNull(), F.col("pages")).otherwise(F.lit(0))).alias("n"),
                     F.sum(F.coalesce(F.col("bad") * F.col("pages"), F.lit(0))).alias("bad")))
    scratch = Scratch()
    rated, _ = stage(reputation(outcomes, scratch, double_suffixes), "url-rated")
    scratch.drop(pages.sparkSession)
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    verdict = F.coalesce(by_rule, F.when(F.col("bound") > block_above, F.lit("block")).otherwise(F.lit("allow")))
    return (rows.join(hint_if_small(rated, rated.count()), "host")
            .select("page_id", "host", "path", rule.alias("rule"), verdict.alias("verdict"), "n", "bad", "bound"))
