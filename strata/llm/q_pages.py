"""Queries over pages: op1 (URL filter), op10 (WARC archives), and their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from strata.llm import url_reputation, warc_chain
from strata.llm.common import table

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
# a page's path starts with its language and the id of the document it shows
REFERENCE = r"^/[^/]*/([0-9]{1,18})"


def op1_url_reputation(spark, sf_dir):
    """Every page's url judged by path rules and host reputation; a page is
    bad when the document it shows is labelled of low quality."""
    judged = url_reputation.judge(
        table(spark, sf_dir, "pages").select("page_id", "url"), table(spark, sf_dir, "labels").select("doc_id", "quality"),
        rules=RULES, reference=F.regexp_extract("path", REFERENCE, 1).try_cast("long"), bad=1 - F.col("quality"))
    return judged.select("page_id", "host", "path", "rule", "verdict", F.col("n").alias("labelled"), "bad",
                         F.round("bound", 6).alias("bound"))


def _shrunk(name, units, keys, prior):
    """SQL of one level: its prior weight and posterior means."""
    return f"""{name}_rho AS (
  SELECT least(greatest(coalesce((sum(n * pow(bad / n - {prior}, 2)) - sum({prior} * (1 - {prior})))
    / nullif(sum({prior} * (1 - {prior}) * (n - 1)), 0), {url_reputation.RHO[0]}), {url_reputation.RHO[0]}), {url_reputation.RHO[1]}) AS rho
  FROM {units} WHERE n > 0
), {name} AS (
  SELECT {keys}, n, bad, (1 - rho) / rho AS weight, (bad + (1 - rho) / rho * {prior}) / (n + (1 - rho) / rho) AS {name}_mean
  FROM {units}, {name}_rho
)"""


_DOUBLE = ", ".join(f"'{s}'" for s in url_reputation.DOUBLE_SUFFIXES)
SQL_URLS = rf"""
WITH p AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
), k AS (
  SELECT doc_id AS ref, max(1 - quality) AS bad FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), h AS (
  SELECT host, count(k.bad) AS n, CAST(coalesce(sum(k.bad), 0) AS BIGINT) AS bad,
    regexp_replace(string_split(host, '@')[-1], ':[0-9]*$', '') AS site, string_split(site, '.') AS l,
    regexp_matches(site, '^([0-9]{{1,3}}\.){{3}}[0-9]{{1,3}}$') OR starts_with(site, '[') AS address,
    CASE WHEN array_to_string(l[-2:], '.') IN ({_DOUBLE}) THEN 2 ELSE 1 END AS s
  FROM p LEFT JOIN k ON k.ref = TRY_CAST(regexp_extract(path, '{REFERENCE}', 1) AS BIGINT)
  GROUP BY host
), hosts AS (
  SELECT host, n, bad, CASE WHEN address THEN site ELSE array_to_string(l[-s:], '.') END AS suffix,
    CASE WHEN address THEN site ELSE array_to_string(l[-(s + 1):], '.') END AS domain FROM h
), g AS (
  SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0) AS rate FROM hosts
), su AS (
  SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(rate) AS rate FROM hosts, g GROUP BY suffix
), {_shrunk("suffixes", "su", "suffix", "rate")}, du AS (
  SELECT hosts.suffix, hosts.domain, sum(hosts.n) AS n, sum(hosts.bad) AS bad, any_value(suffixes_mean) AS suffix_mean
  FROM hosts JOIN suffixes USING (suffix) GROUP BY hosts.suffix, hosts.domain
), {_shrunk("domains", "du", "suffix, domain", "suffix_mean")}, hu AS (
  SELECT hosts.host, hosts.n, hosts.bad, domains_mean AS domain_mean FROM hosts JOIN domains USING (suffix, domain)
), {_shrunk("rated", "hu", "host", "domain_mean")}, b AS (
  SELECT host, n, bad, rated_mean - {url_reputation.Z} * sqrt(rated_mean * (1 - rated_mean) / (n + weight + 1)) AS bound FROM rated
), r AS (
  SELECT * FROM (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
    ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')) AS v(action, rule, rh, rp)
), f AS (
  SELECT page_id, p.host, path, arg_max(rule, len(rule)) AS rule, arg_max(action, len(rule)) AS action
  FROM (SELECT row_number() OVER () AS k, * FROM p) p
  LEFT JOIN r ON (p.host = rh OR ends_with(p.host, '.' || rh)) AND starts_with(path, rp)
  GROUP BY k, page_id, p.host, path
)
SELECT page_id, f.host, path, rule, coalesce(action, CASE WHEN bound > {url_reputation.BLOCK_ABOVE} THEN 'block' ELSE 'allow' END) AS verdict,
  n AS labelled, bad, round(bound, 6) AS bound
FROM f JOIN b ON f.host = b.host
"""


def op10_warc_archive(spark, sf_dir):
    """Every page written to WARC archives and read back."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return warc_chain.archive_and_read(pages, min_bytes=0).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url")


SQL_WARC = """
WITH p AS (
  SELECT page_id, replace(replace(coalesce(url, ''), chr(13), '%0D'), chr(10), '%0A') AS url, coalesce(html, '') AS payload FROM pages
), d AS (
  SELECT *, sha1(payload) AS x, strlen(payload) AS payload_bytes, min(page_id) OVER (PARTITION BY payload) AS first_id FROM p
), r AS (
  SELECT *, CASE WHEN page_id IS NULL OR page_id <> first_id THEN first_id END AS refers_to FROM d
)
SELECT page_id, payload_bytes,
  array_to_string(list_transform(range(32), lambda j: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    ((CAST('0x' || substr(x, 5 * (j // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (j % 4))) & 31) + 1, 1)), '') AS payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to, url
FROM r
"""

QUERIES = {"op1_url_reputation": op1_url_reputation, "op10_warc_archive": op10_warc_archive}
ORACLE_SQL = {"op1_url_reputation": SQL_URLS, "op10_warc_archive": SQL_WARC}
