"""URL filter: rules, and else the empirical-Bayes reputation of the host.

Pages with a label teach about their host. Each level's share of bad pages is shrunk towards the
level above it - host to registered domain to suffix to all pages - through a beta prior whose
strength is estimated from how much the groups of that level differ (method of moments). A host is
blocked if the lower bound of its posterior share of bad pages is over a limit. Everything is
DataFrame expressions; counts are pre-aggregated before they are shuffled, and statistics of all
levels are small.

Defined results: a null url, or one without `://`, has empty host and path, matches no rule and is
judged like any other host, by what is known of the empty host; rows repeat as they do in the input;
an id with several labels is bad if one of them is; an empty table gives an empty result; further
columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docpool.llm import common

#: (verdict, host, path) of each rule.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Suffixes of two labels under which domains are registered.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br")
#: Block where more than this share of pages is bad, with the normal quantile Z to spare.
LIMIT, Z = 0.5, 1.645
WEAKEST, STRONGEST = 1.0, 1000.0
#: Bytes of blocked hosts that are broadcast; beyond, Spark joins by host and splits a host with very many pages.
MOST_BYTES = 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.regexp_extract(host, r"([^.]*)$", 1))


def domain_of(host: Column) -> Column:
    three = F.regexp_extract(host, r"([^.]+\.[^.]+\.[^.]+)$", 1)
    two = F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1)
    return F.when(two.isin(*LONG_SUFFIXES) & (three != ""), three).when(two != "", two).otherwise(host)


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; nulls where none does."""
    text = verdict = F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        text, verdict = F.when(fits, rule_host + rule_path).otherwise(text), F.when(fits, kind).otherwise(verdict)
    return text, verdict


def strength(groups: DataFrame) -> DataFrame:
    """One row, k: the prior's strength, from groups (n, bad)."""
    sums = groups.agg(F.sum("n").alias("sn"), F.sum("bad").alias("sb"), F.sum(F.col("n") * F.col("n")).alias("snn"), F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("sq"), F.count("*").alias("g"))
    p = F.col("sb") / F.col("sn")
    within = (F.col("g") - 1) * p * (1 - p)
    between = (F.col("sq") - F.col("sn") * p * p - within) / (F.col("sn") - F.col("snn") / F.col("sn"))
    k = F.when((F.col("g") > 1) & (F.col("snn") < F.col("sn") * F.col("sn")) & (between > 0), p * (1 - p) / between - 1).otherwise(F.lit(STRONGEST))
    return sums.select(F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), F.coalesce(k, F.lit(STRONGEST)))).alias("k"))


def reputations(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """host, n, bad, mean and lower bound of each host of pages (page_id, url).

    outcomes: (page_id, bad), bad being 0 or 1.
    """
    known = outcomes.where("page_id is not null and bad is not null").groupBy("page_id").agg(F.max("bad").alias("bad"))
    named = pages.select("page_id", host_of(F.col("url")).alias("host"))
    hosts = named.join(known, "page_id", "left").groupBy("host").agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("bad"))
    hosts = hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    whole = suffixes.agg(((F.sum("bad") + 1) / (F.sum("n") + 2)).alias("p"))

    def shrunk(groups: DataFrame, prior: DataFrame, on: list[str]) -> DataFrame:
        """groups with their prior's mean p, and their own m. One-row tables are joined by constants."""
        one = strength(groups.where("n > 0")).withColumn("one", F.lit(1))
        joined = groups.withColumn("one", F.lit(1)).join(F.broadcast(one), "one")
        joined = joined.join(prior, on) if on else joined.join(F.broadcast(prior.withColumn("one", F.lit(1))), "one")
        return joined.withColumn("m", (F.col("bad") + F.col("k") * F.col("p")) / (F.col("n") + F.col("k")))

    by_suffix = shrunk(suffixes, whole, []).select("suffix", F.col("m").alias("p"))
    by_domain = shrunk(domains, by_suffix, ["suffix"]).select("domain", "suffix", F.col("m").alias("p"))
    by_host = shrunk(hosts, by_domain, ["domain", "suffix"])
    a, b = F.col("bad") + F.col("k") * F.col("p"), F.col("n") - F.col("bad") + F.col("k") * (1 - F.col("p"))
    return by_host.select("host", "n", "bad", F.col("m").alias("mean"), (a / (a + b) - Z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))).alias("lower"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]] = RULES, limit: float = LIMIT) -> DataFrame:
    """page_id, host, path, rule and verdict of every row of pages (page_id, url)."""
    pages = pages.select("page_id", "url")
    blocked = common.written(reputations(pages, outcomes).where(F.col("lower") > limit).select("host", F.lit(True).alias("bad_host")), "blocked-hosts")
    size = blocked.agg(F.sum(F.octet_length("host") + 16)).first()[0] or 0
    blocked = F.broadcast(blocked) if size <= MOST_BYTES else blocked
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    judged = parts.join(blocked, "host", "left")
    return judged.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(F.col("bad_host"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"))


def page_outcomes(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(page_id, bad) from labels: bad if toxic or of low quality. A label whose id_col equals a page_id is that page's.

    The given tables have no other key between labels and pages; who has one passes outcomes made by it.
    """
    return labels.select(F.col(id_col).alias("page_id"), ((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)).cast("int").alias("bad"))


#: The same query for DuckDB over views pages and labels.
ORACLE_SQL = """
WITH parts AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
known AS (
  SELECT doc_id AS page_id, max(CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
hosts AS (
  SELECT host, count(bad)::DOUBLE AS n, coalesce(sum(bad), 0)::DOUBLE AS bad,
         regexp_extract(host, '([^.]+\\.[^.]+)$', 1) AS two,
         regexp_extract(host, '([^.]+\\.[^.]+\\.[^.]+)$', 1) AS three
  FROM parts LEFT JOIN known USING (page_id) GROUP BY host),
named AS (
  SELECT *, two IN ('co.uk', 'org.uk', 'ac.uk', 'com.au', 'co.jp', 'com.br') AS long,
         CASE WHEN long AND three <> '' THEN three WHEN two <> '' THEN two ELSE host END AS domain,
         CASE WHEN long THEN two ELSE regexp_extract(host, '([^.]*)$', 1) END AS suffix
  FROM hosts),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM named GROUP BY domain, suffix),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
levels AS (
  SELECT 'h' AS level, n, bad FROM named WHERE n > 0 UNION ALL
  SELECT 'd', n, bad FROM domains WHERE n > 0 UNION ALL
  SELECT 's', n, bad FROM suffixes WHERE n > 0),
sums AS (
  SELECT level, sum(n) AS sn, sum(bad) AS sb, sum(n * n) AS snn, sum(bad * bad / n) AS sq, count(*) AS g, sum(bad) / sum(n) AS p
  FROM levels GROUP BY level),
spread AS (
  SELECT *, CASE WHEN g > 1 AND snn < sn * sn THEN (sq - sn * p * p - (g - 1) * p * (1 - p)) / (sn - snn / sn) END AS between_groups FROM sums),
ks AS (
  SELECT level, greatest(1.0, least(1000.0, coalesce(CASE WHEN between_groups > 0 THEN p * (1 - p) / between_groups - 1 ELSE 1000.0 END, 1000.0))) AS k FROM spread),
k3 AS (
  SELECT coalesce(max(k) FILTER (level = 'h'), 1000.0) AS kh, coalesce(max(k) FILTER (level = 'd'), 1000.0) AS kd, coalesce(max(k) FILTER (level = 's'), 1000.0) AS ks FROM ks),
whole AS (SELECT (sum(bad) + 1) / (sum(n) + 2) AS p FROM suffixes),
ms AS (SELECT suffix, (s.bad + ks * p) / (s.n + ks) AS p FROM suffixes s, k3, whole),
md AS (SELECT d.domain, d.suffix, (d.bad + kd * ms.p) / (d.n + kd) AS p FROM domains d JOIN ms USING (suffix), k3),
post AS (SELECT host, h.bad + kh * md.p AS a, h.n - h.bad + kh * (1 - md.p) AS b FROM named h JOIN md USING (domain, suffix), k3),
blocked AS (SELECT host FROM post WHERE a / (a + b) - 1.645 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.5),
ruled AS (
  SELECT parts.*, CASE
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow'
            WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""
