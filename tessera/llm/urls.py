"""URL rules: host suffixes and path prefixes against rules, by hash prefix and then full digest.

Native: DataFrame functions only. Each distinct (host, path) is expanded once, into the host
suffixes with as many labels as some rule has, and for hosts that have rules into the path
prefixes of their lengths, so a host or URL that many pages share costs no more than one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import UPPER, ascii_lower, fresh, written

#: (verdict, host, path); a host stands for itself and all subdomains, a path for all that start with it.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
PREFIX_DIGITS = 8
_PARTS = "(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; '' where url is null or has no ://."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ?, # or the end."""
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "verdict string, host string, path string")


def decide(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of those rows of urls (host, path) that a rule fits; the longest rule wins.

    A url's host suffixes are looked up first, by short hash prefix and then full digest, among the hosts that rules have;
    its path is cut only to the lengths that rules of those hosts have. So a url costs what its own rules cost, however
    many others there are.

    Rules of the same length: the one with the longer host, then block before allow. Rules with a null in any column
    or an empty host are left out; repeated rules count once; no rules give no rows.
    """
    rules = rules.filter("verdict IS NOT NULL AND host <> '' AND path IS NOT NULL").select(
        "verdict", ascii_lower(F.col("host")).alias("rule_host"), "path"
    )
    keyed = rules.select(
        "verdict", "rule_host", F.concat("rule_host", "path").alias("rule"), F.sha2(F.concat("rule_host", "path"), 256).alias("digest")
    ).distinct()
    # at most as many lengths as a path has characters, and as many labels as a host has
    hosts = rules.groupBy("rule_host").agg(F.collect_set(F.length("path")).alias("lengths"))
    hosts = hosts.withColumn("digest", F.sha2("rule_host", 256))
    found = rules.select(F.size(F.split("rule_host", "\\.")).alias("n")).distinct().orderBy("n").collect()
    labels = F.array(*(F.lit(r.n) for r in found)).cast("array<int>")

    start = lambda c: F.substring(c, 1, PREFIX_DIGITS)
    same = start(F.col("own")) == start(F.col("digest"))
    parts = F.split("host", "\\.")
    suffixes = F.transform(F.filter(labels, lambda n: n <= F.size(parts)), lambda n: F.array_join(F.slice(parts, -n, n), "."))
    made = urls.filter("host <> ''").select("host", "path", F.explode(suffixes).alias("suffix"))
    near = made.withColumn("own", F.sha2("suffix", 256)).join(hosts, same).filter("own = digest AND suffix = rule_host")
    prefixes = F.transform(
        F.filter("lengths", lambda m: m <= F.length("path")), lambda m: F.concat("suffix", F.substr("path", F.lit(1), m))
    )
    ways = near.select("host", "path", "suffix", F.explode(prefixes).alias("expression")).withColumn("own", F.sha2("expression", 256))
    hits = ways.join(keyed, same).filter("own = digest AND expression = rule AND suffix = rule_host")
    best = F.struct(F.length("rule"), F.length("rule_host"), F.col("verdict"))
    return hits.groupBy("host", "path").agg(
        F.max_by("rule", best).alias("rule"), F.max_by("verdict", best).alias("verdict")
    )


def judge(pages: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Every row of pages with host, path, rule and verdict (underscores before names that pages has).

    rule is null and the verdict ``default`` where no rule fits; so it is for null and malformed urls. Repeated rows
    are judged alike, an empty table stays empty, urls of any length are read whole.
    """
    host, path, rule, verdict = names = fresh(pages, "host", "path", "rule", "verdict")
    split = pages.withColumns({host: host_of(F.col(url_col)), path: path_of(F.col(url_col))})
    urls = split.select(F.col(host).alias("host"), F.col(path).alias("path")).distinct()
    # found grows with the pages: sorted, never broadcast; AQE splits a url of very many pages
    found = written(decide(urls, rules), "url-rules").toDF("h", "p", rule, verdict).hint("merge")
    out = split.join(found, (F.col(host) == F.col("h")) & (F.col(path) == F.col("p")), "left")
    return out.select(*pages.columns, host, path, rule, F.coalesce(F.col(verdict), F.lit(default)).alias(verdict))


def verdicts(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    return judge(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url")), rules).drop("url")


SQL = rf"""
WITH u AS (SELECT page_id, translate(coalesce(regexp_extract(url, '{_PARTS}', 1), ''), '{UPPER}', '{UPPER.lower()}') AS host,
  coalesce(regexp_extract(url, '{_PARTS}', 2), '') AS path FROM pages),
r AS (SELECT * FROM (VALUES {", ".join(map(str, RULES))}) AS t(verdict, host, path)),
m AS (SELECT u.*, r.host || r.path AS rule, r.verdict FROM u LEFT JOIN r
  ON (u.host = r.host OR ends_with(u.host, '.' || r.host)) AND starts_with(u.path, r.path))
SELECT page_id, host, path, arg_max(rule, length(rule)) AS rule, coalesce(arg_max(verdict, length(rule)), 'allow') AS verdict
FROM m GROUP BY ALL HAVING true
"""
SQL = SQL.replace("GROUP BY ALL HAVING true", "GROUP BY page_id, host, path")
