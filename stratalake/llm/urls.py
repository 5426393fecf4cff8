"""URL filter: policy rules first, else the host's reputation, all in DataFrame operations.

A rule ``host/path`` fits the host and its subdomains if the url's path starts with
the rule's path; the longest rule that fits decides.

Else the verdict is by an empirical-Bayes estimate of how many pages of the host
are good. Pages with a label (good: quality 1, not toxic) are counted per host,
registered domain and suffix. The rate of each is a beta-binomial estimate whose prior
is the estimate one step up: suffix under all pages, domain under suffix, host under
domain. How strongly a step holds to its prior is measured on the data, by the method of
moments (the overdispersion of the rates around their priors). A host is blocked if the
upper posterior bound of its rate, ``Z`` standard deviations above the mean, is under
``GOOD``; without a label it stands on its domain's estimate, and so on up.

Null urls, and urls without ``://``, have an empty host and path; an empty host fits
no rule and is blocked, as there is nothing to judge by. Null page ids have no label;
a page repeated as a whole is judged each time and counted each time; a page with
several labels is good if all of them are. The counts are summed before each shuffle,
and the join back to the pages has plain exchanges on both sides, which Spark splits at
a host that holds a large part of them. Other columns are ignored.
"""

from __future__ import annotations

import string
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratalake.sources.staging import stage

RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")]
# Suffixes of more than one label that are registered under, as far as not of the form "x.y" itself.
LONG_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz", "co.za"]
GOOD = 0.5
Z = 1.645
LEAST_RHO, MOST_RHO = 0.001, 0.999


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(url, instr(url, '://') + 3)")).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def rule_for(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule that fits, or null."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        domain, slash, start = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit(f".{domain}"))) & F.startswith(path, F.lit(slash + start))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def domain_and_suffix(host: Column, long_suffixes: list[str]) -> tuple[Column, Column]:
    """Registered domain and suffix; a host that is a suffix is its own domain."""
    long = reduce(lambda a, s: a | F.endswith(host, F.lit(f".{s}")), long_suffixes, F.lit(False))
    one, two, three = (F.substring_index(host, ".", -n) for n in (1, 2, 3))
    return F.when(long, three).otherwise(two), F.when(long, two).otherwise(one)


def _step(rates: DataFrame, key: str, prior: str, out: str) -> DataFrame:
    """Adds ``out``: the rate of each row (``n`` labels, ``good`` of them) shrunk to ``prior``; keeps ``strength``."""
    spread = F.col(prior) * (1 - F.col(prior))
    moved = rates.agg(
        F.sum(F.when(F.col("n") > 0, F.pow(F.col("good") - F.col("n") * F.col(prior), 2) / F.col("n"))).alias("s"),
        F.sum(F.when(F.col("n") > 0, spread)).alias("e"),
        F.sum(F.when(F.col("n") > 0, (F.col("n") - 1) * spread)).alias("w"),
    )
    rho = F.coalesce(F.when(F.col("w") > 0, (F.col("s") - F.col("e")) / F.col("w")), F.lit(MOST_RHO))
    rho = F.least(F.greatest(rho, F.lit(LEAST_RHO)), F.lit(MOST_RHO))
    moved = moved.select((1 / rho - 1).alias("strength"))
    # one row, so the product is no larger than the rates
    rates = rates.drop("strength").join(F.broadcast(moved))
    return rates.withColumn(out, (F.col("good") + F.col("strength") * F.col(prior)) / (F.col("n") + F.col("strength")))


def reputation(pages: DataFrame, labels: DataFrame, long_suffixes: list[str] = LONG_SUFFIXES) -> DataFrame:
    """``(host, n, good, rate, upper)`` of every host: labels, good ones, posterior mean and upper bound."""
    outcome = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("page_id")).agg(
        F.min(F.when((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0), 1).otherwise(0)).alias("good")
    )
    labelled = pages.where("page_id is not null").select("page_id", "host").join(outcome, "page_id")
    counted = labelled.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"))
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages")).select("host").join(counted, "host", "left")
    domain, suffix = domain_and_suffix(F.col("host"), long_suffixes)
    hosts = stage(
        hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), *(F.coalesce(c, F.lit(0)).alias(c) for c in ("n", "good"))),
        "hosts",
    )
    sums = [F.sum(c).alias(c) for c in ("n", "good")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    every = suffixes.agg(((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("all_rate"))
    suffixes = _step(suffixes.join(F.broadcast(every)), "suffix", "all_rate", "suffix_rate")
    domains = stage(_step(domains.join(suffixes.select("suffix", "suffix_rate"), "suffix"), "domain", "suffix_rate", "domain_rate"), "domains")
    hosts = _step(hosts.join(domains.select("domain", "suffix", "domain_rate"), ["domain", "suffix"]), "host", "domain_rate", "rate")
    size = F.col("n") + F.col("strength")
    upper = F.col("rate") + Z * F.sqrt(F.col("rate") * (1 - F.col("rate")) / (size + 1))
    return hosts.select("host", "n", "good", "rate", upper.alias("upper"))


def judge(pages: DataFrame, labels: DataFrame, rules: list[tuple[str, str]] = RULES, good: float = GOOD) -> DataFrame:
    """``(page_id, host, path, rule, verdict)`` of every page."""
    host, path = split_url(F.col("url"))
    split = pages.select("page_id", "url").select("page_id", host.alias("host"), path.alias("path"))
    known = stage(reputation(split, labels).where(F.col("upper") < good).select("host"), "blocked")
    known = known.select("host", F.lit("block").alias("by_host"))
    rule = rule_for(F.col("host"), F.col("path"), rules)
    rows = split.withColumn("rule", rule).join(known, "host", "left")
    by_rule = F.lit(None).cast("string")
    for text, verdict in rules:
        by_rule = F.when(F.col("rule") == text, F.lit(verdict)).otherwise(by_rule)
    by_host = F.when(F.col("host") == "", F.lit("block")).otherwise(F.coalesce("by_host", F.lit("allow")))
    return rows.select("page_id", "host", "path", "rule", F.coalesce(by_rule, by_host).alias("verdict"))


def op3_url_reputation(spark, sf_dir):
    pages, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("pages", "labels"))
    return judge(pages, labels)


def _case_sql() -> str:
    """The longest rule first, as the first branch that holds decides."""
    branches = []
    for rule, _ in sorted(RULES, key=lambda r: (-len(r[0]), r[0])):
        domain, slash, start = rule.partition("/")
        branches.append(f"WHEN (host = '{domain}' OR ends_with(host, '.{domain}')) AND starts_with(path, '{slash + start}') THEN '{rule}'")
    return "CASE " + " ".join(branches) + " END"


def _step_sql(rates: str, prior: str, out: str) -> str:
    return f"""
  SELECT r.*, (good + k * {prior}) / (n + k) AS {out}, k AS strength
  FROM {rates} r, (
    SELECT 1 / least(greatest(coalesce((s - e) / nullif(w, 0), {MOST_RHO}), {LEAST_RHO}), {MOST_RHO}) - 1 AS k
    FROM (SELECT sum(pow(good - n * {prior}, 2) / n) FILTER (WHERE n > 0) AS s,
                 sum({prior} * (1 - {prior})) FILTER (WHERE n > 0) AS e,
                 sum((n - 1) * {prior} * (1 - {prior})) FILTER (WHERE n > 0) AS w FROM {rates}))"""


_LABELS_SQL = "CASE WHEN " + " OR ".join(f"ends_with(host, '.{s}')" for s in LONG_SUFFIXES) + " THEN 2 ELSE 1 END"
_LAST_SQL = "array_to_string(list_slice(string_split(host, '.'), -({n}), -1), '.')"
ORACLE = f"""
WITH u AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (
  SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u),
o AS (SELECT doc_id, min((quality = 1 AND coalesce(toxic, 0) = 0)::INT) AS good FROM labels GROUP BY doc_id),
hosts AS (
  SELECT host, {_LAST_SQL.format(n=f"1 + ({_LABELS_SQL})")} AS domain, {_LAST_SQL.format(n=_LABELS_SQL)} AS suffix,
         count(o.good) AS n, coalesce(sum(o.good), 0) AS good
  FROM p LEFT JOIN o ON o.doc_id = p.page_id GROUP BY host),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM hosts GROUP BY ALL),
suffixes AS (
  SELECT suffix, sum(n) AS n, sum(good) AS good, (sum(sum(good)) OVER () + 1) / (sum(sum(n)) OVER () + 2) AS all_rate
  FROM domains GROUP BY suffix),
suffix_rates AS ({_step_sql("suffixes", "all_rate", "suffix_rate")}),
domains_up AS (SELECT d.*, suffix_rate FROM domains d JOIN suffix_rates USING (suffix)),
domain_rates AS ({_step_sql("domains_up", "suffix_rate", "domain_rate")}),
hosts_up AS (SELECT h.*, domain_rate FROM hosts h JOIN domain_rates USING (domain, suffix)),
host_rates AS ({_step_sql("hosts_up", "domain_rate", "rate")}),
judged AS (SELECT host, rate + {Z} * sqrt(rate * (1 - rate) / (n + strength + 1)) AS upper FROM host_rates),
ruled AS (SELECT page_id, host, path, {_case_sql()} AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE {" ".join(f"WHEN rule = '{r}' THEN '{v}'" for r, v in RULES)}
            WHEN host = '' OR upper < {GOOD} THEN 'block' ELSE 'allow' END AS verdict
FROM ruled JOIN judged USING (host)
"""
