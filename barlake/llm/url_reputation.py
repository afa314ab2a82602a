"""URL filters with empirical-Bayes host reputation.

Labelled page outcomes are counted per host, registered domain and public
suffix.  Each level is a beta-binomial whose prior mean is the posterior mean
of the level above (suffix <- all pages, domain <- suffix, host <- domain);
its prior strength is fitted to the counts of the level by the method of
moments.  A page is blocked when the lower posterior bound of its host's rate
of bad pages is above a limit, unless a rule for the host and path decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.joins import broadcast_if_small
from ..session import cut_lineage
from .common import lower_ascii, query, read_table

#: (host, path prefix, verdict); a rule fits its host and all its subdomains.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
         ("com", "/fr/", "allow"), ("com", "/de/", "block"))
#: Second-level labels that belong to the public suffix before a two-letter country code.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "or", "org")
BAD_LIMIT = 0.5
Z_BOUND = 1.64
RHO_RANGE = (0.001, 0.5)


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path) columns; both empty for NULL or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest) + 1), r"^[^?#]*", 0)
    return lower_ascii(host), path


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest fitting rule; NULL where none fits."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def domain_levels(host: Column) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; an address or single label is its own."""
    name = F.regexp_replace(host, r":[0-9]*$", "")
    labels = F.split(name, r"\.")
    n = F.size(labels)
    last = F.element_at(labels, -1)
    two = (n >= 3) & (F.length(last) == 2) & F.get(labels, n - 2).isin(*SECOND_LEVEL)
    k = F.when(two, 2).otherwise(1)
    tail = lambda m: F.concat_ws(".", F.slice(labels, n - m + 1, m))
    whole = (n < 2) | F.regexp_like(last, F.lit(r"^[0-9]*$"))
    return F.when(whole, name).otherwise(tail(k + 1)), F.when(whole, name).otherwise(tail(k))


def _level(groups: DataFrame, key: str, parent_mean: str) -> DataFrame:
    """Posterior (a, b, mean) of each group from (key, n, bad, parent_mean)."""
    mu, p = F.col(parent_mean), F.col("bad") / F.col("n")
    seen = groups.where("n > 0")
    fit = seen.agg(F.sum(F.col("n") * (p - mu) * (p - mu) / (mu * (1 - mu))).alias("x"),
                   F.count("*").alias("g"), F.sum("n").alias("t"))
    rho = F.when(F.col("t") > F.col("g"), F.round((F.col("x") - F.col("g")) / (F.col("t") - F.col("g")), 9)).otherwise(RHO_RANGE[1])
    fit = fit.select(F.lit(1).alias("one"), (1 / F.least(F.greatest(rho, F.lit(RHO_RANGE[0])), F.lit(RHO_RANGE[1])) - 1).alias("m"))
    g = groups.withColumn("one", F.lit(1)).join(F.broadcast(fit), "one").drop("one")   # one row
    a = F.col("m") * mu + F.col("bad")
    b = F.col("m") * (1 - mu) + F.col("n") - F.col("bad")
    return g.withColumn("a", a).withColumn("b", b).withColumn(f"{key}_mean", F.col("a") / (F.col("a") + F.col("b")))


def host_reputation(hosts: DataFrame, outcomes: DataFrame) -> DataFrame:
    """Reputation of every host in ``hosts(host)`` or ``outcomes(host, bad 0/1)``.

    Returns host, domain, suffix, n, bad, mean, bound (lower posterior bound of
    the rate of bad pages).  Without any outcome the prior rate is one half.
    """
    counts = outcomes.where("bad IS NOT NULL").groupBy("host").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    domain, suffix = domain_levels(F.col("host"))
    h = cut_lineage(hosts.select("host").distinct().join(counts, "host", "full").na.fill(0, ["n", "bad"])
                    .withColumn("domain", domain).withColumn("suffix", suffix))
    root = h.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("root_mean"))
    total = lambda key: h.groupBy(key).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suf = total("suffix").withColumn("one", F.lit(1)).join(F.broadcast(root.withColumn("one", F.lit(1))), "one")
    suf = _level(suf, "suffix", "root_mean").select("suffix", "suffix_mean")
    dom = total("domain").join(h.select("domain", "suffix").distinct(), "domain").join(suf, "suffix")
    dom = _level(dom, "domain", "suffix_mean").select("domain", "domain_mean")
    out = _level(h.join(dom, "domain"), "host", "domain_mean")
    t = F.col("a") + F.col("b")
    sd = F.sqrt(F.col("a") * F.col("b") / (t * t * (t + 1)))
    return out.select("host", "domain", "suffix", "n", "bad", F.col("host_mean").alias("mean"),
                      (F.col("host_mean") - F.lit(Z_BOUND) * sd).alias("bound"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules=RULES, bad_limit: float = BAD_LIMIT,
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page.

    ``outcomes`` is (host, bad).  NULL or malformed urls have empty host and
    path and are judged as the empty host.  Repeated rows stay repeated; an
    empty table gives no rows; other columns are not read.  One host may hold
    most pages: pages meet only the blocked hosts, by broadcast while those are
    few, else by a sort-merge join that splits hot keys.
    """
    host, path = url_parts(F.col(url_col))
    p = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    rep = host_reputation(p.select("host"), outcomes)
    blocked = cut_lineage(rep.where(F.round("bound", 9) > bad_limit).select("host", F.lit("block").alias("by_host")))
    rule, by_rule = rule_of(F.col("host"), F.col("path"), rules)
    return (p.join(broadcast_if_small(blocked), "host", "left")
            .select("page_id", "host", "path", rule.alias("rule"),
                    F.coalesce(by_rule, F.col("by_host"), F.lit("allow")).alias("verdict")))


def labelled_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, bad): a page's path names the document it shows, and labels judge documents."""
    host, path = url_parts(F.col("url"))
    number = F.regexp_extract(path, r"/([0-9]{1,18})", 1)
    p = pages.select(host.alias("host"), F.when(number != "", number.cast("long")).alias("doc_id"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    return p.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("host", "bad")


def _sql_level(name: str, source: str, parent: str) -> str:
    lo, hi = RHO_RANGE
    return f"""
{name}_fit AS (SELECT CASE WHEN sum(n) > count(*) THEN round((sum(n * (bad / n - {parent}) * (bad / n - {parent}) / ({parent} * (1 - {parent}))) - count(*)) / (sum(n) - count(*)), 9) ELSE {hi}::DOUBLE END AS rho
  FROM {source} WHERE n > 0),
{name}_post AS (SELECT s.*, m * {parent} + bad AS a, m * (1 - {parent}) + n - bad AS b
  FROM {source} s, (SELECT 1 / least(greatest(rho, {lo}::DOUBLE), {hi}::DOUBLE) - 1 AS m FROM {name}_fit))"""


def _sql_rules(what: int) -> str:
    out = "NULL"
    for h, p, v in sorted(RULES, key=lambda r: len(r[0] + r[1])):
        out = f"CASE WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{(h + p, v)[what]}' ELSE {out} END"
    return out


SQL = f"""
WITH r AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p0 AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM r),
p AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM p0),
o AS (SELECT host, (quality = 0 OR toxic = 1)::INT AS bad FROM p JOIN labels
      ON labels.doc_id = try_cast(nullif(regexp_extract(path, '/([0-9]{{1,18}})', 1), '') AS BIGINT)),
c AS (SELECT host, count(*) AS n, sum(bad) AS bad FROM o WHERE bad IS NOT NULL GROUP BY host),
h0 AS (SELECT host, coalesce(n, 0)::DOUBLE AS n, coalesce(bad, 0)::DOUBLE AS bad, regexp_replace(host, ':[0-9]*$', '') AS name
       FROM (SELECT DISTINCT host FROM p) LEFT JOIN c USING (host)),
h1 AS (SELECT *, string_split(name, '.') AS ls FROM h0),
h2 AS (SELECT *, len(ls) < 2 OR regexp_matches(ls[-1], '^[0-9]*$') AS whole,
              CASE WHEN len(ls) >= 3 AND length(ls[-1]) = 2 AND ls[-2] IN {SECOND_LEVEL} THEN 2 ELSE 1 END AS k FROM h1),
h AS (SELECT host, n, bad, CASE WHEN whole THEN name ELSE array_to_string(ls[len(ls) - k:], '.') END AS domain,
             CASE WHEN whole THEN name ELSE array_to_string(ls[len(ls) - k + 1:], '.') END AS suffix FROM h2),
suf AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, (SELECT (sum(bad) + 1) / (sum(n) + 2) FROM h) AS root_mean FROM h GROUP BY suffix),
{_sql_level('suf', 'suf', 'root_mean')},
dom AS (SELECT domain, any_value(a / (a + b)) AS suffix_mean, sum(h.n) AS n, sum(h.bad) AS bad
        FROM h JOIN suf_post USING (suffix) GROUP BY domain),
{_sql_level('dom', 'dom', 'suffix_mean')},
hst AS (SELECT h.*, a / (a + b) AS domain_mean FROM h JOIN dom_post USING (domain)),
{_sql_level('hst', 'hst', 'domain_mean')},
blocked AS (SELECT host FROM hst_post
            WHERE round(a / (a + b) - {Z_BOUND}::DOUBLE * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 9) > {BAD_LIMIT})
SELECT page_id, host, path, {_sql_rules(0)} AS rule,
       coalesce({_sql_rules(1)}, CASE WHEN host IN (SELECT host FROM blocked) THEN 'block' ELSE 'allow' END) AS verdict
FROM p
"""


@query("op5_url_reputation", SQL)
def op5_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, labelled_outcomes(pages, read_table(spark, sf_dir, "labels")))
