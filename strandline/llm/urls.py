"""URL filters: fixed rules, and empirical-Bayes reputations of hosts.

Labelled pages give each host a number of outcomes and of bad ones. Rates are shrunk down the chain of names: the suffix
towards the overall rate, the registered domain towards its suffix, the host towards its domain. Each level is a
beta-binomial prior whose mean is the level above and whose strength is estimated from the spread of the level's groups
around the rates of their own parents (method of moments), so that spread between parents isn't counted again below them.
A host is blocked if the lower bound of its posterior bad rate exceeds ``THRESHOLD``; a host
without labels gets the posterior of the nearest level that has some. All of it is DataFrame functions.

Outcomes come from ``labels``: ``doc_id`` is the page's id, quality 0 is bad; repeated labels of an id count once (the
best quality holds).

Defined results: null urls and urls without ``://`` have empty host and path, take part as the empty host, and fit no rule
with a host; an IP address is its own domain and suffix; repeated pages each get a row; empty tables give empty results (without labels every verdict is the rule's or
``allow``); further columns are ignored.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.storage import durable

#: (verdict, host, path)
RULES = (
    ("block", "com", "/en/"),
    ("allow", "example.com", "/en/7"),
    ("allow", "net", "/de/"),
    ("block", "example.net", "/de/8"),
    ("block", "org", "/es/"),
)
#: Suffixes of two labels that count as one name; a parameter, as the public list changes.
SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "com.br", "co.in", "co.za")
THRESHOLD, Z = 0.5, 1.645
LEAST_STRENGTH, MOST_STRENGTH = 2.0, 1000.0
#: Sums up to this are rounding, not spread.
LEAST_ROOM = 1e-9
_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"://([^/?#]*)", 1), _AZ, _az), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest fitting rule as host and path in one string, and its verdict; both null without one."""
    rule, verdict = None, None
    for v, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule = F.when(fits, h + p) if rule is None else rule.when(fits, h + p)
        verdict = F.when(fits, v) if verdict is None else verdict.when(fits, v)
    null = F.lit(None).cast("string")
    return (null, null) if rule is None else (rule, verdict)


def _named(host: Column) -> Column:
    return F.regexp_replace(host, r":\d*$", "")


def _address(name: Column) -> Column:
    return name.rlike(r"^\d+\.\d+\.\d+\.\d+$")


def suffix_of(host: Column, suffixes=SUFFIXES) -> Column:
    name = _named(host)
    two = F.substring_index(name, ".", -2)
    return F.when(_address(name), name).when(two.isin(*suffixes), two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column, suffixes=SUFFIXES) -> Column:
    name = _named(host)
    two = F.substring_index(name, ".", -2)
    return F.when(_address(name), name).when(two.isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(two)


def _strength(groups: DataFrame, *parent: str) -> float:
    """Strength of the beta prior that the spread of the groups' rates (columns n, bad) within their parents speaks for.

    Over the groups of a parent with rate m, the sum of n (rate - m)^2 is expected to be (k - 1) m (1 - m) without any
    spread of the true rates; what is beyond it, by m (1 - m) (n - sum n^2 / n), is the correlation 1 / (strength + 1).
    """
    n, bad = F.col("n").cast("double"), F.col("bad").cast("double")
    own = groups.where("n > 0").groupBy(*parent).agg(
        F.count("*").alias("k"), F.sum(n).alias("n"), F.sum(bad).alias("x"), F.sum(bad * bad / n).alias("q"), F.sum(n * n).alias("n2")
    )
    m = F.col("x") / F.col("n")
    spread = F.col("q") - F.col("x") * m - (F.col("k") - 1) * m * (1 - m)
    r = own.agg(F.sum(spread).alias("between"), F.sum(m * (1 - m) * (F.col("n") - F.col("n2") / F.col("n"))).alias("room")).first()
    if not r.room or r.room <= LEAST_ROOM or r.between <= LEAST_ROOM:
        return MOST_STRENGTH
    return min(MOST_STRENGTH, max(LEAST_STRENGTH, r.room / r.between - 1))


def reputations(pages: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, z: float = Z) -> DataFrame:
    """``host, n, bad, mean, bound, bad_host`` for every host of ``pages``."""
    outcome = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    rows = pages.select(F.col("page_id").alias("doc_id"), host_of(F.col("url")).alias("host")).join(outcome, "doc_id", "left")
    seen, bad = F.count("quality").alias("n"), F.count(F.when(F.col("quality") == 0, 1)).alias("bad")
    hosts = rows.groupBy("host").agg(seen, bad)
    hosts = durable(hosts.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    total = (F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    domains = hosts.groupBy("domain", "suffix").agg(*total)
    suffixes = domains.groupBy("suffix").agg(*total)
    overall = hosts.agg(*total).first()
    base = ((overall.bad or 0) + 1.0) / ((overall.n or 0) + 2.0)
    k_suffix, k_domain, k_host = _strength(suffixes), _strength(domains, "suffix"), _strength(hosts, "domain")

    def shrunk(prior, k):
        return (F.col("bad") + k * prior) / (F.col("n") + k)

    up = suffixes.select("suffix", shrunk(F.lit(base), k_suffix).alias("up"))
    mid = domains.join(up, "suffix").select("domain", shrunk(F.col("up"), k_domain).alias("up"))
    mean = shrunk(F.col("up"), k_host)
    out = hosts.join(mid, "domain").select("host", "n", "bad", mean.alias("mean"))
    bound = F.col("mean") - z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + k_host + 1))
    return out.withColumn("bound", bound).withColumn("bad_host", F.col("bound") > threshold)


def judged(pages: DataFrame, labels: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, n_labelled, n_bad, mean, bound``: a page's verdict is its rule's, else its host's."""
    known = durable(reputations(pages, labels), "reputations")
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path")).join(known, "host", "left")
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bad_host"), "block").otherwise("allow")
    return rows.select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"), F.round("mean", 9).alias("mean"), F.round("bound", 9).alias("bound"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(spark.read.parquet(f"{sf_dir}/pages.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def _oracle() -> str:
    ordered = sorted(RULES, key=lambda r: (-len(r[1] + r[2]), r[1], r[2]))
    fits = [f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')" for _, h, p in ordered]
    rule = " ".join(f"WHEN {f} THEN '{h}{p}'" for f, (_, h, p) in zip(fits, ordered, strict=True))
    verdict = " ".join(f"WHEN {f} THEN '{v}'" for f, (v, _, _) in zip(fits, ordered, strict=True))
    two = "array_to_string(list_slice(string_split(name, '.'), -{n}, -1), '.')"
    address = r"regexp_full_match(name, '\d+\.\d+\.\d+\.\d+')"
    known = ", ".join(f"'{s}'" for s in SUFFIXES)

    def strength(table, parent):
        return f"""(SELECT CASE WHEN coalesce(room, 0) <= {LEAST_ROOM} OR between_ <= {LEAST_ROOM} THEN {MOST_STRENGTH}
          ELSE least({MOST_STRENGTH}, greatest({LEAST_STRENGTH}, room / between_ - 1)) END
          FROM (SELECT sum(q - x * x / n - (k - 1) * (x / n) * (1 - x / n)) AS between_, sum((x / n) * (1 - x / n) * (n - n2 / n)) AS room
            FROM (SELECT count(*)::DOUBLE k, sum(n)::DOUBLE n, sum(bad)::DOUBLE x, sum(bad::DOUBLE * bad / n) q, sum(n::DOUBLE * n) n2
              FROM {table} WHERE n > 0 GROUP BY {parent})))"""

    return f"""
WITH p AS (
  SELECT page_id, coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_AZ}', '{_az}'), '') AS host,
    coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
l AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
h AS (
  SELECT host, count(quality)::BIGINT AS n, count(*) FILTER (quality = 0)::BIGINT AS bad,
    CASE WHEN {address} THEN name WHEN {two.format(n=2)} IN ({known}) THEN {two.format(n=3)} ELSE {two.format(n=2)} END AS domain,
    CASE WHEN {address} THEN name WHEN {two.format(n=2)} IN ({known}) THEN {two.format(n=2)} ELSE {two.format(n=1)} END AS suffix
  FROM (SELECT *, regexp_replace(host, ':\\d*$', '') AS name FROM p) LEFT JOIN l ON l.doc_id = page_id GROUP BY host, name),
d AS (SELECT domain, suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM h GROUP BY domain, suffix),
s AS (SELECT suffix, sum(n)::BIGINT AS n, sum(bad)::BIGINT AS bad FROM d GROUP BY suffix),
k AS (SELECT {strength('s', "''")} AS ks, {strength('d', 'suffix')} AS kd, {strength('h', 'domain')} AS kh,
  (SELECT (coalesce(sum(bad), 0) + 1.0) / (coalesce(sum(n), 0) + 2.0) FROM h)::DOUBLE AS base),
sm AS (SELECT suffix, (bad + ks * base) / (n + ks) AS m FROM s, k),
dm AS (SELECT domain, (d.bad + kd * m) / (d.n + kd) AS m FROM d JOIN sm USING (suffix), k),
hm AS (SELECT host, n, bad, (bad + kh * m) / (n + kh) AS mean, kh FROM h JOIN dm USING (domain), k),
v AS (SELECT host, n, bad, mean, mean - {Z} * sqrt(mean * (1 - mean) / (n + kh + 1)) AS bound FROM hm)
SELECT page_id, host, path, CASE {rule} END AS rule,
  coalesce(CASE {verdict} END, CASE WHEN bound > {THRESHOLD} THEN 'block' ELSE 'allow' END) AS verdict, n AS n_labelled, bad AS n_bad,
  round(mean, 9) AS mean, round(bound, 9) AS bound
FROM p JOIN v USING (host)
"""


ORACLE = _oracle()
