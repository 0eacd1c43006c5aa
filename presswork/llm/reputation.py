"""URL filter by rules and by the reputation of hosts.

A rule names a host and a path; it fits that host, its subdomains, and paths that begin
with its own. The longest fitting rule decides. Where no rule fits, the host's reputation
does, learned from pages whose outcome (good or bad) is known.

Reputation is empirical Bayes with beta-binomial priors. The share of bad pages of a
suffix is drawn towards that of all pages, the share of a registered domain towards its
suffix, the share of a host towards its domain. How strongly, is estimated for each level
by the method of moments: shares that differ more between groups than chance explains give
a weak prior, equal shares a strong one. A host's posterior is a beta distribution; it is
blocked if the lower bound of its share of bad pages exceeds ``MAX_BAD``. The bound is
Cantelli's, mean less ``sqrt((1 - d) / d)`` deviations, which holds for every distribution
with certainty ``1 - d``. So a host with few known pages is never blocked for its own
sake, but one of a bad domain is.

Everything is DataFrame operators. Pages are reduced to one row per host before anything
is joined; one row per level reaches the driver. Hosts' verdicts return to the pages by a
salted join, so that a host with a third of all pages is spread over tasks.

Defined cases: a null url, or one without ``://``, has an empty host and path, and empty
hosts have one reputation like any host; rows with equal or null ids are judged one by
one; several outcomes of a page all count; outcomes of no page are ignored; without any
outcome all hosts are allowed; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presswork.cluster import materialize
from presswork.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
MAX_RULES = 1000  # rules are written by people; they are compiled into one expression
MAX_BAD = 0.5
DOUBT = 0.1
WEAKEST, STRONGEST = 1.0, 10_000.0  # prior pages of a group
SALT = 16
#: Suffixes of two labels under which domains are registered.
SECOND_LEVEL = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "org.uk", "plc.uk", "sch.uk",
    "com.au", "edu.au", "gov.au", "id.au", "net.au", "org.au", "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "co.kr", "go.kr", "or.kr", "ac.in", "co.in", "gov.in", "net.in", "org.in",
    "ac.za", "co.za", "gov.za", "org.za", "com.br", "gov.br", "net.br", "org.br", "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn",
    "com.mx", "gob.mx", "org.mx", "com.ar", "gob.ar", "org.ar", "com.tr", "gov.tr", "org.tr", "com.tw", "org.tw", "com.hk", "org.hk", "com.sg", "gov.sg",
)


def host_of(url: Column) -> Column:
    """After the first ``://`` up to a slash, ``?`` or ``#``, A-Z lower-cased."""
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?`` or ``#``."""
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def first_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """Pattern and verdict of the longest rule ``(verdict, pattern)`` that fits, else null.

    Of equally long ones that with the longer host wins.
    """
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} are compiled")
    pattern = verdict = F.lit(None).cast("string")
    # The last branch put on is asked first.
    for decision, rule in sorted(rules, key=lambda r: (len(r[1]), len(r[1].partition("/")[0]))):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(slash + rest))
        pattern, verdict = (F.when(fits, F.lit(new)).otherwise(old) for new, old in ((rule, pattern), (decision, verdict)))
    return pattern, verdict


def registered_domain(host: Column) -> tuple[Column, Column]:
    """Registered domain and its suffix, without user, port and closing dots; an address is both."""
    name = F.rtrim(F.regexp_replace(host, r"(?s)^.*@|:[0-9]*$", ""), F.lit("."))
    last, two, three = (F.substring_index(name, ".", -n) for n in (1, 2, 3))
    address = name.rlike(r"^[0-9.]+$")
    wide = two.isin(*SECOND_LEVEL)
    return F.when(address, name).when(wide, three).otherwise(two), F.when(address, name).when(wide, two).otherwise(last)


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: Column) -> DataFrame:
    """Inner join with a unique ``right``, each key of ``left`` dealt over ``SALT`` parts."""
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALT - 1)))
    dealt = left.withColumn("salt", F.pmod(F.xxhash64(spread), F.lit(SALT)).cast("int"))
    return dealt.join(right.withColumn("salt", salts), [key, "salt"]).drop("salt")


def prior_pages(groups: DataFrame) -> float:
    """Pages that a prior counts for, of ``n, bad, parent_rate`` rows.

    The overdispersion of ``bad`` around ``n * parent_rate`` gives the correlation of two
    pages in a group; its inverse less one is the size of the beta prior.
    """
    chance = F.col("parent_rate") * (1 - F.col("parent_rate"))
    excess = F.pow(F.col("bad") - F.col("n") * F.col("parent_rate"), F.lit(2.0)) - F.col("n") * chance
    sums = groups.agg(F.sum(excess).alias("excess"), F.sum(F.col("n") * (F.col("n") - 1) * chance).alias("pairs")).first()
    if not sums["pairs"] or sums["excess"] <= 0:
        return STRONGEST
    return min(max(sums["pairs"] / sums["excess"] - 1, WEAKEST), STRONGEST)


def shrunk(groups: DataFrame) -> tuple[DataFrame, float]:
    """``rate`` of ``n, bad, parent_rate`` rows, drawn towards the parent's."""
    prior = prior_pages(groups)
    return groups.withColumn("rate", (F.col("bad") + prior * F.col("parent_rate")) / (F.col("n") + prior)), prior


def host_outcomes(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """``host, n, bad`` of every host of ``page_id, host`` rows; ``outcomes`` has ``page_id, bad``."""
    known = outcomes.filter("page_id IS NOT NULL AND bad IS NOT NULL").groupBy("page_id")
    known = known.agg(F.count(F.lit(1)).alias("known"), F.count_if("bad").alias("known_bad"))
    times = pages.groupBy("page_id", "host").agg(F.count(F.lit(1)).alias("times"))
    seen = times.join(known, "page_id").select("host", (F.col("times") * F.col("known")).alias("n"), (F.col("times") * F.col("known_bad")).alias("bad"))
    every = pages.select("host", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("bad"))
    return seen.unionByName(every).groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def reputations(hosts: DataFrame, doubt: float = DOUBT) -> DataFrame:
    """``host, n, bad, bad_rate, bad_low`` of stored ``host, n, bad`` rows."""
    domain, suffix = registered_domain(F.col("host"))
    hosts = hosts.withColumns({"domain": domain, "suffix": suffix})
    add_up = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = materialize(hosts.groupBy("domain", "suffix").agg(*add_up), "domains")
    suffixes = materialize(domains.groupBy("suffix").agg(*add_up), "suffixes")
    all_n, all_bad = suffixes.agg(*add_up).first()
    overall = ((all_bad or 0) + 0.5) / ((all_n or 0) + 1.0)
    up, _ = shrunk(suffixes.withColumn("parent_rate", F.lit(overall)))
    parents = up.select("suffix", F.col("rate").alias("parent_rate"))
    mid, _ = shrunk(salted_join(domains, parents, "suffix", F.col("domain")))
    parents = mid.select("domain", F.col("rate").alias("parent_rate"))
    low, prior = shrunk(salted_join(hosts, parents, "domain", F.col("host")))
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + prior + 1))
    bound = F.greatest(F.lit(0.0), F.col("rate") - math.sqrt((1 - doubt) / doubt) * deviation)
    return low.select("host", "n", "bad", F.col("rate").alias("bad_rate"), bound.alias("bad_low"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    max_bad: float = MAX_BAD,
    doubt: float = DOUBT,
    page_id: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` and the host's reputation, for every page.

    ``outcomes`` has ``page_id`` and ``bad``, for some of the pages.
    """
    parts = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    hosts = materialize(host_outcomes(parts.select("page_id", "host"), outcomes), "hosts")
    known = reputations(hosts, doubt)
    pattern, decision = first_rule(rules, F.col("host"), F.col("path"))
    by_host = F.when(F.col("bad_low") > max_bad, F.lit("block")).otherwise(F.lit("allow"))
    return salted_join(parts, known, "host", F.struct("page_id", "path")).select(
        "page_id", "host", "path", pattern.alias("rule"), F.coalesce(decision, by_host).alias("verdict"),
        F.col("n").alias("n_known"), F.round("bad_rate", 6).alias("bad_rate"), F.round("bad_low", 6).alias("bad_low"),
    )


#: Rules of the query.
RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"))


def op12_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and reputations; a page is bad if its label calls it poor or toxic."""
    labels = table(spark, sf_dir, "labels")
    bad = reduce(lambda a, b: a | b, [F.coalesce(F.col(c) == x, F.lit(False)) for c, x in (("quality", 0), ("toxic", 1))])
    bad = F.when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), bad)
    outcomes = labels.select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return judge_urls(table(spark, sf_dir, "pages"), outcomes, RULES)


def _rule_sql(take: int) -> str:
    """The longest fitting rule as a CASE; ``take`` 0 gives verdicts, 1 patterns."""
    cases = []
    for rule in sorted(RULES, key=lambda r: (-len(r[1]), -len(r[1].partition("/")[0]))):
        name, slash, rest = rule[1].partition("/")
        cases.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '{slash}{rest}') THEN '{rule[take]}'")
    return f"CASE {' '.join(cases)} END"


def _shrunk_sql(name: str, source: str) -> str:
    """A level's groups with their rate and prior, of rows with the parent's rate."""
    return f"""
{name}_prior AS (
  SELECT CASE WHEN coalesce(pairs, 0) = 0 OR excess <= 0 THEN {STRONGEST} ELSE least(greatest(pairs / excess - 1, {WEAKEST}), {STRONGEST}) END AS prior
  FROM (SELECT sum(pow(bad - n * p, 2.0) - n * (p * (1 - p))) AS excess, sum(n * (n - 1) * (p * (1 - p))) AS pairs FROM ({source}))),
{name} AS (SELECT s.*, prior, (bad + prior * p) / (n + prior) AS rate FROM ({source}) s, {name}_prior)"""


OP12_SQL = rf"""
WITH parts AS (
  SELECT page_id, translate(coalesce(regexp_extract(url, '{URL}', 1), ''), '{UPPER}', '{LOWER}') AS host,
    coalesce(regexp_extract(url, '{URL}', 2), '') AS path FROM pages),
outcomes AS (
  SELECT doc_id AS page_id, count(*) AS n, count(*) FILTER (quality = 0 OR toxic = 1) AS bad
  FROM labels WHERE quality IS NOT NULL OR toxic IS NOT NULL GROUP BY doc_id),
named AS (
  SELECT host, rtrim(regexp_replace(host, '(?s)^.*@|:[0-9]*$', '', 'g'), '.') AS name, coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(bad), 0)::BIGINT AS bad
  FROM parts LEFT JOIN outcomes USING (page_id) GROUP BY host),
split AS (SELECT *, string_split(name, '.') AS l FROM named),
hosts AS (
  SELECT host, n, bad,
    CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name WHEN wide THEN array_to_string(l[-3:], '.') ELSE array_to_string(l[-2:], '.') END AS domain,
    CASE WHEN regexp_matches(name, '^[0-9.]+$') THEN name WHEN wide THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix
  FROM (SELECT *, array_to_string(l[-2:], '.') IN {SECOND_LEVEL} AS wide FROM split)),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL),
top AS (SELECT (coalesce(sum(bad), 0) + 0.5::DOUBLE) / (coalesce(sum(n), 0) + 1.0::DOUBLE) AS p FROM suffixes),
{_shrunk_sql("by_suffix", "SELECT *, p FROM suffixes, top")},
{_shrunk_sql("by_domain", "SELECT d.*, u.rate AS p FROM domains d JOIN by_suffix u USING (suffix)")},
{_shrunk_sql("by_host", "SELECT h.*, m.rate AS p FROM hosts h JOIN by_domain m USING (domain)")},
known AS (
  SELECT host, n, rate, greatest(0.0::DOUBLE, rate - sqrt((1 - {DOUBT}::DOUBLE) / {DOUBT}::DOUBLE) * sqrt(rate * (1 - rate) / (n + prior + 1))) AS low FROM by_host)
SELECT page_id, host, path, {_rule_sql(1)} AS rule,
  coalesce({_rule_sql(0)}, CASE WHEN low > {MAX_BAD} THEN 'block' ELSE 'allow' END) AS verdict,
  n AS n_known, round(rate, 6) AS bad_rate, round(low, 6) AS bad_low
FROM parts JOIN known USING (host)
"""

QUERIES = {"op12_host_reputation": op12_host_reputation}
ORACLES = {"op12_host_reputation": OP12_SQL}
