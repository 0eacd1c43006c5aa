import math

import pytest
from pyspark.sql import functions as F

from presswork.llm import reputation as rp


def fit(rules, host, path):
    """The longest rule that fits, in plain Python."""
    fitting = []
    for verdict, rule in rules:
        name, _, rest = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + rest):
            fitting.append((len(rule), len(name), rule, verdict))
    return max(fitting)[2:] if fitting else (None, None)


URLS = {
    None: ("", ""), "": ("", ""), "no scheme/x": ("", ""), "://": ("", ""), "a://b://c": ("b:", "//c"),
    "HTTP://WWW.Ä.Com": ("www.Ä.com", ""), "http://h?x=/y": ("h", ""), "http://h#/a": ("h", ""), "http://h/a/b?c/d#e": ("h", "/a/b"),
    "http://u@H:80/p": ("u@h:80", "/p"), "x\ny://h\ni/p\nq": ("h\ni", "/p\nq"), "http:///p": ("", "/p"), "http://" + "a." * 50_000 + "org/x": ("a." * 50_000 + "org", "/x"),
}


def test_parts_of_urls(spark):
    df = spark.createDataFrame([(u,) for u in URLS], "url string")
    got = df.select("url", rp.host_of(F.col("url")), rp.path_of(F.col("url"))).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == URLS


def test_longest_rule(spark):
    rules = [*rp.RULES, ("block", "a.com/en"), ("allow", "com/en/1"), ("allow", "example.org/es/ok")]
    hosts = ["org", "example.org", "a.example.org", "xexample.org", "com", "a.com", "net", "", "orgx", "b.a.com"]
    paths = ["", "/", "/es/", "/es", "/es/ok/1", "/en/1", "/en/12", "/en/2", "/fr/", "/de/x", "/en/1/2"]
    df = spark.createDataFrame([(h, p) for h in hosts for p in paths], "host string, path string")
    pattern, verdict = rp.first_rule(rules, F.col("host"), F.col("path"))
    for r in df.select("host", "path", pattern.alias("rule"), verdict.alias("verdict")).collect():
        assert (r["rule"], r["verdict"]) == fit(rules, r["host"], r["path"]), r
    with pytest.raises(ValueError):
        rp.first_rule([("allow", f"h{i}/") for i in range(rp.MAX_RULES + 1)], F.col("host"), F.col("path"))


DOMAINS = {
    "a.b.example.com": ("example.com", "com"), "example.com": ("example.com", "com"), "com": ("com", "com"), "": ("", ""), "u:p@www.x.co.uk:80": ("x.co.uk", "co.uk"),
    "co.uk": ("co.uk", "co.uk"), "10.0.0.1:8080": ("10.0.0.1", "10.0.0.1"), "a.b.org.": ("b.org", "org"), "a.b.org.:1": ("b.org", "org"),
}


def test_registered_domains(spark):
    df = spark.createDataFrame([(h,) for h in DOMAINS], "host string")
    assert {r[0]: (r[1], r[2]) for r in df.select("host", *rp.registered_domain(F.col("host"))).collect()} == DOMAINS


def shrink(groups, parent):
    """Rates of ``{name: (n, bad)}`` drawn towards ``parent(name)``, and the prior."""
    p = {g: parent(g) for g in groups}
    excess = sum((b - n * p[g]) ** 2 - n * p[g] * (1 - p[g]) for g, (n, b) in groups.items())
    pairs = sum(n * (n - 1) * p[g] * (1 - p[g]) for g, (n, b) in groups.items())
    prior = 10_000.0 if not pairs or excess <= 0 else min(max(pairs / excess - 1, 1.0), 10_000.0)
    return {g: (b + prior * p[g]) / (n + prior) for g, (n, b) in groups.items()}, prior


def brute(hosts, parent_of):
    """``{host: (rate, low)}`` of ``{host: (n, bad)}``."""
    def up(groups, level):
        out = {}
        for g, (n, b) in groups.items():
            at = out.setdefault(level(g), [0, 0])
            at[0] += n
            at[1] += b
        return {g: tuple(x) for g, x in out.items()}

    domains = up(hosts, lambda h: parent_of[h])
    suffixes = up(domains, lambda d: d[1])
    n, b = map(sum, zip(*suffixes.values(), strict=True))
    by_suffix, _ = shrink(suffixes, lambda s: (b + 0.5) / (n + 1))
    by_domain, _ = shrink(domains, lambda d: by_suffix[d[1]])
    rates, prior = shrink(hosts, lambda h: by_domain[parent_of[h]])
    return {h: (r, max(0.0, r - 3 * math.sqrt(r * (1 - r) / (hosts[h][0] + prior + 1)))) for h, r in rates.items()}


@pytest.fixture
def pages():
    """Bad hosts of a bad domain, a mixed domain, and a host with most of the pages."""
    rows, outcomes = [], []
    shares = {**{f"h{i}.bad.net": 0.95 for i in range(6)}, **{f"h{i}.fair.com": 0.1 for i in range(6)}, "spam.fair.com": 0.9, "big.example.org": 0.05}
    for host, share in shares.items():
        for i in range(400 if host.startswith("big") else 40):
            rows.append((len(rows), f"https://{host}/en/{i}"))
            outcomes.append((rows[-1][0], i % 20 < 20 * share))
    rows += [(len(rows) + i, f"http://new{i}.bad.net/x") for i in range(3)] + [(5000, "http://new.other.io/"), (None, None), (None, "http://h1.bad.net/en/1")]
    return rows, [*outcomes, (None, True), (0, None), (99_999, True)]


def test_against_brute_force(spark, pages, small_batches):
    rows, outcomes = pages
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "1 AS host", "2 AS salt", "'x' AS n", "0 AS bad").repartition(5)
    known = spark.createDataFrame(outcomes, "page_id long, bad boolean")
    out = rp.judge_urls(df, known, rp.RULES).collect()
    assert sorted((str(r["page_id"]), r["host"]) for r in out) == sorted((str(i), (u or "").partition("://")[2].partition("/")[0]) for i, u in rows)
    label = {i: b for i, b in outcomes if b is not None and i is not None}
    hosts, parents = {}, {}
    for i, u in rows:
        h = (u or "").partition("://")[2].partition("/")[0]
        n, b = hosts.get(h, (0, 0))
        hosts[h] = (n + (i in label), b + label.get(i, False))
        parents[h] = (".".join(h.split(".")[-2:]), h.split(".")[-1])
    want = brute(hosts, parents)
    for r in out:
        rate, low = want[r["host"]]
        assert r["n_known"] == hosts[r["host"]][0]
        assert r["bad_rate"] == pytest.approx(rate, abs=2e-6) and r["bad_low"] == pytest.approx(low, abs=2e-6)
        rule, verdict = fit(rp.RULES, r["host"], r["path"])
        assert r["rule"] == rule and r["verdict"] == (verdict or ("block" if low > 0.5 else "allow"))
    verdicts = {r["host"]: r["verdict"] for r in out}
    assert {h for h, v in verdicts.items() if v == "block"} >= {f"h{i}.bad.net" for i in range(6)}
    assert verdicts["h1.fair.com"] == verdicts["new.other.io"] == "allow" and want["big.example.org"][1] < 0.1


def test_empty_tables_and_no_outcomes(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")] * 3, "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    assert rp.judge_urls(pages.limit(0), none).count() == 0
    assert [r["verdict"] for r in rp.judge_urls(pages, none).collect()] == ["allow"] * 3
    outcomes = spark.createDataFrame([(1, True), (1, False)], none.schema)
    assert {r["n_known"] for r in rp.judge_urls(pages, outcomes).collect()} == {6}
