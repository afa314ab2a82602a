import pytest
from pyspark.sql import functions as F

from barlake.llm import url_reputation as U

SCHEMA = "page_id long, url string, host string, path string, m string"


@pytest.mark.parametrize("url,host,path", [
    ("http://A.Example.ORG/es/x?q#f", "a.example.org", "/es/x"), ("https://h?x=/y", "h", ""), ("x://h#/a", "h", ""), ("no scheme/a", "", ""),
    (None, "", ""), ("", "", ""), ("://h/p", "h", "/p"), ("a://b://c/d", "b:", "//c/d"), ("http://É.COM:80/Ä\n/b", "É.com:80", "/Ä\n/b"), ("http:///p", "", "/p")])
def test_url_parts(spark, url, host, path):
    df = spark.createDataFrame([(url,)], "u string")
    h, p = U.url_parts(F.col("u"))
    assert tuple(df.select(h, p).first()) == (host, path)


def test_rules_longest_wins_on_host_and_subdomains(spark):
    cases = {("example.org", "/es/a"): ("example.org/es/", "block"), ("m.example.org", "/en/17"): ("example.org/en/1", "block"),
             ("example.org", "/en/2"): ("org/", "allow"), ("badexample.org", "/es/"): ("org/", "allow"), ("org", ""): (None, None),
             ("x.com", "/fr/1"): ("com/fr/", "allow"), ("x.com", "/de/1"): ("com/de/", "block"), ("xcom", "/de/1"): (None, None), ("", ""): (None, None)}
    df = spark.createDataFrame([(h, p) for h, p in cases], "h string, p string")
    rule, verdict = U.rule_of(F.col("h"), F.col("p"))
    assert {(r.h, r.p): (r[2], r[3]) for r in df.select("h", "p", rule, verdict).collect()} == cases


def test_domain_levels(spark):
    cases = {"a.b.example.com": ("example.com", "com"), "x.example.co.uk": ("example.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "localhost": ("localhost", "localhost"),
             "10.1.2.3:80": ("10.1.2.3", "10.1.2.3"), "": ("", ""), "example.net:8080": ("example.net", "net")}
    df = spark.createDataFrame([(h,) for h in cases], "h string")
    d, s = U.domain_levels(F.col("h"))
    assert {r.h: (r[1], r[2]) for r in df.select("h", d, s).collect()} == cases


def test_reputation_shrinks_from_host_to_domain_to_suffix(spark):
    out = [("bad.spam.net", 1)] * 60 + [("bad.spam.net", 0)] + [("www.good.com", 0)] * 80 + [("one.spam.net", 1)] + [("a.mixed.com", i % 2) for i in range(40)] + [("a.mixed.com", None)]
    hosts = [("bad.spam.net",), ("www.good.com",), ("one.spam.net",), ("new.spam.net",), ("new.good.com",), ("other.org",), ("a.mixed.com",), ("",)]
    rep = {r.host: r for r in U.host_reputation(spark.createDataFrame(hosts * 2, "host string"), spark.createDataFrame(out, "host string, bad int")).collect()}
    assert len(rep) == 8 and rep["a.mixed.com"].n == 40 and rep["new.spam.net"].n == 0
    assert rep["bad.spam.net"].bound > 0.5 > rep["a.mixed.com"].bound
    assert rep["www.good.com"].mean < rep["new.good.com"].mean < rep["other.org"].mean < rep["new.spam.net"].mean < rep["bad.spam.net"].mean
    assert all(r.bound < r.mean for r in rep.values())


def test_judged_pages_hot_host_nulls_and_empty_tables(spark):
    rows = [(i, "http://bad.spam.net/en/1", None, "p", None) for i in range(50)] + [(None, None, None, None, None), (7, "", "h", None, None), (8, "http://x.com/de/", None, None, "m")]
    outcomes = spark.createDataFrame([("bad.spam.net", 1)] * 50 + [("www.good.com", 0)] * 50, "host string, bad int")
    got = U.judge_urls(spark.createDataFrame(rows, SCHEMA).repartition(3), outcomes).collect()
    assert len(got) == len(rows)
    assert {r.verdict for r in got if r.host == "bad.spam.net"} == {"block"}
    assert {(r.page_id, r.host, r.rule, r.verdict) for r in got if r.host != "bad.spam.net"} == {(None, "", None, "allow"), (7, "", None, "allow"), (8, "x.com", "com/de/", "block")}
    none = spark.createDataFrame([], "host string, bad int")
    assert {r.verdict for r in U.judge_urls(spark.createDataFrame(rows[:1], SCHEMA), none).collect()} == {"allow"}
    assert U.judge_urls(spark.createDataFrame([], SCHEMA), outcomes).collect() == []


def test_very_long_urls_and_hosts(spark):
    host, path = "sub." * 20_000 + "spam.net", "/de/" + "x" * 500_000
    rows = [(1, f"http://{host}{path}?q", None, None, None), (2, "http://" + "h" * 300_000, None, None, None), (3, "u" * 400_000, None, None, None)]
    outcomes = spark.createDataFrame([("bad.spam.net", 1)] * 50 + [("www.good.com", 0)] * 50, "host string, bad int")
    got = {r.page_id: r for r in U.judge_urls(spark.createDataFrame(rows, SCHEMA), outcomes).collect()}
    assert (got[1].host, got[1].path) == (host, path) and got[1].rule is None
    assert (got[2].host, got[2].path) == ("h" * 300_000, "") and (got[3].host, got[3].verdict) == ("", "allow")
