"""Domains from a table against a search one by one."""

import random

from pyspark.sql import functions as F

from hiregrain.operators.domains import domain_table, matched_hosts, with_site
from hiregrain.operators.sites import SITES, site_of

LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789-"


def test_many_domains_equal_a_search_one_by_one(spark):
    rnd = random.Random(5)
    names = ["".join(rnd.choices(LETTERS, k=rnd.randint(3, 14))) + rnd.choice([".com", ".co.kr", ".io"]) for _ in range(9_990)]
    domains = [*names, "x.y", "co", "www.long-name-of-a-site.example", "q", "", ".kr"] + names[:4]
    table = spark.createDataFrame(
        [(f"site{k}", domain, k) for k, domain in enumerate(domains)], "name string, domain string, ordinal long"
    )
    hosts = ["", "q", "x.y", "nothing", "www.x.y:80", "me@www.long-name-of-a-site.example"]
    hosts += [f"{rnd.choice(['www.', '', 'jobs.'])}{rnd.choice(names)}{rnd.choice(['', ':8080', '.kr'])}" for _ in range(150)]
    frame = spark.createDataFrame([(host,) for host in set(hosts)], "host string")
    result = matched_hosts(frame, table)
    found = {row["host"]: row["site"] for row in result.collect()}
    for host in hosts:
        first = next((k for k, domain in enumerate(domains) if domain and domain in host), None)
        assert found.get(host) == (None if first is None else f"site{first}")
    plan = result._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_the_same_sites_as_by_rules(spark):
    urls = ["https://www.wanted.co.kr/wd/1", "//SARAMIN.co.kr:443/x", "https://a.example/wanted.co.kr", None, "", "no url"]
    rows = spark.createDataFrame([(k, url) for k, url in enumerate(urls * 3)], "k int, url string")
    found = {row["k"]: row["site"] for row in with_site(rows, domain_table(spark)).collect()}
    assert found == {row["k"]: row["site"] for row in rows.select("k", site_of(F.col("url")).alias("site")).collect()}
    assert len(found) == 18 and found[0] == SITES[0].name
    assert with_site(rows, domain_table(spark).limit(0)).where("site is null").count() == 18
