"""Routing by a table of domains: for registries too long for one branch of CASE per site."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.functions.urls import authority
from hiregrain.operators.sites import SITES, SiteRule
from hiregrain.operators.skew import checked_broadcast, salted_left_join

#: Letters of a gram at most; a shorter domain is its own gram.
GRAM = 8


def domain_table(spark: SparkSession, sites: tuple[SiteRule, ...] = SITES) -> DataFrame:
    """(name, domain, ordinal) of site rules in their order."""
    rows = [(site.name, site.domain, k) for k, site in enumerate(sites)]
    return spark.createDataFrame(rows, "name string, domain string, ordinal long")


def _grams(text: Column, size: Column | int) -> Column:
    """The distinct substrings of a size; none if the text is shorter."""
    last = F.length(text) - size + 1
    at = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(at, lambda k: F.substring(text, k, F.lit(size))))


def keyed_domains(domains: DataFrame) -> DataFrame:
    """Domains with one gram each, the one that fewest domains have. An empty one has none."""
    size = F.least(F.length("domain"), F.lit(GRAM))
    every = domains.where("domain <> ''").select("*", F.explode(_grams(F.col("domain"), size)).alias("gram"))
    counts = every.groupBy("gram").agg(F.count(F.lit(1)).alias("shared"))
    rarest = F.min(F.struct("shared", "gram")).alias("rarest")
    chosen = every.join(counts, "gram").groupBy("name", "domain", "ordinal").agg(rarest)
    return chosen.select("name", "domain", "ordinal", F.col("rarest.gram").alias("gram"))


def matched_hosts(hosts: DataFrame, domains: DataFrame) -> DataFrame:
    """(host, site) of the ``hosts`` (host) that hold a domain: the first by ``ordinal``.

    A host holds a domain only if it holds the domain's gram, so grams meet in an equality join
    and only what meets is searched for. A domain and a host of any length are compared whole.
    """
    keyed = keyed_domains(domains).withColumn("size", F.length("gram"))
    sizes = sorted(row["size"] for row in keyed.select("size").distinct().collect())
    if not sizes:
        return hosts.select("host", F.lit(None).cast("string").alias("site")).limit(0)
    parts = F.flatten(F.array(*[_grams(F.col("host"), size) for size in sizes]))
    met = hosts.select("host", F.explode(parts).alias("gram")).join(checked_broadcast(keyed), "gram")
    held = met.where(F.contains("host", "domain"))
    return held.groupBy("host").agg(F.min_by("name", F.struct("ordinal", "name")).alias("site"))


def with_site(rows: DataFrame, domains: DataFrame, url: str = "url") -> DataFrame:
    """``rows`` with ``site``, the name of the first of ``domains`` (name, domain, ordinal) whose
    domain is part of the URL's authority, else NULL, as ``site_of`` finds it.

    Each host is looked at once, however many rows have it. A null URL has no site.
    """
    hosted = rows.withColumn("_host", authority(F.col(url)))
    found = matched_hosts(hosted.select(F.col("_host").alias("host")).where("host <> ''").distinct(), domains)
    sites = found.withColumnRenamed("host", "_host")
    return salted_left_join(hosted, sites, ["_host"], F.xxhash64(url)).drop("_host")
