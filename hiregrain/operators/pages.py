"""Pages: what one crawl result says, and which page stands for a URL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiregrain.functions.page_signals import signals_of
from hiregrain.functions.text import WS, drop_tags
from hiregrain.operators.sites import SITES, SiteRule, site_flag, site_of
from hiregrain.operators.skew import checked_broadcast, salted_left_join
from hiregrain.schemas import SIGNALS
from hiregrain.session import cut

PREVIEW_LENGTH = 500
NOT_FETCHED = "not_fetched"

FACTS = ("html_length", "text_preview", *SIGNALS.fieldNames(), "body_markup")


def page_facts(pages: DataFrame) -> DataFrame:
    """Replaces ``html`` by everything later steps need of it.

    One tokenizer pass per page. The page's text (still with entities) is kept only
    where the meta description may turn out blank, as nothing else falls back to it.
    """
    html = F.col("html")
    others = [name for name in pages.columns if name != "html"]
    read = pages.select("*", F.inline(F.array(signals_of(html))))
    sure = F.coalesce(
        F.regexp_like("meta_description", F.lit(f"(?U)^[{WS}]*[^{WS}&]")), F.lit(False)
    )
    return read.withColumns(
        {
            "html_length": F.length(html),
            "text_preview": F.left(html, F.lit(PREVIEW_LENGTH)),
            "body_markup": F.when(~sure, drop_tags(html)),
        }
    ).select(*others, *FACTS)


def fetch_error_type(error_class: Column, status: Column, message: Column) -> Column:
    """Class of a failed fetch; the special cases come before the general ones."""
    lowered = F.lower(F.coalesce(message, F.lit("")))
    unresolved = F.contains(lowered, F.lit("name or service not known")) | F.contains(
        lowered, F.lit("failed to resolve")
    )
    http = (
        F.when(status.between(400, 499), F.concat(F.lit("http_4xx_"), status))
        .when(status.between(500, 599), F.concat(F.lit("http_5xx_"), status))
        .otherwise("http_error")
    )
    return (
        F.when(error_class == "ConnectTimeout", "connect_timeout")
        .when(error_class == "ReadTimeout", "read_timeout")
        .when(error_class == "SSLError", "ssl_error")
        .when(error_class == "HTTPError", http)
        .when(
            error_class.isin("ConnectionError", "ProxyError"),
            F.when(unresolved, "dns_error").otherwise("connection_error"),
        )
        .otherwise(error_class)
    )


def fetch_outcome(pages: DataFrame) -> DataFrame:
    """Adds ``fetch_error`` and ``fetch_message``, both NULL for a page that was fetched."""
    failed = F.col("error_class").isNotNull()
    absent = F.col("html").isNull()
    error = fetch_error_type(F.col("error_class"), F.col("status_code"), F.col("error_message"))
    return pages.withColumns(
        {
            "fetch_error": F.when(failed, error).when(absent, NOT_FETCHED),
            "fetch_message": F.when(failed, F.coalesce("error_message", F.lit(""))).when(
                absent, "no page was fetched for this url"
            ),
        }
    )


def wants_canonical(
    site: Column, url: Column, canonical: Column, sites: tuple[SiteRule, ...] = SITES
) -> Column:
    """The site asks for it and the page names another, non-empty canonical URL."""
    return site_flag(site, "refetch_canonical", sites) & F.coalesce(
        (canonical != "") & (canonical != url), F.lit(False)
    )


def resolve_pages(
    urls: DataFrame,
    page_fetch: DataFrame,
    sites: tuple[SiteRule, ...] = SITES,
    keep: Callable[[DataFrame], DataFrame] = cut,
) -> DataFrame:
    """One row per URL: page facts, the URL they came from, or the fetch error.

    ``urls`` and ``page_fetch`` hold each URL once. Only needed pages are parsed, each
    once; pages of sites with canonical refetch are stored after parsing because both
    the list of canonical URLs and the final rows are made from them.
    """
    # Crawl results are cut down to the needed ones first, without moving the others: a left
    # join could not broadcast its left side and would shuffle every page.
    asked_for = checked_broadcast(urls.select("url"))
    needed = keep(page_fetch.join(asked_for, "url", "left_semi"))
    placed = fetch_outcome(urls.select("url").join(needed, "url", "left")).withColumn(
        "site", site_of(F.col("url"), sites)
    )
    facts = page_facts(
        placed.select("url", "site", "html", "fetch_error", "fetch_message")
    ).withColumn("page_url", F.when(F.col("fetch_error").isNull(), F.col("url")))

    refetching = site_flag(F.col("site"), "refetch_canonical", sites)
    if not any(site.refetch_canonical for site in sites):
        return facts
    # The flag depends on the URL alone, so both filters reach the scan below the parser.
    plain, first = facts.where(~refetching), keep(facts.where(refetching))
    wants = wants_canonical(F.col("site"), F.col("url"), F.col("canonical_href"), sites)
    asked = first.withColumn("_canonical", F.when(wants, F.col("canonical_href")))
    targets = asked.where("_canonical IS NOT NULL").select(F.col("_canonical").alias("url"))
    fetched = page_fetch.where("html IS NOT NULL AND error_class IS NULL")
    second = page_facts(
        fetched.join(checked_broadcast(targets.distinct()), "url", "left_semi").select("url", "html")
    ).select(F.col("url").alias("_canonical"), F.struct(*FACTS).alias("_second"))
    joined = salted_left_join(asked, second, ["_canonical"], F.col("url"))
    found = F.col("_second").isNotNull()
    replaced = joined.select(
        *[name for name in facts.columns if name not in (*FACTS, "page_url")],
        *[
            F.when(found, F.col(f"_second.{name}")).otherwise(F.col(name)).alias(name)
            for name in FACTS
        ],
        F.when(found, F.col("_canonical")).otherwise(F.col("page_url")).alias("page_url"),
    )
    return plain.unionByName(replaced)
