"""Raw, processed and curated documents of jobs whose pages are resolved."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hiregrain.functions.text import sha256_hex
from hiregrain.operators.keys import lake_keys, local_date
from hiregrain.operators.pages import FACTS, page_facts, resolve_pages
from hiregrain.operators.sites import SITES, SiteRule, extract_fields
from hiregrain.operators.skew import checked_broadcast, salted_left_join
from hiregrain.schemas import CURATED_COLUMNS
from hiregrain.session import cut


def with_keys(jobs: DataFrame) -> DataFrame:
    """Adds ``dt`` and the three lake keys; all NULL when ``collected_at`` is not ISO-8601."""
    return jobs.withColumn("dt", local_date(F.col("collected_at"))).withColumns(
        lake_keys(F.col("source"), F.col("dt"), F.col("job_id"))
    )


def final_description(pages: DataFrame, length: int | None = None) -> DataFrame:
    """The description as stored, whole or cut to ``length``, and the hash of the whole text; an
    empty text has a hash too."""
    whole = F.coalesce("stored_text", F.lit(""))
    text = whole if length is None else F.left(whole, F.lit(length))
    return pages.withColumns(
        {"description_text": text, "content_hash": sha256_hex(whole)}
    ).drop("stored_text")


def curate_urls(
    urls: DataFrame,
    page_fetch: DataFrame,
    sites: tuple[SiteRule, ...] = SITES,
    keep: Callable[[DataFrame], DataFrame] = cut,
) -> DataFrame:
    """One row per URL with everything a job for that URL is documented with.

    Pages are parsed once per URL, however many jobs ask for it, and their html does
    not leave this step.
    """
    resolved = resolve_pages(urls, page_fetch, sites, keep).drop("site")
    curated = final_description(extract_fields(resolved, sites))
    parsed = [name for name in FACTS if name not in ("html_length", "text_preview")]
    return curated.drop("site", *parsed)


def curate_jobs(
    jobs: DataFrame,
    page_fetch: DataFrame,
    sites: tuple[SiteRule, ...] = SITES,
    keep: Callable[[DataFrame], DataFrame] = cut,
) -> DataFrame:
    """Every job (with keys) next to its URL's page facts, posting fields and errors.

    What the pages gave is stored: it is small, and no later reader parses them again.
    """
    per_url = keep(curate_urls(jobs.select("url").distinct(), page_fetch, sites, keep))
    return salted_left_join(
        jobs, per_url, ["url"], F.col("job_id"), counted=jobs.select("url")
    )


def processed_documents(curated: DataFrame, processed_at: Column) -> DataFrame:
    return curated.select(
        "job_id",
        "source",
        "url",
        "collected_at",
        "raw_s3_key",
        processed_at.alias("processed_at"),
        "html_length",
        "text_preview",
        "dt",
    )


def curated_documents(curated: DataFrame) -> DataFrame:
    renamed = {
        "posting_id": F.col("job_id"),
        "original_url": F.col("url"),
        "skills": F.lit("[]"),
    }
    return curated.select(
        *[renamed.get(name, F.col(name)).alias(name) for name in CURATED_COLUMNS], "dt"
    )


def raw_documents(curated: DataFrame, page_fetch: DataFrame) -> DataFrame:
    """The html each job ended with, joined only here because it is wide."""
    wanted = curated.select("job_id", "source", "dt", "raw_s3_key", "page_url")
    html = page_fetch.select(F.col("url").alias("page_url"), "html")
    asked_for = checked_broadcast(wanted.select("page_url").distinct())
    needed = html.join(asked_for, "page_url", "left_semi")
    return salted_left_join(wanted, needed, ["page_url"], F.col("job_id")).drop("page_url")


def last_of_batch(rows: DataFrame) -> DataFrame:
    """The last message of each identity: one object per key, as a keyed store would hold."""
    latest = Window.partitionBy("source", "dt", "job_id").orderBy(
        F.col("partition").desc(), F.col("offset").desc()
    )
    return rows.withColumn("_rank", F.row_number().over(latest)).where("_rank = 1").drop("_rank")


def reprocess_from_raw(
    raw_pages: DataFrame, jobs: DataFrame, sites: tuple[SiteRule, ...] = SITES
) -> DataFrame:
    """Curated documents from stored html after a rule change; nothing is fetched.

    ``raw_pages(source, dt, job_id, html)`` and ``jobs`` with keys share one identity, of which
    each has one row.
    """
    identity = ["source", "dt", "job_id"]
    facts = page_facts(raw_pages.select(*identity, "html"))
    stored = jobs.join(facts, identity)
    return curated_documents(
        final_description(extract_fields(stored, sites)).where("extract_error IS NULL")
    )

