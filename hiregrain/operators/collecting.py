"""Fetch jobs from listing pages, seed URLs and synthetic batches."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiregrain.functions.text import sha256_hex
from hiregrain.functions.urls import detail_links
from hiregrain.schemas import JOB

# URLs of the manual seed run and of the load-test batch.
SEED_URLS = (
    "https://invalid-url-test-1234.com",
    "https://example.com",
    "https://10.255.255.1",
    "http://httpstat.us/500",
    "https://www.wanted.co.kr/wd/242151",
)
GOOD_TEST_URLS = (
    "https://www.wanted.co.kr/wd/242151",
    "https://groupby.kr/positions/9644",
    "https://www.catch.co.kr/NCS/RecruitInfoDetails/543587",
)
BAD_TEST_URLS = ("https://invalid-url-test-1234.com", "https://10.255.255.1")


def iso_utc(time: Column) -> Column:
    return F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def job_id(batch_id: str, *parts: Column) -> Column:
    """An id that is the same however often a lost task is run again."""
    return sha256_hex(F.concat_ws("|", *parts, F.lit(batch_id)))


def job_messages(urls: DataFrame, batch_id: str, collected_at: Column) -> DataFrame:
    """A fresh job per row of ``urls(source, url[, ordinal])``."""
    parts = [F.col(name) for name in ("source", "url", "ordinal") if name in urls.columns]
    return urls.select(
        job_id(batch_id, *[part.cast("string") for part in parts]).alias("job_id"),
        "source",
        "url",
        collected_at.alias("collected_at"),
        F.lit(0).alias("retry_count"),
    ).select(*JOB.fieldNames())


def topic_messages(jobs: DataFrame) -> DataFrame:
    """``(key, value)`` for the fetch topic."""
    value = F.to_json(F.struct(*JOB.fieldNames()), {"ignoreNullFields": "false"})
    return jobs.select(
        F.col("job_id").cast("binary").alias("key"), value.cast("binary").alias("value")
    )


def listing_links(listing_pages: DataFrame, site: str) -> DataFrame:
    """Distinct ``(source, url)`` detail links of all listing pages of a site."""
    found = listing_pages.where(F.col("site") == site).select(
        F.lit(site).alias("source"), F.explode(detail_links(F.col("html"), site)).alias("url")
    )
    return found.distinct()


def first_links(links: DataFrame, limit: int | None = None) -> DataFrame:
    """The first links of each source in code-point order; all of them for ``None``."""
    if limit is None:
        return links
    by_url = Window.partitionBy("source").orderBy("url")
    return (
        links.withColumn("_rank", F.row_number().over(by_url))
        .where(F.col("_rank") <= limit)
        .drop("_rank")
    )


def collect_jobs(
    listing_pages: DataFrame,
    site: str,
    batch_id: str,
    collected_at: Column,
    limit: int | None = None,
) -> DataFrame:
    return job_messages(first_links(listing_links(listing_pages, site), limit), batch_id, collected_at)


def seed_jobs(
    spark: SparkSession,
    batch_id: str,
    collected_at: Column,
    urls: DataFrame | tuple[str, ...] = SEED_URLS,
) -> DataFrame:
    """Jobs for given URLs: a frame with ``url``, or a short list typed in."""
    if not isinstance(urls, DataFrame):
        urls = spark.createDataFrame([(url,) for url in urls], "url string")
    seeds = urls.select(F.lit("seed").alias("source"), "url")
    return job_messages(seeds, batch_id, collected_at)


def synthetic_jobs(
    tests: DataFrame,
    batch_id: str,
    collected_at: Column,
    good: tuple[str, ...] = GOOD_TEST_URLS,
    bad: tuple[str, ...] = BAD_TEST_URLS,
) -> DataFrame:
    """A job per row of ``tests(ordinal, fails)``: ordinals take turns through the URLs that can
    be fetched, or through those that fail."""

    def turn(urls: tuple[str, ...]) -> Column:
        values = F.array(*[F.lit(url) for url in urls])
        return F.get(values, F.pmod("ordinal", F.lit(len(urls))).cast("int"))

    urls = tests.select(
        F.lit("load_test").alias("source"),
        F.when(F.col("fails"), turn(bad)).otherwise(turn(good)).alias("url"),
        "ordinal",
    )
    return job_messages(urls, batch_id, collected_at)
