"""Marts over the latest postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiregrain.operators.latest import POSTING_KEY, RECENCY, latest_rows


def filled(name: str) -> Column:
    return F.coalesce(F.col(name) != "", F.lit(False))


def slim(staging: DataFrame, **extra: Column) -> DataFrame:
    """Key and order columns plus small derived ones, so wide text stays in the scan."""
    return staging.select(
        *POSTING_KEY, *RECENCY, *[column.alias(name) for name, column in extra.items()]
    )


def daily_counts(clean: DataFrame) -> DataFrame:
    """Postings per UTC collection date and source, newest date first."""
    return (
        clean.groupBy(F.to_date("collected_at").alias("collected_date"), "source")
        .agg(F.count(F.lit(1)).alias("posting_count"))
        .orderBy(F.col("collected_date").desc(), "source")
    )


def mart_daily(staging: DataFrame) -> DataFrame:
    return daily_counts(latest_rows(slim(staging)))


def flagged(rows: DataFrame, **extra: Column) -> DataFrame:
    """Rows reduced to what the quality mart counts."""
    return slim(
        rows,
        description_filled=filled("description_text"),
        content_hash_filled=filled("content_hash"),
        missing_title=~filled("title"),
        missing_company=~filled("company_name"),
        **extra,
    )


def quality_flags(staging: DataFrame, **extra: Column) -> DataFrame:
    """Latest postings reduced to what the quality mart counts."""
    return latest_rows(flagged(staging, **extra))


def quality_counts(flags: DataFrame, *by: Column | str) -> DataFrame:
    return flags.groupBy(*(by or ("source",))).agg(
        F.count(F.lit(1)).alias("total_postings"),
        F.count_if("description_filled").alias("description_filled_count"),
        F.count_if("content_hash_filled").alias("content_hash_filled_count"),
        F.count_if("missing_title").alias("missing_title_count"),
        F.count_if("missing_company").alias("missing_company_count"),
    )


def mart_source_quality(staging: DataFrame) -> DataFrame:
    """Fill and gap counts per source, largest source first."""
    return quality_counts(quality_flags(staging)).orderBy(
        F.col("total_postings").desc(), "source"
    )
