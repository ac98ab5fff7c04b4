"""Operational views: volumes, failures, description quality and freshness."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiregrain.operators.marts import filled


def _count(rows: DataFrame, name: str, *by) -> DataFrame:
    return rows.groupBy(*by).agg(F.count(F.lit(1)).alias(name))


def posting_volume(clean: DataFrame) -> DataFrame:
    return _count(clean, "posting_count", F.to_date("collected_at").alias("collected_date"))


def source_volume(clean: DataFrame) -> DataFrame:
    return _count(clean, "posting_count", "source")


def failures_per_hour(events: DataFrame) -> DataFrame:
    """Failure counts per hour; times that are not timestamps count under NULL."""
    time = F.try_to_timestamp("failed_at")
    return _count(events, "event_count", F.date_trunc("hour", time).alias("failed_hour"))


def retry_distribution(events: DataFrame) -> DataFrame:
    return _count(events, "event_count", "retry_count")


def error_types(events: DataFrame) -> DataFrame:
    return _count(events, "event_count", "error_type")


def failed_stages(events: DataFrame) -> DataFrame:
    return _count(events, "event_count", "failed_stage")


def failure_trend(events: DataFrame) -> DataFrame:
    """Failures per hour and error type; times that are not timestamps count under NULL."""
    hour = F.date_trunc("hour", F.try_to_timestamp("failed_at")).alias("failed_hour")
    return _count(events, "event_count", hour, "error_type")


def summed_trend(counts: DataFrame) -> DataFrame:
    """Counts of several batches as one."""
    total = F.sum("event_count").alias("event_count")
    return counts.groupBy("failed_hour", "error_type").agg(total)


def description_trend(clean: DataFrame) -> DataFrame:
    """Description fill rate per collection date and source."""
    counted = clean.groupBy(F.to_date("collected_at").alias("collected_date"), "source").agg(
        F.count(F.lit(1)).alias("total_postings"),
        F.count_if(filled("description_text")).alias("description_filled_count"),
    )
    return counted.withColumn(
        "fill_rate", F.col("description_filled_count") / F.col("total_postings")
    )


def load_trend(staging: DataFrame) -> DataFrame:
    return _count(staging, "row_count", F.date_trunc("hour", "loaded_at").alias("loaded_hour"))


def freshness(staging: DataFrame) -> DataFrame:
    return staging.groupBy("source").agg(
        F.max("loaded_at").alias("last_loaded_at"),
        F.max("collected_at").alias("last_collected_at"),
    )
