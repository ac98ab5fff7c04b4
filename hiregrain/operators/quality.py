"""Data-quality checks as one verdict table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiregrain.operators.marts import quality_counts, quality_flags
from hiregrain.schemas import REQUIRED_CLEAN, REQUIRED_STAGING, VERDICT
from hiregrain.session import cut

MIN_POSTINGS = 5
MIN_FILL_RATE = 0.3

STAGING_NOT_EMPTY = "stg_not_empty"
CLEAN_NOT_EMPTY = "int_not_empty"
REQUIRED_FIELDS = "int_required_fields"
NO_DUPLICATE_HASH = "int_no_duplicate_content_hash"
DESCRIPTION_QUALITY = "description_quality"
# The two emptiness checks come first; each later check only counts if all before passed.
CHECK_ORDER = (
    STAGING_NOT_EMPTY,
    CLEAN_NOT_EMPTY,
    REQUIRED_FIELDS,
    NO_DUPLICATE_HASH,
    DESCRIPTION_QUALITY,
)


class QualityCheckFailed(Exception):
    """The first failing check, in the fixed order."""


def any_null(*names: str) -> Column:
    found = F.lit(False)
    for name in names:
        found = found | F.col(name).isNull()
    return found


def row_count(rows: DataFrame) -> DataFrame:
    return rows.agg(F.count(F.lit(1)).alias("row_count"))


def required_field_nulls(clean: DataFrame) -> DataFrame:
    return clean.where(any_null(*REQUIRED_CLEAN)).agg(F.count(F.lit(1)).alias("invalid_count"))


def duplicate_hashes(clean: DataFrame) -> DataFrame:
    """Content hashes that more than one posting has, with the number of postings."""
    return clean.groupBy("content_hash").agg(F.count(F.lit(1)).alias("posting_count")).where(
        "posting_count > 1"
    )


def fill_rates(quality: DataFrame) -> DataFrame:
    total, found = F.col("total_postings"), F.col("description_filled_count")
    rate = F.when(total == 0, F.lit(0.0)).otherwise(found / total)
    return quality.select("source", "total_postings", rate.alias("fill_rate"))


def fill_rate_too_low(
    min_postings: int = MIN_POSTINGS, min_fill_rate: float = MIN_FILL_RATE
) -> Column:
    return (F.col("total_postings") >= min_postings) & (F.col("fill_rate") < min_fill_rate)


def lacking() -> Column:
    """The required columns that a staging row lacks, as a text; empty if none."""
    names = [F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED_STAGING]
    return F.array_join(F.array_compact(F.array(*names)), ", ")


def required_violations(rows: DataFrame) -> DataFrame:
    """Rows that may not enter staging, each with the columns it lacks."""
    return rows.withColumn("violations", lacking()).where("violations <> ''")


def _verdict(check: str, subject: Column, observed: Column, threshold: float, passed: Column):
    return [
        F.lit(check).alias("check_name"),
        subject.alias("subject"),
        observed.cast("double").alias("observed"),
        F.lit(float(threshold)).alias("threshold"),
        F.lit("error").alias("severity"),
        passed.alias("passed"),
    ]


def check_verdicts(
    staging: DataFrame,
    min_postings: int = MIN_POSTINGS,
    min_fill_rate: float = MIN_FILL_RATE,
    keep: Callable[[DataFrame], DataFrame] = cut,
) -> DataFrame:
    """One row per check, and per source for the fill rate.

    The latest rows are reduced to flags and a hash before the deduplicating shuffle,
    stored once, and all checks over them read that narrow copy.
    """
    flags = keep(
        quality_flags(staging, field_missing=any_null(*REQUIRED_CLEAN)).drop(
            "original_url", "collected_at", "loaded_at", "posting_id"
        )
    )
    counted = flags.agg(
        F.count(F.lit(1)).alias("row_count"), F.count_if("field_missing").alias("invalid")
    )
    groups = duplicate_hashes(flags).agg(F.count(F.lit(1)).alias("groups"))
    return verdicts_of(
        row_count(staging), counted, groups, quality_counts(flags), min_postings, min_fill_rate
    )


def verdicts_of(
    staged: DataFrame,
    counted: DataFrame,
    groups: DataFrame,
    quality: DataFrame,
    min_postings: int = MIN_POSTINGS,
    min_fill_rate: float = MIN_FILL_RATE,
) -> DataFrame:
    """The verdicts on counts: ``staged`` (row_count), ``counted`` (row_count, invalid), ``groups``
    (groups) in one row each, and the ``quality`` counts of each source."""
    stg = staged.select(
        *_verdict(
            STAGING_NOT_EMPTY, F.lit("staging"), F.col("row_count"), 1, F.col("row_count") > 0
        )
    )
    rows = counted.select(
        *_verdict(
            CLEAN_NOT_EMPTY, F.lit("intermediate"), F.col("row_count"), 1, F.col("row_count") > 0
        )
    )
    required = counted.select(
        *_verdict(REQUIRED_FIELDS, F.lit("intermediate"), F.col("invalid"), 0, F.col("invalid") == 0)
    )
    hashes = groups.select(
        *_verdict(
            NO_DUPLICATE_HASH, F.lit("intermediate"), F.col("groups"), 0, F.col("groups") == 0
        )
    )
    rates = fill_rates(quality).select(
        *_verdict(
            DESCRIPTION_QUALITY,
            F.col("source"),
            F.col("fill_rate"),
            min_fill_rate,
            ~fill_rate_too_low(min_postings, min_fill_rate),
        )
    )
    parts = (rows, required, hashes, rates)
    return reduce(DataFrame.unionByName, parts, stg).select(*VERDICT.fieldNames())


def first_failure(verdicts: DataFrame) -> DataFrame:
    """The failing check that comes first, if any: one row, whatever the number of sources."""
    rank = F.array_position(F.array(*[F.lit(name) for name in CHECK_ORDER]), F.col("check_name"))
    return verdicts.where("NOT passed").orderBy(rank, "subject").limit(1)


def enforce(verdicts: DataFrame) -> None:
    """Raise on the first failing check."""
    failed = first_failure(verdicts).collect()
    if failed:
        row = failed[0]
        raise QualityCheckFailed(
            f"{row.check_name} failed for {row.subject}: "
            f"observed {row.observed}, threshold {row.threshold}"
        )
