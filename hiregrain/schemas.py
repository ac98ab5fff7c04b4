"""Declared schemas of every message, document and table.

Fixed values: the names, types and order of columns are those that other systems read and write.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str, nullable: bool = True) -> list[T.StructField]:
    return [T.StructField(name, T.StringType(), nullable) for name in names]


TOPIC = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

JOB = T.StructType(
    [*_strings("job_id", "source", "url", "collected_at"), T.StructField("retry_count", T.IntegerType())]
)

PAGE_FETCH = T.StructType(
    [
        *_strings("url", "html", "error_class"),
        T.StructField("status_code", T.IntegerType()),
        *_strings("error_message"),
    ]
)

SIGNALS = T.StructType(
    _strings("title_tag", "og_title", "meta_description", "canonical_href", "job_ld")
)

POSTING_FIELDS = (
    "company_name",
    "title",
    "location",
    "employment_type",
    "experience_level",
    "description_text",
)

PROCESSED = T.StructType(
    [
        *_strings("job_id", "source", "url", "collected_at", "raw_s3_key"),
        T.StructField("processed_at", T.TimestampType()),
        T.StructField("html_length", T.IntegerType()),
        *_strings("text_preview"),
    ]
)

CURATED_COLUMNS = (
    "posting_id",
    "source",
    "original_url",
    "company_name",
    "title",
    "location",
    "employment_type",
    "experience_level",
    "description_text",
    "skills",
    "collected_at",
    "content_hash",
    "raw_s3_key",
    "processed_s3_key",
    "curated_s3_key",
)

CURATED = T.StructType(_strings(*CURATED_COLUMNS))

REQUIRED_STAGING = (
    "posting_id",
    "source",
    "original_url",
    "collected_at",
    "content_hash",
    "raw_s3_key",
    "processed_s3_key",
    "curated_s3_key",
    "loaded_at",
)

#: What a clean posting may not lack.
REQUIRED_CLEAN = ("title", "original_url", "source", "collected_at")

STAGING_COLUMNS = (*CURATED_COLUMNS, "loaded_at")

STAGING = T.StructType(
    [
        T.StructField(
            name,
            T.TimestampType() if name in ("collected_at", "loaded_at") else T.StringType(),
            name not in REQUIRED_STAGING,
        )
        for name in STAGING_COLUMNS
    ]
)

LOAD_CHECKPOINT = T.StructType(
    [
        T.StructField("s3_key", T.StringType(), False),
        T.StructField("loaded_at", T.TimestampType(), False),
        T.StructField("rule_version", T.LongType()),
    ]
)

DLQ_EVENTS = T.StructType(
    [
        *_strings("failed_at", "failed_stage", "error_type", "error_message"),
        T.StructField("retry_count", T.IntegerType()),
        *_strings("source", "url", "payload"),
    ]
)

VERDICT = T.StructType(
    [
        *_strings("check_name", "subject"),
        T.StructField("observed", T.DoubleType()),
        T.StructField("threshold", T.DoubleType()),
        *_strings("severity"),
        T.StructField("passed", T.BooleanType()),
    ]
)
