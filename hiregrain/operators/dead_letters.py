"""Failure messages: archive rows and replay decisions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiregrain.functions.linked_data import part
from hiregrain.operators.gate import filled_text, gate_failures, retry_count
from hiregrain.operators.routing import MAX_RETRY, exceeds_retry_limit

REPLAYED_STAGE = "fetch"


def _text(value: Column, field: str) -> Column:
    return F.try_variant_get(value, f"$.{field}", "string")


def archive_rows(messages: DataFrame, now: Column) -> DataFrame:
    """One ``dlq_events`` row per readable failure message."""
    return event_rows(gate_failures(messages), now)


def event_rows(gated: DataFrame, now: Column) -> DataFrame:
    """One ``dlq_events`` row per readable message of those that went through the gate.

    ``failed_at`` and ``retry_count`` get a default only where the key is absent; a JSON
    null stays NULL. ``payload`` is the message as it came.
    """
    events = gated.where("NOT rejected")
    payload, job = F.col("payload"), F.col("job")
    failed_at = F.when(part(payload, "$.failed_at").isNull(), now).otherwise(
        _text(payload, "failed_at")
    )
    attempts = F.when(part(job, "$.retry_count").isNull(), F.lit(0)).otherwise(
        F.try_variant_get(job, "$.retry_count", "int")
    )
    return events.select(
        failed_at.alias("failed_at"),
        _text(payload, "failed_stage").alias("failed_stage"),
        _text(payload, "error_type").alias("error_type"),
        _text(payload, "error_message").alias("error_message"),
        attempts.alias("retry_count"),
        _text(job, "source").alias("source"),
        _text(job, "url").alias("url"),
        F.col("message").alias("payload"),
    )


def replay_decisions(messages: DataFrame, max_retry: int = MAX_RETRY) -> DataFrame:
    """Adds ``skip_reason``; NULL marks jobs that go back to the fetch topic."""
    read = gate_failures(messages)
    job = F.col("job")
    has_job = F.coalesce(F.to_json(job) != "{}", F.lit(False))
    counted = read.withColumns(
        {
            "failed_stage": _text(F.col("payload"), "failed_stage"),
            "retry_count": retry_count(job),
            "job_id": filled_text(job, "job_id"),
        }
    )
    other_stage = ~F.coalesce(F.col("failed_stage") == REPLAYED_STAGE, F.lit(False))
    reason = (
        F.when(F.col("rejected"), "unreadable")
        .when(~has_job, "no_job")
        .when(exceeds_retry_limit(F.col("retry_count"), max_retry), "retry_limit")
        .when(other_stage, "unsupported_stage")
        .when(F.col("job_id").isNull(), "no_job_id")
    )
    return counted.withColumn("skip_reason", reason)


#: What becomes of a failure: it goes back, or the reason why not.
REPLAYED = "replayed"
DECISIONS = (REPLAYED, "unreadable", "no_job", "retry_limit", "unsupported_stage", "no_job_id")


def decision() -> Column:
    return F.coalesce("skip_reason", F.lit(REPLAYED))


def replay_messages(decisions: DataFrame) -> DataFrame:
    """``(key, value)`` of replayed jobs: the stored job, unchanged."""
    return decisions.where("skip_reason IS NULL").select(
        F.col("job_id").cast("binary").alias("key"),
        F.to_json("job").cast("binary").alias("value"),
    )


def replay_counts(decisions: DataFrame) -> DataFrame:
    return decisions.groupBy(decision().alias("decision")).agg(
        F.count(F.lit(1)).alias("message_count")
    )
