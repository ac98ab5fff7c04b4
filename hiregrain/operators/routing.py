"""What becomes of each message of one batch: one outcome per message, then the sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiregrain.operators.curation import curate_urls, with_keys
from hiregrain.operators.gate import gate_jobs
from hiregrain.operators.sites import SITES, SiteRule
from hiregrain.operators.skew import hot_keys, salted_left_join
from hiregrain.session import cut

MAX_RETRY = 3

# Outcomes, in the order they are decided.
MALFORMED = "malformed"
RETRY_EXCEEDED = "retry_exceeded"
PARSE_FAILED = "parse_failed"
DUPLICATE = "duplicate"
FETCH_FAILED = "fetch_failed"
CURATED_FAILED = "curated_failed"
SUCCESS = "success"
OUTCOMES = (MALFORMED, RETRY_EXCEEDED, PARSE_FAILED, DUPLICATE, FETCH_FAILED, CURATED_FAILED, SUCCESS)


def exceeds_retry_limit(count: Column, limit: int = MAX_RETRY) -> Column:
    return count >= limit


def early_outcome(limit: int = MAX_RETRY) -> Column:
    """Outcome of messages that need no page; NULL for those that go on."""
    return (
        F.when(F.col("malformed_reason").isNotNull(), MALFORMED)
        .when(exceeds_retry_limit(F.col("retry_count"), limit), RETRY_EXCEEDED)
        .when(F.col("dt").isNull(), PARSE_FAILED)
    )


def gate_and_key(messages: DataFrame, limit: int = MAX_RETRY) -> DataFrame:
    """Messages with what routing needs of them; only malformed ones keep their bytes."""
    gated = with_keys(gate_jobs(messages)).withColumn("outcome", early_outcome(limit))
    kept = F.when(F.col("outcome") == MALFORMED, F.col("value"))
    return gated.withColumn("value", kept).drop("key", "timestamp")


def route(
    gated: DataFrame,
    page_fetch: DataFrame,
    curated_keys: DataFrame,
    sites: tuple[SiteRule, ...] = SITES,
    keep: Callable[[DataFrame], DataFrame] = cut,
) -> DataFrame:
    """Completes ``outcome`` for gated messages, with page facts and fields for each job.

    ``gated`` is read several times: pass a stored frame, so that messages are parsed
    once. ``curated_keys(dt, job_id)`` names the documents that exist. Processing is as if
    messages came one by one in ``(partition, offset)`` order: after the first success
    for a ``(dt, job_id)`` every later message for it is a duplicate, while failures
    before it stand. Jobs already done are set aside before any page is touched.
    """
    identity = ["dt", "job_id"]
    live = gated.where("outcome IS NULL").drop("outcome")
    keys = live.select(*identity)
    hot = keep(hot_keys(keys, identity))
    done = curated_keys.select(*identity).join(keys.distinct(), identity, "left_semi").distinct()
    marked = keep(
        salted_left_join(
            live,
            done.withColumn("_done", F.lit(True)),
            identity,
            F.struct("partition", "offset"),
            hot=hot,
        )
    )
    jobs = marked.where("_done IS NULL").drop("_done")
    per_url = keep(curate_urls(jobs.select("url").distinct(), page_fetch, sites, keep))
    hot_urls = keep(hot_keys(jobs.select("url"), ["url"]))

    def with_page(rows: DataFrame, *names: str) -> DataFrame:
        given = per_url.select("url", *names) if names else per_url
        return salted_left_join(rows, given, ["url"], F.col("job_id"), hot=hot_urls)

    # Errors decide; the texts of pages join the jobs only when these are moved no more.
    errors = ("fetch_error", "extract_error")
    tried = with_page(jobs, *errors).withColumns(
        {
            "outcome": F.when(F.col("fetch_error").isNotNull(), FETCH_FAILED)
            .when(F.col("extract_error").isNotNull(), CURATED_FAILED)
            .otherwise(SUCCESS),
            "_order": F.struct("partition", "offset"),
        }
    ).drop(*errors)
    first_ok = (
        tried.where(F.col("outcome") == SUCCESS)
        .groupBy(*identity)
        .agg(F.min("_order").alias("_first_ok"))
    )
    late = F.col("_order") > F.col("_first_ok")
    settled = (
        salted_left_join(tried, first_ok, identity, F.col("_order"), hot=hot)
        .withColumn("outcome", F.when(late, DUPLICATE).otherwise(F.col("outcome")))
        .drop("_order", "_first_ok")
    )
    settled = with_page(settled)
    aside = marked.where("_done").drop("_done").withColumn("outcome", F.lit(DUPLICATE))
    return (
        gated.where("outcome IS NOT NULL")
        .unionByName(aside)
        .unionByName(settled, allowMissingColumns=True)
    )


def route_messages(
    messages: DataFrame,
    page_fetch: DataFrame,
    curated_keys: DataFrame,
    limit: int = MAX_RETRY,
    sites: tuple[SiteRule, ...] = SITES,
    keep: Callable[[DataFrame], DataFrame] = cut,
) -> DataFrame:
    """Gate and route one bounded batch of messages."""
    return route(keep(gate_and_key(messages, limit)), page_fetch, curated_keys, sites, keep)


def bumped_job(job: Column, retry_count: Column) -> Column:
    """The whole job, extra fields included, with one more attempt counted."""
    fields = F.try_variant_get(job, "$", "map<string,variant>")
    rest = F.map_filter(fields, lambda name, _: name != "retry_count")
    bumped = F.create_map(F.lit("retry_count"), (retry_count + 1).cast("variant"))
    return F.map_concat(rest, bumped)


def failure_messages(routed: DataFrame, failed_at: Column, *kept: str) -> DataFrame:
    """``(key, value)`` for the failure topic: an envelope per failed message.

    Columns named in ``kept`` come out next to them.
    """
    outcome = F.col("outcome")
    malformed = outcome == MALFORMED
    error_type = (
        F.when(malformed, "malformed_message")
        .when(outcome == PARSE_FAILED, "ValueError")
        .when(outcome == FETCH_FAILED, F.col("fetch_error"))
        .otherwise(F.col("extract_error"))
    )
    message = (
        F.when(malformed, F.col("malformed_reason"))
        .when(
            outcome == PARSE_FAILED,
            F.concat(F.lit("collected_at is not an ISO-8601 time: "), F.col("collected_at")),
        )
        .when(outcome == FETCH_FAILED, F.col("fetch_message"))
        .otherwise(F.lit("a linked-data or description field has an unusable type"))
    )
    stage = (
        F.when(outcome.isin(MALFORMED, PARSE_FAILED), "parse")
        .when(outcome == FETCH_FAILED, "fetch")
        .otherwise("curated")
    )
    failed = routed.where(outcome.isin(MALFORMED, PARSE_FAILED, FETCH_FAILED, CURATED_FAILED))
    empty = F.map_from_arrays(
        F.array().cast("array<string>"), F.array().cast("array<variant>")
    )
    shared = failed.select(
        *kept,
        F.when(~malformed, F.col("job_id").cast("binary")).alias("key"),
        F.when(malformed, empty)
        .otherwise(bumped_job(F.col("job"), F.col("retry_count")))
        .alias("job"),
        F.when(malformed, F.coalesce(F.col("raw_message"), F.lit(""))).alias("raw_message"),
        error_type.alias("error_type"),
        message.alias("error_message"),
        stage.alias("failed_stage"),
        failed_at.alias("failed_at"),
    )
    envelope = F.to_json(F.struct(*[name for name in shared.columns if name not in ("key", *kept)]))
    return shared.select(*kept, "key", envelope.cast("binary").alias("value"))

