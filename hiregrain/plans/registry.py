"""Every operator as a query over the given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiregrain.functions import linked_data as ld
from hiregrain.functions.page_signals import linked_objects_of, signals_of
from hiregrain.functions.text import html_to_text, normalize
from hiregrain.operators import collecting, curation, monitoring, quality, routing
from hiregrain.operators.dead_letters import (
    archive_rows,
    replay_counts,
    replay_decisions,
    replay_messages,
)
from hiregrain.operators.domains import domain_table, with_site
from hiregrain.operators.gate import gate_jobs
from hiregrain.operators.latest import clean_postings, merge_latest
from hiregrain.operators.marts import mart_daily, mart_source_quality, quality_counts, quality_flags
from hiregrain.operators.pages import NOT_FETCHED, fetch_outcome, page_facts, resolve_pages
from hiregrain.operators.sites import extract_fields, site_flag, site_of
from hiregrain.operators.skew import salted_left_join
from hiregrain.plans import standins
from hiregrain.plans.backfill import backfill
from hiregrain.plans.clean import CleanPostings
from hiregrain.plans.loading import Staging, load_increment, new_keys, staging_rows
from hiregrain.plans.warehouse import DAILY_VIEW, QUALITY_VIEW, compact_closed_days, publish
from hiregrain.schemas import CURATED_COLUMNS, POSTING_FIELDS
from hiregrain.session import cut, pin, shared_dir
from hiregrain.sources.lake import CURATED_PREFIX, Layers, ObjectDocuments, TableDocuments
from hiregrain.sources.tables import BATCH_COLUMNS
from hiregrain.sources.topics import FETCH_TOPIC, FolderTopics
from hiregrain.streaming.failures import Archive, FailureTrend, Replay
from hiregrain.streaming.worker import Worker

Query = Callable[[SparkSession, str], DataFrame]

NOW = datetime(2024, 2, 1)
RUN = "run-1"
#: Documents of a batch of a whole month from which on they are not moved to be written.
GATHER_ROWS = 1_000_000


def now() -> Column:
    return F.lit(NOW).cast("timestamp")


def shown(rows: DataFrame) -> DataFrame:
    """Times and dates as text, so that results compare across engines."""
    formats = {T.TimestampType: "yyyy-MM-dd HH:mm:ss.SSSSSS", T.DateType: "yyyy-MM-dd"}
    return rows.select(
        *[
            F.date_format(f.name, formats[type(f.dataType)]).alias(f.name)
            if type(f.dataType) in formats
            else F.col(f.name)
            for f in rows.schema.fields
        ]
    )


def _fresh_dir(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


# --- staging, marts, checks -----------------------------------------------------------


def int_postings_clean(spark, sf_dir):
    return clean_postings(standins.staging(spark, sf_dir))


def latest_by_merge(spark, sf_dir):
    """Clean rows of the first half of the month, carried on with the second half."""
    rows = standins.staging(spark, sf_dir)
    early = F.col("loaded_at") < F.lit("2024-01-16").cast("timestamp")
    return merge_latest(clean_postings(rows.where(early)), rows.where(~early))


def mart_postings_daily(spark, sf_dir):
    return mart_daily(standins.staging(spark, sf_dir))


def mart_quality(spark, sf_dir):
    return mart_source_quality(standins.staging(spark, sf_dir))


def dq_verdicts(spark, sf_dir):
    return quality.check_verdicts(standins.staging(spark, sf_dir))


def dq_first_failure(spark, sf_dir):
    verdicts = quality.check_verdicts(standins.staging(spark, sf_dir))
    return quality.first_failure(verdicts).select("check_name", "subject")


def _published(name: str) -> Query:
    def read_back(spark, sf_dir):
        publish(standins.staging(spark, sf_dir), _fresh_dir(spark, "marts"))
        return spark.table(name)

    return read_back


def _carried(spark, sf_dir) -> CleanPostings:
    """The clean table and its counts after three loads, of every third event each."""
    root = _fresh_dir(spark, "carried")
    staging, clean = Staging(root).create(spark), CleanPostings(f"{root}/clean", buckets=8)
    rows = standins.staging(spark, sf_dir)
    for k in range(3):
        staging.rows.append(rows.where(F.pmod(F.crc32("posting_id"), F.lit(3)) == k))
        clean.advance(spark, staging)
    return clean


def carried_clean(spark, sf_dir):
    return _carried(spark, sf_dir).read(spark)


def carried_daily(spark, sf_dir):
    return _carried(spark, sf_dir).daily(spark)


def carried_source_quality(spark, sf_dir):
    return _carried(spark, sf_dir).source_quality(spark)


def carried_verdicts(spark, sf_dir):
    return _carried(spark, sf_dir).verdicts(spark)


def dq_required_fields(spark, sf_dir):
    return quality.required_field_nulls(clean_postings(standins.staging(spark, sf_dir)))


def dq_duplicate_hash_groups(spark, sf_dir):
    return quality.duplicate_hashes(clean_postings(standins.staging(spark, sf_dir)))


def dq_fill_rate(spark, sf_dir):
    flags = quality_flags(standins.staging(spark, sf_dir))
    rates = quality.fill_rates(quality_counts(flags))
    return rates.withColumn("too_low", quality.fill_rate_too_low())


# --- loading --------------------------------------------------------------------------


def stg_projection(spark, sf_dir):
    return staging_rows(standins.curated(spark, sf_dir), now())


def load_new_keys(spark, sf_dir):
    fresh = new_keys(standins.listed_keys(spark, sf_dir), standins.loaded_keys(spark, sf_dir))
    return fresh.select("s3_key")


def load_required_violations(spark, sf_dir):
    """Staging rows with two required columns emptied wherever an optional one is blank."""
    rows = standins.staging(spark, sf_dir)
    holed = rows.withColumns(
        {
            "source": F.when(F.coalesce(F.col("title") != "", F.lit(True)), F.col("source")),
            "original_url": F.when(
                F.coalesce(F.col("company_name") != "", F.lit(True)), F.col("original_url")
            ),
        }
    )
    return quality.required_violations(holed).select("posting_id", "violations")


def staging_load(spark, sf_dir):
    """The whole load: a curated table, a checkpoint, one increment, the appended rows."""
    root = _fresh_dir(spark, "load")
    lake = replace(Layers(root).curated, gather_rows=GATHER_ROWS)
    lake.write_batch(standins.curated(spark, sf_dir), RUN, 0)
    staging = Staging(root).create(spark)
    staging.loaded_keys.append(
        standins.loaded_keys(spark, sf_dir)
    )
    load_increment(spark, TableDocuments(lake), staging, NOW)
    return staging.postings(spark)


def staging_load_objects(spark, sf_dir):
    """The latest document of every posting as one JSON object in a file of its own, loaded."""
    root = _fresh_dir(spark, "objects")
    documents = standins.before_loading(clean_postings(standins.staging(spark, sf_dir)))
    standins.put_objects(documents, f"{root}/{CURATED_PREFIX}")
    staging = Staging(root).create(spark)
    load_increment(spark, ObjectDocuments(root), staging, NOW)
    return staging.postings(spark)


# --- gate and routing -----------------------------------------------------------------


def job_keys(spark, sf_dir):
    return curation.with_keys(standins.jobs(spark, sf_dir)).select(
        "event_id", "dt", "raw_s3_key", "processed_s3_key", "curated_s3_key"
    )


def retry_limit(spark, sf_dir):
    jobs = standins.jobs(spark, sf_dir)
    return jobs.select(
        "event_id", routing.exceeds_retry_limit(F.col("retry_count")).alias("exceeded")
    )


def gate_outcomes(spark, sf_dir):
    return gate_jobs(standins.messages(spark, sf_dir)).select("offset", "malformed_reason")


def _routed(spark, sf_dir) -> DataFrame:
    return routing.route_messages(
        standins.messages(spark, sf_dir),
        standins.page_fetch(spark, sf_dir),
        standins.done_keys(spark, sf_dir),
    )


def route_outcomes(spark, sf_dir):
    return _routed(spark, sf_dir).select("offset", "outcome")


def dlq_envelopes(spark, sf_dir):
    """Envelopes read back from their JSON, next to the message they are about."""
    sent = routing.failure_messages(_routed(spark, sf_dir), F.lit("now"), "offset")
    value = F.col("value").cast("string")

    def got(path: str) -> Column:
        return F.get_json_object(value, path)

    malformed = got("$.error_type") == "malformed_message"
    return sent.select(
        "offset",
        F.col("key").cast("string").alias("key"),
        got("$.error_type").alias("error_type"),
        got("$.failed_stage").alias("failed_stage"),
        got("$.error_message").alias("error_message"),
        F.when(got("$.raw_message") == "", "")
        .when(got("$.raw_message").rlike(r'^\{"|\}'), None)
        .otherwise(got("$.raw_message"))
        .alias("raw_message"),
        F.when(malformed, got("$.error_message")).alias("malformed_reason"),
        got("$.job.retry_count").cast("int").alias("retry_count"),
        got("$.job.url").alias("url"),
    )


def domain_route(spark, sf_dir):
    jobs = standins.jobs(spark, sf_dir).withColumn("site", site_of(F.col("url")))
    flags = ("disable_ssl_verify", "refetch_canonical")
    return jobs.select(
        "event_id", "site", *[site_flag(F.col("site"), flag).alias(flag) for flag in flags]
    )


def domain_table_route(spark, sf_dir):
    """Routing by a table of domains instead of one branch per site."""
    jobs = standins.jobs(spark, sf_dir).select("event_id", "url")
    return with_site(jobs, domain_table(spark)).select("event_id", "site")


def fetch_errors(spark, sf_dir):
    """Every job with the class of its page's failure; html stays out of the join."""
    jobs = standins.jobs(spark, sf_dir).select("event_id", "url")
    fetched = fetch_outcome(standins.page_fetch(spark, sf_dir)).select(
        "url", "fetch_error", F.lit(True).alias("known")
    )
    joined = salted_left_join(jobs, fetched, ["url"], F.col("event_id"))
    absent = F.when(F.col("known").isNull(), NOT_FETCHED)
    return joined.select("event_id", F.coalesce(absent, F.col("fetch_error")).alias("fetch_error"))


def skewed_join(spark, sf_dir):
    """A key with a third of all rows goes through many slices of a hundred rows."""
    user = F.concat(F.lit("u"), F.col("user_id").cast("string"))
    keyed = standins.table(spark, sf_dir, "events").select(
        "event_id", F.when(F.col("event_id") % 3 == 0, "hot").otherwise(user).alias("key")
    )
    totals = keyed.where("key <> 'u7'").groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    return salted_left_join(keyed, totals, ["key"], F.col("event_id"), slice_rows=100)


def canonical_refetch(spark, sf_dir):
    pages = standins.redirecting_pages(spark, sf_dir)
    urls = pages.where(F.contains("url", F.lit("/jobs/"))).select("url")
    return resolve_pages(urls, pages).select("url", "page_url", "title_tag")


# --- pages and documents --------------------------------------------------------------


def page_titles(spark, sf_dir):
    pages = standins.spread_table(spark, sf_dir, "pages")
    return pages.select("page_id", signals_of("html").alias("s")).select("page_id", "s.title_tag")


def page_text(spark, sf_dir):
    pages = standins.spread_table(spark, sf_dir, "pages")
    return pages.select("page_id", html_to_text(F.col("html")).alias("page_text"))


def page_hash(spark, sf_dir):
    pages = standins.spread_table(spark, sf_dir, "pages")
    fields = extract_fields(page_facts(pages))
    return curation.final_description(fields).select("page_id", "content_hash")


def _site(site: str) -> Query:
    def fields(spark, sf_dir):
        pages = standins.site_pages(spark, sf_dir, site)
        return extract_fields(page_facts(pages)).select(
            "page_id",
            *[F.col(name) for name in POSTING_FIELDS if name != "description_text"],
            "description_text",
        )

    return fields


def ld_fields(spark, sf_dir):
    """Linked-data fields alone, for the pages that have a posting object."""
    pages = standins.site_pages(spark, sf_dir, "wanted")
    read = pages.select("page_id", signals_of("html").alias("s"))
    posting = F.col("posting")
    found = read.select("page_id", F.try_parse_json("s.job_ld").alias("posting")).where(
        "posting IS NOT NULL"
    )

    def text(value: Column) -> Column:
        return normalize(ld.as_text(value))

    return found.select(
        "page_id",
        text(ld.part(posting, "$.hiringOrganization.name")).alias("company_name"),
        text(ld.part(posting, "$.title")).alias("title"),
        ld.place_name(
            text(ld.of_first_place(posting, "addressRegion")),
            text(ld.of_first_place(posting, "addressLocality")),
        ).alias("location"),
        ld.joined(ld.part(posting, "$.employmentType")).alias("employment_type"),
        ld.joined(ld.part(posting, "$.experienceRequirements")).alias("experience_level"),
    )


def ld_objects(spark, sf_dir):
    """One row per linked-data object of every page."""
    pages = standins.site_pages(spark, sf_dir, "wanted")
    objects = pages.select("page_id", F.explode(linked_objects_of("html")).alias("object"))
    return objects.select("page_id", F.get_json_object("object", "$['@type']").alias("object_type"))


def _succeeded(spark, sf_dir) -> DataFrame:
    """Stored, because raw documents are made from several reads of it."""
    return cut(_routed(spark, sf_dir).where(F.col("outcome") == routing.SUCCESS))


def curated_docs(spark, sf_dir):
    return curation.curated_documents(_succeeded(spark, sf_dir)).drop("dt")


def processed_docs(spark, sf_dir):
    return curation.processed_documents(_succeeded(spark, sf_dir), now()).drop("dt")


def raw_docs(spark, sf_dir):
    documents = curation.raw_documents(
        _succeeded(spark, sf_dir), standins.page_fetch(spark, sf_dir)
    )
    return documents.withColumn("html_md5", F.md5("html")).drop("html")


def reprocess_from_raw(spark, sf_dir):
    """Documents made again from the raw layer of the same run."""
    succeeded = _succeeded(spark, sf_dir)
    raw = curation.raw_documents(succeeded, standins.page_fetch(spark, sf_dir))
    jobs = succeeded.select(
        "job_id", "source", "url", "collected_at", "dt",
        "raw_s3_key", "processed_s3_key", "curated_s3_key",
    )
    return curation.reprocess_from_raw(raw, jobs).drop("dt")


# --- failures -------------------------------------------------------------------------


def _events(spark, sf_dir) -> DataFrame:
    return archive_rows(standins.failures(spark, sf_dir), collecting.iso_utc(now()))


def replayed(messages: DataFrame) -> DataFrame:
    value = F.col("value").cast("string")
    return messages.select(
        F.col("key").cast("string").alias("key"),
        F.get_json_object(value, "$.source").alias("source"),
        F.get_json_object(value, "$.url").alias("url"),
        F.get_json_object(value, "$.retry_count").cast("int").alias("retry_count"),
    )


def replay_eligible(spark, sf_dir):
    return replayed(replay_messages(replay_decisions(standins.failures(spark, sf_dir))))


def replay_skips(spark, sf_dir):
    return replay_counts(replay_decisions(standins.failures(spark, sf_dir)))


# --- streams --------------------------------------------------------------------------


def _worked(spark, sf_dir, parts: tuple[Column | None, ...] = (None,)) -> Layers:
    """A worker for each part of the events, one after the other, until none is left."""
    root = _fresh_dir(spark, "worker")
    layers = _lake(spark, sf_dir, root)
    for k, part in enumerate(parts):
        worker = Worker(
            layers,
            standins.EventTopics(f"{root}/topics", sf_dir, part),
            lambda session: standins.page_fetch(session, sf_dir),
            clock=lambda: NOW,
        )
        worker.start(spark, f"{root}/checkpoint-{k}", availableNow=True).awaitTermination()
    return layers


def _lake(spark, sf_dir, root: str) -> Layers:
    """A lake in which some identities are done already."""
    layers = Layers(root).create(spark)
    done = standins.done_keys(spark, sf_dir).withColumnRenamed("job_id", "posting_id")
    layers.curated.write_batch(done, "before", -1)
    return layers


def worker_stream_outcomes(spark, sf_dir):
    counts = _worked(spark, sf_dir).outcomes.read(spark)
    return counts.groupBy("outcome").agg(F.sum("message_count").alias("message_count"))


def _documents(spark, layers: Layers) -> DataFrame:
    return layers.documents(spark).where("batch_id >= 0").select(*CURATED_COLUMNS)


def worker_stream_documents(spark, sf_dir):
    return _documents(spark, _worked(spark, sf_dir))


def two_workers_documents(spark, sf_dir):
    """Two workers of the same name, each with a checkpoint of its own, over halves of the
    events: both start with batch 0 on one lake."""
    half = F.percentile_approx("event_id", 0.5)
    middle = standins.table(spark, sf_dir, "events").agg(half).first()[0]
    parts = (F.col("event_id") <= middle, F.col("event_id") > middle)
    return _documents(spark, _worked(spark, sf_dir, parts))


def overlapping_workers_documents(spark, sf_dir):
    """Two workers over the first and the last two thirds of the events: the second does its work
    after the first has looked for documents and before it writes its own."""
    thirds = F.percentile_approx("event_id", F.array(F.lit(1 / 3), F.lit(2 / 3)))
    low, high = standins.table(spark, sf_dir, "events").agg(thirds).first()[0]
    layers = _lake(spark, sf_dir, _fresh_dir(spark, "worker"))
    topics = FolderTopics(f"{layers.root}/topics")

    def worker(name: str, time: datetime) -> Worker:
        pages = lambda session: standins.page_fetch(session, sf_dir)
        return Worker(layers, topics, pages, clock=lambda: time, name=name)

    messages = standins.messages(spark, sf_dir)
    first, second = worker("first", NOW + timedelta(minutes=1)), worker("second", NOW)
    judged = first.routed(messages.where(F.col("offset") <= high), 0, "run-1")
    second.process(messages.where(F.col("offset") > low), 0, "run-2")
    first.store(*judged, "run-1", 0)
    return _documents(spark, layers)


def backfill_documents(spark, sf_dir):
    """Every document of a worker made again from the stored pages, as of newer rules."""
    layers = _worked(spark, sf_dir)
    backfill(spark, layers, 1, NOW + timedelta(days=1))
    return _documents(spark, layers)


def compacted_documents(spark, sf_dir):
    """Documents after two workers, a backfill and the compaction of all days:
    the last row of each identity, in one batch a day. Read from the bare table."""
    middle = standins.table(spark, sf_dir, "events").agg(F.percentile_approx("event_id", 0.5)).first()[0]
    layers = _worked(spark, sf_dir, (F.col("event_id") <= middle, F.col("event_id") > middle))
    backfill(spark, layers, 1, NOW + timedelta(days=1))
    compact_closed_days(spark, layers, f"{NOW:%Y-%m-%d}", "9999", NOW + timedelta(days=2))
    rows = layers.curated.read(spark).where("batch_id >= 0")
    return rows.select(*CURATED_COLUMNS)


def loaded_from_commits(spark, sf_dir):
    """Staging after a load that follows the commits of a worker: the same documents again."""
    layers = _worked(spark, sf_dir)
    staging = Staging(_fresh_dir(spark, "load")).create(spark)
    load_increment(spark, TableDocuments(layers.curated, layers.commits), staging, NOW)
    return staging.postings(spark)


def archive_stream(spark, sf_dir):
    root = _fresh_dir(spark, "archive")
    archive = Archive(root, standins.EventTopics(f"{root}/topics", sf_dir), clock=lambda: NOW)
    archive.start(spark, f"{root}/checkpoint", availableNow=True).awaitTermination()
    return archive.events.read(spark).drop(*BATCH_COLUMNS)


def replay_stream(spark, sf_dir):
    root = _fresh_dir(spark, "replay")
    topics = standins.EventTopics(f"{root}/topics", sf_dir)
    Replay(root, topics).run(spark, f"{root}/checkpoint")
    return replayed(topics.read(spark, FETCH_TOPIC))


def failure_trend_stream(spark, sf_dir):
    root = _fresh_dir(spark, "trend")
    topics = standins.EventTopics(f"{root}/topics", sf_dir)
    events = archive_rows(topics.stream(spark, "failures"), collecting.iso_utc(now()))
    trend = FailureTrend(root)
    trend.start(events, f"{root}/checkpoint", availableNow=True).awaitTermination()
    return trend.read(spark)


# --- collecting -----------------------------------------------------------------------


def _links(spark, sf_dir) -> DataFrame:
    pages = standins.listing_pages(spark, sf_dir)
    wanted, jobkorea = (collecting.listing_links(pages, site) for site in ("wanted", "jobkorea"))
    return wanted.unionByName(jobkorea)


def collect_jobs(spark, sf_dir):
    return collecting.job_messages(_links(spark, sf_dir), RUN, collecting.iso_utc(now()))


def collect_first_jobs(spark, sf_dir):
    """A report of the first twenty links of each site."""
    first = collecting.first_links(_links(spark, sf_dir), 20)
    return collecting.job_messages(first, RUN, collecting.iso_utc(now()))


def fetch_messages(spark, sf_dir):
    sent = collecting.topic_messages(standins.jobs(spark, sf_dir))
    return sent.select(F.col("key").cast("string"), F.col("value").cast("string"))


def seed_jobs(spark, sf_dir):
    pages = standins.table(spark, sf_dir, "pages").select("url")
    return collecting.seed_jobs(spark, RUN, collecting.iso_utc(now()), pages)


def synthetic_jobs(spark, sf_dir):
    """A test job per event; those of error events fail."""
    tests = standins.table(spark, sf_dir, "events").select(
        F.col("event_id").alias("ordinal"), (F.col("event_type") == "error").alias("fails")
    )
    return collecting.synthetic_jobs(tests, RUN, collecting.iso_utc(now()))


def _over_clean(view: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: view(clean_postings(standins.staging(spark, sf_dir)))


def _over_staging(view: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: view(standins.staging(spark, sf_dir))


def _over_events(view: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: view(_events(spark, sf_dir))


_QUERIES: dict[str, Query] = {
    "int_postings_clean": int_postings_clean,
    "latest_by_merge": latest_by_merge,
    "mart_postings_daily": mart_postings_daily,
    "mart_source_quality": mart_quality,
    "published_daily": _published(DAILY_VIEW),
    "published_source_quality": _published(QUALITY_VIEW),
    "dq_verdicts": dq_verdicts,
    "carried_clean": carried_clean,
    "carried_daily": carried_daily,
    "carried_source_quality": carried_source_quality,
    "carried_verdicts": carried_verdicts,
    "dq_first_failure": dq_first_failure,
    "dq_required_fields": dq_required_fields,
    "dq_duplicate_hash_groups": dq_duplicate_hash_groups,
    "dq_fill_rate": dq_fill_rate,
    "stg_projection": stg_projection,
    "staging_load": staging_load,
    "staging_load_objects": staging_load_objects,
    "load_new_keys": load_new_keys,
    "load_required_violations": load_required_violations,
    "job_keys": job_keys,
    "retry_limit": retry_limit,
    "gate_outcomes": gate_outcomes,
    "route_outcomes": route_outcomes,
    "dlq_envelopes": dlq_envelopes,
    "domain_route": domain_route,
    "domain_table_route": domain_table_route,
    "fetch_errors": fetch_errors,
    "canonical_refetch": canonical_refetch,
    "page_titles": page_titles,
    "page_text": page_text,
    "page_hash": page_hash,
    **{
        f"site_{site}": _site(site)
        for site in ("wanted", "groupby", "saramin", "catch", "jobkorea")
    },
    "ld_fields": ld_fields,
    "ld_objects": ld_objects,
    "curated_docs": curated_docs,
    "processed_docs": processed_docs,
    "raw_docs": raw_docs,
    "reprocess_from_raw": reprocess_from_raw,
    "dlq_event_rows": _events,
    "replay_eligible": replay_eligible,
    "replay_skips": replay_skips,
    "mon_volume": _over_clean(monitoring.posting_volume),
    "mon_source_volume": _over_clean(monitoring.source_volume),
    "mon_dlq_hourly": _over_events(monitoring.failures_per_hour),
    "mon_retry": _over_events(monitoring.retry_distribution),
    "mon_error_type": _over_events(monitoring.error_types),
    "mon_stage": _over_events(monitoring.failed_stages),
    "mon_quality_trend": _over_clean(monitoring.description_trend),
    "mon_load_trend": _over_staging(monitoring.load_trend),
    "mon_freshness": _over_staging(monitoring.freshness),
    "worker_stream_outcomes": worker_stream_outcomes,
    "worker_stream_documents": worker_stream_documents,
    "two_workers_documents": two_workers_documents,
    "overlapping_workers_documents": overlapping_workers_documents,
    "backfill_documents": backfill_documents,
    "compacted_documents": compacted_documents,
    "loaded_from_commits": loaded_from_commits,
    "archive_stream": archive_stream,
    "replay_stream": replay_stream,
    "failure_trend_stream": failure_trend_stream,
    "collect_links": _links,
    "collect_jobs": collect_jobs,
    "collect_first_jobs": collect_first_jobs,
    "fetch_messages": fetch_messages,
    "skewed_join": skewed_join,
    "seed_jobs": seed_jobs,
    "synthetic_jobs": synthetic_jobs,
}


def _registered(query: Query) -> Query:
    return lambda spark, sf_dir: shown(query(pin(spark), sf_dir))


QUERIES: dict[str, Query] = {name: _registered(query) for name, query in _QUERIES.items()}
