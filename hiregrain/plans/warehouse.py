"""Views over staging, the hourly run and the monitoring set."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.operators import monitoring
from hiregrain.operators.latest import clean_postings
from hiregrain.operators.marts import (
    daily_counts,
    flagged,
    mart_daily,
    mart_source_quality,
    quality_counts,
)
from hiregrain.operators.quality import check_verdicts, enforce
from hiregrain.plans.clean import KEPT, CleanPostings, Version
from hiregrain.plans.loading import Staging, load_increment
from hiregrain.schemas import STAGING
from hiregrain.sources.lake import Documents, Layers
from hiregrain.sources.tables import delete, matching

CLEAN_VIEW = "int_job_postings_clean"
DAILY_VIEW = "mart_job_postings_daily"
QUALITY_VIEW = "mart_job_postings_source_quality"


def build_views(staging: DataFrame) -> dict[str, DataFrame]:
    """Create or replace the three views; nothing is computed until one is read."""
    views = {
        CLEAN_VIEW: clean_postings(staging),
        DAILY_VIEW: mart_daily(staging),
        QUALITY_VIEW: mart_source_quality(staging),
    }
    for name, rows in views.items():
        rows.createOrReplaceTempView(name)
    return views


def switch_view(
    spark: SparkSession, name: str, root: str, places: list[str], columns: list[str]
) -> None:
    """Make a catalog view read from some parquet folders below ``root``: one step for its readers,
    who see the folders before or these, never none and never both."""
    spark.catalog.dropTempView(name)  # it would hide the view
    if spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW":
        spark.sql(f"DROP TABLE {name}")
    place = f"{root}/{{{','.join(places)}}}" if len(places) > 1 else f"{root}/{places[0]}"
    chosen = ", ".join(f"`{column}`" for column in columns)
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT {chosen} FROM parquet.`{place}`")


def publish(rows: DataFrame, root: str, kept: int = KEPT) -> None:
    """Store the three results over staging or clean ``rows`` as versions below ``root`` and turn
    the catalog views to them, for other sessions to read. ``kept`` versions stay.

    The marts are made from the clean rows just stored, so ``rows`` are worked out once."""
    _publish(rows.sparkSession, {CLEAN_VIEW: clean_postings(rows)}, root, kept, _marts)


def _marts(clean: DataFrame) -> dict[str, DataFrame]:
    """The marts over stored clean rows, which have one row per posting already."""
    return {
        DAILY_VIEW: daily_counts(clean),
        QUALITY_VIEW: quality_counts(flagged(clean)).orderBy(F.col("total_postings").desc(), "source"),
    }


def _publish(
    spark: SparkSession,
    results: dict[str, DataFrame],
    root: str,
    kept: int,
    more: Callable[[DataFrame], dict[str, DataFrame]] | None = None,
) -> None:
    """Store and show ``results``, and what ``more`` makes of the stored clean rows."""
    made, columns = {}, {}

    def store(named: dict[str, DataFrame]) -> None:
        for name, result in named.items():
            versions = matching(spark, f"{root}/{name}/version=*")
            number = int(versions[-1].rpartition("=")[2]) + 1 if versions else 0
            made[name], columns[name] = f"{name}/version={number:010d}", result.columns
            result.write.parquet(f"{root}/{made[name]}")

    store(results)
    if more is not None:
        schema = results[CLEAN_VIEW].schema
        store(more(spark.read.schema(schema).parquet(f"{root}/{made[CLEAN_VIEW]}")))
    for name, place in made.items():
        switch_view(spark, name, root, [place], columns[name])
        for old in matching(spark, f"{root}/{name}/version=*")[:-kept]:
            delete(spark, old)


def publish_version(spark: SparkSession, clean: CleanPostings, of: Version, root: str, kept: int = KEPT) -> None:
    """Turn the views to a version of the clean table, whose rows are not written again."""
    places = list(of.places.get("rows", {}).values())
    marts = {DAILY_VIEW: clean.daily(spark, of), QUALITY_VIEW: clean.source_quality(spark, of)}
    if not places:
        marts[CLEAN_VIEW] = clean.read(spark, of)
    _publish(spark, marts, root, kept)
    if places:
        switch_view(spark, CLEAN_VIEW, clean.root, places, STAGING.fieldNames())


def run_checks(staging: DataFrame, stop_on_failure: bool = False) -> DataFrame:
    """All verdicts; with ``stop_on_failure`` the first failing check raises."""
    verdicts = check_verdicts(staging)
    if stop_on_failure:
        enforce(verdicts)
    return verdicts


def hourly_run(
    spark: SparkSession,
    documents: Documents,
    staging: Staging,
    loaded_at: datetime,
    stop_on_failure: bool = False,
    publish_to: str | None = None,
) -> DataFrame:
    """Load what is new, carry the clean table and its counts on, refresh the views (or those in
    the catalog, with their files below ``publish_to``), check the result.

    Everything after the load reads the increment, the postings it displaces and stored counts.
    """
    staging.create(spark)
    load_increment(spark, documents, staging, loaded_at)
    clean = CleanPostings(f"{staging.root}/clean_postings")
    version = clean.advance(spark, staging)
    if publish_to is None:
        clean.read(spark, version).createOrReplaceTempView(CLEAN_VIEW)
        clean.daily(spark, version).createOrReplaceTempView(DAILY_VIEW)
        clean.source_quality(spark, version).createOrReplaceTempView(QUALITY_VIEW)
    else:
        publish_version(spark, clean, version, publish_to)
    verdicts = clean.verdicts(spark, version)
    if stop_on_failure:
        enforce(verdicts)
    return verdicts


def housekeeping(spark: SparkSession, staging: Staging) -> int:
    """Delete what interrupted loads and old versions have left; for an hour without a run.
    Returns the number of folders deleted."""
    return staging.sweep(spark) + CleanPostings(f"{staging.root}/clean_postings").sweep(spark)


def compact_closed_days(spark: SparkSession, layers: Layers, since: str, before: str, time: datetime) -> int:
    """Put together the batches of each day before ``before`` that has several in the commits
    written since ``since``. Returns the number of folders deleted.

    Nothing is done to a day that is one batch already, so this may run as often as one likes;
    a document that comes late makes its day one of several batches again.
    """
    return layers.compact(spark, layers.closed_days(spark, since, before), since, time)


def monitor(staging: DataFrame, events: DataFrame) -> dict[str, DataFrame]:
    """Every operational view, by name; each is computed only when read."""
    clean = clean_postings(staging)
    return {
        "posting_volume": monitoring.posting_volume(clean),
        "source_volume": monitoring.source_volume(clean),
        "failures_per_hour": monitoring.failures_per_hour(events),
        "retry_distribution": monitoring.retry_distribution(events),
        "error_types": monitoring.error_types(events),
        "failed_stages": monitoring.failed_stages(events),
        "description_trend": monitoring.description_trend(clean),
        "load_trend": monitoring.load_trend(staging),
        "freshness": monitoring.freshness(staging),
    }
