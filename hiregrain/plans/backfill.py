"""Documents made again from stored html, through to staging and the marts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.operators.curation import reprocess_from_raw, with_keys
from hiregrain.operators.sites import SITES, SiteRule
from hiregrain.sources.lake import Layers
from hiregrain.sources.tables import BATCH_COLUMNS


def documented_jobs(spark: SparkSession, layers: Layers) -> DataFrame:
    """The jobs that have a document, with their lake keys."""
    jobs = layers.processed_pages(spark).drop(
        *BATCH_COLUMNS, "processed_at", "html_length", "text_preview", "raw_s3_key", "dt"
    )
    made = layers.documents(spark).select("dt", F.col("posting_id").alias("job_id"))
    return with_keys(jobs).join(made, ["dt", "job_id"], "left_semi")


def backfill(
    spark: SparkSession,
    layers: Layers,
    rule_version: int,
    written_at: datetime,
    sites: tuple[SiteRule, ...] = SITES,
) -> None:
    """After a change of site rules: make every document again and commit it as one more batch.

    Nothing is fetched. Keys of documents stay, their ``rule_version`` grows; so the next load
    takes them in as new rows, later than those of the older rules, and they replace those in the
    clean table and the marts. Doing a version again replaces what it wrote before.
    """
    run = f"rules-{rule_version}"
    for table in (layers.commits, layers.curated):
        table.clear_batch(spark, run, 0)
    raw = layers.raw_pages(spark).select("source", "dt", "job_id", "html")
    documents = reprocess_from_raw(raw, documented_jobs(spark, layers), sites)
    layers.write_documents(documents, rule_version, written_at, run, 0)
