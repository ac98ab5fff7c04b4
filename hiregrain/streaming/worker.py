"""The worker: fetch jobs in, documents and failures out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from itertools import count

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hiregrain.operators.collecting import iso_utc
from hiregrain.operators.counting import Counted
from hiregrain.operators.curation import (
    curated_documents,
    last_of_batch,
    processed_documents,
    raw_documents,
)
from hiregrain.operators.routing import (
    CURATED_FAILED,
    MALFORMED,
    MAX_RETRY,
    OUTCOMES,
    SUCCESS,
    failure_messages,
    gate_and_key,
    route,
)
from hiregrain.operators.sites import SITES, SiteRule
from hiregrain.sources.lake import OUTCOME_COUNTS, Layers, days_of
from hiregrain.sources.tables import BATCH, BATCH_COLUMNS, RUN
from hiregrain.sources.topics import FAILURE_TOPIC, FETCH_TOPIC, Topics


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def run_of(messages: DataFrame) -> str | None:
    """The id of the streaming query that calls: it is stored with the query's checkpoint."""
    return messages.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")


def begun_before(spark: SparkSession, folder: str, batch_id: int) -> bool:
    """Notes that a batch begins; true if it did before, that is, if it is done again."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    mark = path(f"{folder}/{batch_id}")
    files = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    again = files.exists(mark)
    if not again:
        files.create(mark).close()
        files.delete(path(f"{folder}/{batch_id - 2}"), False)
    return again


@dataclass(frozen=True)
class Worker:
    """One micro-batch at a time; a batch that is redone gives the same documents.

    ``pages`` returns the crawl results, one row per URL. Tables are written by run and
    batch, and jobs done before are looked up in other batches only, so an interrupted
    batch neither loses nor doubles anything; failure messages may come twice. A run is a
    streaming checkpoint: any number of workers may write one lake. Two that overlap may both
    document an identity; the readers of ``Layers`` then see the row written last. A batch counts
    for loads when its commit is there, which is its last write.
    """

    layers: Layers
    topics: Topics
    pages: Callable[[SparkSession], DataFrame]
    max_retry: int = MAX_RETRY
    sites: tuple[SiteRule, ...] = SITES
    clock: Callable[[], datetime] = utc_now
    name: str = "worker"
    rule_version: int = 0

    def _done(self, spark: SparkSession, gated: DataFrame, run: str, batch_id: int) -> DataFrame:
        """Identities documented by other batches, on the days of this batch only."""
        days = days_of(gated.where("outcome IS NULL"))
        rows = self.layers.curated.on_days(spark, days).select("dt", "posting_id", *BATCH_COLUMNS)
        own = F.col(RUN).eqNullSafe(run) & F.col(BATCH).eqNullSafe(batch_id)
        return rows.where(~own).select("dt", F.col("posting_id").alias("job_id"))

    def _keeper(self, spark: SparkSession, run: str) -> Callable[[DataFrame], DataFrame]:
        """Stores a step's result where the same step of the last batch was stored.

        A batch's steps are read several times and their plans would pile up; a table
        ends the plan, outlives lost executors and needs no more room than one batch.
        """
        steps = count()

        def keep(rows: DataFrame) -> DataFrame:
            path = f"{self.layers.root}/work/{self.name}-{run}/step={next(steps)}"
            rows.write.mode("overwrite").parquet(path)
            return spark.read.schema(rows.schema).parquet(path)

        return keep

    def process(self, messages: DataFrame, batch_id: int, run: str | None = None) -> None:
        run = run or run_of(messages) or self.name
        self.store(*self.routed(messages, batch_id, run), run, batch_id)

    def routed(
        self, messages: DataFrame, batch_id: int, run: str
    ) -> tuple[DataFrame, DataFrame, DataFrame]:
        """The batch's messages with their outcomes, stored, the pages they were judged by, and
        the number of each outcome."""
        spark = messages.sparkSession
        if begun_before(spark, f"{self.layers.root}/work/{self.name}-{run}/begun", batch_id):
            for table in self.layers.tables():
                table.clear_batch(spark, run, batch_id)
        keep = self._keeper(spark, run)
        pages = self.pages(spark)
        gated = keep(gate_and_key(messages, self.max_retry))
        done = self._done(spark, gated, run, batch_id)
        judged = route(gated, pages, done, self.sites, keep)
        counted = Counted.of(judged, F.col("outcome"), OUTCOMES)
        routed = keep(counted.rows)
        return routed, pages, counted.counts(spark, OUTCOME_COUNTS)

    def store(
        self, routed: DataFrame, pages: DataFrame, counts: DataFrame, run: str, batch_id: int
    ) -> None:
        """Write what becomes of a batch's messages."""
        time = self.clock()
        now = F.lit(time).cast("timestamp")
        fetched = last_of_batch(routed.where(F.col("outcome").isin(SUCCESS, CURATED_FAILED)))
        raw = raw_documents(fetched, pages).withColumn("written_at", now)
        self.layers.raw.write_batch(raw, run, batch_id)
        self.layers.processed.write_batch(processed_documents(fetched, now), run, batch_id)
        malformed = routed.where(F.col("outcome") == MALFORMED)
        self.layers.malformed.write_batch(malformed, run, batch_id)
        producer = f"{self.name}-{run}"
        self.topics.write(
            failure_messages(routed, iso_utc(now)), FAILURE_TOPIC, producer, batch_id
        )
        self.layers.outcomes.write_batch(counts, run, batch_id)
        # Late, because a curated document marks its job as done.
        documents = curated_documents(routed.where(F.col("outcome") == SUCCESS))
        self.layers.write_documents(documents, self.rule_version, time, run, batch_id)

    def start(self, spark: SparkSession, checkpoint: str, **trigger) -> StreamingQuery:
        """Process the fetch topic; offsets are committed after a batch's last write."""
        self.layers.create(spark)
        return (
            self.topics.stream(spark, FETCH_TOPIC)
            .writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )
