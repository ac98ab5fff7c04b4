"""Failure topic consumers: archive, bounded replay and the hourly trend.

Each has its own checkpoint, so they read the topic independently.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hiregrain.operators.collecting import iso_utc
from hiregrain.operators.counting import Counted
from hiregrain.operators.dead_letters import (
    DECISIONS,
    decision,
    event_rows,
    replay_decisions,
    replay_messages,
)
from hiregrain.operators.gate import gate_failures
from hiregrain.operators.monitoring import failure_trend, summed_trend
from hiregrain.operators.routing import MAX_RETRY
from hiregrain.schemas import DLQ_EVENTS, TOPIC
from hiregrain.sources.tables import Table
from hiregrain.sources.topics import FAILURE_TOPIC, FETCH_TOPIC, Topics
from hiregrain.streaming.worker import run_of, utc_now

REPLAY_COUNTS = T.StructType(
    [T.StructField("decision", T.StringType()), T.StructField("message_count", T.LongType())]
)


TREND = T.StructType(
    [
        T.StructField("failed_hour", T.TimestampType()),
        T.StructField("error_type", T.StringType()),
        T.StructField("event_count", T.LongType()),
    ]
)


def kept_step(rows: DataFrame, path: str) -> DataFrame:
    """What a batch read and parsed, stored once for all that is made from it."""
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


@dataclass(frozen=True)
class Archive:
    """Keeps every readable failure as an event row, and the unreadable ones apart."""

    root: str
    topics: Topics
    clock: Callable[[], datetime] = utc_now
    name: str = "archive"

    @property
    def events(self) -> Table:
        return Table(f"{self.root}/dlq_events", DLQ_EVENTS, batched=True)

    @property
    def quarantine(self) -> Table:
        return Table(f"{self.root}/dlq_unreadable", TOPIC, batched=True)

    def process(self, messages: DataFrame, batch_id: int, run: str | None = None) -> None:
        run = run or run_of(messages) or self.name
        now = iso_utc(F.lit(self.clock()).cast("timestamp"))
        gated = kept_step(gate_failures(messages), f"{self.root}/work/{self.name}-{run}")
        self.events.write_batch(event_rows(gated, now), run, batch_id)
        self.quarantine.write_batch(gated.where("rejected"), run, batch_id)

    def start(self, spark: SparkSession, checkpoint: str, **trigger) -> StreamingQuery:
        self.events.create(spark)
        self.quarantine.create(spark)
        return (
            self.topics.stream(spark, FAILURE_TOPIC)
            .writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )


@dataclass(frozen=True)
class Replay:
    """Puts failed fetches back on the fetch topic, then stops."""

    root: str
    topics: Topics
    max_retry: int = MAX_RETRY
    name: str = "replay"

    @property
    def counts(self) -> Table:
        return Table(f"{self.root}/replay_counts", REPLAY_COUNTS, batched=True)

    def process(self, messages: DataFrame, batch_id: int, run: str | None = None) -> None:
        run = run or run_of(messages) or self.name
        place = f"{self.root}/work/{self.name}-{run}"
        counted = Counted.of(replay_decisions(messages, self.max_retry), decision(), DECISIONS)
        decisions = kept_step(counted.rows, place)
        producer = f"{self.name}-{run}"
        self.topics.write(replay_messages(decisions), FETCH_TOPIC, producer, batch_id)
        counts = counted.counts(messages.sparkSession, REPLAY_COUNTS)
        self.counts.write_batch(counts, run, batch_id)

    def run(self, spark: SparkSession, checkpoint: str) -> None:
        self.counts.create(spark)
        query = (
            self.topics.stream(spark, FAILURE_TOPIC)
            .writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()


@dataclass(frozen=True)
class FailureTrend:
    """Hourly counts per error type from a stream of event rows.

    Each batch writes what it counted, and reading adds the batches up: late events and times
    that cannot be read (under NULL) count like any other, and the last hours are there at once.
    """

    root: str

    @property
    def counts(self) -> Table:
        return Table(f"{self.root}/failure_trend", TREND, batched=True)

    def process(self, events: DataFrame, batch_id: int, run: str | None = None) -> None:
        run = run or run_of(events) or "trend"
        self.counts.write_batch(failure_trend(events), run, batch_id)

    def read(self, spark: SparkSession) -> DataFrame:
        return summed_trend(self.counts.read(spark))

    def start(self, events: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        self.counts.create(events.sparkSession)
        return (
            events.writeStream.foreachBatch(self.process)
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "1 minute"}))
            .start()
        )
