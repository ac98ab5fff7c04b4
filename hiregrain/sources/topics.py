"""Message topics on Kafka, or in folders where there is no broker.

Both give ``key, value, partition, offset, timestamp`` and take ``key, value``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.schemas import TOPIC

# Topic names.
FETCH_TOPIC = "job_postings.fetch_jobs"
FAILURE_TOPIC = "job_postings.dlq"


class Topics(Protocol):
    def stream(self, spark: SparkSession, topic: str) -> DataFrame: ...

    def read(self, spark: SparkSession, topic: str) -> DataFrame: ...

    def write(self, messages: DataFrame, topic: str, producer: str, batch_id: int) -> None: ...


@dataclass(frozen=True)
class KafkaTopics:
    """Reads from the earliest offset; Spark's checkpoint keeps the position."""

    bootstrap_servers: str
    options: dict[str, str] = field(default_factory=dict)

    def _connected(self, io):
        return io.format("kafka").options(
            **{"kafka.bootstrap.servers": self.bootstrap_servers, **self.options}
        )

    def _source(self, reader, topic: str) -> DataFrame:
        rows = (
            self._connected(reader)
            .option("subscribe", topic)
            .option("startingOffsets", "earliest")
            .load()
        )
        return rows.select(*TOPIC.fieldNames())

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        return self._source(spark.readStream, topic)

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return self._source(spark.read, topic)

    def write(self, messages: DataFrame, topic: str, producer: str, batch_id: int) -> None:
        self._connected(messages.select("key", "value").write).option("topic", topic).save()


@dataclass(frozen=True)
class FolderTopics:
    """A topic is a folder; a producer's batch is one subfolder, replaced when redone.

    ``partition`` is the batch number and ``offset`` the position in it, so order
    within a producer is the order of writing.
    """

    root: str
    max_files_per_trigger: int | None = None

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        reader = spark.readStream.schema(TOPIC).option("recursiveFileLookup", "true")
        if self.max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", self.max_files_per_trigger)
        return reader.parquet(f"{self.root}/{topic}")

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        reader = spark.read.schema(TOPIC).option("recursiveFileLookup", "true")
        return reader.parquet(f"{self.root}/{topic}")

    def write(self, messages: DataFrame, topic: str, producer: str, batch_id: int) -> None:
        placed = messages.select(
            "key",
            "value",
            F.lit(batch_id).cast("int").alias("partition"),
            F.monotonically_increasing_id().alias("offset"),
            F.current_timestamp().alias("timestamp"),
        )
        placed.write.mode("overwrite").parquet(f"{self.root}/{topic}/{producer}/{batch_id}")
