"""The document lake: layers written by the worker, and documents to load from.

Documents come as a curated table (the layout for scale) or as one JSON object per
file. Both list keys without reading documents and read only the days asked for.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime
from typing import ClassVar, Protocol

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiregrain.operators.latest import last_written
from hiregrain.operators.steps import settled
from hiregrain.schemas import CURATED, CURATED_COLUMNS, PROCESSED, TOPIC
from hiregrain.sources.places import semi_join_files
from hiregrain.sources.tables import BATCH_COLUMNS, Table, delete

CURATED_PREFIX = "curated/job_postings"

_DT = T.StructField("dt", T.StringType())
RAW_PAGES = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("job_id", "html", "raw_s3_key", "source")]
    + [T.StructField("written_at", T.TimestampType()), _DT]
)
#: What a batch has written, one row for each day of its documents.
COMMITS = T.StructType(
    [
        _DT,
        T.StructField("documents", T.LongType()),
        T.StructField("written_at", T.TimestampType()),
        T.StructField("written_on", T.StringType()),
    ]
)
#: Which rows of a layer are of one object: of several, the one written last stays.
DOCUMENT, PAGE = ("dt", "posting_id"), ("source", "dt", "job_id")
#: The last document is that made by the newest site rules, and of these the last written.
LAST_DOCUMENT = ("rule_version", "written_at", *BATCH_COLUMNS)
LAST_RAW = ("written_at", *BATCH_COLUMNS)
LAST_PROCESSED = ("processed_at", *BATCH_COLUMNS)
#: How the run of a batch begins that holds what was once several batches of a day.
COMPACTED = "compacted-"
#: Objects that a task reads, and small ones that Spark gives to it by its defaults.
TASK_OBJECTS, PLANNED_OBJECTS = 512, 32
OUTCOME_COUNTS = T.StructType(
    [T.StructField("outcome", T.StringType()), T.StructField("message_count", T.LongType())]
)


@dataclass(frozen=True)
class Layers:
    """Tables the worker fills below one root.

    Two workers that overlap may both write an identity. Readers see one row of it, that of the
    last write, as in a store with one object for each key; see ``documents``.
    """

    root: str

    @property
    def raw(self) -> Table:
        return Table(f"{self.root}/raw_pages", RAW_PAGES, ("source", "dt"), batched=True)

    @property
    def processed(self) -> Table:
        schema = T.StructType([*PROCESSED.fields, _DT])
        return Table(f"{self.root}/processed_docs", schema, ("source", "dt"), batched=True)

    @property
    def curated(self) -> Table:
        own = [T.StructField("rule_version", T.LongType()), T.StructField("written_at", T.TimestampType())]
        schema = T.StructType([*CURATED.fields, *own, _DT])
        return Table(f"{self.root}/curated_docs", schema, ("dt",), batched=True)

    @property
    def commits(self) -> Table:
        """Batches that are complete, by the day they were written on."""
        return Table(f"{self.root}/commits", COMMITS, ("written_on",), batched=True)

    @property
    def malformed(self) -> Table:
        """Bytes of messages that are no jobs; the failure topic has their text."""
        schema = T.StructType([f for f in TOPIC.fields if f.name in ("value", "partition", "offset")])
        return Table(f"{self.root}/malformed_messages", schema, batched=True)

    @property
    def outcomes(self) -> Table:
        return Table(f"{self.root}/outcome_counts", OUTCOME_COUNTS, batched=True)

    def tables(self) -> tuple[Table, ...]:
        """All tables; the commits come first, so that a batch to be cleared is not seen half."""
        return self.commits, self.raw, self.processed, self.curated, self.malformed, self.outcomes

    def create(self, spark: SparkSession) -> "Layers":
        for table in self.tables():
            table.create(spark)
        return self

    def write_documents(
        self, documents: DataFrame, rule_version: int, time: datetime, run: str, batch_id: int
    ) -> None:
        """Write a batch's curated documents and then commit them, one row for each day."""
        own = {"rule_version": F.lit(rule_version).cast("long"), "written_at": F.lit(time).cast("timestamp")}
        self.curated.write_batch(documents.withColumns(own), run, batch_id)
        commits = documents.groupBy("dt").agg(F.count(F.lit(1)).alias("documents")).withColumns(
            {"written_at": own["written_at"], "written_on": F.lit(f"{time:%Y-%m-%d}")}
        )
        self.commits.write_batch(commits, run, batch_id)

    def documents(self, spark: SparkSession) -> DataFrame:
        """Curated documents, one for each identity."""
        return last_written(self.curated.read(spark), DOCUMENT, LAST_DOCUMENT)

    def raw_pages(self, spark: SparkSession) -> DataFrame:
        """Stored html, one page for each identity."""
        return last_written(self.raw.read(spark), PAGE, LAST_RAW)

    def processed_pages(self, spark: SparkSession) -> DataFrame:
        return last_written(self.processed.read(spark), PAGE, LAST_PROCESSED)

    def closed_days(self, spark: SparkSession, since: str, before: str) -> list[str]:
        """Days before ``before`` of which several batches were committed, as seen from the
        commits written since ``since``."""
        rows = self.commits.from_day(spark, "written_on", since).where(F.col("dt") < before)
        several = rows.groupBy("dt").agg(F.countDistinct(*BATCH_COLUMNS).alias("_n")).where("_n > 1")
        return sorted(row["dt"] for row in several.select("dt").collect())

    def compact(self, spark: SparkSession, days: list[str], since: str, time: datetime) -> int:
        """Put the committed batches of each closed day together as one, in each layer, all days
        in one job a layer. Returns the number of folders deleted.

        Only batches in the commits written since ``since`` are taken, so none that a worker is
        at; of each identity the row that readers see stays. The new batch is complete and
        committed before the old folders go: a load that has not seen them yet finds their
        documents by the new commit, and one that has finds only keys it knows. Interrupted, it
        leaves rows twice, of which ``documents`` and the like show one, until it runs again.
        One compaction at a time, in an hour without a load.
        """
        commits = self.commits.from_day(spark, "written_on", since).where(F.col("dt").isin(days))
        committed = {tuple(row) for row in commits.select("dt", *BATCH_COLUMNS).distinct().collect()}
        run, layers = f"{COMPACTED}{uuid.uuid4().hex}", (
            (self.raw, PAGE, LAST_RAW),
            (self.processed, PAGE, LAST_PROCESSED),
            (self.curated, DOCUMENT, LAST_DOCUMENT),
        )
        gone: list[str] = []
        for table, identity, order in layers:
            old = []
            for day in days:
                found = table.folders(spark, day)
                own = [
                    at for at, of in found.items() if (day, *of) in committed or of[0].startswith(COMPACTED)
                ]
                if len({found[at] for at in own}) > 1:
                    old += own
            if old:
                rows = table.in_folders(spark, old)
                table.write_batch(last_written(rows, identity, order), run, 0)
                gone += old
        new = [
            at for day in days for at, of in self.curated.folders(spark, day).items() if of[0] == run
        ]
        if new:
            commit = self.curated.in_folders(spark, new).groupBy("dt").agg(F.count(F.lit(1)).alias("documents"))
            own = {"written_at": F.lit(time).cast("timestamp"), "written_on": F.lit(f"{time:%Y-%m-%d}")}
            self.commits.write_batch(commit.withColumns(own), run, 0)
        for place in gone:
            delete(spark, place)
        return len(gone)


class Documents(Protocol):
    #: Whether some columns are read without the others, so that rows are better read again than
    #: stored.
    columnar: ClassVar[bool]

    def listing(self, spark: SparkSession, since: str | None = None) -> DataFrame | None:
        """``(dt, run, batch_id, files, noted_on)`` if documents come in parts; ``files`` tells
        whether anything in a part has changed. Parts noted before the day ``since`` may be left
        out."""

    def keys(self, spark: SparkSession, parts: DataFrame | None = None) -> DataFrame:
        """``(s3_key, dt, rule_version)`` of every document, or of those in some parts, each key
        once."""

    def read(self, spark: SparkSession, wanted: DataFrame) -> DataFrame:
        """``s3_key``, ``rule_version`` and the curated columns of the ``wanted`` documents
        (s3_key, dt)."""


def version_of() -> Column:
    """Version of the site rules a document was made by; those without one are of version 0."""
    return F.coalesce("rule_version", F.lit(0)).cast("long").alias("rule_version")


def days_of(rows: DataFrame) -> list[str | None]:
    """The days (dt) of ``rows``: they are dates, and few whatever the input."""
    return [row["dt"] for row in rows.select("dt").distinct().collect()]


@dataclass(frozen=True)
class TableDocuments:
    """Documents of a curated table.

    With ``commits`` a part is what a batch has committed, and only commits written since a day
    are read, on whatever day their documents are. Without, parts are the table's folders, all of
    which are listed.
    """

    table: Table
    commits: Table | None = None
    columnar: ClassVar[bool] = True

    def parts(self, spark: SparkSession) -> DataFrame:
        return self.table.parts(spark)

    def listing(self, spark: SparkSession, since: str | None = None) -> DataFrame:
        if self.commits is None:
            return self.table.listing(spark).withColumn("noted_on", F.lit(""))
        rows = self.commits.from_day(spark, "written_on", since)
        time = F.date_format("written_at", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        return rows.select(
            "dt",
            *BATCH_COLUMNS,
            F.concat_ws(" ", time, "documents").alias("files"),
            F.col("written_on").alias("noted_on"),
        )

    def keys(self, spark: SparkSession, parts: DataFrame | None = None) -> DataFrame:
        rows = self.table.read(spark) if parts is None else self.table.in_parts(spark, parts)
        keys = rows.groupBy(F.col("curated_s3_key").alias("s3_key"), "dt")
        return keys.agg(F.max(version_of()).alias("rule_version"))

    def read(self, spark: SparkSession, wanted: DataFrame) -> DataFrame:
        days = days_of(wanted)
        held = self.table.day_folders(spark, days)
        rows = self.table.on_days(spark, days).withColumn("s3_key", F.col("curated_s3_key"))
        # Without a folder there are no files to choose from.
        chosen = semi_join_files(rows, wanted, ["s3_key"]) if held else rows.limit(0)
        only = last_written(chosen, ("s3_key",), LAST_DOCUMENT)
        return only.select("s3_key", version_of(), *CURATED_COLUMNS)


def on_days(rows: DataFrame, days: DataFrame) -> DataFrame:
    """Rows of some days (dt) and those without a day.

    Days are few whatever the input, so they are broadcast, and Spark prunes the folders of
    other days by them when it runs the scan.
    """
    # Spark prunes only by a side with a comparison in it; this one is true of every day.
    dated = rows.join(F.broadcast(days.where("dt >= ''").distinct()), "dt", "left_semi")
    return dated.select(*rows.columns).unionByName(rows.where("dt IS NULL"))


def tasks_for(spark: SparkSession, objects: int) -> int:
    """Tasks that read so many objects: more than a task for each core only for many objects.

    Spark counts a file as 4 MB at least and so plans a task, and later a stored part, for some
    thirty objects of any size.
    """
    return max(spark.sparkContext.defaultParallelism, objects // TASK_OBJECTS)


@dataclass(frozen=True)
class ObjectDocuments:
    """``<root>/curated/job_postings/dt=.../<id>.json``, one object per file."""

    root: str
    prefix: str = CURATED_PREFIX
    columnar: ClassVar[bool] = False

    def _key(self, path: Column) -> Column:
        at = F.locate(f"/{self.prefix}/", path)
        return F.substring(path, at + 1, F.length(path))

    def listing(self, spark: SparkSession, since: str | None = None) -> None:
        return None

    def keys(self, spark: SparkSession, parts: DataFrame | None = None) -> DataFrame:
        files = (
            spark.read.format("binaryFile")
            .option("pathGlobFilter", "*.json")
            .load(f"{self.root}/{self.prefix}")
        )
        zero = F.lit(0).cast("long").alias("rule_version")
        listed = files.select("path", F.col("dt").cast("string"), zero)
        listed = listed.coalesce(tasks_for(spark, listed.rdd.getNumPartitions() * PLANNED_OBJECTS))
        # Settled here and below, as joins by key would otherwise be pushed below the coalescing.
        return settled(listed, {"s3_key": self._key(F.col("path"))}).select("s3_key", "dt", "rule_version")

    def read(self, spark: SparkSession, wanted: DataFrame) -> DataFrame:
        schema = T.StructType([*CURATED.fields, _DT])
        objects = (
            spark.read.schema(schema)
            .option("multiLine", "true")
            .option("pathGlobFilter", "*.json")
            .json(f"{self.root}/{self.prefix}")
        )
        # File paths come percent-encoded here and plain from the listing.
        path = F.url_decode(F.replace(F.col("_path"), F.lit("+"), F.lit("%2B")))
        rows = on_days(objects.withColumn("_path", F.col("_metadata.file_path")), wanted.select("dt"))
        rows = settled(rows.coalesce(tasks_for(spark, wanted.count())), {"s3_key": self._key(path)})
        zero = F.lit(0).cast("long").alias("rule_version")
        found = rows.select("s3_key", zero, *CURATED_COLUMNS)
        return found.join(wanted.select("s3_key"), "s3_key", "left_semi")

