"""Incremental load of curated documents into staging."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiregrain.operators.quality import lacking
from hiregrain.operators.skew import checked_broadcast
from hiregrain.schemas import CURATED_COLUMNS, LOAD_CHECKPOINT, STAGING
from hiregrain.session import cut
from hiregrain.sources.lake import Documents
from hiregrain.sources.loads import Loads, LoadTable, Note

PARTS = T.StructType(
    [
        T.StructField("dt", T.StringType()),
        T.StructField("run", T.StringType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("files", T.StringType()),
        T.StructField("noted_on", T.StringType()),
    ]
)
QUARANTINE = T.StructType(
    [
        T.StructField("s3_key", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("document", T.StringType()),
        T.StructField("rule_version", T.LongType()),
        T.StructField("loaded_at", T.TimestampType()),
    ]
)
#: Rows of a load from which on its files are packed.
PACKED_ROWS = 1_000_000
#: Days that a batch may need from its time of writing to its commit.
LOOK_BACK = 2


class LoadMismatch(Exception):
    """Documents listed as new and documents read differ."""


@dataclass(frozen=True)
class Staging:
    """The staging table, the loaded keys and parts, and what could not be loaded, below one root.

    All are tables of loads: rows, keys, parts and quarantine of a load are seen together or not
    at all.
    """

    root: str

    @property
    def loads(self) -> Loads:
        return Loads(f"{self.root}/loads_job_postings")

    @property
    def rows(self) -> LoadTable:
        return LoadTable(f"{self.root}/stg_job_postings", STAGING, self.loads)

    @property
    def loaded_keys(self) -> LoadTable:
        path = f"{self.root}/etl_loaded_s3_keys_job_postings"
        return LoadTable(path, LOAD_CHECKPOINT, self.loads)

    @property
    def loaded_parts(self) -> LoadTable:
        return LoadTable(f"{self.root}/etl_loaded_parts_job_postings", PARTS, self.loads)

    @property
    def quarantine(self) -> LoadTable:
        """Documents that lack a required value, or are several in one object."""
        return LoadTable(f"{self.root}/etl_quarantine_job_postings", QUARANTINE, self.loads)

    def tables(self) -> tuple[LoadTable, ...]:
        return self.rows, self.loaded_keys, self.loaded_parts, self.quarantine

    def create(self, spark: SparkSession) -> "Staging":
        self.loads.create(spark)
        for table in self.tables():
            table.create(spark)
        return self

    def postings(self, spark: SparkSession) -> DataFrame:
        return self.rows.read(spark)

    def sweep(self, spark: SparkSession) -> int:
        """Delete what interrupted loads have left; not while a load runs."""
        return sum(table.sweep(spark) for table in self.tables())


def utc(time: datetime) -> datetime:
    """A time in UTC without a zone; one without a zone is taken as UTC."""
    return time.astimezone(timezone.utc).replace(tzinfo=None) if time.tzinfo else time


def new_keys(listed: DataFrame, loaded: DataFrame) -> DataFrame:
    """Listed keys that were never loaded, or only as documents of an older ``rule_version`` if
    keys have one. Both sides are shuffled by key unless Spark measures one small enough to send
    it whole."""
    if "rule_version" not in listed.columns:
        return listed.join(loaded.select("s3_key"), "s3_key", "left_anti")
    had = loaded.select(
        F.col("s3_key").alias("_key"), F.coalesce("rule_version", F.lit(0)).alias("_version")
    )
    met = (F.col("s3_key") == F.col("_key")) & (F.col("_version") >= F.col("rule_version"))
    return listed.join(had, met, "left_anti")


def staging_rows(documents: DataFrame, loaded_at: Column, *kept: str) -> DataFrame:
    """The 16 staging columns, and those named in ``kept``; a time that is none becomes NULL."""
    typed = {"collected_at": F.try_to_timestamp("collected_at")}
    return documents.select(
        *kept,
        *[typed.get(name, F.col(name)).alias(name) for name in CURATED_COLUMNS],
        loaded_at.alias("loaded_at"),
    )


def not_loadable(judged: DataFrame) -> DataFrame:
    """``_key`` and ``reason`` of rows that may not enter staging, from the ``_key`` and the
    ``violations`` of all rows."""
    bad = judged.where("violations <> ''")
    bad = bad.select("_key", F.concat(F.lit("no value in "), "violations").alias("reason"))
    again = judged.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = again.select("_key", F.concat("n", F.lit(" documents in one object")).alias("reason"))
    return bad.unionByName(several).groupBy("_key").agg(F.max("reason").alias("reason"))


def load_increment(
    spark: SparkSession,
    documents: Documents,
    staging: Staging,
    loaded_at: datetime,
    keep: Callable[[DataFrame], DataFrame] = cut,
    look_back: int | None = LOOK_BACK,
    retry: bool = False,
) -> int:
    """Take in the documents not loaded before. Returns the number of new staging rows.

    The list of new keys is stored first, so rows and keys come from the same list whatever
    arrives meanwhile. Rows, keys, parts and quarantine are written next and become visible
    together: a load that is interrupted anywhere leaves nothing to be seen, and one that another
    has overtaken raises ``LoadConflict`` and does the same. Documents that cannot be loaded go to
    the quarantine with their reason and do not stop the others; they are tried again with
    ``retry``.

    Documents that come in parts are looked for only in parts that no load has noted with the
    files they have now: a part may be written again. Only parts noted from ``look_back`` days
    before the newest one known are listed; None lists all.
    """
    notes = staging.loads.notes(spark)
    upto = max((note.upto for note in notes), default="")
    since = None
    if upto and look_back is not None:
        since = f"{datetime.fromisoformat(upto) - timedelta(days=look_back):%Y-%m-%d}"
    known = staging.loaded_keys.read(spark, notes).select("s3_key", "rule_version")
    if not retry:
        aside = staging.quarantine.read(spark, notes).select("s3_key", "rule_version")
        known = known.unionByName(aside)
    parts = documents.listing(spark, since)
    if parts is not None:
        late = [note for note in notes if note.upto >= (since or "")]
        noted = staging.loaded_parts.read(spark, late)
        parts = keep(parts.join(noted, ["dt", "run", "batch_id", "files"], "left_anti"))
        newest = parts.agg(F.max("noted_on")).first()[0]
        if newest is None:
            return 0
        upto = max(upto, newest)
    fresh = keep(new_keys(documents.keys(spark, parts), known))
    count = fresh.count()
    if not count and parts is None:
        return 0
    note = staging.loads.begin(notes)
    loaded = _write(spark, documents, staging, fresh, count, utc(loaded_at), note, keep)
    if parts is not None:
        staging.loaded_parts.put(parts, note)
    staging.loads.publish(spark, replace(note, row_count=loaded, upto=upto))
    return loaded


def _write(
    spark: SparkSession,
    documents: Documents,
    staging: Staging,
    fresh: DataFrame,
    count: int,
    loaded_at: datetime,
    note: Note,
    keep: Callable[[DataFrame], DataFrame],
) -> int:
    """Write rows, keys and quarantine of the ``fresh`` documents; the number of rows.

    Documents in columns are judged by their narrow columns first, and read again to be written:
    texts are neither stored in between nor shuffled. What was written is counted, so documents
    that changed meanwhile stop the load before it is seen.
    """
    if not count:
        return 0
    time = F.lit(loaded_at).cast("timestamp")
    found = documents.read(spark, fresh).withColumnRenamed("s3_key", "_key")
    rows = staging_rows(found, time, "_key", "rule_version")
    if not documents.columnar:
        rows = keep(rows)
    judged = keep(rows.select("_key", "rule_version", "loaded_at", lacking().alias("violations")))
    bad = keep(not_loadable(judged))
    seen = judged.agg(F.count_distinct("_key")).first()[0]
    if seen != count:
        raise LoadMismatch(f"{count} new documents, {seen} read")
    refused, n_bad = checked_broadcast(bad), bad.count()

    def good(given: DataFrame) -> DataFrame:
        return given.join(refused, "_key", "left_anti") if n_bad else given

    replace(staging.rows, packed=count >= PACKED_ROWS).put(good(rows), note)
    written = staging.rows.put_rows(spark, note)
    whole = F.count_if(lacking() == "").alias("n")
    if (n := written.agg(whole).first()[0]) != count - n_bad:
        raise LoadMismatch(f"{count - n_bad} documents to be loaded, {n} written")
    staging.loaded_keys.put(good(judged).withColumnRenamed("_key", "s3_key"), note)
    if n_bad:
        text = F.to_json(F.struct(*CURATED_COLUMNS))
        aside = rows.withColumn("document", text).join(refused, "_key")
        staging.quarantine.put(aside.withColumnRenamed("_key", "s3_key"), note)
    return count - n_bad
