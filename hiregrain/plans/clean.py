"""The clean table and what is counted over it, carried on from load to load.

Rows lie in buckets by the hash of their posting. A load rewrites only the buckets it touches; a
version is a list of bucket folders, and becomes the current one by one small file. The counts
behind marts and checks are sums: a load adds the rows of the buckets it has written with weight 1
and those of the buckets before with weight -1, so no other bucket is read for them.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiregrain.operators.latest import POSTING_KEY, latest_of_wide
from hiregrain.operators.marts import filled
from hiregrain.operators.quality import any_null, verdicts_of
from hiregrain.plans.loading import Staging
from hiregrain.schemas import REQUIRED_CLEAN, STAGING
from hiregrain.session import cut
from hiregrain.sources.tables import delete, make_folder, matching, put_if_absent

BUCKETS = 64
#: Versions that stay for readers that began with them.
KEPT = 2

_LONG = T.LongType()
DAILY = T.StructType(
    [
        T.StructField("collected_date", T.DateType()),
        T.StructField("source", T.StringType()),
        T.StructField("posting_count", _LONG),
    ]
)
QUALITY_COUNTS = (
    "total_postings",
    "description_filled_count",
    "content_hash_filled_count",
    "missing_title_count",
    "missing_company_count",
)
SOURCES = T.StructType(
    [
        T.StructField("source", T.StringType()),
        *[T.StructField(name, _LONG) for name in QUALITY_COUNTS],
        T.StructField("invalid", _LONG),
    ]
)
HASHES = T.StructType([T.StructField("content_hash", T.StringType()), T.StructField("n", _LONG)])


class VersionConflict(Exception):
    """Another run has carried the clean table on meanwhile."""


@dataclass(frozen=True)
class Version:
    """What is current: the loads taken in (all up to a number), the rows they staged, the number
    of hashes that more than one posting has, and the folders of each table's buckets."""

    number: int = -1
    taken: int = -1
    staged: int = 0
    groups: int = 0
    buckets: int = BUCKETS
    places: dict[str, dict[str, str]] = field(default_factory=dict)


def bucket_of(buckets: int, *names: str) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(buckets)).cast("int")


def weighted(rows: DataFrame, weight: int) -> DataFrame:
    """Rows reduced to what is counted, with a weight."""
    return rows.select(
        F.to_date("collected_at").alias("collected_date"),
        "source",
        "content_hash",
        filled("description_text").alias("description_filled_count"),
        filled("content_hash").alias("content_hash_filled_count"),
        (~filled("title")).alias("missing_title_count"),
        (~filled("company_name")).alias("missing_company_count"),
        any_null(*REQUIRED_CLEAN).alias("invalid"),
        F.lit(weight).alias("weight"),
    )


@dataclass(frozen=True)
class CleanPostings:
    root: str
    buckets: int = BUCKETS

    def version(self, spark: SparkSession) -> Version:
        """The current version; before the first load one without rows."""
        notes = matching(spark, f"{self.root}/versions/[0-9]*")
        if not notes:
            return Version(buckets=self.buckets)
        text = spark.read.text(notes[-1], wholetext=True).first()[0]
        return Version(**json.loads(text))

    def _table(self, spark: SparkSession, of: Version, name: str, schema: T.StructType, only=None) -> DataFrame:
        places = of.places.get(name, {})
        found = [place for bucket, place in places.items() if only is None or int(bucket) in only]
        if not found:
            return spark.createDataFrame([], schema)
        return spark.read.schema(schema).parquet(*[f"{self.root}/{place}" for place in found])

    def read(self, spark: SparkSession, of: Version | None = None) -> DataFrame:
        """The latest row per posting."""
        return self._table(spark, of or self.version(spark), "rows", STAGING)

    def daily(self, spark: SparkSession, of: Version | None = None) -> DataFrame:
        """Postings per date and source, as ``mart_daily`` counts them."""
        rows = self._table(spark, of or self.version(spark), "daily", DAILY)
        return rows.orderBy(F.col("collected_date").desc(), "source")

    def source_quality(self, spark: SparkSession, of: Version | None = None) -> DataFrame:
        """Fill and gap counts per source, as ``mart_source_quality`` counts them."""
        rows = self._table(spark, of or self.version(spark), "sources", SOURCES).drop("invalid")
        return rows.orderBy(F.col("total_postings").desc(), "source")

    def verdicts(self, spark: SparkSession, of: Version | None = None) -> DataFrame:
        """All checks, from the stored counts: no posting is read."""
        of = of or self.version(spark)
        sources = self._table(spark, of, "sources", SOURCES)
        one = spark.range(1)
        counted = sources.agg(
            F.coalesce(F.sum("total_postings"), F.lit(0)).alias("row_count"),
            F.coalesce(F.sum("invalid"), F.lit(0)).alias("invalid"),
        )
        return verdicts_of(
            one.select(F.lit(of.staged).alias("row_count")),
            counted,
            one.select(F.lit(of.groups).alias("groups")),
            sources.drop("invalid"),
        )

    def _write(self, rows: DataFrame, name: str, number: int) -> dict[str, str]:
        """Write rows by their ``bucket``; the new folders below the root by bucket."""
        folder = f"{name}/{number:010d}-{uuid.uuid4().hex[:8]}"
        spark = rows.sparkSession
        rows.hint("rebalance", "bucket").write.partitionBy("bucket").parquet(f"{self.root}/{folder}")
        made = [place.rpartition("/")[2] for place in matching(spark, f"{self.root}/{folder}/bucket=*")]
        return {name.rpartition("=")[2]: f"{folder}/{name}" for name in made}

    def _carried(self, of: Version, name: str, touched: set[int], made: dict[str, str]) -> dict[str, str]:
        """Old folders of the buckets that were not touched, and the new ones; a touched bucket
        that is empty now has none."""
        kept = {b: place for b, place in of.places.get(name, {}).items() if int(b) not in touched}
        return {**kept, **made}

    def advance(self, spark: SparkSession, staging: Staging) -> Version:
        """Take in the loads that the current version has not. An interrupted step leaves the
        version before; of two at once one is refused."""
        last = self.version(spark)
        notes = staging.loads.notes(spark)
        fresh = [note for note in notes if note.number > last.taken]
        if not fresh:
            return last
        number, bucket = last.number + 1, bucket_of(last.buckets, *POSTING_KEY)
        increment = staging.rows.read(spark, fresh)
        touched = {row[0] for row in increment.select(bucket).distinct().collect()}
        before = self._table(spark, last, "rows", STAGING, touched)
        rows = latest_of_wide(before.unionByName(increment)).withColumn("bucket", bucket)
        made = self._write(rows, "rows", number)
        places = {"rows": self._carried(last, "rows", touched, made)}
        # From the files, column by column; rows that stayed come to nothing.
        after = self._table(spark, Version(places={"rows": made}), "rows", STAGING)
        both = weighted(after, 1).unionByName(weighted(before, -1))
        delta = both.groupBy(*[name for name in both.columns if name != "weight"])
        delta = cut(delta.agg(F.sum("weight").alias("weight")).where("weight <> 0"))
        places["daily"] = self._summed(last, "daily", DAILY, delta.withColumn("posting_count", F.col("weight")), number)
        counts = {
            name: F.when(F.col(name), F.col("weight")).otherwise(0)
            for name in (*QUALITY_COUNTS[1:], "invalid")
        }
        by_source = delta.withColumns({"total_postings": F.col("weight"), **counts})
        places["sources"] = self._summed(last, "sources", SOURCES, by_source, number)
        places["hashes"], groups = self._hashes(last, delta, number)
        staged = last.staged + sum(note.row_count for note in fresh)
        current = Version(number, notes[-1].number, staged, last.groups + groups, last.buckets, places)
        make_folder(spark, f"{self.root}/versions")
        if not put_if_absent(spark, f"{self.root}/versions/{number:010d}", json.dumps(vars(current))):
            raise VersionConflict(f"version {number} is there already")
        return current

    def _summed(self, last: Version, name: str, schema: T.StructType, delta: DataFrame, number: int) -> dict[str, str]:
        """The sums of a small table with those of ``delta`` added; what comes to nothing goes."""
        keys = [f.name for f in schema.fields if f.dataType != _LONG]
        sums = [f.name for f in schema.fields if f.dataType == _LONG]
        stored = self._table(delta.sparkSession, last, name, schema)
        both = stored.unionByName(delta.select(*keys, *[F.col(s).cast("long").alias(s) for s in sums]))
        total = both.groupBy(*keys).agg(*[F.sum(s).alias(s) for s in sums]).where(F.col(sums[0]) != 0)
        return self._write(total.withColumn("bucket", F.lit(0)), name, number)

    def _hashes(self, last: Version, delta: DataFrame, number: int) -> tuple[dict[str, str], int]:
        """Postings of each content hash, by buckets of the hash, and by how many the hashes with
        more than one posting grow."""
        spark, bucket = delta.sparkSession, bucket_of(last.buckets, "content_hash")
        change = delta.groupBy("content_hash").agg(F.sum("weight").alias("n")).where("n <> 0")
        change = cut(change)
        touched = {row[0] for row in change.select(bucket).distinct().collect()}
        if not touched:
            return last.places.get("hashes", {}), 0
        before = self._table(spark, last, "hashes", HASHES, touched)
        after = before.unionByName(change).groupBy("content_hash").agg(F.sum("n").alias("n"))
        made = self._write(after.where("n <> 0").withColumn("bucket", bucket), "hashes", number)
        now = self._table(spark, Version(places={"hashes": made}), "hashes", HASHES)
        grown = now.where("n > 1").count() - before.where("n > 1").count()
        return self._carried(last, "hashes", touched, made), grown

    def sweep(self, spark: SparkSession, kept: int = KEPT) -> int:
        """Delete folders that none of the last ``kept`` versions has, and older notes; not while
        a step runs."""
        notes = matching(spark, f"{self.root}/versions/[0-9]*")
        used = set()
        for note in notes[-kept:]:
            places = json.loads(spark.read.text(note, wholetext=True).first()[0])["places"]
            used |= {place for buckets in places.values() for place in buckets.values()}
        found = matching(spark, f"{self.root}/{{rows,hashes,daily,sources}}/*/bucket=*")
        lost = [place for place in found if "/".join(place.split("/")[-3:]) not in used]
        for place in [*lost, *notes[:-kept]]:
            delete(spark, place)
        return len(lost)
