"""Parquet tables: create if absent, append, replace one batch, read."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiregrain.operators.skew import checked_broadcast

RUN, BATCH = "run", "batch_id"
BATCH_COLUMNS = (RUN, BATCH)


#: How rows that are not gathered are written: a task has files open in some folders at once, the
#: days of a month and more, and sorts its rows only for still more; what was shuffled to make the
#: rows goes as soon as they are written.
UNMOVED = {
    "spark.sql.maxConcurrentOutputFileWriters": "40",
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
}
#: A task holds a row group for each of those folders.
OPEN_BYTES = 8 << 20
#: Files of very many long texts: smaller by some 7 percent, for a third more time to write them.
PACKED = {"parquet.page.size": 4 << 20, "parquet.compression.codec.zstd.level": 5}
#: The folder of rows without a day.
NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _hadoop(spark: SparkSession, place: str):
    """A Hadoop path and its file system."""
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Files and folders that a pattern names, in order."""
    path, files = _hadoop(spark, pattern)
    return sorted(found.getPath().toString() for found in files.globStatus(path) or [])


def delete(spark: SparkSession, place: str) -> None:
    path, files = _hadoop(spark, place)
    files.delete(path, True)


def make_folder(spark: SparkSession, place: str) -> None:
    path, files = _hadoop(spark, place)
    files.mkdirs(path)


def put_if_absent(spark: SparkSession, place: str, text: str) -> bool:
    """Creates a file with all of its content in one step; false if there is one already.

    The content is written beside and renamed. Where renaming is one step that fails at an
    existing name, as in HDFS, of several writers exactly one gets true.
    """
    folder, _, name = place.rpartition("/")
    beside, files = _hadoop(spark, f"{folder}/.{name}-{uuid.uuid4().hex}")
    target, _ = _hadoop(spark, place)
    out = files.create(beside, True)
    out.write(bytearray(text.encode()))
    out.close()
    jvm, gateway = spark._jvm, spark._sc._gateway
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        files.makeQualified(target).toUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(
            files.makeQualified(beside), files.makeQualified(target), gateway.new_array(kind, 0)
        )
    except Py4JJavaError as error:
        files.delete(beside, False)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    return True


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Settings of the session, for a while."""
    before = {name: spark.conf.get(name, None) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def fitted(rows: DataFrame, schema: T.StructType) -> DataFrame:
    """The columns of ``schema``; those that rows lack and may be null are null."""
    missing = [f for f in schema.fields if f.nullable and f.name not in rows.columns]
    rows = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing})
    return rows.select(*schema.fieldNames())


@dataclass(frozen=True)
class Table:
    """A folder of parquet files with a declared schema.

    ``batched`` tables have two last partition levels, ``run`` and ``batch_id``: batch ids
    count from 0 in each streaming checkpoint, so only both together name a batch. Writing
    a batch again replaces what an interrupted try of it left in the same folders;
    ``clear_batch`` removes it from all folders.
    ``gathered`` tables are shuffled by partition before writing, so that the number of
    files stays near the number of folders; a folder with very many rows is split over
    tasks at run time. With ``gather_rows``, batches of more rows are not: their tasks have
    enough for files of their own, and write them without moving or sorting a row.
    """

    path: str
    schema: T.StructType
    partitions: tuple[str, ...] = ()
    batched: bool = False
    gathered: bool = True
    gather_rows: int | None = None

    def _full_schema(self) -> T.StructType:
        own = [T.StructField(RUN, T.StringType()), T.StructField(BATCH, T.LongType())]
        batch = own if self.batched else []
        return T.StructType([*self.schema.fields, *batch])

    def create(self, spark: SparkSession) -> "Table":
        """Make the folder if nobody has; an existing table is left as it is."""
        empty = spark.createDataFrame([], self.schema)
        empty.write.mode("ignore").parquet(self.path)
        return self

    def read(self, spark: SparkSession) -> DataFrame:
        """All rows; a missing or unreadable folder is an error, never an empty table."""
        return spark.read.schema(self._full_schema()).parquet(self.path)

    def day_folders(self, spark: SparkSession, days: list[str | None]) -> list[str]:
        """The folders of some days (dt); nothing else is listed."""
        above = "".join(f"/{name}=*" for name in self.partitions[: self.partitions.index("dt")])
        found = []
        for day in sorted({NO_DAY if day is None else day for day in days}):
            found += matching(spark, f"{self.path}{above}/dt={day}")
        return found

    def on_days(self, spark: SparkSession, days: list[str | None]) -> DataFrame:
        """Rows of some days (dt); of the table's folders only those of the days are listed."""
        found = self.day_folders(spark, days)
        if not found and not matching(spark, self.path):
            return self.read(spark)  # fails, as there is no table
        if not found:
            return spark.createDataFrame([], self._full_schema())
        files = spark.read.schema(self._full_schema()).option("basePath", self.path)
        return files.parquet(*found)

    def from_day(self, spark: SparkSession, level: str, first: str | None) -> DataFrame:
        """Rows whose first partition level, ``level``, is at least ``first``, or all of them; of
        the other folders only the names are listed."""
        found = matching(spark, f"{self.path}/{level}=*")
        if first is not None:
            found = [place for place in found if place.rpartition("=")[2] >= first]
        if not found and not matching(spark, self.path):
            return self.read(spark)
        if not found:
            return spark.createDataFrame([], self._full_schema())
        files = spark.read.schema(self._full_schema()).option("basePath", self.path)
        return files.parquet(*found)

    def clear_batch(self, spark: SparkSession, run: str, batch_id: int) -> None:
        """Remove a batch that is to be done again from every folder."""
        levels = ["*"] * len(self.partitions)
        place = "/".join([self.path, *levels, f"{RUN}={run}", f"{BATCH}={batch_id}"])
        for found in matching(spark, place):
            delete(spark, found)

    def parts(self, spark: SparkSession) -> DataFrame:
        """The folders of a batched table as their partition values."""
        return self.listing(spark).drop("files")

    def listing(self, spark: SparkSession) -> DataFrame:
        """The folders of a batched table as their partition values, and in ``files`` a digest of
        the names and sizes of what lies in each, from a listing: no file is opened. Whatever
        writes to a folder changes it, as no two writes name a file the same."""
        levels = [*self.partitions, *BATCH_COLUMNS]
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
        try:
            listed = files.option("basePath", self.path).load(f"{self.path}/{self.partitions[0]}=*")
        except AnalysisException:  # no folder yet; a missing table is an error elsewhere
            return self.read(spark).select(*levels, F.lit("").alias("files")).limit(0)
        kinds = {RUN: "string", BATCH: "long"}
        # From the table's folder on: the same files may be reached under another address.
        name = F.concat_ws(" ", F.substring_index("path", "/", -1 - len(levels)), "length")
        named = [F.col(level).cast(kinds.get(level, "string")).alias(level) for level in levels]
        digest = F.sha2(F.concat_ws("\n", F.array_sort(F.collect_list("_name"))), 256)
        return listed.select(*named, name.alias("_name")).groupBy(*levels).agg(digest.alias("files"))

    def in_parts(self, spark: SparkSession, parts: DataFrame) -> DataFrame:
        """Rows of some folders; of the table's folders only those of their days are listed."""
        days = [row[0] for row in parts.select("dt").distinct().collect()]
        levels = [*self.partitions, *BATCH_COLUMNS]
        return self.on_days(spark, days).join(checked_broadcast(parts.select(*levels)), levels, "left_semi")

    def compact(self, spark: SparkSession, value: str) -> None:
        """Rewrite the batches of one value of the first partition as one: for a closed day.

        The new folder is complete before the old ones go, so nothing is lost when this is
        interrupted; until it ends, or is run again, readers may see rows twice.
        """
        first = self.partitions[0]
        old = [row.asDict() for row in self.parts(spark).where(F.col(first) == value).collect()]
        rows = self.read(spark).where(F.col(first) == value).dropDuplicates(self.schema.fieldNames())
        self.write_batch(rows, f"compacted-{uuid.uuid4().hex}", 0)
        for part in old:
            levels = [f"{name}={part[name]}" for name in (*self.partitions, *BATCH_COLUMNS)]
            delete(spark, "/".join([self.path, *levels]))

    def folders(self, spark: SparkSession, day: str) -> dict[str, tuple[str, int]]:
        """The batch folders of one day, and whose run and batch each is; nothing else is listed."""
        above = "".join(f"/{name}=*" for name in self.partitions[: self.partitions.index("dt")])
        found = {}
        for place in matching(spark, f"{self.path}{above}/dt={day}/{RUN}=*/{BATCH}=*"):
            run, batch = (level.partition("=")[2] for level in place.rsplit("/", 2)[1:])
            found[place] = run, int(batch)
        return found

    def in_folders(self, spark: SparkSession, places: list[str]) -> DataFrame:
        """Rows of some of its folders, none of the others listed."""
        files = spark.read.schema(self._full_schema()).option("basePath", self.path)
        return files.parquet(*places)

    def _gathers(self, rows: DataFrame) -> bool:
        if not (self.gathered and self.partitions):
            return False
        return self.gather_rows is None or rows.count() <= self.gather_rows

    def append(self, rows: DataFrame) -> None:
        self._write(rows, self.partitions, "append")

    def write_batch(self, rows: DataFrame, run: str, batch_id: int) -> None:
        batch = {RUN: F.lit(run), BATCH: F.lit(batch_id).cast("long")}
        self._write(rows, (*self.partitions, *BATCH_COLUMNS), "overwrite", batch)

    def _write(
        self, rows: DataFrame, levels: tuple[str, ...], mode: str, batch: dict[str, Column] | None = None
    ) -> None:
        chosen = fitted(rows, self.schema)
        gathers = self._gathers(chosen)
        if gathers:
            chosen = chosen.hint("rebalance", *self.partitions)
        write = chosen.withColumns(batch or {}).write.partitionBy(*levels).mode(mode)
        write = write.option("partitionOverwriteMode", "dynamic")
        if gathers or not self.partitions:
            write.parquet(self.path)
            return
        with settings(rows.sparkSession, UNMOVED):
            write.options(**PACKED).option("parquet.block.size", OPEN_BYTES).parquet(self.path)
