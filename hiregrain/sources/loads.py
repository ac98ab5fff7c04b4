"""Loads: numbered sets of new files in several tables that become visible in one step."""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hiregrain.sources.tables import PACKED, delete, fitted, make_folder, matching, put_if_absent

LOAD = "load_id"
_NOTE = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField(LOAD, T.StringType()),
        T.StructField("row_count", T.LongType()),
        T.StructField("upto", T.StringType()),
    ]
)


class LoadConflict(Exception):
    """Another load became visible meanwhile: this one has left nothing and may be run again."""


@dataclass(frozen=True)
class Note:
    """What is known of a visible load: its number, the name of its folders, its rows, and the
    last day on which a part that it has taken in was written."""

    number: int
    load_id: str
    row_count: int = 0
    upto: str = ""


@dataclass(frozen=True)
class Loads:
    """The notes of all visible loads, one small file each.

    A load writes to folders of its own and becomes visible, in all tables at once, by its note,
    which bears the next number. Of two loads that began with the same number one is refused.
    """

    path: str

    def create(self, spark: SparkSession) -> "Loads":
        make_folder(spark, self.path)
        return self

    def notes(self, spark: SparkSession) -> list[Note]:
        """By number. A missing folder is an error, never no loads."""
        rows = spark.read.schema(_NOTE).json(self.path).collect()
        return sorted((Note(*row) for row in rows), key=lambda note: note.number)

    def begin(self, notes: list[Note]) -> Note:
        number = notes[-1].number + 1 if notes else 0
        return Note(number, f"{number:010d}-{uuid.uuid4().hex[:8]}")

    def publish(self, spark: SparkSession, note: Note) -> None:
        place = f"{self.path}/{note.number:010d}"
        if not put_if_absent(spark, place, json.dumps(vars(note))):
            raise LoadConflict(f"load {note.number} is there already")


@dataclass(frozen=True)
class LoadTable:
    """A table whose rows come in loads; only those of visible loads are read.

    ``packed`` says that rows are written to smaller files, in more time.
    """

    path: str
    schema: T.StructType
    loads: Loads
    packed: bool = False

    def create(self, spark: SparkSession) -> "LoadTable":
        make_folder(spark, self.path)
        return self

    def put(self, rows: DataFrame, note: Note) -> None:
        """Write the rows of a load that is not visible yet."""
        place = f"{self.path}/{LOAD}={note.load_id}"
        options = PACKED if self.packed else {}
        fitted(rows, self.schema).write.mode("overwrite").options(**options).parquet(place)

    def put_rows(self, spark: SparkSession, note: Note) -> DataFrame:
        """The rows of a load as written, visible or not."""
        return spark.read.schema(self.schema).parquet(f"{self.path}/{LOAD}={note.load_id}")

    def append(self, rows: DataFrame) -> None:
        """Rows as a load of their own."""
        spark = rows.sparkSession
        note = self.loads.begin(self.loads.create(spark).notes(spark))
        self.put(rows, note)
        self.loads.publish(spark, replace(note, row_count=self.put_rows(spark, note).count()))

    def read(self, spark: SparkSession, notes: list[Note] | None = None) -> DataFrame:
        """Rows of all visible loads, or of some; a missing table is an error."""
        wanted = {note.load_id for note in (self.loads.notes(spark) if notes is None else notes)}
        found = [p for p in matching(spark, f"{self.path}/{LOAD}=*") if p.rpartition("=")[2] in wanted]
        if not found:
            if not matching(spark, self.path):
                return spark.read.schema(self.schema).parquet(self.path)  # fails
            return spark.createDataFrame([], self.schema)
        return spark.read.schema(self.schema).parquet(*found)

    def sweep(self, spark: SparkSession) -> int:
        """Delete the folders of loads that never became visible; not while a load runs."""
        known = {note.load_id for note in self.loads.notes(spark)}
        lost = [p for p in matching(spark, f"{self.path}/{LOAD}=*") if p.rpartition("=")[2] not in known]
        for place in lost:
            delete(spark, place)
        return len(lost)

