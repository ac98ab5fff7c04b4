"""Counts that ride on a write: no second pass over what was written."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Counted:
    """Rows that are counted by a column of few known values when they are written."""

    rows: DataFrame
    observation: Observation
    values: tuple[str, ...]

    @classmethod
    def of(cls, rows: DataFrame, by: Column, values: tuple[str, ...]) -> "Counted":
        observation = Observation()
        counts = [F.count_if(by == value).alias(value) for value in values]
        return cls(rows.observe(observation, *counts), observation, values)

    def counts(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """(value, count) of the values met, in the columns of ``schema``; there once ``rows`` have
        been written, and waits until then."""
        met = self.observation.get
        return spark.createDataFrame([(v, met[v]) for v in self.values if met[v]], schema)
