"""Columns that are worked out exactly once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def settled(rows: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """Adds or replaces columns through a generator of one row.

    The optimizer repeats the expression behind a plain column in every filter it
    pushes down, and between two Python steps for every later use. It does not look
    through a generator, so costly parsing and decoding goes here.
    """
    named = F.struct(*[column.alias(name) for name, column in columns.items()])
    kept = [name for name in rows.columns if name not in columns]
    return rows.select(*kept, F.inline(F.array(named)))
