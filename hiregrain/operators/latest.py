"""Latest row per posting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hiregrain.operators.skew import BROADCAST_ROWS, SENT_HASHES, hashes_of
from hiregrain.schemas import STAGING_COLUMNS

POSTING_KEY = ("source", "original_url")
# The last two only break ties between rows collected and loaded at the same moments.
RECENCY = ("collected_at", "loaded_at", "posting_id", "content_hash")


def _descending() -> list[Column]:
    return [F.col(name).desc() for name in RECENCY]


def latest_rows(staging: DataFrame) -> DataFrame:
    """One row per (source, original_url): collected last, then loaded last.

    Spark cuts each task's rows to one per key before the shuffle, so a key with very
    many rows sends one row per task. Project to the needed columns first: everything
    selected here is sorted and shuffled.
    """
    newest = Window.partitionBy(*POSTING_KEY).orderBy(*_descending())
    return staging.withColumn("_rank", F.row_number().over(newest)).where("_rank = 1").drop("_rank")


def latest_of_wide(staging: DataFrame, limit: int = SENT_HASHES) -> DataFrame:
    """``latest_rows`` of rows with long texts, which are neither sorted nor moved to find them.

    Keys and times come first: per posting the newest row by all but the content hash. Rows with
    the hash of such a key and times pass; postings with several of these, by ties or by equal
    hashes, are few and ranked whole.
    """
    # Without the content hash, so that nothing here needs the text.
    decisive = (*POSTING_KEY, *RECENCY[:-1])
    newest = Window.partitionBy(*POSTING_KEY).orderBy(*_descending()[:-1])
    narrow = staging.select(*decisive).withColumn("_rank", F.row_number().over(newest))
    found = narrow.where("_rank = 1").drop("_rank")
    hashes = hashes_of(found, decisive, limit)
    hashed = staging.withColumn("_hash", F.xxhash64(*decisive))
    return last_written(hashed.join(hashes, "_hash", "left_semi").drop("_hash"), POSTING_KEY, RECENCY)


def clean_postings(staging: DataFrame) -> DataFrame:
    return latest_of_wide(staging.select(*STAGING_COLUMNS))


def last_written(rows: DataFrame, identity: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row of each identity: the last by ``order``, and then by the whole row.

    Identities with more than one row, which are few, are found on narrow columns; all other
    rows pass as they are, without a shuffle while those few can be sent. Without any, ``rows``
    are returned.
    """
    again = rows.groupBy(*identity).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    again = again.select(*[F.col(name).alias(f"_{name}") for name in identity])
    found = again.count()
    if not found:
        return rows
    if found <= BROADCAST_ROWS:
        again = F.broadcast(again)
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in identity]
    ties = F.to_json(F.struct(*[name for name in rows.columns if name not in identity]))
    last = Window.partitionBy(*identity).orderBy(*[F.col(name).desc() for name in order], ties.desc())
    contested = rows.join(again, same, "left_semi").withColumn("_rank", F.row_number().over(last))
    settled = contested.where("_rank = 1").drop("_rank")
    return rows.join(again, same, "left_anti").unionByName(settled)


def merge_latest(current: DataFrame, increment: DataFrame) -> DataFrame:
    """Newest row per posting of an already clean table and new staging rows.

    While the increment's postings are few enough to send, rows of the clean table with another
    key pass as they are. Otherwise keys and times of both decide; no wide row is shuffled.
    """
    columns = current.columns
    increment = increment.select(*columns)
    keys = increment.select(*[F.col(name).alias(f"_{name}") for name in POSTING_KEY]).distinct()
    if keys.count() > BROADCAST_ROWS:
        return latest_of_wide(current.unionByName(increment))
    keys = F.broadcast(keys)
    same = [F.col(name).eqNullSafe(F.col(f"_{name}")) for name in POSTING_KEY]
    untouched = current.join(keys, same, "left_anti")
    contested = current.join(keys, same, "left_semi").unionByName(increment)
    return untouched.unionByName(latest_of_wide(contested))
