"""Joins that stay balanced when a few keys hold most of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Left rows of one key that a task may hold; a key of more is cut into slices of about so many.
SLICE_ROWS = 1_000_000
# Rows of a narrow table that may be broadcast; with more, the join shuffles.
BROADCAST_ROWS = 100_000
# Hashes that may be sent to every executor, eight bytes each before their index.
SENT_HASHES = 4_000_000


def checked_broadcast(small: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` with a broadcast hint if it has at most ``limit`` rows; otherwise as it is."""
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def hashes_of(rows: DataFrame, names: Sequence[str], limit: int = SENT_HASHES) -> DataFrame:
    """``_hash``, the hash of the ``names`` of ``rows``, to be sent to every executor if there are
    at most ``limit`` rows."""
    hashes = rows.select(F.xxhash64(*names).alias("_hash"))
    return F.broadcast(hashes) if rows.count() <= limit else hashes


def semi_join(
    rows: DataFrame, wanted: DataFrame, names: Sequence[str], limit: int = SENT_HASHES
) -> DataFrame:
    """``rows LEFT SEMI JOIN wanted`` for wide rows: while there are at most ``limit`` wanted keys,
    their hashes are sent and no row is moved.

    Rows that share no more than the hash of a wanted key are found on the keys alone and left
    out. Nulls in ``names`` match nothing.
    """
    hashes = hashes_of(wanted, names, limit)
    hashed = rows.dropna(subset=list(names)).withColumn("_hash", F.xxhash64(*names))
    met = hashed.join(hashes, "_hash", "left_semi").drop("_hash")
    strays = met.select(*names).join(wanted, list(names), "left_anti").distinct()
    return met.join(checked_broadcast(strays), list(names), "left_anti")


def hot_keys(rows: DataFrame, on: list[str], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Hashes of the keys with more than ``slice_rows`` rows, with the number of slices each is
    cut into; there are fewer of them than rows / ``slice_rows``."""
    counts = rows.groupBy(F.xxhash64(*on).alias("_hash")).agg(F.count(F.lit(1)).alias("_rows"))
    return counts.where(F.col("_rows") > slice_rows).select(
        "_hash", F.ceil(F.col("_rows") / slice_rows).cast("int").alias("_slices")
    )


def salted_left_join(
    left: DataFrame,
    right: DataFrame,
    on: list[str],
    spread_by: Column,
    counted: DataFrame | None = None,
    slice_rows: int = SLICE_ROWS,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``left LEFT JOIN right`` where ``right`` holds each key once.

    Rows of a hot key are spread over slices by ``spread_by`` and the one matching
    right row is copied to each slice. ``counted`` may name a cheaper frame with the
    same keys to find the hot ones in; ``hot`` the keys found already.
    """
    if hot is None:
        hot = hot_keys(left if counted is None else counted, on, slice_rows)
    hot = checked_broadcast(hot)
    slices = F.coalesce(F.col("_slices"), F.lit(1))
    spread = (
        left.withColumn("_hash", F.xxhash64(*on))
        .join(hot, "_hash", "left")
        .withColumn("_slice", F.pmod(F.xxhash64(spread_by), slices).cast("int"))
        .drop("_hash", "_slices")
    )
    copied = (
        right.withColumn("_hash", F.xxhash64(*on))
        .join(hot, "_hash", "left")
        .withColumn("_slice", F.explode(F.sequence(F.lit(0), slices - 1)))
        .drop("_hash", "_slices")
    )
    return spread.join(copied, [*on, "_slice"], "left").drop("_slice")
