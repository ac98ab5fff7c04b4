"""SimHash near-duplicates by Golay-code fuzzy hashing.

Copies meet first: everything after the fingerprints works on distinct ones. A fingerprint of 64
bits is cut in segments of 23, 23 and 18 bits (the last filled up with zeros). Two differing bits
leave one segment equal, and one of the other two, taken in turn, differs by one bit at most; so the key of
a segment pair is one segment as it is and the Golay codeword indices of the next. Fingerprints
that share a key are compared. A key shared by more than MOST_SHARING fingerprints is not paired
up: its fingerprints meet at the words within one bit of them, of which two fingerprints share
one exactly if they differ by two bits at most, and which at most 65 of them can share.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.llm import golay
from hiregrain.llm.common import checked_broadcast, per_text, stored, table
from hiregrain.llm.components import components

SEED = 42
BITS = 64
SHINGLE = 3
MOST_DIFFERING = 2
#: Shift and width of each segment.
SEGMENTS = ((41, 23), (18, 23), (0, 18))
#: A key of more fingerprints takes the way for crowded keys.
MOST_SHARING = 64


def shingles(text: bytes | None) -> list[bytes]:
    words = text.lower().split() if text else []
    if len(words) < SHINGLE:
        return [b" ".join(words)] if words else []
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    stops = np.cumsum(lengths)
    starts = (stops - lengths)[: 1 - SHINGLE].tolist()
    return [joined[i:j] for i, j in zip(starts, (stops - 1)[SHINGLE - 1 :].tolist(), strict=True)]


def fingerprint(text: bytes | None) -> int:
    """A bit is set if more than half of the shingles' hashes have it; 0 without a word."""
    found = shingles(text)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(x, SEED) for x in found], np.uint64)
    # Counted in byte planes, a slice at a time: 64 flags for each hash.
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(hashes), 1 << 14):
        own = hashes[start : start + (1 << 14)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(own, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return sum(1 << bit for bit in np.flatnonzero(2 * counts > len(hashes)).tolist())


def fingerprints(docs: DataFrame) -> DataFrame:
    """``row`` and ``fingerprint``, the 64 bits as a signed long."""

    def worker():
        def work(texts):
            found = np.array([fingerprint(text) for text in texts], np.uint64)
            return [pa.array(found.view(np.int64))]

        return work

    return per_text(docs, worker, "fingerprint long")


def segment_keys(prints: DataFrame) -> DataFrame:
    """(key, fingerprint) for every segment key of each fingerprint."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_byte, errors = golay.tables()
        for batch in batches:
            found = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64)
            parts = [found >> shift & ((1 << width) - 1) for shift, width in SEGMENTS]
            for turn, exact in enumerate(parts):
                near = golay.keys(parts[(turn + 1) % 3], by_byte, errors)
                own = np.ones(near.shape, bool)
                own[:, 1:] = near[:, 1:] != near[:, :1]
                key = (turn << 35 | exact << 12)[:, None] | near
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key[own]), pa.array(np.repeat(found, own.sum(1)))],
                    names=["key", "fingerprint"],
                )

    return prints.select("fingerprint").mapInArrow(run, "key long, fingerprint long")


def links(prints: DataFrame, most_sharing: int = MOST_SHARING) -> DataFrame:
    """(a, b): enough pairs of distinct fingerprints that differ by two bits at most to connect
    all that such pairs connect."""
    keyed = stored(segment_keys(prints))
    sizes = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    sizes = stored(sizes)
    shared = keyed.join(sizes.where(F.col("n") <= most_sharing).select("key"), "key")
    shared = stored(shared)
    pairs = (
        shared.select("key", F.col("fingerprint").alias("a"))
        .join(shared.select("key", F.col("fingerprint").alias("b")), "key")
        .where("a < b")
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= MOST_DIFFERING)
        .select("a", "b")
    )
    crowded = sizes.where(F.col("n") > most_sharing).select("key")
    members = keyed.join(checked_broadcast(crowded), "key").select("fingerprint").distinct()
    flips = F.array(F.lit(0), *[F.lit(1 << bit if bit < 63 else -(1 << 63)) for bit in range(BITS)])
    around = members.select("fingerprint", F.explode(flips).alias("flip")).select(
        F.col("fingerprint").bitwiseXOR(F.col("flip")).alias("middle"), "fingerprint"
    )
    # At most 65 fingerprints have a middle in common: the middle itself and one for each bit.
    met = around.groupBy("middle").agg(F.collect_set("fingerprint").alias("all")).where("size(all) > 1")
    stars = met.select(F.array_min("all").alias("a"), F.explode("all").alias("b")).where("a < b")
    return pairs.union(stars).distinct()


def grouped(prints: DataFrame) -> DataFrame:
    """(fingerprint, component_id, root) for ``prints`` (fingerprint, doc_id): the smallest
    doc_id among all that links reach, and the fingerprint that stands for them."""
    distinct = stored(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least")))
    roots = components(links(distinct.select("fingerprint")))
    rooted = distinct.join(roots, distinct.fingerprint == roots.node, "left").select(
        "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = stored(rooted)
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fingerprint", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id of every row of ``docs`` (doc_id, text).

    Null and empty texts have fingerprint zero and are copies of each other. A null doc_id is
    smaller than none: it is component_id only where no other id is reached.
    """
    rows = fingerprints(docs.select("doc_id", "text"))
    rows = stored(rows.select("row.doc_id", "fingerprint"))
    return rows.join(stored(grouped(rows)), "fingerprint").select(
        "doc_id",
        F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each component of ``docs``, with its own columns: that of the smallest doc_id
    (null ids last), and of rows with the same id that of the smallest text hash. Texts without a
    word are copies of each other, so one of them stays; columns of any name are kept."""
    rows = fingerprints(docs)
    rows = rows.select("row.doc_id", F.xxhash64("row.text").alias("hash"), "fingerprint")
    rows = stored(rows)
    groups = rows.join(stored(grouped(rows)), "fingerprint")
    rank = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "hash")
    chosen = groups.groupBy("root").agg(F.min(rank).alias("first"))
    chosen = chosen.select(
        F.col("first.doc_id").alias("_id"), F.col("first.hash").alias("_hash")
    ).distinct()
    packed = docs.select(
        F.struct("*").alias("row"), F.col("doc_id").alias("_id"), F.xxhash64("text").alias("_hash")
    )
    kept = packed.join(
        chosen.withColumnsRenamed({"_id": "_cid", "_hash": "_chash"}),
        F.col("_id").eqNullSafe(F.col("_cid")) & (F.col("_hash") == F.col("_chash")),
        "left_semi",
    )
    return kept.dropDuplicates(["_id", "_hash"]).select("row.*")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document; see ``near_duplicates`` for odd rows. Repeated
    rows come each; an empty table gives no rows."""
    return near_duplicates(table(spark, sf_dir, "documents"))
