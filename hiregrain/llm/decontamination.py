"""Benchmark decontamination: an FM-index for each shard of documents.

A shard is a block of whole texts in a task, as numbers of the words that the benchmark has; all
other words are separators, and runs too short for any window are left out of the index. The
benchmark's windows are searched backward by wavelet ranks, their occurrences located by sampled
positions, and the located word ranges merged into removal spans.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.llm.common import per_text, stored, table
from hiregrain.llm.fm_index import FMIndex

WINDOW = 13
#: A document is contaminated if a word is hit, and of its words at least this share.
LEAST_SHARE = (1, 20)
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Symbols of an index; a longer block is cut in shards that overlap by a window.
SHARD = 1 << 21
#: Bytes of benchmark text that are searched in one pass over the documents.
PASS_BYTES = 32 << 20
_SPAN = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("begin", pa.int32()), ("end", pa.int32())])
FIELDS = "n_words long, spans array<struct<start:int,stop:int,begin:int,end:int>>, items array<string>"


def words(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


@dataclass
class Windows:
    """The windows of some benchmark items, as rows of word numbers."""

    vocabulary: dict[bytes, int]
    phrases: np.ndarray
    lengths: np.ndarray
    owners: list[list[str]]

    @classmethod
    def of(cls, items: list[tuple[str, bytes]]) -> Windows:
        vocabulary: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [vocabulary.setdefault(word, len(vocabulary) + 1) for word in words(text)]
            for start in range(max(1, len(ids) - WINDOW + 1) if ids else 0):
                owners.setdefault(tuple(ids[start : start + WINDOW]), set()).add(item)
        phrases = np.zeros((len(owners), WINDOW), np.int64)
        for row, phrase in enumerate(owners):
            phrases[row, : len(phrase)] = phrase
        lengths = (phrases > 0).sum(1)
        return cls(vocabulary, phrases, lengths, [sorted(own) for own in owners.values()])

    def occurrences(self, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions in ``symbols`` (0 is any other word) and the window found at each."""
        places, found = [], []
        if len(self.phrases) and len(symbols):
            searchable = runs(symbols, int(self.lengths.min()))
            overlap = int(self.lengths.max()) - 1
            for start in range(0, len(searchable), SHARD):
                at = searchable[start : start + SHARD + overlap]
                index = FMIndex(symbols[at], len(self.vocabulary))
                low, high = index.search(self.phrases, self.lengths)
                times = high - low
                window = np.repeat(np.arange(len(times)), times)
                rows = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times) + low[window]
                places.append(at[index.locate(rows)])
                found.append(window)
        if not places:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(places), np.concatenate(found)

    def worker(self):
        get = self.vocabulary.get

        def work(texts):
            found = [words(text) for text in texts]
            counts = np.array([len(own) for own in found], np.int64)
            # One separator after each document.
            symbols = np.zeros(int(counts.sum()) + len(found), np.int64)
            starts = np.cumsum(counts + 1) - (counts + 1)
            for start, own in zip(starts.tolist(), found, strict=True):
                symbols[start : start + len(own)] = np.fromiter(map(get, own, repeat(0)), np.int64, len(own))
            places, windows = self.occurrences(symbols)
            change = np.zeros(len(symbols) + 1, np.int64)
            np.add.at(change, places, 1)
            np.add.at(change, places + self.lengths[windows], -1)
            hit = np.cumsum(change)[:-1] > 0
            docs = np.searchsorted(starts, places, side="right") - 1
            items: dict[int, set[str]] = {}
            pairs = np.unique(docs * max(1, len(self.owners)) + windows)
            for pair in pairs.tolist():
                doc, window = divmod(pair, len(self.owners))
                items.setdefault(doc, set()).update(self.owners[window])
            spans = [
                merged(texts[doc], hit[starts[doc] : starts[doc] + counts[doc]]) if doc in items else []
                for doc in range(len(texts))
            ]
            named = [sorted(items.get(doc, ())) for doc in range(len(texts))]
            return [
                pa.array(counts),
                pa.array(spans, pa.list_(_SPAN)),
                pa.array(named, pa.list_(pa.string())),
            ]

        return work


def runs(symbols: np.ndarray, least: int) -> np.ndarray:
    """Positions of the runs of ``least`` or more numbers, and of one separator after each."""
    known = np.concatenate([[0], symbols > 0, [0]]).astype(np.int8)
    edges = np.diff(known)
    begin, end = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    long = end - begin >= least
    change = np.zeros(len(symbols) + 2, np.int64)
    change[begin[long]] += 1
    change[np.minimum(end[long] + 1, len(symbols))] -= 1
    return np.flatnonzero(np.cumsum(change)[: len(symbols)] > 0)


def merged(text: bytes, hit: np.ndarray) -> list[dict]:
    """Removal spans: ranges of hit words, and the characters from their first to their last."""
    edges = np.diff(np.concatenate([[0], hit, [0]]).astype(np.int8))
    begin, end = np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist()
    places = [match.span() for match in WORD.finditer(text.lower())]
    out, seen, chars = [], 0, 0
    for start, stop in zip(begin, end, strict=True):
        at = []
        for place in (places[start][0], places[stop - 1][1]):
            chars += len(text[seen:place].decode("utf-8", "replace"))
            seen = place
            at.append(chars)
        out.append({"start": start, "stop": stop, "begin": at[0], "end": at[1]})
    return out


def parts_of(benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> list[DataFrame]:
    """``benchmark`` (item_id, text) as (item, text) in parts of about ``pass_bytes`` of text.

    A null item_id counts as empty. There is always a part, if an empty one.
    """
    item = F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item")
    items = benchmark.where("text is not null").select(item, "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-total // pass_bytes))
    part = F.pmod(F.xxhash64("item", "text"), F.lit(parts))
    return [items.where(part == k) for k in range(parts)]


def _hit_words() -> Column:
    """Words in the union of the spans of all passes."""
    return F.aggregate(
        F.array_sort("spans"),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("stop")),
        lambda seen, span: F.struct(
            (
                seen["n"]
                + F.greatest(F.lit(0), span["stop"] - F.greatest(span["start"], seen["stop"]))
            ).alias("n"),
            F.greatest(seen["stop"], span["stop"]).alias("stop"),
        ),
        lambda seen: seen["n"],
    )


def searched(docs: DataFrame, benchmark: DataFrame, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``row``, n_words, n_hit, spans, items and contaminated for every row of ``docs``.

    A null or empty text has no word and is not contaminated. With more than one pass, what a
    pass found is stored before the next, so that a task holds the windows of one.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.struct("*").alias("doc"))
    parts = parts_of(benchmark, pass_bytes)
    for k, part in enumerate(parts):
        windows = Windows.of([(x["item"], x["text"].encode()) for x in part.collect()])
        sent = context.broadcast(windows)
        found = per_text(rows, lambda sent=sent: sent.value.worker(), FIELDS, path=("doc", "text"))
        spans = F.concat("row.spans", "spans") if k else F.col("spans")
        items = F.array_union("row.items", "items") if k else F.col("items")
        rows = found.select("row.doc", "n_words", spans.alias("spans"), items.alias("items"))
        if len(parts) > 1:
            rows = stored(rows)
    hit, (share, whole) = F.col("n_hit"), LEAST_SHARE
    return rows.select(
        F.col("doc").alias("row"), "n_words", _hit_words().alias("n_hit"), "spans", "items"
    ).withColumn("contaminated", (hit > 0) & (hit * whole >= F.col("n_words") * share))


def without_spans(text: Column, spans: Column) -> Column:
    """``text`` without the characters of its removal spans."""
    ends = F.aggregate(
        F.array_sort(spans),
        F.struct(F.lit("").alias("kept"), F.lit(0).alias("at")),
        lambda seen, span: F.struct(
            F.concat(
                seen["kept"],
                F.substring(text, seen["at"] + 1, F.greatest(F.lit(0), span["begin"] - seen["at"])),
            ).alias("kept"),
            F.greatest(seen["at"], span["end"]).alias("at"),
        ),
    )
    return F.concat(ends["kept"], F.substring(text, ends["at"] + 1, F.length(text)))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their own columns, whatever their names.
    Null and empty texts stay, and with an empty benchmark every row; repeats stay or go together."""
    return searched(docs, benchmark).where(~F.col("contaminated")).select("row.*")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What of the benchmark every document holds; see ``searched`` for odd rows.

    A benchmark item without a word has no window, and an empty benchmark hits nothing; items that
    share a window all count; repeated documents are judged each.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return searched(docs, table(spark, sf_dir, "benchmark")).select(
        "row.doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("items")), 256).alias("items_sha256"),
        "contaminated",
    )


OP3_SQL = r"""
WITH words AS (
  SELECT doc_id, row_number() OVER () AS k, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(len(w), 13) AS size FROM items WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
places AS (
  SELECT k, size, i, array_to_string(w[i:i + size - 1], ' ') AS phrase
  FROM (SELECT k, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM words, (SELECT DISTINCT size FROM windows))),
found AS (SELECT k, i, size, item_id FROM places JOIN windows USING (size, phrase)),
hits AS (
  SELECT k, count(DISTINCT pos) AS n_hit
  FROM (SELECT k, unnest(range(i, i + size)) AS pos FROM found) GROUP BY k),
named AS (
  SELECT k, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY k)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
  coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM words LEFT JOIN hits USING (k) LEFT JOIN named USING (k)
"""
