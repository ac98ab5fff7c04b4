"""Byte-level BPE by overlapping chunks.

A text is cut in chunks that reach into the next one. Each chunk is split into pieces by the
pattern on its own, in parallel. The pattern looks ahead only, so from a place where the pieces of two
neighbours both end, they go on alike: there they are stitched, and each chunk encodes the
pieces that are its own. Decoding concatenates the bytes of the ids.

Texts of one chunk, nearly all, need no stitching and stay where they are; only the chunks of
longer texts are dealt out. A text with an overlap in which no common place is found (a run of
thousands of letters) is split whole.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiregrain.llm.common import per_text, stored, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Characters of a chunk, and how far it reaches into the next.
CHUNK = 1 << 16
OVERLAP = 1 << 10
#: The pattern looks this many characters past the end of a piece at most.
LOOK_AHEAD = 4
#: Pieces whose ids a worker process keeps (about 200 bytes each): with more than CACHE, the
#: ones met first stay, which are the more frequent ones.
CACHE = 200_000
STAYING = 100_000
#: Bytes from which a piece is merged with a heap.
LONG_PIECE = 200
#: Texts with a character from here on are split by the ``regex`` pattern as it is.
PLANE = "\U00010000"
#: How ids are packed.
ID = np.dtype("<i4")
#: Stands for no rank.
NONE = 1 << 62
FIELDS = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def read_ranks(path: str) -> dict[bytes, int]:
    """Ranks of the byte strings of a vocabulary file: a base64 string and a rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines)}


def pair_table(ranks: dict[bytes, int]) -> dict[int, int]:
    """The rank of every two ids (packed in one number) that join to a string of the vocabulary."""
    pairs = {}
    for string, rank in ranks.items():
        for cut in range(1, len(string)):
            left, right = ranks.get(string[:cut]), ranks.get(string[cut:])
            if left is not None and right is not None:
                pairs[left << 32 | right] = rank
    return pairs


class Pairs:
    """The table of pairs as sorted arrays, and densely for two bytes."""

    def __init__(self, ranks: dict[bytes, int]):
        self.table = pair_table(ranks)
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.keys = np.array(sorted(self.table), np.int64)
        self.ranks = np.array([self.table[key] for key in self.keys.tolist()], np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 32 | np.maximum(right, 0)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[at] == key) & (left >= 0) & (right >= 0), self.ranks[at], NONE)


def merge(pieces: list[bytes], pairs: Pairs) -> list[bytes]:
    """Ids of each piece, packed as ID: of all neighbours, the pair of the lowest rank is joined, the first
    one of equals, until no pair has a rank. Pieces of like length take each step together."""
    out = [b""] * len(pieces)
    sizes = np.array([len(piece) for piece in pieces], np.int64)
    for low, high in zip((0, 6, 9, 13, 20, 40, 80), (6, 9, 13, 20, 40, 80, LONG_PIECE), strict=True):
        rows = np.flatnonzero((sizes > low) & (sizes <= high))
        for start in range(0, len(rows), 1 << 15):
            own = rows[start : start + (1 << 15)]
            padded = b"".join(pieces[i].ljust(high, b"\0") for i in own.tolist())
            parts = pairs.bytes[np.frombuffer(padded, np.uint8).reshape(-1, high)]
            parts[np.arange(high) >= sizes[own][:, None]] = -1
            for i, ids in zip(own.tolist(), _merged(parts, pairs), strict=True):
                out[i] = ids
    for i in np.flatnonzero(sizes > LONG_PIECE).tolist():
        parts = pairs.bytes[np.frombuffer(pieces[i], np.uint8)].tolist()
        out[i] = np.array(merge_long(parts, pairs.table), ID).tobytes()
    return out


def _merged(parts: np.ndarray, pairs: Pairs) -> list[bytes]:
    """``parts``: ids of the bytes of a piece in each row, filled up with -1."""
    n, width = parts.shape
    ended: list[np.ndarray] = []
    order: list[np.ndarray] = []
    live, columns = np.arange(n), np.arange(width)
    ranked = np.full((n, width), NONE)
    ranked[:, :-1] = pairs.rank(parts[:, :-1].ravel(), parts[:, 1:].ravel()).reshape(n, -1)
    while len(live):
        at = ranked.argmin(1)
        least = ranked[np.arange(len(live)), at]
        more = least != NONE
        if not more.all():
            ended.append(parts[~more])
            order.append(live[~more])
            parts, ranked, live, at, least = (x[more] for x in (parts, ranked, live, at, least))
        here = np.arange(len(live))
        parts[here, at] = least
        shift = np.minimum(columns + (columns > at[:, None]), width - 1)
        parts = np.take_along_axis(parts, shift, 1)
        parts[:, -1] = -1
        shift = np.minimum(columns + (columns >= at[:, None]), width - 1)
        ranked = np.take_along_axis(ranked, shift, 1)
        ranked[:, -1] = NONE
        after = np.minimum(at + 1, width - 1)
        ranked[here, at] = np.where(at + 1 < width, pairs.rank(least, parts[here, after]), NONE)
        before = np.maximum(at - 1, 0)
        ranked[here, before] = np.where(
            at > 0, pairs.rank(parts[here, before], least), ranked[here, before]
        )
    rows = np.concatenate(ended)[np.argsort(np.concatenate(order))]
    size, packed = ID.itemsize, rows.astype(ID).tobytes()
    starts = np.arange(n) * (width * size)
    stops = starts + (rows >= 0).sum(1) * size
    return [packed[i:j] for i, j in zip(starts.tolist(), stops.tolist(), strict=True)]


def merge_long(parts: list[int], pairs: dict[int, int]) -> list[int]:
    """The same with a heap of pairs, for pieces of any length."""
    n = len(parts)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int, int]] = []

    def offer(i: int) -> None:
        if after[i] < n:
            rank = pairs.get(parts[i] << 32 | parts[after[i]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, parts[i], parts[after[i]]))

    for i in range(n - 1):
        offer(i)
    while heap:
        rank, i, left, right = heapq.heappop(heap)
        j = after[i]
        if parts[i] != left or j >= n or parts[j] != right:
            continue  # one of the two has been joined to another meanwhile
        parts[i], parts[j] = rank, -1
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    return [part for part in parts if part >= 0]


def characters(kind: str) -> str:
    """The code points below PLANE of a Unicode property as ranges for a character class."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, ord(PLANE))]))
    found = (m.group() for m in regex.finditer(rf"\p{{{kind}}}+", every))
    return "".join(f"\\u{ord(run[0]):04x}-\\u{ord(run[-1]):04x}" for run in found)


def plain_pattern(pattern: str) -> str:
    """``pattern`` for ``re``, which is faster: Unicode properties and spaces as ranges. Right
    for texts below PLANE. Surrogates inside a range do not matter: no text has them."""
    out, inside, at = [], False, 0
    for found in re.finditer(r"\\p\{(\w+)\}|\\[sS]|\\.|[\[\]]", pattern):
        out.append(pattern[at : found.start()])
        at, token = found.end(), found.group()
        if token.startswith(r"\p") or token in (r"\s", r"\S"):
            own = characters(found.group(1) or "White_Space")
            if inside and token == r"\S":
                raise ValueError("a class with \\S can't be written as ranges")
            out.append(own if inside else f"[{'^' * (token == chr(92) + 'S')}{own}]")
        else:
            inside = {"[": True, "]": False}.get(token, inside)
            out.append(token)
    return "".join(out) + pattern[at:]


class Codec:
    """Encodes pieces, and decodes ids, of one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], plain: str, pattern: str):
        self.ranks, self.pairs = ranks, Pairs(ranks)
        self.plain, self.full = re.compile(plain), regex.compile(pattern)
        self.known: dict[str, bytes] = {}
        self.strings: list[bytes] = [b""] * (max(ranks.values(), default=-1) + 1)
        for string, rank in ranks.items():
            self.strings[rank] = string
        self.decimal = [b"%d" % rank for rank in range(len(self.strings))]
        self.packed = [np.array(rank, ID).tobytes() for rank in range(len(self.strings))]

    def split(self, text: str) -> list[str]:
        return self._pattern(text).findall(text)

    def ends(self, text: str) -> list[int]:
        return [found.end() for found in self._pattern(text).finditer(text)]

    def _pattern(self, text: str):
        return self.plain if text.isascii() or max(text) < PLANE else self.full

    def encode(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Ids of several texts, given as pieces."""
        known = self.known
        if len(known) > CACHE:
            for piece in list(islice(known, STAYING, None)):
                del known[piece]
        new = list({piece for pieces in texts for piece in pieces if piece not in known})
        raw = [piece.encode() for piece in new]
        whole = [self.ranks.get(x) for x in raw]
        known.update((x, self.packed[rank]) for x, rank in zip(new, whole, strict=True) if rank is not None)
        rest = [i for i, rank in enumerate(whole) if rank is None]
        known.update(zip((new[i] for i in rest), merge([raw[i] for i in rest], self.pairs), strict=True))
        get = known.__getitem__
        return [np.frombuffer(b"".join(map(get, pieces)), ID) for pieces in texts]

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.strings.__getitem__, ids.tolist()))

    def joined(self, ids: np.ndarray) -> bytes:
        return b",".join(map(self.decimal.__getitem__, ids.tolist()))


#: The codec a worker process made last; the tasks that follow in it use its pieces again.
_LATEST: list[tuple[int, Codec]] = []


@dataclass
class Source:
    """A vocabulary file's ranks and the pattern, sent once to each executor (about 1 MB)."""

    ranks: dict[bytes, int]
    plain: str
    pattern: str
    number: int

    def codec(self) -> Codec:
        if not _LATEST or _LATEST[0][0] != self.number:
            _LATEST[:] = [(self.number, Codec(self.ranks, self.plain, self.pattern))]
        return _LATEST[0][1]


def source(path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> Source:
    ranks, plain = read_ranks(path or public_tokenizers.path(VOCABULARY)), plain_pattern(pattern)
    return Source(ranks, plain, pattern, hash((pattern, frozenset(ranks.items()))))


def _digest(codec: Codec, ids: np.ndarray) -> tuple[int, str, str]:
    joined, raw = codec.joined(ids), codec.decode(ids)
    return len(ids), hashlib.sha256(joined).hexdigest(), hashlib.sha256(raw).hexdigest()


def encoded_whole(docs: DataFrame, source_: Source, keep_ids: bool) -> DataFrame:
    """``row`` and FIELDS (and ids), each text split from its start."""
    sent = docs.sparkSession.sparkContext.broadcast(source_)

    def worker():
        codec = sent.value.codec()

        def work(texts):
            ids = codec.encode([codec.split((text or b"").decode()) for text in texts])
            digests = [_digest(codec, own) for own in ids]
            out = [pa.array(x) for x in zip(*digests, strict=True)]
            return [*out, pa.array(ids, pa.list_(pa.int32()))] if keep_ids else out

        return work

    return per_text(docs, worker, FIELDS + (", ids array<int>" if keep_ids else ""))


def chunks(text: Column, chunk: int = CHUNK, overlap: int = OVERLAP) -> Column:
    """The chunks of a text as structs: number k, start, characters; also if it is the last."""
    count = F.greatest(F.lit(1), F.ceil(F.length(text) / chunk).cast("int"))
    return F.transform(
        F.sequence(F.lit(0), count - 1),
        lambda k: F.struct(
            k.alias("k"),
            (k * chunk).alias("start"),
            F.substring(text, k * chunk + 1, F.lit(chunk + overlap)).alias("chars"),
            (k == count - 1).alias("last"),
        ),
    )


def piece_ends(rows: DataFrame, source_: Source) -> DataFrame:
    """``rows`` (key, k, start, chars, last) with the ends of the pieces that no later text can
    change, from the start of the text on."""
    sent = rows.sparkSession.sparkContext.broadcast(source_)
    schema = T.StructType([*rows.schema.fields, *T.StructType.fromDDL("ends array<int>").fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent.value.codec()
        for batch in batches:
            ends = []
            own = zip(*(batch.column(c).to_pylist() for c in ("start", "chars", "last")), strict=True)
            for start, chars, last in own:
                sure = len(chars) - (0 if last else LOOK_AHEAD)
                ends.append([start + end for end in codec.ends(chars) if end <= sure])
            columns = [*batch.columns, pa.array(ends, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return rows.mapInArrow(run, schema)


def stitched(rows: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """``rows`` of piece_ends with the range [begin, end) of each chunk's own pieces.

    A chunk hands over to the next at the first place in their overlap where a piece ends in
    both. ``synchronised`` is false if there is none.
    """
    in_order = Window.partitionBy("key").orderBy("k")
    start_of_next = F.col("start") + chunk
    head = F.filter("ends", lambda e: e <= F.col("start") + overlap)
    tail = F.filter("ends", lambda e: e >= start_of_next)
    rows = rows.withColumn("head", head).withColumn("tail", tail)
    rows = rows.withColumn("met", F.array_min(F.array_intersect("tail", F.lead("head").over(in_order))))
    rows = rows.withColumn("begin", F.when(F.col("k") == 0, 0).otherwise(F.lag("met").over(in_order)))
    rows = rows.withColumn("end", F.when(F.col("last"), F.element_at("ends", -1)).otherwise(F.col("met")))
    return rows.withColumn("synchronised", F.col("begin").isNotNull() & F.col("end").isNotNull())


def encoded_chunks(rows: DataFrame, source_: Source) -> DataFrame:
    """(key, k, ids, synchronised): the ids of each chunk's own pieces."""
    sent = rows.sparkSession.sparkContext.broadcast(source_)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent.value.codec()
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                start, begin, end = row["start"], row["begin"], row["end"]
                cuts, chars = [], row["chars"]
                if row["synchronised"]:
                    cuts = [begin, *[e for e in row["ends"] if begin < e <= end]]
                out.append([chars[a - start : b - start] for a, b in zip(cuts, cuts[1:], strict=False)])
            out = codec.encode(out)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    batch.column("k"),
                    pa.array(out, pa.list_(pa.int32())),
                    batch.column("synchronised"),
                ],
                names=["key", "k", "ids", "synchronised"],
            )

    return rows.mapInArrow(run, "key string, k int, ids array<int>, synchronised boolean")


def encoded(
    docs: DataFrame,
    source_: Source | None = None,
    keep_ids: bool = False,
    chunk: int = CHUNK,
    overlap: int = OVERLAP,
) -> DataFrame:
    """``row``, n_tokens, ids_sha256, decoded_sha256 (and ids) for every row of ``docs``.

    A null text counts as empty: no token, digests of no byte. Repeated rows are encoded each;
    the chunks of a long text are known by the text's hash and meet its rows again by it.
    """
    source_ = source_ or source()
    long = F.coalesce(F.length("text") > chunk, F.lit(False))
    whole = encoded_whole(docs.where(~long), source_, keep_ids)
    big = docs.where(long).select(F.struct("*").alias("row"))
    key = F.sha2(F.col("row.text").cast("binary"), 256)
    big = stored(big.withColumn("key", key))
    pieces = (
        big.dropDuplicates(["key"])
        .select("key", F.explode(chunks(F.col("row.text"), chunk, overlap)).alias("chunk"))
        .select("key", "chunk.*")
        .repartition("key", "k")
    )
    parts = stored(encoded_chunks(stitched(piece_ends(pieces, source_), chunk, overlap), source_))
    whole_again = parts.where(~F.col("synchronised")).select("key").distinct()
    # The ids of one text, already one row of one column when it was read.
    ordered = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x["ids"]))
    texts = parts.join(whole_again, "key", "left_anti").groupBy("key").agg(ordered.alias("ids"))
    sent = docs.sparkSession.sparkContext.broadcast(source_)
    schema = "key string, " + FIELDS + ", ids array<int>"

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = sent.value.codec()
        for batch in batches:
            for start in range(len(batch)):
                one = batch.slice(start, 1)
                found = _digest(codec, np.array(one.column("ids")[0].as_py(), ID))
                arrays = [one.column("key"), *[pa.array([x]) for x in found], one.column("ids")]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["key", "n_tokens", "ids_sha256", "decoded_sha256", "ids"]
                )

    digests = texts.mapInArrow(digest, schema)
    names = ["n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * keep_ids]
    joined = big.join(digests, "key").select("row", *names)
    again = encoded_whole(big.join(whole_again, "key", "left_semi").select("row.*"), source_, keep_ids)
    return whole.union(joined).union(again)


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document, as digests, and what they decode to. A null text is empty and
    has no token; a text of any length is encoded whole; repeated rows are encoded each."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encoded(docs).select("row.doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


def encode_documents(docs: DataFrame) -> DataFrame:
    """Token ids of every row of ``docs`` with its doc_id, language and source. Null and empty
    texts have no ids; repeated rows come each."""
    return encoded(docs, keep_ids=True).select(
        "row.doc_id", "row.lang", "row.source", "n_tokens", "ids_sha256", "decoded_sha256", "ids"
    )
