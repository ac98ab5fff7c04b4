"""Language-model scores by a Brown class-based bigram model.

A symbol is a word that occurs MIN_COUNT times or more, the end of a text, or the shape of any
other word. The training texts are stored once as numbers of symbols. Exchange clustering on the
driver moves each of the CLUSTERED most frequent words, the core, to the class that raises the
likelihood of the pair counts most. Every other symbol word joins the core's class that raises the
likelihood most, by Spark aggregates of the classes before and after it, over several passes. A
shape and the end are classes of their own. The probability of a word is that of its class after
the class before, times that of the word in its class.

Counts of all words stay on the cluster. Only words above a frequency that at most HOT of them
reach are broadcast; the rest of each text meets its counts in a shuffle. What grows with the
vocabulary on the driver and in each worker is a hash, a shape and a class of each symbol word,
some eleven bytes.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.llm.common import per_text, ranges, remainder, small_batches, table, written

END = b"\n"
#: Added to each count of a word; an unseen word is one word more.
ADDED = 0.1
#: Words of the core, classes they are put in, rounds of exchange at most.
CLUSTERED = 1000
CLASSES = 40
ROUNDS = 8
#: Words that occur less often have the class of their shape; times the others choose a class.
MIN_COUNT = 2
PASSES = 2
#: Of those, so many choose in one task.
WORDS_A_TASK = 20_000
#: Weight of a class's own share in the probability of following another.
BACKOFF = 20.0
#: The words that are broadcast with their counts are the most frequent, so many at most.
HOT = 200_000
#: Shapes of unseen and one-off words: four lengths, with a last byte in a word or not.
SHAPES = 8
#: Distinct words or symbols a task holds before it passes counts on.
HELD = 400_000
_WORD_BYTES = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz") | frozenset(range(0x80, 0x100))


def words(text: bytes | None) -> list[bytes]:
    return text.lower().split() if text else []


def shape(word: bytes) -> int:
    size = len(word)
    return (0 if size < 5 else 2 if size < 9 else 4 if size < 14 else 6) + (word[-1] in _WORD_BYTES)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes | None]]:
    for batch in batches:
        texts = batch.column(0)
        for start, stop in ranges(texts):
            yield texts.slice(start, stop - start).to_pylist()


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n): tokens of ``texts`` (text), each text's end included; counted in each task first."""

    def run(batches):
        held: Counter[bytes] = Counter()

        def rows():
            return pa.RecordBatch.from_arrays(
                [pa.array(held.keys(), pa.binary()), pa.array(held.values(), pa.int64())], names=["word", "n"]
            )

        for block in _blocks(batches):
            for text in block:
                held.update(words(text))
            held[END] += len(block)
            if len(held) > HELD:
                yield rows()
                held.clear()
        yield rows()

    small_batches(texts.sparkSession)
    counted = texts.select(F.col("text").cast("binary")).mapInArrow(run, "word binary, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def word_hashes(words_: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words_), np.uint64, len(words_))


def flat(split: list[list[bytes]]) -> tuple[list[bytes], np.ndarray]:
    """The distinct words of some texts, and for each of their words after each other its place
    among them."""
    place: defaultdict[bytes, int] = defaultdict()
    place.default_factory = place.__len__
    n = sum(map(len, split))
    found = np.fromiter(map(place.__getitem__, chain.from_iterable(split)), np.int64, n)
    place.default_factory = None  # it would keep the words until they are searched for
    return list(place), found


def closed(values: np.ndarray, split: list[list[bytes]], end: int) -> tuple[np.ndarray, np.ndarray]:
    """``values`` of the words of some texts with ``end`` after each text, and where texts begin."""
    sizes = np.fromiter(map(len, split), np.int64, len(split))
    stops = np.cumsum(sizes)
    return np.insert(values, stops, end), stops - sizes + np.arange(len(split))


@dataclass
class Clustered:
    """The words that have a class: the core by name, the others by sorted hashes, with shapes."""

    core: list[bytes]
    tail: np.ndarray
    shapes: np.ndarray

    def __len__(self) -> int:
        return len(self.core) + len(self.tail)


class Symbols:
    """Numbers of the clustered words, END, and the shapes of all others."""

    def __init__(self, clustered: Clustered):
        self.core = {word: k for k, word in enumerate(clustered.core)}
        self.tail, self.end = clustered.tail, len(clustered)
        self.count = len(clustered) + 1 + SHAPES

    def of(self, own: list[bytes]) -> np.ndarray:
        """The symbols of words, looked up together: best called with distinct ones."""
        found = np.fromiter(map(self.core.get, own, repeat(-1)), np.int64, len(own))
        rest = np.flatnonzero(found < 0)
        if len(rest) and len(self.tail):
            keys = word_hashes(own)[rest]
            at = np.minimum(self.tail.searchsorted(keys), len(self.tail) - 1)
            hit = self.tail[at] == keys
            found[rest[hit]] = len(self.core) + at[hit]
            rest = rest[~hit]
        shapes = [self.end if own[k] == END else self.end + 1 + shape(own[k]) for k in rest.tolist()]
        found[rest] = shapes
        return found


def clustered_words(counts: DataFrame) -> Clustered:
    """The core, and every other word of MIN_COUNT or more."""
    words_ = counts.where(F.col("word") != F.lit(bytearray(END)))
    core = [bytes(row["word"]) for row in words_.orderBy(F.desc("n"), "word").limit(CLUSTERED).collect()]
    named = set(core)

    def run(batches):
        for batch in batches:
            own = [word for word in batch.column(0).to_pylist() if word not in named]
            keys = word_hashes(own).view(np.int64)
            shapes = np.array([shape(word) for word in own], np.int8)
            yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(shapes)], names=["key", "shape"])

    found = words_.where(F.col("n") >= MIN_COUNT).select("word").mapInArrow(run, "key long, shape byte").toArrow()
    keys, first = np.unique(found["key"].to_numpy().view(np.uint64), return_index=True)
    return Clustered(core, keys, found["shape"].to_numpy()[first])


def encoded(texts: DataFrame, clustered: Clustered) -> DataFrame:
    """(symbols): the numbers of each text's symbols, its end included, four bytes each."""
    sent = texts.sparkSession.sparkContext.broadcast(clustered)

    def run(batches):
        symbols = Symbols(sent.value)
        for block in _blocks(batches):
            split = [words(text) for text in block]
            met, at = flat(split)
            own, starts = closed(symbols.of(met)[at], split, symbols.end)
            offsets = np.append(starts, len(own)) * 4
            rows = _binaries(offsets, own.astype(np.int32))
            yield pa.RecordBatch.from_arrays([rows], names=["symbols"])

    small_batches(texts.sparkSession)
    return texts.select(F.col("text").cast("binary")).mapInArrow(run, "symbols binary")


def _binaries(offsets: np.ndarray, data: np.ndarray) -> pa.Array:
    """Binary values that lie after each other in ``data``."""
    buffers = [None, pa.py_buffer(offsets.astype(np.int32).tobytes()), pa.py_buffer(data.tobytes())]
    return pa.Array.from_buffers(pa.binary(), len(offsets) - 1, buffers)


def _runs(batches: Iterator[pa.RecordBatch], end: int) -> Iterator[np.ndarray]:
    """The symbols of some texts after each other; the first text too begins after an end."""
    for batch in batches:
        for start, stop in ranges(batch.column(0)):
            block = batch.column(0).slice(start, stop - start).to_pylist()
            yield np.concatenate([[end], np.frombuffer(b"".join(block), np.int32)]).astype(np.int64)


def pair_counts(codes: DataFrame, kinds: np.ndarray, end: int) -> np.ndarray:
    """How often each kind of symbol follows each. ``kinds`` has the kind of each symbol; there are
    so few that the result comes to the driver."""
    count = int(kinds.max()) + 1
    sent = codes.sparkSession.sparkContext.broadcast(kinds)

    def run(batches):
        held = np.zeros(count * count, np.int64)
        for symbols in _runs(batches, end):
            own = sent.value[symbols].astype(np.int64)
            np.add.at(held, own[:-1] * count + own[1:], 1)
        pairs = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(pairs), pa.array(held[pairs])], names=["pair", "n"])

    found = codes.mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    pairs = np.zeros(count * count)
    pairs[found["pair"].to_numpy()] = found["n"].to_numpy()
    return pairs.reshape(count, count)


def _summed(keys: list[np.ndarray], sums: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    keys = np.concatenate([np.zeros(0, np.int64), *keys])
    order = np.argsort(keys, kind="stable")
    keys, sums = keys[order], np.concatenate([np.zeros(0, np.int64), *sums])[order]
    starts = np.flatnonzero(np.diff(keys, prepend=-1))
    return keys[starts], np.add.reduceat(sums, starts) if len(starts) else sums


def contexts(codes: DataFrame, clustered: Clustered, classes: np.ndarray) -> DataFrame:
    """(word, sides, counts): for a word outside the core, as its place in ``tail``, how often each
    class comes before it (side = class) and after it (side = classes + class), as bytes. Counted in
    each task; all rows of a word are in one partition, and a partition has some WORDS_A_TASK words."""
    total, first, end = int(classes.max()) + 1, len(clustered.core), len(clustered)
    sent = codes.sparkSession.sparkContext.broadcast(classes)

    def rows(keys, sums):
        word, side = np.divmod(keys, 2 * total)
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        cuts = np.append(starts, len(word))
        columns = [pa.array(word[starts])]
        for data in (side.astype(np.uint16), sums.astype(np.uint32)):
            columns.append(_binaries(cuts * data.itemsize, data))
        return pa.RecordBatch.from_arrays(columns, names=["word", "sides", "counts"])

    def run(batches):
        keys, sums, size = [], [], 0
        for symbols in _runs(batches, end):
            kinds = sent.value[symbols].astype(np.int64)
            at = np.flatnonzero((symbols >= first) & (symbols < end))
            place = (symbols[at] - first) * (2 * total)
            # An end closes each run, so a word always has a symbol after it.
            met = np.concatenate([place + kinds[at - 1], place + total + kinds[at + 1]])
            for x, y in zip((keys, sums), _summed([met], [np.ones(len(met), np.int64)]), strict=True):
                x.append(y)
            size += len(keys[-1])
            if size > 8 * HELD:
                yield rows(*_summed(keys, sums))
                keys, sums, size = [], [], 0
        yield rows(*_summed(keys, sums))

    found = codes.mapInArrow(run, "word long, sides binary, counts binary")
    return found.repartition(1 + len(clustered.tail) // WORDS_A_TASK, "word")


def chosen(near: DataFrame, old: np.ndarray, grid: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Words of ``near`` (contexts) and the one of the first ``classes`` classes that raises the
    likelihood of ``grid`` most for each. ``old`` has the classes they are counted in now."""
    total, size = len(grid), grid.sum(0)
    # What a class follows, then what follows it: a row for each side, a column for each class.
    sides = np.concatenate([grid, grid.T])[:, :classes]
    sent = near.sparkSession.sparkContext.broadcast((old, sides, size[:classes]))

    def best(word, side, n):
        old, sides, size = sent.value
        starts = np.flatnonzero(np.diff(word, prepend=-1))
        owner = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(word))))
        word = word[starts]
        weight = np.bincount(owner, n * (side < total), len(word))
        # The word itself is taken out of its class before all classes are compared.
        here = np.arange(classes)[None, :] == old[word][:, None]
        base = np.maximum(sides[side] - n[:, None] * here[owner], 0)
        gain = np.add.reduceat(_entropy(base + n[:, None]) - _entropy(base), starts)
        rest = np.maximum(size[None, :] - weight[:, None] * here, 0)
        gain -= 2 * (_entropy(rest + weight[:, None]) - _entropy(rest))
        kind = gain.argmax(1).astype(np.int16)
        return pa.RecordBatch.from_arrays([pa.array(word), pa.array(kind)], names=["word", "kind"])

    def run(batches):
        keys, sums = [], []
        for batch in batches:
            side = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
            times = pc.binary_length(batch.column(1)).to_numpy() // 2
            keys.append(np.repeat(batch.column(0).to_numpy(), times) * (2 * total) + side)
            sums.append(np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).astype(np.int64))
        keys, sums = _summed(keys, sums)
        word, side = np.divmod(keys, 2 * total)
        edges = np.append(np.flatnonzero(np.diff(word, prepend=-1)), len(word))
        for start in range(0, len(edges) - 1, 1000):
            part = slice(edges[start], edges[min(start + 1000, len(edges) - 1)])
            yield best(word[part], side[part], sums[part].astype(float))

    found = near.mapInArrow(run, "word long, kind short").toArrow()
    return found["word"].to_numpy(), found["kind"].to_numpy()


def likelihood(grid: np.ndarray) -> float:
    """What depends on the classes in the log likelihood of class pairs ``grid``."""
    return float(_entropy(grid).sum() - _entropy(grid.sum(0)).sum() - _entropy(grid.sum(1)).sum())


def assigned(codes: DataFrame, clustered: Clustered) -> tuple[np.ndarray, np.ndarray]:
    """The class of each symbol, and how often each class follows each."""
    core, end = len(clustered.core), len(clustered)
    # For the core, all other words count as their shapes.
    kinds = np.concatenate(
        [np.arange(core), core + 1 + clustered.shapes.astype(np.int64), core + np.arange(1 + SHAPES)]
    ).astype(np.int32)
    classes = exchanged(pair_counts(codes, kinds, end), core).astype(np.int16)[kinds]
    grid = pair_counts(codes, classes, end)
    own = len(grid) - 1 - SHAPES
    best = None
    for _ in range(PASSES if len(clustered.tail) else 0):
        words_, found = chosen(contexts(codes, clustered, classes), classes[core:end], grid, own)
        classes = classes.copy()
        classes[core + words_] = found
        grid = pair_counts(codes, classes, end)
        reached = likelihood(grid)
        if best is not None and reached <= best[0]:
            break
        best = reached, classes, grid
    return best[1:] if best else (classes, grid)


def _entropy(x: np.ndarray | float) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchanged(pairs: np.ndarray, movable: int, classes: int = CLASSES, rounds: int = ROUNDS) -> np.ndarray:
    """The class of each symbol: the first ``movable`` ones take turns in moving to the class
    that raises the likelihood most; the others keep a class of their own."""
    count = len(pairs)
    classes = max(1, min(classes, movable))
    total = classes + count - movable
    assigned = np.concatenate([np.arange(movable) % classes, np.arange(classes, total)]).astype(np.int64)
    member = np.zeros((count, total))
    member[np.arange(count), assigned] = 1
    grid = member.T @ pairs @ member
    size = pairs.sum(0) @ member
    weight = pairs.sum(0)
    for _ in range(rounds):
        moved = 0
        for word in range(movable):
            old = assigned[word]
            again = pairs[word, word]
            after = np.bincount(assigned, pairs[word], total)
            before = np.bincount(assigned, pairs[:, word], total)
            after[old] -= again
            before[old] -= again
            grid[old] -= after
            grid[:, old] -= before
            grid[old, old] -= again
            size[old] -= weight[word]
            own = grid[:classes]
            side = grid[:, :classes]
            here = np.arange(classes)
            corner = grid[here, here]
            gain = (_entropy(own + after) - _entropy(own)).sum(1)
            gain += (_entropy(side + before[:, None]) - _entropy(side)).sum(0)
            left, right = after[:classes], before[:classes]
            gain += _entropy(corner + left + right + again) + _entropy(corner)
            gain -= _entropy(corner + left) + _entropy(corner + right)
            gain -= 2 * (_entropy(size[:classes] + weight[word]) - _entropy(size[:classes]))
            new = int(np.argmax(gain))
            if gain[new] <= gain[old] + 1e-9:
                new = int(old)
            moved += new != old
            assigned[word] = new
            grid[new] += after
            grid[:, new] += before
            grid[new, new] += again
            size[new] += weight[word]
        if not moved:
            break
    return assigned


@dataclass
class Model:
    """What scoring needs on every executor."""

    clustered: Clustered
    hot: list[bytes]
    hot_counts: np.ndarray
    hot_kinds: np.ndarray
    #: Class of each symbol; log10 of a class after a class; of each class its tokens and words.
    classes: np.ndarray
    follows: np.ndarray
    class_tokens: np.ndarray
    class_words: np.ndarray
    tokens: int
    distinct: int

    def base(self, n):
        return np.log10((n + ADDED) / (self.tokens + ADDED * (self.distinct + 1)))

    def emission(self, n, kind):
        whole = self.class_tokens[kind] + ADDED * (self.class_words[kind] + 1)
        return np.log10((n + ADDED) / whole)

    def worker(self):
        symbols = Symbols(self.clustered)
        index = {word: k for k, word in enumerate(self.hot)}
        counts = self.hot_counts.astype(float)
        base, emission = self.base(counts), self.emission(counts, self.hot_kinds)
        end, end_place = int(self.classes[symbols.end]), index[END]
        names = ("word", "kind", "n")

        def work(texts):
            split = [words(text) for text in texts]
            met, at = flat(split)
            hot = np.fromiter(map(index.get, met, repeat(-1)), np.int64, len(met))
            kinds = np.empty(len(met), np.int64)
            rare = np.flatnonzero(hot < 0)
            kinds[hot >= 0] = self.hot_kinds[hot[hot >= 0]]
            kinds[rare] = self.classes[symbols.of([met[k] for k in rare.tolist()])]
            own, starts = closed(hot[at], split, end_place)
            kind, _ = closed(kinds[at], split, end)
            # What comes before a text's first word is an end, as the text before has one.
            steps = self.follows[np.concatenate([[end], kind[:-1]]), kind]
            known = own >= 0
            place = np.maximum(own, 0)
            sums = [
                np.add.reduceat(x, starts)
                for x in (
                    (known & (counts[place] > 0)).astype(np.int64),
                    np.where(known, base[place], 0.0),
                    steps + np.where(known, emission[place], 0.0),
                )
            ]
            owner = np.repeat(np.arange(len(split)), np.fromiter(map(len, split), np.int64, len(split)))
            left = np.flatnonzero(hot[at] < 0)
            pairs, times = np.unique(owner[left] * len(met) + at[left], return_counts=True)
            text, word = np.divmod(pairs, max(1, len(met)))
            offsets = np.searchsorted(text, np.arange(len(split) + 1))
            rows = pa.StructArray.from_arrays(
                [
                    pa.array([met[k] for k in word.tolist()], pa.binary()),
                    pa.array(kinds[word], pa.int32()),
                    pa.array(times, pa.int64()),
                ],
                names=names,
            )
            n_tokens = np.diff(np.append(starts, len(own)))
            return [*map(pa.array, (n_tokens, *sums)), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), rows)]

        return work


def hot_words(counts: DataFrame, most: int = HOT) -> tuple[list[bytes], np.ndarray]:
    """The most frequent words, all of a frequency or none: ``most`` at most, END always."""
    band = F.floor(F.log2("n") * 8)
    sizes = counts.groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("words")).collect()
    least, room = None, most
    for row in sorted(sizes, key=lambda x: -x["band"]):
        if row["words"] > room:
            break
        least, room = row["band"], room - row["words"]
    chosen = F.col("word") == F.lit(bytearray(END))
    if least is not None:
        chosen = chosen | (band >= least)
    found = counts.where(chosen).toArrow().sort_by([("n", "descending"), ("word", "ascending")])
    return found["word"].to_pylist(), found["n"].to_numpy()


def class_sizes(counts: DataFrame, clustered: Clustered, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each class."""
    sent = counts.sparkSession.sparkContext.broadcast((clustered, classes))

    def run(batches):
        clustered, classes = sent.value
        symbols, total = Symbols(clustered), int(classes.max()) + 1
        tokens, distinct = np.zeros(total, np.int64), np.zeros(total, np.int64)
        for batch in batches:
            kinds = classes[symbols.of(batch.column(0).to_pylist())]
            tokens += np.bincount(kinds, batch.column(1).to_numpy(), total).astype(np.int64)
            distinct += np.bincount(kinds, minlength=total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(total)), pa.array(tokens), pa.array(distinct)], names=["kind", "tokens", "words"]
        )

    parts = counts.select("word", "n").mapInArrow(run, "kind long, tokens long, words long")
    sums = parts.groupBy("kind").agg(F.sum("tokens").alias("t"), F.sum("words").alias("w")).collect()
    tokens, distinct = (np.zeros(int(classes.max()) + 1) for _ in range(2))
    for row in sums:
        tokens[row["kind"]], distinct[row["kind"]] = row["t"], row["w"]
    return tokens, distinct


def fit(docs: DataFrame, learn: Column) -> tuple[Model, DataFrame]:
    """The model of the ``learn`` rows of ``docs`` (doc_id, text), and their word counts.

    Without such rows all counts are zero and all words unseen.
    """
    texts = docs.where(learn).select("text")
    counts = written(word_counts(texts))
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    hot, hot_counts = hot_words(counts)
    if END not in hot:  # nothing to learn from
        hot, hot_counts = [*hot, END], np.append(hot_counts, 0)
    clustered = clustered_words(counts)
    classes, grid = assigned(written(encoded(texts, clustered)), clustered)
    total = len(grid)
    symbols = Symbols(clustered)
    hot_kinds = classes[symbols.of(hot)].astype(np.int64)
    share = (grid.sum(0) + 1) / (grid.sum() + total)
    follows = np.log10((grid + BACKOFF * share) / (grid.sum(1, keepdims=True) + BACKOFF))
    class_tokens, class_words = class_sizes(counts, clustered, classes)
    model = Model(
        clustered, hot, hot_counts, hot_kinds, classes, follows, class_tokens, class_words, tokens, distinct
    )
    return model, counts


def scored(docs: DataFrame, model: Model, counts: DataFrame) -> DataFrame:
    """``row`` of ``docs`` with n_tokens, n_known, train_tokens, base_score and score.

    A null or empty text is its end alone. Sums may differ in the last digits between runs.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    fields = (
        "n_tokens long, hot_known long, hot_base double, hot_score double, "
        "rare array<struct<word:binary,kind:int,n:long>>"
    )
    parts = per_text(docs, lambda: sent.value.worker(), fields)
    # What the texts gave is stored under a number of its own before it is joined with itself.
    narrow = F.struct(*[F.col("row")[c].alias(c) for c in docs.columns if c != "text"])
    parts = parts.select(narrow.alias("row"), *[c for c in parts.columns if c != "row"])
    parts = written(parts.withColumn("uid", F.monotonically_increasing_id()))
    n = F.coalesce(F.col("count"), F.lit(0)) + ADDED
    base = F.log10(n / (model.tokens + ADDED * (model.distinct + 1)))
    wholes = [float(t + ADDED * (w + 1)) for t, w in zip(model.class_tokens, model.class_words, strict=True)]
    whole = F.element_at(F.array(*map(F.lit, wholes)), F.col("kind") + 1)
    rare = (
        parts.select("uid", F.explode("rare").alias("rare"))
        .select("uid", "rare.*")
        .join(counts.select("word", F.col("n").alias("count")), "word", "left")
        .groupBy("uid")
        .agg(
            F.sum(F.when(F.col("count") > 0, F.col("n")).otherwise(0)).alias("known"),
            F.sum(F.col("n") * base).alias("base"),
            F.sum(F.col("n") * F.log10(n / whole)).alias("part"),
        )
    )

    def plus(a, b):
        return F.col(a) + F.coalesce(F.col(b), F.lit(0))

    return parts.drop("rare").join(rare, "uid", "left").select(
        "row",
        "n_tokens",
        plus("hot_known", "known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        plus("hot_base", "base").alias("base_score"),
        plus("hot_score", "part").alias("score"),
    )


def perplexity(score: Column, tokens: Column) -> Column:
    """Per token, from a text's log10 probability."""
    return F.pow(F.lit(10.0), -score / tokens)


def op7_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every document by the model of the documents that are not held out.

    A null text is empty: its end alone. Rows are scored each for itself, repeated ones alike; a
    null doc_id is neither learned from nor held out. Without documents to learn from all words
    are unseen. ``perplexity`` is per token, the end included.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model, counts = fit(docs, remainder("doc_id", 10) != 0)
    return scored(docs, model, counts).select(
        "row.doc_id",
        F.coalesce(remainder("row.doc_id", 10) == 0, F.lit(False)).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
        perplexity(F.col("score"), F.col("n_tokens")).alias("perplexity"),
    )
