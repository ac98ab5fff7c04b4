"""Toxicity: a linear-chain conditional random field tags toxic tokens.

Fitting: documents carry one label each, so tokens are labelled first: words and word beginnings
that occur in toxic documents only, beside many different words, mark the toxic tokens of those
documents; all tokens of clean documents are clean. A two-state chain (clean, toxic) with features
of the word's form is trained on them by its gradient. Scoring: forward-backward marginals of
every token of a whole text; a logistic function of their sum, maximum and share is the score. It is
fitted on marginals that each labelled document gets from a chain trained without its third of the
documents; the chain that scores is trained on all of them.
"""

from __future__ import annotations

import math
import re
from array import array
from collections import defaultdict
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.llm.common import per_text, remainder, table

#: The bound of the fit: so many labelled documents of each label, of at most so many bytes.
FIT_DOCUMENTS = 1500
FIT_BYTES = 50_000
#: Scores from here on count as toxic.
THRESHOLD = 0.7
#: Tokens whose marginal reaches this are reported as offending.
OFFENDING = 0.5

TOKEN = re.compile(rb"[0-9a-z\x80-\xff]+")
BITS = 18
#: Evidence (a log likelihood ratio) and different left neighbours that make a form toxic.
MIN_EVIDENCE = 7.0
MIN_NEIGHBOURS = 3
#: A form that marks occurs in this many times more toxic documents than clean ones.
MIN_RATIO = 8
#: The parts of the labelled documents, each scored by a chain that is trained on the others.
FOLDS = 3
STEPS = 25
RATE = 0.5
RIDGE = 1e-2
#: Lengths in bytes of the beginnings of a word that are features.
BEGINNINGS = range(3, 11)
#: Words whose weight a task keeps: the ones it meets first.
CACHE = 150_000
FIELDS = "score double, toxic_tokens double, spans array<struct<start:int,stop:int,marginal:double>>"


def forms(word: bytes) -> list[bytes]:
    """The word and its beginnings of 3 to 10 bytes, its end, as distinct features."""
    return [
        b"w" + word,
        b"s" + word[-3:],
        *[b"p" + word[:k] for k in BEGINNINGS if len(word) > k],
    ]


def slots(word: bytes) -> list[int]:
    return [crc32(form) & ((1 << BITS) - 1) for form in forms(word)]


def lowered(text: bytes) -> bytes:
    """Lower case with every byte in its place: a character whose lower case is longer or shorter
    stays as it is."""
    if text.isascii():
        return text.lower()
    whole = text.decode("utf-8", "surrogateescape")
    low = whole.lower().encode("utf-8", "surrogateescape")
    if len(low) == len(text):
        return low

    def size(part: str) -> int:
        return len(part.encode("utf-8", "surrogateescape"))

    same = {ord(c): c.lower() for c in set(whole) if size(c.lower()) == size(c)}
    return whole.translate(same).encode("utf-8", "surrogateescape")


def tokens(text: bytes | None) -> list[bytes]:
    return TOKEN.findall(lowered(text)) if text else []


class Layout:
    """Token positions of several sequences, longest first, with one step of all side by side."""

    def __init__(self, lengths: np.ndarray):
        self.lengths = lengths
        order = np.argsort(-lengths, kind="stable")
        by_length = lengths[order]
        steps = int(by_length[0]) if len(by_length) else 0
        #: How many sequences have a token at a step.
        self.live = np.searchsorted(-by_length, -np.arange(steps), side="left")
        self.starts = np.concatenate([[0], np.cumsum(self.live)])
        rank = np.empty(len(lengths), np.int64)
        rank[order] = np.arange(len(lengths))
        first = np.cumsum(lengths) - lengths
        step = np.arange(int(lengths.sum())) - np.repeat(first, lengths)
        #: Where each token of the concatenated sequences lies in the layout.
        self.place = self.starts[step] + np.repeat(rank, lengths)


@dataclass
class Chain:
    """Weights: emission of state 1 by feature; transitions and start as log weights."""

    theta: np.ndarray = field(default_factory=lambda: np.zeros(1 << BITS))
    links: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    start: float = 0.0

    def messages(self, weights: np.ndarray, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Odds of state 1 going forward and backward, and exp of the emissions, as laid out."""
        emit = np.empty(len(weights))
        emit[layout.place] = np.exp(np.clip(weights, -30, 30))
        (a00, a01), (a10, a11) = np.exp(self.links)
        ahead, back = np.empty_like(emit), np.ones_like(emit)
        starts, live = layout.starts, layout.live
        if len(live):
            odds = emit[: live[0]] * math.exp(self.start)
            ahead[: live[0]] = odds
            for t in range(1, len(live)):
                odds = odds[: live[t]]
                odds = emit[starts[t] : starts[t + 1]] * (a01 + a11 * odds) / (a00 + a10 * odds)
                ahead[starts[t] : starts[t + 1]] = odds
            for t in range(len(live) - 1, 0, -1):
                after = emit[starts[t] : starts[t + 1]] * back[starts[t] : starts[t + 1]]
                back[starts[t - 1] : starts[t - 1] + live[t]] = (a10 + a11 * after) / (a00 + a01 * after)
        return ahead, back, emit

    def marginals(self, weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Probability of state 1 for each token of the concatenated sequences."""
        layout = Layout(lengths)
        ahead, back, _ = self.messages(weights, layout)
        odds = (ahead * back)[layout.place]
        return odds / (1 + odds)


@dataclass
class Sample:
    """Labelled documents as numbers of their words."""

    words: list[bytes]
    flat: np.ndarray
    lengths: np.ndarray
    labels: np.ndarray

    @classmethod
    def of(cls, texts: list[bytes], labels: list[int]) -> Sample:
        index: dict[bytes, int] = {}
        number = index.setdefault
        parts = [np.array([number(w, len(index)) for w in tokens(text)], np.int32) for text in texts]
        lengths = np.array([len(part) for part in parts], np.int64)
        flat = np.concatenate([*parts, np.zeros(0, np.int32)])
        return cls(list(index), flat, lengths, np.array(labels, np.int64))

    def part(self, use: np.ndarray) -> Sample:
        return Sample(
            self.words, self.flat[np.repeat(use, self.lengths)], self.lengths[use], self.labels[use]
        )


def toxic_words(sample: Sample) -> np.ndarray:
    """Which words have a form that marks toxic documents: the word or one of its beginnings
    occurs in them, beside several different words, and in hardly any clean one."""
    doc = np.repeat(np.arange(len(sample.lengths)), sample.lengths)
    before = np.concatenate([[-1], sample.flat[:-1]]).astype(np.int64)
    before[np.cumsum(sample.lengths)[:-1][sample.lengths[1:] > 0]] = -1
    toxic = sample.labels[doc] == 1
    share = max(sample.labels.sum(), 1) / max(len(sample.labels), 1)
    found = np.zeros(len(sample.words), bool)
    for size in (0, *BEGINNINGS):
        index: dict[bytes, int] = {}
        number = index.setdefault
        # Words of up to this length have no such beginning: they share number 0.
        number(b"", 0)
        form = np.array(
            [number(w if not size else w[:size] if len(w) > size else b"", len(index)) for w in sample.words]
        )
        own = form[sample.flat].astype(np.int64)
        pairs = np.unique(own * len(doc) + doc) if len(doc) else own
        of_form, of_doc = pairs // max(len(doc), 1), pairs % max(len(doc), 1)
        seen = np.bincount(of_form, minlength=len(index))
        hits = np.bincount(of_form[sample.labels[of_doc] == 1], minlength=len(index))
        span = len(sample.words) + 1
        beside = np.unique(own[toxic] * span + before[toxic] + 1) // span
        beside = np.bincount(beside, minlength=len(index))
        clean = seen - hits
        rate = np.clip(hits / np.maximum(seen, 1), 1e-9, 1 - 1e-9)
        evidence = hits * np.log(rate / share) + clean * np.log((1 - rate) / max(1 - share, 1e-9))
        marks = (rate > share) & (evidence >= MIN_EVIDENCE)
        marks &= (beside >= MIN_NEIGHBOURS) & (clean * MIN_RATIO <= hits)
        marks[0] = False
        found |= marks[form]
    return found


def trained(sample: Sample) -> tuple[Chain, np.ndarray]:
    """The chain whose likelihood of the labelled tokens is climbed by adaptive gradients, and
    the weight of each word."""
    chain, flat, lengths = Chain(), sample.flat, sample.lengths
    slot_list, sizes = array("i"), array("i")
    for word in sample.words:
        own = slots(word)
        slot_list.extend(own)
        sizes.append(len(own))
    slot = np.frombuffer(slot_list, np.int32) if len(slot_list) else np.zeros(0, np.int32)
    n_words = len(sample.words)
    owner = np.repeat(np.arange(n_words, dtype=np.int32), np.frombuffer(sizes, np.int32)) if n_words else slot
    if not len(flat):
        return chain, np.zeros(n_words)
    truth = toxic_words(sample)[flat] & np.repeat(sample.labels.astype(bool), lengths)
    layout = Layout(lengths)
    begins = (np.cumsum(lengths) - lengths)[lengths > 0]
    inner = np.ones(len(flat), bool)
    inner[begins] = False
    inner = inner[1:]
    pairs = np.bincount((2 * truth[:-1].astype(np.int8) + truth[1:])[inner], minlength=4).reshape(2, 2)
    squares, link_squares, start_square = np.full(1 << BITS, 1e-8), np.full((2, 2), 1e-8), 1e-8
    prior = math.log((truth.sum() + 1) / (len(truth) + 2))
    chain.start, chain.links = prior / 2, np.array([[0.0, prior / 2], [0.0, 0.0]])
    for _ in range(STEPS):
        weights = np.bincount(owner, chain.theta[slot], n_words)[flat]
        ahead, back, emit = chain.messages(weights, layout)
        odds = (ahead * back)[layout.place]
        marginal = odds / (1 + odds)
        gap = np.bincount(flat, truth - marginal, n_words)
        gradient = np.bincount(slot, gap[owner], 1 << BITS) - RIDGE * chain.theta
        # Expected transitions, from the messages on both sides of each.
        left, right = ahead[layout.place][:-1][inner], (emit * back)[layout.place][1:][inner]
        (a00, a01), (a10, a11) = np.exp(chain.links)
        whole = a00 + a01 * right + (a10 + a11 * right) * left
        expected = np.array(
            [
                [(a00 / whole).sum(), (a01 * right / whole).sum()],
                [(a10 * left / whole).sum(), (a11 * left * right / whole).sum()],
            ]
        )
        link_gradient = pairs - expected - RIDGE * chain.links
        start_gradient = (truth[begins] - marginal[begins]).sum()
        squares += gradient**2
        link_squares += link_gradient**2
        start_square += start_gradient**2
        chain.theta += RATE * gradient / np.sqrt(squares)
        chain.links = chain.links + RATE * link_gradient / np.sqrt(link_squares)
        chain.start += RATE * start_gradient / math.sqrt(start_square)
    return chain, np.bincount(owner, chain.theta[slot], n_words)


def document_features(marginal: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Of each document: a constant, log of the toxic tokens, the surest one, their share."""
    ends = np.cumsum(lengths)
    total = np.concatenate([[0.0], np.cumsum(marginal)])
    mass = np.maximum(total[ends] - total[ends - lengths], 0.0)
    most = np.zeros(len(lengths))
    full = lengths > 0
    if full.any():
        most[full] = np.maximum.reduceat(marginal, (ends - lengths)[full])
    share = mass / np.maximum(lengths, 1)
    return np.stack([np.ones(len(lengths)), np.log1p(mass), most, np.log1p(1000 * share)], 1)


def logistic(features: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Weights by Newton steps with a small ridge."""
    beta = np.zeros(features.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(features @ beta, -30, 30)))
        slope = features.T @ (labels - p) - 0.1 * beta
        bend = (features * (p * (1 - p))[:, None]).T @ features + 0.1 * np.eye(len(beta))
        beta = beta + np.clip(np.linalg.solve(bend, slope), -2, 2)
    return beta


@dataclass
class Model:
    chain: Chain
    beta: np.ndarray

    def numbers(self) -> dict:
        chain = self.chain
        links = chain.links.ravel().tolist()
        theta = chain.theta.astype(np.float64).tobytes()
        return {"theta": theta, "links": links, "start": float(chain.start), "beta": self.beta.tolist()}

    @classmethod
    def of(cls, numbers: dict) -> Model:
        theta, links = np.frombuffer(numbers["theta"]), np.array(numbers["links"]).reshape(2, 2)
        return cls(Chain(theta, links, numbers["start"]), np.array(numbers["beta"]))

    @classmethod
    def unknowing(cls) -> Model:
        """No token is toxic and no text."""
        chain = Chain(links=np.array([[0.0, -30.0], [0.0, -30.0]]), start=-30.0)
        return cls(chain, np.array([-30.0, 0, 0, 0]))

    def worker(self):
        """Scores blocks of texts; keeps the weights of words it has met."""
        theta = self.chain.theta.tolist()
        known: dict[bytes, float] = {}

        def weight(word: bytes) -> float:
            found = known.get(word)
            if found is None:
                found = sum(theta[slot] for slot in slots(word))
                if len(known) < CACHE:
                    known[word] = found
            return found

        def work(texts):
            words = [tokens(text) for text in texts]
            lengths = np.array([len(x) for x in words], np.int64)
            flat = np.array([weight(word) for x in words for word in x], float)
            marginal = self.chain.marginals(flat, lengths)
            features = document_features(marginal, lengths)
            score = 1 / (1 + np.exp(-np.clip(features @ self.beta, -30, 30)))
            spans = self.spans(texts, marginal, lengths)
            mass = np.expm1(features[:, 1])
            return [pa.array(score), pa.array(mass), spans]

        return work

    @staticmethod
    def spans(texts, marginal: np.ndarray, lengths: np.ndarray) -> pa.Array:
        """Character offsets of the offending tokens, neighbours joined."""
        first = np.cumsum(lengths) - lengths
        offending = defaultdict(list)
        hits = np.flatnonzero(marginal >= OFFENDING)
        for hit, doc in zip(hits, np.searchsorted(np.cumsum(lengths), hits, side="right"), strict=True):
            offending[int(doc)].append(int(hit - first[doc]))
        out = []
        for doc, text in enumerate(texts):
            found: list[dict] = []
            if doc in offending:
                places = [m.span() for m in TOKEN.finditer(lowered(text))]
                before = -2
                for at in offending[doc]:
                    start, stop = (len(text[:x].decode("utf-8", "replace")) for x in places[at])
                    p = float(marginal[first[doc] + at])
                    if at == before + 1:
                        found[-1] = found[-1] | {"stop": stop, "marginal": max(found[-1]["marginal"], p)}
                    else:
                        found.append({"start": start, "stop": stop, "marginal": p})
                    before = at
            out.append(found)
        kind = pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("marginal", pa.float64())])
        return pa.array(out, pa.list_(kind))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, most: int = FIT_DOCUMENTS) -> Model:
    """The model of a sample of labelled documents: those with the smallest hash of their id.

    ``docs`` has doc_id and text, ``labels`` doc_id and toxic; ``learn`` tells the ids that may
    be learned from. At most ``most`` documents of each label are learned from, each of
    FIT_BYTES at most; only those with such a text in ``docs`` take a place. A document whose
    labels contradict each other teaches nothing. Without a toxic or a clean one every score is 0.
    """
    rank = F.xxhash64("doc_id")
    short = docs.where(F.octet_length("text") <= FIT_BYTES).select("doc_id", "text")
    able = labels.where(F.col("toxic").isin(0, 1) & learn).groupBy("doc_id")
    able = able.agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_most"))
    able = able.where("toxic = _most").drop("_most")
    able = able.join(short.select("doc_id"), "doc_id", "left_semi")
    chosen = None
    for label in (0, 1):
        own = able.where(F.col("toxic") == label).orderBy(rank).limit(most)
        chosen = own if chosen is None else chosen.union(own)
    rows = short.join(F.broadcast(chosen), "doc_id").distinct().orderBy(rank, "text").limit(2 * most)

    def run(batches):
        sample = [row for batch in batches for row in batch.to_pylist()]
        yield pa.RecordBatch.from_pylist([learned(sample).numbers()])

    # One task trains, on an executor: the sample is bounded, and so is the model (2 MB).
    numbers = "theta binary, links array<double>, start double, beta array<double>"
    found = rows.repartition(1).mapInArrow(run, numbers).first()
    return Model.of(found.asDict()) if found else Model.unknowing()


def learned(rows: list[dict]) -> Model:
    """The model of labelled documents (doc_id, text, toxic). With so few of a label that a fold or
    the rest of it has none, the score is fitted on what the chain was trained on."""
    rows = sorted(rows, key=lambda row: (row["doc_id"], row["text"]))
    sample = Sample.of([row["text"].encode() for row in rows], [row["toxic"] for row in rows])
    if len(set(sample.labels.tolist())) < 2:
        return Model.unknowing()
    fold = np.array([crc32(b"fit %d" % row["doc_id"]) % FOLDS for row in rows])
    chain, weights = trained(sample)
    parts = [fold == k for k in range(FOLDS)]
    if all(len(set(sample.labels[use])) == 2 for use in parts):
        features = np.zeros((len(rows), 4))
        for use in parts:
            own = sample.part(use)
            other, held = trained(sample.part(~use))
            features[use] = document_features(other.marginals(held[own.flat], own.lengths), own.lengths)
    else:
        features = document_features(chain.marginals(weights[sample.flat], sample.lengths), sample.lengths)
    return Model(chain, logistic(features, sample.labels))


def may_learn() -> Column:
    return remainder("doc_id", 3) != 1


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``row`` and FIELDS for every row of ``docs``; a null or empty text has no token."""
    context = docs.sparkSession.sparkContext
    sent = context.broadcast(model)  # 2 MB, whatever the input
    return per_text(docs, lambda: sent.value.worker(), FIELDS)


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that score below ``threshold``, with their own columns, whatever their
    names. Null and empty texts are scored like any other; without labels every row stays."""
    rows = scored(docs, fit(docs, labels, may_learn()))
    return rows.where(F.col("score") < threshold).select("row.*")


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, by a chain fitted on labelled ones that are not held out.

    A null or empty text has no token and the score of a text without marks; a null doc_id is
    neither held out nor learned from; null labels teach nothing, and without labels no token is
    marked; repeated rows are scored each and alike.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scored(docs, fit(docs, table(spark, sf_dir, "labels"), may_learn()))
    return rows.select(
        "row.doc_id",
        F.coalesce(remainder("row.doc_id", 3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "toxic_tokens",
        "spans",
    )
