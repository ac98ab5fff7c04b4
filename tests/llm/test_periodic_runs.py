"""Runs against the definition, word by word."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hiregrain.llm.common import table
from hiregrain.llm.periodic_runs import (
    RangeSuccessor,
    collapsed,
    op12_periodic_runs,
    periodic_runs,
    planted,
    runs_in,
)


def runs_by_definition(words):
    found = {}
    for period in range(1, len(words) // 4 + 1):
        start = 0
        while start + period < len(words):
            stop = start
            while stop + period < len(words) and words[stop] == words[stop + period]:
                stop += 1
            length = stop - start + period
            if stop > start and length >= max(6, 4 * period):
                found.setdefault((start, length), period)
            start = stop + 1
    return sorted(((s, n, p) for (s, n), p in found.items()), key=lambda run: (run[0], run[2]))


def made_up(rnd):
    """Words with a root repeated, roots in roots, or few kinds of words."""
    words = []
    while len(words) < rnd.randint(0, 150):
        root = [rnd.choice("abcd") for _ in range(rnd.randint(1, 9))]
        root = (root * rnd.randint(1, 5))[: rnd.randint(1, 20)] + [rnd.choice("abx")] * rnd.randint(0, 1)
        words += (root * 9)[: rnd.randint(1, 80)]
    return [word.encode() for word in words]


def test_runs_equal_their_definition():
    rnd = random.Random(3)
    n = 0
    for _ in range(300):
        texts = [made_up(rnd) for _ in range(rnd.randint(1, 4))]
        for words, found in zip(texts, runs_in(texts), strict=True):
            assert found == runs_by_definition(words)
            n += len(found)
    assert n > 500


@given(st.lists(st.lists(st.sampled_from([b"a", b"b"]), max_size=40), max_size=4))
@settings(max_examples=200, deadline=None)
def test_runs_of_two_words(texts):
    assert runs_in(texts) == [runs_by_definition(words) for words in texts]


@pytest.mark.parametrize("n", [1, 2, 63, 64, 65, 1000])
def test_range_successor(n):
    rng = np.random.default_rng(n)
    values = rng.permutation(n)
    low = rng.integers(0, n, 50)
    high = low + rng.integers(0, n - low + 1)
    bound = rng.integers(0, n + 5, 50)
    tree = RangeSuccessor(values)
    below = tree.below(low, high, bound)
    assert below.tolist() == [(values[a:b] < c).sum() for a, b, c in zip(low, high, bound, strict=True)]
    some = below < high - low
    found = tree.select(low[some], high[some], below[some])
    expected = [
        values[a:b][values[a:b] >= c].min()
        for a, b, c in zip(low[some], high[some], bound[some], strict=True)
    ]
    assert found.tolist() == expected


def test_long_text_of_one_word():
    words = [b"w"] * 50_000
    assert runs_in([words, words[:5], []]) == [[(0, 50_000, 1)], [], []]


def test_repeats_go():
    words = b"x a b a b a b a b y".split()
    assert collapsed(words, [(1, 8, 2)]) == b"x a b y"


def test_query_equals_the_definition(spark):
    folder = "/root/testdata/sf0.001"
    names = ["start", "length", "period", "exponent_milli"]
    found = {row["doc_id"]: row for row in op12_periodic_runs(spark, folder).collect()}
    docs = table(spark, folder, "documents").collect()
    assert len(found) == len(docs)
    some = 0
    for doc in docs:
        words, h = (doc["text"] or "").encode().split(), zlib.crc32(str(doc["doc_id"]).encode())
        if h % 10 == 0 and words:
            a = h // 10 % len(words)
            p = 1 + (len(words) - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(len(words))]
        assert words == planted((doc["text"] or "").encode().split(), doc["doc_id"])
        if len(words) > 3000:
            continue
        runs = runs_by_definition(words)
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        row = found[doc["doc_id"]]
        lines = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
        kept = b" ".join(word for i, word in enumerate(words) if i not in gone)
        assert row["runs_sha256"] == hashlib.sha256(lines.encode()).hexdigest()
        assert row["collapsed_sha256"] == hashlib.sha256(kept).hexdigest()
        best = max(runs, key=lambda run: (run[1], -run[0], -run[2]), default=None)
        shown = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        assert (row["n_runs"], *(row[name] for name in names)) == (len(runs), *shown)
        some += bool(runs)
    assert some > 5


def test_odd_rows(odd_docs):
    found = periodic_runs(odd_docs)
    assert found.count() == odd_docs.count()
    assert found.select("row.*").columns == odd_docs.columns
    by_id = {row["doc_id"]: row for row in found.select("row.doc_id", "n_words", "runs").collect()}
    assert by_id[1]["n_words"] == by_id[2]["n_words"] == by_id[3]["n_words"] == 0
    assert [tuple(run) for run in by_id[6]["runs"]] == [(1, 27_000, 3)]
    altered = periodic_runs(odd_docs, altered=True)
    assert altered.count() == odd_docs.count()
    assert periodic_runs(odd_docs.where(F.lit(False))).count() == 0
