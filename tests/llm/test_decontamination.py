import random

import numpy as np
from pyspark.sql import functions as F

from hiregrain.llm.decontamination import (
    WINDOW,
    drop_contaminated,
    searched,
    without_spans,
    words,
)
from hiregrain.llm.fm_index import FMIndex


def test_index_finds_every_occurrence():
    source = np.random.default_rng(2)
    for _ in range(25):
        symbols = source.integers(0, 4, source.integers(1, 300))
        found = [source.integers(1, 4, source.integers(1, 6)) for _ in range(15)]
        phrases, lengths = np.zeros((15, 6), np.int64), np.array([len(p) for p in found])
        for row, phrase in enumerate(found):
            phrases[row, : len(phrase)] = phrase
        index = FMIndex(symbols, 3)
        low, high = index.search(phrases, lengths)
        for row, phrase in enumerate(found):
            size = len(phrase)
            want = [k for k in range(len(symbols) - size + 1) if (symbols[k : k + size] == phrase).all()]
            assert sorted(index.locate(np.arange(low[row], high[row])).tolist()) == want


def brute(text, items):
    own, hit, found = words((text or "").encode()), set(), set()
    for item, other in items:
        theirs = words((other or "").encode())
        size = min(WINDOW, len(theirs))
        windows = {tuple(theirs[k : k + size]) for k in range(len(theirs) - size + 1)} if size else set()
        for k in range(len(own) - size + 1):
            if tuple(own[k : k + size]) in windows:
                hit.update(range(k, k + size))
                found.add(str(item))
    return len(own), len(hit), sorted(found)


def test_equals_brute_force(spark):
    source = random.Random(8)
    vocabulary = [f"w{k}" for k in range(40)]
    long = [" ".join(source.choices(vocabulary, k=source.randrange(1, 40))) for _ in range(30)]
    items = [(k, text.upper()) for k, text in enumerate(long[:12])] + [(50, None), (51, "."), (3, long[3])]
    texts = [
        ", ".join(source.choice([*long, source.choice(vocabulary)]) for _ in range(8)) for _ in range(60)
    ]
    docs = spark.createDataFrame(list(enumerate([*texts, None, ""])), "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for size in (1 << 20, 600):  # one pass, several passes
        rows = searched(docs, benchmark, size).collect()
        assert len(rows) == 62
        for row in rows:
            n, hit, found = brute(row["row"]["text"], items)
            assert (row["n_words"], row["n_hit"], sorted(row["items"])) == (n, hit, found)
            assert row["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_removal_spans_are_characters(spark):
    passage = " ".join(f"q{k}" for k in range(15))
    docs = spark.createDataFrame([(1, f"Ünder 𝄞 é {passage} ende."), (2, "rein")], "doc_id long, text string")
    benchmark = spark.createDataFrame([(9, passage)], "item_id long, text string")
    rows = searched(docs, benchmark).select("row.doc_id", without_spans(F.col("row.text"), F.col("spans")))
    assert dict(map(tuple, rows.collect())) == {1: "Ünder 𝄞 é  ende.", 2: "rein"}


def test_odd_rows(spark, odd_docs):
    passage = " ".join(f"word{k}" for k in range(20, 60))
    benchmark = spark.createDataFrame([(5, passage), (None, "temp")], "item_id long, text string")
    rows = searched(odd_docs, benchmark).select("row.doc_id", "n_hit", "contaminated").collect()
    assert len(rows) == odd_docs.count()
    assert {row["doc_id"] for row in rows if row["contaminated"]} == {8, 9}
    kept = drop_contaminated(odd_docs, benchmark)
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count() - 2
    nothing = benchmark.where(F.lit(False))
    assert drop_contaminated(odd_docs, nothing).count() == odd_docs.count()
    assert drop_contaminated(odd_docs.where(F.lit(False)), benchmark).count() == 0
