"""Spot signatures against a plain version; neighbours over many blocks."""

import hashlib

import pytest
import regex
from pyspark.sql import functions as F

from hiregrain.llm.spot_signatures import (
    ANCHORS,
    Spots,
    block_of,
    block_tops,
    edited_text,
    fingerprint,
    length_class,
    likeness,
    with_next,
    with_signatures,
)


def plain(text, spots=Spots()):
    words = ["", *regex.findall(r"[\p{L}\p{N}\p{M}]+", (text or "").lower())]
    anchors = {"", *spots.anchors}
    found = set()
    for at, word in enumerate(words):
        after = [w for w in words[at + 1 :] if w not in anchors]
        chain = after[spots.distance - 1 :: spots.distance][: spots.chain]
        if word in anchors and chain:
            found.add(hashlib.md5(" ".join([word, *chain]).encode()).hexdigest()[:8])
    return sorted(found)


TEXTS = [
    None,
    "",
    "?!",
    "the of and",
    "word",
    "The cat sat on the mat, and the dog of the house was in the yard.",
    "der Hund ist in dem Haus für die Katze l'été à la mer",
    "content words only here without any spot",
    "the of and " * 2000 + "end",
]


@pytest.mark.parametrize("spots", [Spots(), Spots(chain=3), Spots(distance=2), Spots(("cat", "dog"), 1, 1)])
def test_signatures(spark, spots):
    rows = spark.createDataFrame([(k, text) for k, text in enumerate(TEXTS)], "k int, text string")
    found = with_signatures(rows, spots, own="text").orderBy("k").collect()
    assert [row["own"] for row in found] == [plain(text, spots) for text in TEXTS]
    assert with_signatures(rows, own="text").columns == ["k", "text", "own"]


@pytest.mark.parametrize("rows,most", [(1, 1000), (3, 1000), (7, 4), (1000, 1)])
def test_next_document_over_blocks(spark, rows, most):
    ids = [*range(-30, 300, 7), 5_000_000_000]
    docs = spark.createDataFrame([(k, f"text {k}") for k in ids], "doc_id long, text string")
    found = {row["doc_id"]: row["next_text"] for row in with_next(docs, rows=rows, most=most).collect()}
    down = sorted(ids, reverse=True)
    assert found == {k: f"text {after}" for k, after in zip(down, down[1:] + down[:1], strict=True)}


def test_many_blocks(spark):
    tops = list(range(9, 100_000, 10))
    values = [0, 9, 10, 2559, 2560, 2569, 2570, 99_999]
    frame = spark.createDataFrame([(v,) for v in values], "v long")
    found = [row[0] for row in frame.select(block_of(F.col("v"), tops)).collect()]
    assert found == [sum(top < v for top in tops) for v in values]
    assert block_tops(spark.range(0).toDF("x")) == []


def test_odd_rows(spark, odd_docs):
    found = with_next(odd_docs, rows=2)
    assert found.count() == odd_docs.count()
    rows = [row for row in found.collect() if row["doc_id"] is None]
    # The null id comes last; the first document follows it.
    assert rows[0]["next_text"].startswith("Word0 ")
    assert with_next(odd_docs.where(F.lit(False))).count() == 0
    alone = odd_docs.where("doc_id = 1")
    assert with_next(alone).select("doc_id", "next_text").collect() == [(1, "")]
    twice = with_next(odd_docs.where("doc_id = 4")).collect()
    assert len(twice) == 2 and all(row["next_text"] == row["text"] for row in twice)


def test_edit(spark):
    rows = [("abcdefgh", "XYZ"), ("ab", "XYZ"), ("", "X"), ("𝄞éabcd", "ÄB"), ("abcdef", "")]
    found = spark.createDataFrame(rows, "a string, b string").select(edited_text("a", "b")).collect()
    assert [row[0] for row in found] == ["abcdefXY", "ab", "", "𝄞éabÄB", "abcd"]


def test_likeness_and_classes(spark):
    sets = [[], ["a"], ["a", "b"], list("abcd"), list("abcde"), list("bcdef")]
    pairs = [(a, b) for a in sets for b in sets]
    frame = spark.createDataFrame(pairs, "a array<string>, b array<string>")
    found = frame.select("a", "b", likeness("a", "b").alias("j"), likeness("a", "b", 0.6).alias("p")).collect()
    for a, b, j, p in found:
        exact = len({*a} & {*b}) / len({*a} | {*b}) if a or b else 1.0
        assert j == exact and p == (exact if exact >= 0.6 else 0.0)
    sizes = spark.range(1, 2000).select("id", length_class(F.col("id"), 0.8).alias("c")).collect()
    of = {row["id"]: row["c"] for row in sizes}
    assert all(of[n * 10 // 8] - of[n] <= 1 for n in range(1, 1500))


def test_equal_texts_and_anchors(spark):
    rows = spark.createDataFrame([(1, TEXTS[5]), (2, TEXTS[5])], "k int, text string")
    prints = with_signatures(rows, own="text").select(fingerprint("own").alias("f")).distinct()
    assert prints.count() == 1
    assert len(ANCHORS) == len(set(ANCHORS))
