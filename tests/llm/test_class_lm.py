import math
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from hiregrain.llm import class_lm
from hiregrain.llm.class_lm import END, Symbols, exchanged, fit, hot_words, scored, words
from hiregrain.llm.common import remainder, table

SF_DIR = "/root/testdata/sf0.001"


def likelihood(pairs, assigned):
    total = assigned.max() + 1
    member = np.eye(total)[assigned]
    grid, size = member.T @ pairs @ member, pairs.sum(0) @ member
    return class_lm._entropy(grid).sum() - 2 * class_lm._entropy(size).sum()


def test_exchange_raises_the_likelihood_and_finds_classes():
    source = np.random.default_rng(4)
    kinds = np.arange(30) % 3  # a word of kind k is followed by one of kind k + 1
    pairs = np.where((kinds[:, None] + 1) % 3 == kinds, source.integers(20, 40, (30, 30)), 0.0)
    start = np.arange(30) % 4
    found = exchanged(pairs, 30, classes=4)
    assert likelihood(pairs, found) >= likelihood(pairs, start)
    best = exchanged(pairs, 30, classes=3)
    assert all(len(set(best[kinds == k])) == 1 for k in range(3))


@pytest.mark.parametrize("hot", [0, 300, 200_000])
def test_scores_equal_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(class_lm.hot_words, "__defaults__", (hot,))
    docs = table(spark, SF_DIR, "documents").select("doc_id", "text")
    extra = spark.createDataFrame([(10_001, None), (10_002, ""), (10_001, "the THE newword newword")], docs.schema)
    docs = docs.union(extra)
    model, counts = fit(docs, remainder("doc_id", 10) != 0)
    texts = [(row["doc_id"], row["text"]) for row in docs.collect()]
    counted = Counter()
    for doc, text in texts:
        if crc32(str(doc).encode()) % 10:
            counted.update([*words((text or "").encode()), END])
    assert len(hot_words(counts, hot)[0]) <= max(hot, 1) + 1
    whole, distinct = sum(counted.values()), len(counted)
    symbols = Symbols(model.clustered)
    kind = {word: int(model.classes[symbols.of([word])[0]]) for word in counted}
    sums = Counter()
    for word, n in counted.items():
        sums[kind[word]] += n
    members = Counter(kind.values())
    rows = {(row["row"]["doc_id"], row["n_tokens"]): row for row in scored(docs, model, counts).collect()}
    for doc, text in texts:
        own = [*words((text or "").encode()), END]
        row = rows[doc, len(own)]
        base = sum(math.log10((counted[w] + 0.1) / (whole + 0.1 * (distinct + 1))) for w in own)
        before, score = int(model.classes[symbols.end]), 0.0
        for word in own:
            k = int(model.classes[symbols.of([word])[0]])
            score += model.follows[before, k]
            score += math.log10((counted[word] + 0.1) / (sums[k] + 0.1 * (members[k] + 1)))
            before = k
        assert row["n_known"] == sum(counted[w] > 0 for w in own) and row["train_tokens"] == whole
        assert math.isclose(row["base_score"], base, rel_tol=1e-9)
        assert math.isclose(row["score"], score, rel_tol=1e-9)
    # A class follows a class with probabilities that add up to one.
    assert np.allclose((10**model.follows).sum(1), 1)


def test_odd_rows(odd_docs):
    learn = remainder("doc_id", 10) != 0
    model, counts = fit(odd_docs, learn)
    rows = scored(odd_docs, model, counts).collect()
    assert len(rows) == odd_docs.count()
    by_id = {row["row"]["doc_id"]: row for row in rows}
    assert by_id[1]["n_tokens"] == by_id[2]["n_tokens"] == by_id[3]["n_tokens"] == 1
    empty = odd_docs.where(F.lit(False))
    assert scored(empty, model, counts).count() == 0
    nothing = scored(odd_docs, *fit(empty, learn)).collect()
    assert {row["n_known"] for row in nothing} == {0} and {row["train_tokens"] for row in nothing} == {0}
    assert all(math.isfinite(row["score"]) for row in nothing)


def test_words_outside_the_core_get_the_class_of_their_use(spark, monkeypatch):
    monkeypatch.setattr(class_lm, "CLUSTERED", 20)
    monkeypatch.setattr(exchanged, "__defaults__", (2, class_lm.ROUNDS))
    source = np.random.default_rng(3)
    # Two kinds of words take turns; ten of each are frequent, thirty of each are rare. All of one shape.
    named = [[f"{kind}{k:02d}" for k in range(40)] for kind in "ab"]
    weights = np.array([20.0] * 10 + [1.0] * 30) / 230
    rows = [
        (k, " ".join(str(source.choice(named[j % 2], p=weights)) for j in range(100))) for k in range(150)
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model, counts = fit(docs, F.lit(True))
    symbols = Symbols(model.clustered)
    kinds = [{int(model.classes[symbols.of([word.encode()])[0]]) for word in words_} for words_ in named]
    assert [len(kind) for kind in kinds] == [1, 1] and kinds[0] != kinds[1]
    # A word met once, and one never met, have the class of their shape.
    once = docs.union(spark.createDataFrame([(999, "zzz")], docs.schema))
    model, counts = fit(once, F.lit(True))
    symbols = Symbols(model.clustered)
    alike = symbols.end + 1 + class_lm.shape(b"zzz")
    assert symbols.of([b"zzz", END, b"yyy"]).tolist() == [alike, symbols.end, alike]
    score = scored(docs, model, counts).agg(F.sum("score"), F.sum("base_score")).first()
    assert score[0] > score[1]


def test_perplexity(spark):
    frame = spark.createDataFrame([(-6.0, 3), (0.0, 1)], "score double, n long")
    found = frame.select(class_lm.perplexity(F.col("score"), F.col("n")).alias("p")).collect()
    assert [row["p"] for row in found] == [100.0, 1.0]
