from itertools import product

import numpy as np
from pyspark.sql import functions as F

from hiregrain.llm.common import table
from hiregrain.llm.toxicity import (
    THRESHOLD,
    Chain,
    drop_toxic,
    fit,
    lowered,
    may_learn,
    op6_toxicity,
    scored,
    tokens,
)

SF_DIR = "/root/testdata/sf0.1"


def test_marginals_equal_enumeration():
    source = np.random.default_rng(3)
    chain = Chain(links=source.normal(size=(2, 2)), start=0.4)
    lengths = np.array([3, 0, 1, 6, 2])
    weights = source.normal(size=int(lengths.sum()))
    found, at = chain.marginals(weights, lengths), 0
    for size in lengths:
        own, total, ones = weights[at : at + size], 0.0, np.zeros(size)
        for states in product((0, 1), repeat=int(size)):
            value = chain.start * states[0] if size else 0.0
            value += sum(own[k] * s for k, s in enumerate(states))
            value += sum(chain.links[a, b] for a, b in zip(states, states[1:]))
            total += np.exp(value)
            ones += np.exp(value) * np.array(states)
        assert np.allclose(found[at : at + size], ones / total if size else [])
        at += size


def test_held_out_recall_in_each_language(spark):
    labels = table(spark, SF_DIR, "labels").where("toxic is not null").select("doc_id", "toxic")
    langs = table(spark, SF_DIR, "documents").select("doc_id", "lang")
    rows = op6_toxicity(spark, SF_DIR).join(labels, "doc_id").join(langs, "doc_id").where("held_out").collect()
    assert all(row["predicted"] == (row["score"] >= THRESHOLD) for row in rows)
    for lang in {row["lang"] for row in rows}:
        clean = [row["predicted"] for row in rows if row["lang"] == lang and row["toxic"] == 0]
        toxic = [row["predicted"] for row in rows if row["lang"] == lang and row["toxic"] == 1]
        assert sum(clean) <= 0.02 * len(clean) and sum(toxic) >= 0.9 * len(toxic)


def test_lower_case_keeps_every_byte_in_its_place():
    # Upper case with a shorter and a longer lower case stays; so do bytes that are no UTF-8.
    for text in ("ÉCOLE Straße", "É\u212a\u0130É", "\u212a"):
        found = lowered(text.encode())
        assert len(found) == len(text.encode()) and "É" not in found.decode()
    assert lowered(b"\xff\xc3\x89A") == b"\xff\xc3\xa9a"
    assert tokens("RÉEUX réeux".encode()) == ["réeux".encode()] * 2


def test_contradicting_labels_and_missing_texts_teach_nothing(spark):
    docs = spark.createDataFrame([(k, f"blorg{k % 3} one {k}") for k in range(60)], "doc_id long, text string")
    labels = [(k, k % 2) for k in range(60)]
    plain = fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), may_learn(), 12)
    # Labels of documents that are not there take no place, and a repeated label counts once.
    more = labels + labels[:9] + [(k, k % 2) for k in range(100, 300)] + [(k, None) for k in range(9)]
    same = fit(docs, spark.createDataFrame(more, "doc_id long, toxic int"), may_learn(), 12)
    assert np.array_equal(plain.chain.theta, same.chain.theta) and np.array_equal(plain.beta, same.beta)
    both = labels + [(k, 1 - k % 2) for k in range(60)]
    none = fit(docs, spark.createDataFrame(both, "doc_id long, toxic int"), may_learn(), 12)
    assert all(row["score"] < 0.01 for row in scored(docs, none).collect())


def test_spans_mark_the_offending_words(spark):
    filler = ["one", "two", "three", "four", "five", "six", "seven"]
    rows, labels = [], []
    for k in range(240):
        words = [filler[(k * j) % 7] for j in range(1, 30)]
        if k % 4 == 0:
            for at in (3 + k % 5, 12 + k % 9, 25):
                words[at] = "blorgy" if k % 8 else "blorgish"
        rows.append((k, "É " + " ".join(words)))
        labels.append((k, int(k % 4 == 0)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"), may_learn())
    for row in scored(docs, model).collect():
        text, spans = row["row"]["text"], row["spans"]
        assert (row["score"] >= THRESHOLD) == (row["row"]["doc_id"] % 4 == 0)
        found = [text[span["start"] : span["stop"]] for span in spans]
        assert found == [word for word in text.split() if word.startswith("blorg")]


def test_odd_rows(odd_docs, odd_labels):
    model = fit(odd_docs, odd_labels, may_learn())
    rows = scored(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= row["score"] <= 1 for row in rows)
    empty = odd_docs.where(F.lit(False))
    assert scored(empty, model).count() == 0
    nothing = fit(odd_docs, odd_labels.where(F.lit(False)), may_learn())
    assert all(row["score"] < 0.01 and not row["spans"] for row in scored(odd_docs, nothing).collect())
    kept = drop_toxic(odd_docs, odd_labels.where(F.lit(False)))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()
