import numpy as np
from pyspark.sql import functions as F

from hiregrain.llm.common import remainder, table
from hiregrain.llm.language_id import (
    FAMILIES,
    Model,
    family_of,
    fit,
    identified,
    machine,
    op1_language_id,
    trigrams,
)

SF_DIR = "/root/testdata/sf0.01"


def test_trigrams_stay_within_their_text():
    texts = [b"abcd", None, b"", b"x", b"ABCD"]
    hashes, sizes = trigrams(texts)
    assert sizes.tolist() == [4, 0, 0, 1, 4] and len(hashes) == 9
    assert hashes[:4].tolist() == hashes[5:].tolist() == trigrams([b"abcd"])[0].tolist()


def test_machine_separates():
    source = np.random.default_rng(0)
    rows = source.normal(size=(200, 6))
    signs = np.where(rows @ np.array([1.0, -2, 0, 0, 1, 0]) + 0.3 > 0, 1.0, -1.0)
    weights, offset = machine(rows, signs)
    assert (np.sign(rows @ weights + offset) == signs).mean() > 0.98


def test_families():
    assert family_of("en-GB") == family_of("de") == "germanic" and family_of("xx") == "xx"
    assert len({code for codes in FAMILIES.values() for code in codes}) == sum(map(len, FAMILIES.values()))


def test_held_out_accuracy(spark):
    docs = table(spark, SF_DIR, "documents").select("doc_id", "lang")
    rows = op1_language_id(spark, SF_DIR).join(docs, "doc_id").collect()
    held = [row for row in rows if row["held_out"]]
    assert len(rows) == docs.count() and len(held) > 100
    assert sum(row["lang"] == row["lang_pred"] for row in held) >= 0.98 * len(held)
    assert all(0 <= row["score"] <= 1 for row in rows)


def test_odd_rows(spark, odd_docs):
    learn = remainder("doc_id", 4) != 2
    model = fit(odd_docs, learn)
    rows = identified(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    for row in rows:
        if row["row"]["doc_id"] in (1, 2, 3, 7):
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
        else:
            assert row["lang_pred"] in model.languages and 0 <= row["score"] <= 1
    empty = odd_docs.where(F.lit(False))
    nothing = fit(empty, learn)
    assert nothing.languages == []
    assert {row["lang_pred"] for row in identified(odd_docs, nothing).collect()} == {"und"}
    assert identified(empty, model).count() == 0
    one = Model.trained(np.ones((1, 1 << 12)), ["en"])
    assert identified(odd_docs, one).where("row.doc_id = 8").first()["lang_pred"] == "en"
