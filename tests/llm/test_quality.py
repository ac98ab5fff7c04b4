import random

import numpy as np
import pytest
from pyspark.sql import functions as F


from hiregrain.llm import quality
from hiregrain.llm.quality import keep_good, quality_rules, statistics

SPACE = " \t\n\r\x0b\x0c"


def plain(text):
    words = [w for w in "".join(" " if c in SPACE else c for c in text or "").split(" ") if w]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    repeated = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    lines = [x for x in (text or "").split("\n") if any(c not in SPACE for c in x)]
    return (
        len(words),
        sum(map(len, words)),
        sum(c in "#*$%&|<>" for c in text or ""),
        len(lines),
        len(lines) - len(set(lines)),
        len(repeated),
    )


def test_statistics_equal_the_definition():
    source = random.Random(5)
    texts = [None, "", "\n", "a b c a b c", "é\x0bü\r\nx\n\nx\nx"]
    for _ in range(200):
        texts.append("".join(source.choice("ab é\n#|\t\x0b\x85 ") for _ in range(source.randrange(80))))
    for text in texts:
        assert statistics(None if text is None else text.encode()) == plain(text)


def test_robust_estimate_withstands_a_quarter_of_outliers(spark):
    source = np.random.default_rng(1)
    rows = []
    for k in range(1200):
        bad = k % 5 == 0
        n_words = int(source.integers(100, 400))
        chars = int(n_words * source.normal(5.0, 0.1))
        symbols = n_words if bad else int(source.integers(0, 3))
        rows.append((k, "en", "s", n_words, chars, symbols, 10, 0, int(source.integers(0, 9))))
    measured = spark.createDataFrame(rows, "doc_id long, lang string, source string, " + quality.STATISTICS)
    params = quality.fit(measured)
    found = quality.judged(measured, params).collect()
    assert {row["doc_id"] for row in found if not row["kept"]} == {k for k in range(1200) if k % 5 == 0}
    # The location equals that of the clean rows.
    clean = np.log1p([r[4] / r[3] for r in rows if r[0] % 5])
    assert abs(params.first()["_m0"] - clean.mean()) < 0.01


@pytest.fixture(scope="module")
def planted(spark):
    """Clean texts of one group, with forty outliers in each of the four statistics; who is rejected."""
    source = np.random.default_rng(2)
    rows = []
    for k in range(1600):
        kind = k % 10 if k < 400 else 9
        n_words, n_lines = int(source.integers(100, 400)), int(source.integers(20, 40))
        chars = int(n_words * (9.0 if kind == 0 else source.normal(5.0, 0.1)))
        symbols = chars // 10 if kind == 1 else int(source.integers(0, 2))
        equal = n_lines * 3 // 10 if kind == 2 else 0
        repeats = n_words * 2 // 5 if kind == 3 else int(source.integers(0, 2)) * 3
        rows.append((k, "en", "s", n_words, chars, symbols, n_lines, equal, repeats))
    measured = spark.createDataFrame(rows, "doc_id long, lang string, source string, " + quality.STATISTICS)
    found = quality.judged(measured, quality.fit(measured)).collect()
    assert not any(row["base_failed"] for row in found)
    return {row["doc_id"] for row in found if not row["kept"]}


@pytest.mark.parametrize("kind", range(4))
def test_each_statistic_rejects_by_itself(planted, kind):
    assert {k for k in range(400) if k % 10 == kind} <= planted


def test_clean_texts_are_kept(planted):
    assert not {k for k in planted if k >= 400 or k % 10 > 3}


def test_chi_square_quantile():
    assert abs(quality.chi2_quantile(0.05, 4) - 9.4877) < 1e-3
    assert abs(quality.chi2_quantile(0.025, 4) - 11.1433) < 1e-3


def test_odd_rows(odd_docs):
    found = quality_rules(odd_docs).collect()
    assert len(found) == odd_docs.count()
    by_id = {row["doc_id"]: row for row in found}
    assert all(by_id[k]["n_words"] == 0 and by_id[k]["base_failed"] for k in (1, 2, 3))
    assert not by_id[1]["kept"] and by_id[8]["kept"]
    kept = keep_good(odd_docs)
    assert kept.columns == odd_docs.columns
    assert {row["doc_id"] for row in kept.collect()} == {k for k, row in by_id.items() if row["kept"]}
    empty = odd_docs.where(F.lit(False))
    assert quality_rules(empty).count() == 0 and keep_good(empty).columns == odd_docs.columns
    assert keep_good(empty).count() == 0
