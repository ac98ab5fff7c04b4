"""The potential against orders counted one by one; odd rows."""

from itertools import permutations

import pytest
from pyspark.sql import functions as F

from hiregrain.llm.filter_audit import audit, failure_counts, potentials


def counted(rows, filters):
    """Rows (part, mask, good, toxic, n) filtered order by order."""
    found, shares = {}, {}
    for part in {row[0] for row in rows}:
        for order in permutations(range(len(filters))):
            name, before = "".join(filters[k] for k in order), 0
            for step, k in enumerate(order, 1):
                own = [row for row in rows if row[0] == part and row[1] >> k & 1]
                now = [row for row in own if not row[1] & before]
                before |= 1 << k
                removed = sum(row[4] for row in now)
                shares[part, k] = shares.get((part, k), 0) + removed
                found[part, name, step] = [
                    sum(row[4] for row in rows if row[0] == part and not row[1] & before),
                    removed,
                    sum(row[4] for row in own) - removed,
                    sum(row[4] for row in own if row[1] == 1 << k),
                    sum(row[4] for row in now if row[2]),
                    sum(row[4] for row in now if row[3]),
                ]
    return {
        key: (*values, shares[key[0], filters.index(key[1][key[2] - 1])]) for key, values in found.items()
    }


@pytest.mark.parametrize("filters", ["A", "AB", "XYZ", "ABCDE"])
def test_audit_equals_counting(spark, filters):
    rows = [
        (part, mask, mask % 2, mask % 3 % 2, (mask * 7 + len(part)) % 5 + 1)
        for part in ("", "en")
        for mask in range(1 << len(filters))
    ]
    counts = spark.createDataFrame(rows, "part string, mask int, good int, toxic int, n long")
    found = {(r[0], r[1], r[2]): tuple(r)[3:] for r in audit(counts, filters).collect()}
    assert found == counted(rows, filters)


def test_potential_of_a_unanimity_game(spark):
    # Only coalitions that hold filters 0 and 2 remove anything: those share it evenly.
    worth = [6 if (s & 5) == 5 else 0 for s in range(8)]
    frame = spark.createDataFrame([(worth,)], "v array<long>").select(potentials("v", 3).alias("p"))
    p = frame.first()["p"]
    assert [p[7] - p[7 - (1 << i)] for i in range(3)] == [18, 0, 18]


@pytest.fixture(scope="module")
def odd_labels(odd_labels):
    return odd_labels.withColumn("quality", 1 - F.col("toxic"))


def test_copies_and_odd_rows(spark, odd_docs, odd_labels):
    counts = failure_counts(odd_docs, odd_labels)
    rows = counts.where("n > 0").collect()
    assert sum(row["n"] for row in rows) == odd_docs.count()
    assert {row["part"] for row in rows} == {"", "en", "de", "fr"}
    # Of the texts 1 and 2, one empty and one null, the second is a copy; those of one id are not.
    assert sum(row["n"] for row in rows if row["mask"] & 16) == 1
    assert audit(counts).count() == 4 * 600
    none = odd_docs.where(F.lit(False))
    assert audit(failure_counts(none, odd_labels)).count() == 0
    without = failure_counts(odd_docs, odd_labels.where(F.lit(False)))
    assert without.agg(F.sum("n")).first()[0] == odd_docs.count()


def test_null_ids_are_the_largest(spark, odd_labels):
    schema = "doc_id long, text string, lang string"
    both = spark.createDataFrame([(None, "t", "en"), (None, "t", "de")], schema)
    assert failure_counts(both, odd_labels).where("n > 0 and mask >= 16").count() == 0
    third = both.union(spark.createDataFrame([(5, "t", None), (5, "t", "en")], schema))
    found = failure_counts(third, odd_labels).where("n > 0 and mask >= 16").collect()
    assert sorted((row["part"], row["n"]) for row in found) == [("de", 1), ("en", 1)]
