"""Filter interaction audit by the Hart-Mas-Colell potential.

A filter's failures make a game: what a coalition of filters removes is the number of rows that
fail any of them. Rows are first counted by part and set of failed filters, so that one small
array for each part holds the worth of all coalitions. The potential of a coalition follows from
those of the coalitions with one filter less, P(S) = (v(S) + sum of P(S - i)) / |S|; a filter's
Shapley value is the grand potential minus the potential without it. Applied in some order, a
filter removes the difference of the coalitions up to it and before it.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiregrain.llm.common import table

#: Fixed values of the contract: the filters' letters, in the order of their bits.
FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
SPACES = r"[\x20\x09-\x0D]+"


def text_failures(docs: DataFrame) -> DataFrame:
    """doc_id, part (lang, null as empty), digest of the text and ``mask``: the bits of the failed
    filters among A to D, which look at one text only. A null text is the empty text."""
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        "doc_id",
        F.coalesce("lang", F.lit("")).alias("part"),
        text.alias("text"),
        F.array_remove(F.split(text, SPACES), "").alias("words"),
    )
    n_words, distinct = F.size("words"), F.size(F.array_distinct("words"))
    capitals = F.length(F.regexp_replace("text", "[^A-Z]+", ""))
    fails = (
        n_words < 100,
        distinct * 100 < n_words * 80,
        capitals.cast("long") * 100 > F.length("text").cast("long") * 10,
        F.col("text").rlike(r"[#$%&*|]"),
    )
    mask = sum((F.when(fails_it, 1 << bit).otherwise(0) for bit, fails_it in enumerate(fails)), F.lit(0))
    return split.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def marked(labels: DataFrame) -> DataFrame:
    """doc_id, good and toxic (0 or 1) of ``labels``; of several rows of an id any 1 counts."""

    def any_one(name: str) -> Column:
        return F.max(F.when(F.col(name) == 1, 1).otherwise(0))

    return labels.groupBy("doc_id").agg(any_one("quality").alias("good"), any_one("toxic").alias("toxic"))


def failure_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """part, mask (all five bits), good, toxic and n, the rows of each.

    Filter E fails what has the text of a smaller doc_id. Rows of the smallest id of a text all
    pass; a null id is larger than all others. A text's rows are counted, not gathered: copies
    without number meet as one row of each part, mark and task.
    """
    by_row = ["digest", "part", "mask", "good", "toxic"]
    known = text_failures(docs).join(marked(labels), "doc_id", "left")
    known = known.fillna(0, ["good", "toxic"]).groupBy("doc_id", *by_row).agg(F.count(F.lit(1)).alias("n"))
    place = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id")
    groups = known.groupBy(*by_row).agg(
        F.sum("n").alias("n"), F.min(F.struct(place.alias("place"), "n")).alias("first")
    )
    least = F.min("first.place").over(Window.partitionBy("digest"))
    passing = F.when(F.col("first.place") == F.col("least"), F.col("first.n")).otherwise(0)
    both = groups.withColumn("least", least).select(
        "part",
        "good",
        "toxic",
        F.explode(
            F.array(
                F.struct(F.col("mask"), passing.alias("n")),
                F.struct(F.col("mask").bitwiseOR(COPY).alias("mask"), (F.col("n") - passing).alias("n")),
            )
        ).alias("own"),
    )
    by_part = both.groupBy("part", F.col("own.mask").alias("mask"), "good", "toxic")
    return by_part.agg(F.sum("own.n").alias("n"))


def coalition_worths(counts: DataFrame, n_filters: int, measures: dict[str, Column]) -> DataFrame:
    """part, n and for each measure an array: its sum over the rows that fail any filter of the
    coalition, for all coalitions in the order of their bits."""

    def worth(measure: Column, coalition: int) -> Column:
        return F.sum(F.when(F.col("mask").bitwiseAND(coalition) != 0, measure).otherwise(0))

    return counts.groupBy("part").agg(
        F.sum("n").alias("n"),
        *[
            F.array(*[worth(measure, coalition) for coalition in range(1 << n_filters)]).alias(name)
            for name, measure in measures.items()
        ],
    )


def potentials(worth: str, n_filters: int) -> Column:
    """The potential of every coalition, times n_filters factorial, which makes it whole.

    Coalitions come in the order of their bits: those with one filter less are there already.
    """
    whole = factorial(n_filters)
    return F.expr(
        f"aggregate(sequence(1, {(1 << n_filters) - 1}), array(0L), (p, s) -> concat(p, array(("
        f"{whole}L * {worth}[s] + aggregate(sequence(0, {n_filters - 1}), 0L, (t, i) -> "
        "t + if((s & shiftleft(1, i)) <> 0, p[s - shiftleft(1, i)], 0L))) div bit_count(s))))"
    )


def audit(counts: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row of each part, order of the filters and step, from ``counts`` (part, mask, good,
    toxic, n; a filter's bit is its place in ``filters``). No rows give no parts."""
    n, everyone = len(filters), (1 << len(filters)) - 1
    measures = {
        "removes": F.col("n"),
        "good": F.when(F.col("good") == 1, F.col("n")).otherwise(0),
        "bad": F.when(F.col("toxic") == 1, F.col("n")).otherwise(0),
    }
    worths = coalition_worths(counts, n, measures)
    worths = worths.withColumn("potential", potentials("removes", n))
    orders = F.array(*[F.lit("".join(order)) for order in permutations(filters)])
    steps = worths.withColumn("filter_order", F.explode(orders)).withColumn(
        "step", F.explode(F.array(*map(F.lit, range(1, n + 1))))
    )
    bit = f"shiftleft(1, instr('{filters}', substring(filter_order, {{}}, 1)) - 1)"
    before = F.expr(
        f"aggregate(filter(sequence(1, {n}), k -> k < step), 0, (b, k) -> b | {bit.format('k')})"
    )
    steps = steps.withColumns({"own": F.expr(bit.format("step")), "before": before})
    steps = steps.withColumn("after", F.col("before").bitwiseOR(F.col("own")))

    def of(name: str, coalition: Column | str) -> Column:
        return F.get(name, F.col(coalition) if isinstance(coalition, str) else coalition)

    removed = of("removes", "after") - of("removes", "before")
    others = F.lit(everyone) - F.col("own")
    return steps.select(
        "part",
        "filter_order",
        "step",
        (F.col("n") - of("removes", "after")).alias("kept"),
        removed.alias("removed"),
        (of("removes", "own") - removed).alias("redundant"),
        (of("removes", F.lit(everyone)) - of("removes", others)).alias("unique_fails"),
        (of("good", "after") - of("good", "before")).alias("good_lost"),
        (of("bad", "after") - of("bad", "before")).alias("toxic_lost"),
        (of("potential", F.lit(everyone)) - of("potential", others)).alias("shapley"),
    )


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of the five filters over ``documents``, by lang.

    Null and empty texts are one text, null and empty langs one part; repeated rows count each;
    ids without a label lose nothing good or toxic; empty tables give no rows; columns beyond
    doc_id, text and lang are not looked at.
    """
    return audit(failure_counts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP13_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
      FROM labels GROUP BY doc_id),
m AS (SELECT t, min(doc_id) AS least FROM d GROUP BY t),
r AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         [len(w) < 100,
          100 * len(list_distinct(w)) < 80 * len(w),
          100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t),
          regexp_matches(t, '[#$%&*|]'),
          d.doc_id > least] AS f
  FROM d JOIN m USING (t) LEFT JOIN l USING (doc_id)),
k AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM k a, k b, k c, k d, k e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
g AS (SELECT part, f, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM r GROUP BY part, f),
s AS (
  SELECT part, filter_order, step, g.n, good, toxic,
         f[ascii(filter_order[step]) - 64] AS own,
         list_bool_or(list_transform(range(1, step), lambda i: f[ascii(filter_order[i]) - 64])) AS earlier,
         len(list_filter(f, lambda x: x)) AS fails
  FROM g, o, unnest(range(1, 6)) AS u(step)),
a AS (
  SELECT part, filter_order, CAST(step AS INT) AS step,
         CAST(sum(CASE WHEN NOT own AND NOT coalesce(earlier, false) THEN n ELSE 0 END) AS BIGINT) AS kept,
         CAST(sum(CASE WHEN own AND NOT coalesce(earlier, false) THEN n ELSE 0 END) AS BIGINT) AS removed,
         CAST(sum(CASE WHEN own AND coalesce(earlier, false) THEN n ELSE 0 END) AS BIGINT) AS redundant,
         CAST(sum(CASE WHEN own AND fails = 1 THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
         CAST(sum(CASE WHEN own AND NOT coalesce(earlier, false) THEN good ELSE 0 END) AS BIGINT) AS good_lost,
         CAST(sum(CASE WHEN own AND NOT coalesce(earlier, false) THEN toxic ELSE 0 END) AS BIGINT) AS toxic_lost
  FROM s GROUP BY part, filter_order, step),
h AS (SELECT part, filter_order[step] AS x, CAST(sum(removed) AS BIGINT) AS shapley FROM a GROUP BY ALL)
SELECT a.*, shapley FROM a JOIN h ON h.part = a.part AND h.x = a.filter_order[step]
"""
