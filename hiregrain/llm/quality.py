"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Each text gives a vector of transformed statistics. For each language and source the location
and scatter of those vectors come from the minimum-covariance-determinant estimate, found by
concentration steps that run as Spark aggregations: no group is ever gathered in a task. A text
is rejected if its squared Mahalanobis distance is beyond a chi-square quantile.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.llm.common import checked_broadcast, per_text, stored, table

#: Fixed values of the contract.
SYMBOLS = b"#*$%&|<>"
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

#: The share of a group that each concentration step keeps.
CORE = 0.75
#: A text is rejected if a clean one lies as far out with this probability at most.
ALPHA = 1e-6
#: Spread below which a difference of a statistic means nothing, added to each variance: the
#: statistics of clean texts are often all zero, and their scatter would be singular. Where they
#: are, over 8 percent of equal lines or of words repeated are beyond the cut by themselves.
FLOORS = (0.05, 0.03, 0.05, 0.05)
#: Languages and sources with fewer rows are estimated together, by language or as a whole.
MIN_GROUP = 200
#: Concentration steps end when no log determinant falls by this much, or after so many.
MIN_FALL = 0.01
MAX_STEPS = 10

DIM = 4
_CONTINUATION = bytes(range(0x80, 0xC0))
_Y = [f"_y{i}" for i in range(DIM)]
_M = [f"_m{i}" for i in range(DIM)]
_PAIRS = [(i, j) for i in range(DIM) for j in range(i, DIM)]
STATISTICS = "n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long"


def repeat_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more, the first time included."""
    n = len(words)
    if n < 4:
        return 0
    index: dict[bytes, int] = {}
    number = index.setdefault
    ids = np.array([number(word, len(index)) for word in words], np.int64)
    distinct = len(index)
    key = ids[:-2] * distinct + ids[1:-1]
    if distinct >= 1 << 21:
        key = np.unique(key, return_inverse=True)[1].astype(np.int64)
    key = key * distinct + ids[2:]
    ordered = np.sort(key)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    at = np.flatnonzero(np.isin(key, twice))
    hit = np.zeros(n, bool)
    for step in range(3):
        hit[at + step] = True
    return int(hit.sum())


def statistics(text: bytes | None) -> tuple[int, int, int, int, int, int]:
    """The counts of STATISTICS for one text."""
    if not text:
        return (0, 0, 0, 0, 0, 0)
    words = text.split()
    lines = [line for line in text.split(b"\n") if line.strip()]
    return (
        len(words),
        len(text.translate(None, SPACES + _CONTINUATION)),
        len(text) - len(text.translate(None, SYMBOLS)),
        len(lines),
        len(lines) - len(set(lines)),
        repeat_words(words),
    )


def with_statistics(docs: DataFrame) -> DataFrame:
    """``row`` and STATISTICS."""

    def worker():
        def work(texts):
            found = [statistics(text) for text in texts]
            return [pa.array(column, pa.int64()) for column in zip(*found, strict=True)]

        return work

    return per_text(docs, worker, STATISTICS)


def base_failed() -> Column:
    repeats = F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    return (F.col("n_words") < MIN_WORDS) | repeats


def vector() -> list[Column]:
    """Log word length, and the angles of the shares of symbols, equal lines, repeated words."""

    def angle(part: str, whole: str) -> Column:
        share = F.col(part) / F.greatest(F.col(whole), F.lit(1))
        return F.asin(F.sqrt(F.least(share, F.lit(1.0))))

    length = F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))
    return [
        F.log1p(length),
        angle("n_symbols", "word_chars"),
        angle("n_dup_lines", "n_lines"),
        angle("n_repeat_words", "n_words"),
    ]


def chi2_cdf(x: float, dof: int) -> float:
    """Chi-square distribution for an even number of degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dof // 2))


def chi2_quantile(tail: float, dof: int) -> float:
    """The value that is exceeded with probability ``tail``."""
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        above = math.exp(-middle / 2) * sum(
            (middle / 2) ** k / math.factorial(k) for k in range(dof // 2)
        )
        low, high = (middle, high) if above > tail else (low, middle)
    return high


def consistency(core: float) -> float:
    """What makes the scatter of the inner ``core`` of normal rows that of all of them."""
    return core / chi2_cdf(chi2_quantile(1 - core, DIM), DIM + 2)


def _distance() -> Column:
    total = F.lit(0.0)
    for i, j in _PAIRS:
        term = (F.col(_Y[i]) - F.col(_M[i])) * (F.col(_Y[j]) - F.col(_M[j])) * F.col(f"_p{i}{j}")
        total = total + (term if i == j else term * 2)
    return total


def _precisions(moments: DataFrame, scale: float, floors: tuple[float, ...]) -> DataFrame:
    """Means, inverse scatter and log determinant of each group, one row of sums a group."""
    schema = "_g string, " + ", ".join(f"{m} double" for m in _M)
    schema += "".join(f", _p{i}{j} double" for i, j in _PAIRS) + ", _logdet double"

    def run(frames):
        for frame in frames:
            n = np.maximum(frame["_n"].to_numpy(float), 1.0)
            shift = np.stack([frame[f"_s{i}"].to_numpy(float) / n for i in range(DIM)], 1)
            scatter = np.zeros((len(frame), DIM, DIM))
            for i, j in _PAIRS:
                scatter[:, i, j] = scatter[:, j, i] = (
                    frame[f"_q{i}{j}"].to_numpy(float) / n - shift[:, i] * shift[:, j]
                )
            scatter = scatter * scale + np.diag(np.square(floors))
            inverse = np.linalg.inv(scatter)
            out = {"_g": frame["_g"]}
            for i in range(DIM):
                out[_M[i]] = frame[f"_c{i}"].to_numpy(float) + shift[:, i]
            for i, j in _PAIRS:
                out[f"_p{i}{j}"] = inverse[:, i, j]
            out["_logdet"] = np.linalg.slogdet(scatter)[1]
            yield pd.DataFrame(out)

    return moments.mapInPandas(run, schema)


def _moments(rows: DataFrame) -> DataFrame:
    """Sums of the rows about the means they carry, added up in each task before the shuffle."""
    away = [F.col(y) - F.col(m) for y, m in zip(_Y, _M, strict=True)]
    return rows.groupBy("_g").agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.first(m).alias(f"_c{i}") for i, m in enumerate(_M)],
        *[F.sum(away[i]).alias(f"_s{i}") for i in range(DIM)],
        *[F.sum(away[i] * away[j]).alias(f"_q{i}{j}") for i, j in _PAIRS],
    )


def _keyed(rows: DataFrame) -> DataFrame:
    """``rows`` with one key for their language and source, and one for their language."""
    lang, source = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("lang", "source"))
    return rows.withColumn("_own", F.to_json(F.array(lang, source))).withColumn(
        "_lang", F.to_json(F.array(lang))
    )


def _group_names(rows: DataFrame, min_group: int) -> DataFrame:
    """Each language and source with the group it is estimated in."""
    sizes = rows.groupBy("_own", "_lang").agg(F.count(F.lit(1)).alias("_n"))
    small = F.col("_n") < min_group
    pooled = sizes.where(small).groupBy("_lang").agg(F.sum("_n").alias("_pool"))
    pooled = pooled.where(F.col("_pool") >= min_group)
    return sizes.join(pooled, "_lang", "left").select(
        "_own",
        F.when(~small, F.col("_own"))
        .when(F.col("_pool").isNotNull(), F.col("_lang"))
        .otherwise(F.lit("[]"))
        .alias("_g"),
    )


def fit(
    measured: DataFrame,
    core: float = CORE,
    floors: tuple[float, ...] = FLOORS,
    min_group: int = MIN_GROUP,
    max_steps: int = MAX_STEPS,
) -> DataFrame:
    """Robust location and inverse scatter for each language and source of ``measured``.

    ``measured`` has lang, source and STATISTICS; rows that fail the base rules count for
    nothing. Returns ``_own`` (language and source), ``_m*`` and ``_p*``. Null languages and
    sources count as empty ones. An empty table gives no row.
    """
    named = [y.alias(name) for name, y in zip(_Y, vector(), strict=True)]
    rows = stored(_keyed(measured.where(~base_failed())).select("_own", "_lang", *named))
    names = stored(_group_names(rows, min_group))
    rows = rows.join(checked_broadcast(names), "_own").drop("_own", "_lang")
    # The first core: inside the coordinate-wise medians and quartile ranges.
    quartiles = rows.groupBy("_g").agg(
        *[F.percentile_approx(y, [0.25, 0.5, 0.75], 2000).alias(f"_t{i}") for i, y in enumerate(_Y)]
    )
    spread = [
        F.pow((F.element_at(f"_t{i}", 3) - F.element_at(f"_t{i}", 1)) / 1.349, 2) + floors[i] ** 2
        for i in range(DIM)
    ]
    params = quartiles.select(
        "_g",
        *[F.element_at(f"_t{i}", 2).alias(m) for i, m in enumerate(_M)],
        *[(1 / spread[i] if i == j else F.lit(0.0)).alias(f"_p{i}{j}") for i, j in _PAIRS],
        F.lit(math.inf).alias("_logdet"),
    )
    params = stored(params)
    scale = consistency(core)
    for _ in range(max_steps):
        near = rows.join(checked_broadcast(params), "_g").withColumn("_d", _distance())
        radius = near.groupBy("_g").agg(F.percentile_approx("_d", core, 2000).alias("_radius"))
        inner = near.join(checked_broadcast(stored(radius)), "_g").where("_d <= _radius")
        after = stored(_precisions(_moments(inner), scale, floors))
        before = params.select("_g", F.col("_logdet").alias("_before"))
        fall = after.join(before, "_g").agg(F.max(F.col("_before") - F.col("_logdet"))).first()[0]
        params = after
        if fall is None or fall < MIN_FALL:
            break
    # One reweighting: all rows within the usual quantile of the core's estimate.
    weighed = rows.join(checked_broadcast(params), "_g").withColumn("_d", _distance())
    inner = weighed.where(F.col("_d") <= chi2_quantile(0.025, DIM))
    final = _precisions(_moments(inner), consistency(0.975), floors)
    return stored(names.join(final, "_g").drop("_g", "_logdet"))


def judged(measured: DataFrame, params: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """``measured`` with base_failed, distance (null if base_failed) and kept."""
    rows = (
        _keyed(measured)
        .withColumn("base_failed", base_failed())
        .withColumns(dict(zip(_Y, vector(), strict=True)))
        .join(checked_broadcast(params), "_own", "left")
        .withColumn("distance", F.when(~F.col("base_failed"), _distance()))
    )
    far = F.coalesce(F.col("distance"), F.lit(0.0)) > chi2_quantile(alpha, DIM)
    inner = [*_Y, *_M, *[f"_p{i}{j}" for i, j in _PAIRS], "_own", "_lang"]
    return rows.withColumn("kept", ~F.col("base_failed") & ~far).drop(*inner)


def quality_rules(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """Statistics and verdict of every row of ``docs`` (doc_id, text, lang, source).

    A null or empty text has no word and fails the base rules. Repeated rows are judged each;
    a language or source that is null counts as an empty one.
    """
    measured = with_statistics(docs.select("doc_id", "text", "lang", "source"))
    named = [c for c in measured.columns if c != "row"]
    measured = stored(measured.select("row.doc_id", "row.lang", "row.source", *named))
    return judged(measured, fit(measured), alpha)


def keep_good(docs: DataFrame, alpha: float = ALPHA) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with their own columns, whatever their names.

    Null and empty texts go, as they fail the base rules; repeated rows stay or go together; an
    empty table stays empty. Groups are those of ``docs``, so what a stage before has taken away
    does not count.
    """
    measured = with_statistics(docs)
    named = [c for c in measured.columns if c != "row"]
    params = fit(measured.select("row.lang", "row.source", *named))
    rows = measured.select("row", "row.lang", "row.source", *named)
    return judged(rows, params, alpha).where("kept").select("row.*")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics and verdicts of every document; see ``quality_rules`` for odd rows. An empty
    table gives no rows; columns beyond doc_id, text, lang and source are not looked at."""
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "distance",
    )
