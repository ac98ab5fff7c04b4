"""Language identification in two steps: the family, then the language within it.

Both steps are one-versus-one linear support vector machines over shares of byte trigrams of the
whole text, trained by dual coordinate descent on a bounded sample of labelled documents. The
machines of all families' pairs vote for a family; those of the pairs within it for a language.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.llm.common import per_text, remainder, table

#: The bound of the fit: so many documents of each language, and so many languages (the most
#: frequent ones).
FIT_DOCUMENTS = 250
FIT_LANGUAGES = 100
BITS = 12
EPOCHS = 30
COST = 10.0
UNKNOWN = "und"

#: Families of language codes; any other code is a family of its own.
FAMILIES = {
    "germanic": ("af", "da", "de", "en", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"),
    "romance": ("ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"),
    "slavic": ("be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"),
    "baltic": ("lt", "lv"),
    "celtic": ("br", "cy", "ga", "gd"),
    "finnic": ("et", "fi"),
    "indic": ("bn", "gu", "hi", "mr", "ne", "pa", "ur"),
    "turkic": ("az", "kk", "ky", "tr", "uz"),
    "semitic": ("am", "ar", "he", "mt"),
    "dravidian": ("kn", "ml", "ta", "te"),
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().replace("_", "-").split("-")[0], lang)


def trigrams(texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the trigrams of all texts one after the other, and how many each text has.

    A text is lower-cased (A-Z) and stands between two spaces.
    """
    joined = b"".join(b" " + (text or b"").lower() + b" " for text in texts)
    sizes = np.array([len(text or b"") for text in texts], np.int64)
    raw = np.frombuffer(joined, np.uint8).astype(np.uint32)
    mixed = raw[:-2] * np.uint32(0x9E3779B1)
    mixed ^= raw[1:-1] * np.uint32(0x85EBCA77) << np.uint32(1)
    mixed ^= raw[2:] * np.uint32(0xC2B2AE3D) << np.uint32(2)
    mixed = (mixed * np.uint32(0x27D4EB2F)) >> np.uint32(32 - BITS)
    starts = np.cumsum(sizes + 2) - (sizes + 2)
    # Trigrams that reach into the next text are left out.
    inside = np.ones(len(mixed), bool)
    borders = starts[1:]
    inside[borders - 1] = inside[borders - 2] = False
    return mixed[inside], sizes


def machine(rows: np.ndarray, signs: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear support vector machine with squared hinge loss, by dual
    coordinate descent."""
    rows = np.concatenate([rows, np.ones((len(rows), 1))], 1)
    weights, alphas = np.zeros(rows.shape[1]), np.zeros(len(rows))
    lengths = (rows**2).sum(1) + 1 / (2 * COST)
    order = np.random.default_rng(7)
    for _ in range(EPOCHS):
        for i in order.permutation(len(rows)):
            slope = signs[i] * (rows[i] @ weights) - 1 + alphas[i] / (2 * COST)
            alpha = max(alphas[i] - slope / lengths[i], 0.0)
            if alpha != alphas[i]:
                weights += (alpha - alphas[i]) * signs[i] * rows[i]
                alphas[i] = alpha
    return weights[:-1], float(weights[-1])


@dataclass
class Model:
    """Machines of pairs: (first, second, weights, offset); positive means the first."""

    languages: list[str]
    families: list[tuple[str, str, np.ndarray, float]]
    within: list[tuple[str, str, np.ndarray, float]]

    @classmethod
    def trained(cls, shares: np.ndarray, langs: list[str]) -> Model:
        own = np.array(langs, object)
        names = sorted(set(langs))
        scale = 1 / np.sqrt(shares.mean(0) + 1e-5) if len(shares) else 1.0
        scaled = shares * scale
        family = np.array([family_of(lang) for lang in langs], object)

        def pair(first, second, of):
            use = (of == first) | (of == second)
            weights, offset = machine(scaled[use], np.where(of[use] == first, 1.0, -1.0))
            return first, second, weights * scale, offset

        families = [pair(a, b, family) for a, b in combinations(sorted(set(family)), 2)]
        within = [
            pair(a, b, own) for a, b in combinations(names, 2) if family_of(a) == family_of(b)
        ]
        return cls(names, families, within)

    def worker(self):
        machines = [*self.families, *self.within]
        weights = np.stack([m[2] for m in machines], 1) if machines else np.zeros((1 << BITS, 0))
        offsets = np.array([m[3] for m in machines])
        families = sorted({family_of(lang) for lang in self.languages})
        members = {f: [x for x in self.languages if family_of(x) == f] for f in families}

        def work(texts):
            margins = np.tile(offsets, (len(texts), 1))
            hashes, sizes = trigrams(texts)
            starts = np.cumsum(sizes) - sizes
            full = np.flatnonzero(sizes > 0)
            for m in range(len(machines)):
                if len(full):
                    # Each text has as many trigrams as bytes.
                    sums = np.add.reduceat(weights[:, m][hashes], starts[full])
                    margins[full, m] += sums / sizes[full]
            langs, scores = [], []
            for row in margins:
                votes = _tally(families, machines[: len(self.families)], row)
                best = max(families, key=lambda f: votes[f], default=None)
                own = members.get(best, [])
                inner = _tally(own, machines, row, len(self.families))
                lang = max(own, key=lambda x: inner[x], default=None)
                sure = min([votes[best][1], *([inner[lang][1]] if len(own) > 1 else [])]) if lang else -np.inf
                langs.append(lang)
                scores.append(float(1 / (1 + np.exp(-np.clip(4 * sure, -30, 30)))) if lang else 0.0)
            return [pa.array(langs, pa.string()), pa.array(scores, pa.float64())]

        return work


def _tally(names, machines, margins, start: int = 0) -> dict[str, tuple[int, float]]:
    """Votes of each name, and its least margin (ties go to the surer, then the first name)."""
    votes, least = dict.fromkeys(names, 0), dict.fromkeys(names, 30.0)
    for at in range(start, len(machines)):
        first, second = machines[at][:2]
        if first in votes and second in votes:
            votes[first if margins[at] > 0 else second] += 1
            least[first] = min(least[first], margins[at])
            least[second] = min(least[second], -margins[at])
    return {name: (votes[name], least[name]) for name in names}


def has_letter() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def fit(docs: DataFrame, learn: Column) -> Model:
    """The model of a sample of ``docs`` (doc_id, text, lang): of each language the ``learn``
    rows with the smallest hash of their id. Only their trigram shares come to the driver.
    Without a labelled document no language is known."""
    ids = docs.where(learn & F.col("lang").isNotNull() & F.col("doc_id").isNotNull())
    ids = ids.select("doc_id", "lang")
    known = ids.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(FIT_LANGUAGES)
    chosen = None
    for row in known.collect():
        own = ids.where(F.col("lang") == row["lang"]).orderBy(F.xxhash64("doc_id")).limit(FIT_DOCUMENTS)
        chosen = own if chosen is None else chosen.union(own)
    if chosen is None:
        return Model([], [], [])
    chosen = F.broadcast(chosen.distinct())  # FIT_DOCUMENTS of FIT_LANGUAGES at most
    sample = docs.where(has_letter()).select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])

    def worker():
        def work(texts):
            shares = []
            for text in texts:
                hashes, _ = trigrams([text])
                counts = np.bincount(hashes, minlength=1 << BITS) / max(len(hashes), 1)
                shares.append(counts.astype(np.float32).tobytes())
            return [pa.array(shares, pa.binary())]

        return work

    rows = per_text(sample, worker, "shares binary").select("row.doc_id", "row.lang", "shares")
    found = rows.orderBy(F.xxhash64("doc_id"), "lang", "shares").collect()
    shares = np.array([np.frombuffer(row["shares"], np.float32) for row in found], float)
    return Model.trained(shares, [row["lang"] for row in found])


def identified(docs: DataFrame, model: Model) -> DataFrame:
    """``row``, lang_pred and score for every row of ``docs``.

    A text that is null or has no letter is ``und`` with score 0; so is every text if no language was learned.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    found = per_text(docs, lambda: sent.value.worker(), "lang_pred string, score double")
    letter = F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False)) & F.col("lang_pred").isNotNull()
    return found.select(
        "row",
        F.when(letter, F.col("lang_pred")).otherwise(UNKNOWN).alias("lang_pred"),
        F.when(letter, F.col("score")).otherwise(0.0).alias("score"),
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, by machines fitted on those that are not held out.

    A null text, and one without a letter, is ``und`` with score 0; rows without a lang are judged
    but not learned from; a null doc_id is neither held out nor learned from; repeated rows are
    judged each and alike, and texts whole. Without a row to learn from every text is ``und``.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = fit(docs, remainder("doc_id", 4) != 2)
    held = F.coalesce(remainder("row.doc_id", 4) == 2, F.lit(False))
    return identified(docs.select("doc_id", "text"), model).select(
        "row.doc_id", held.alias("held_out"), "lang_pred", "score"
    )
