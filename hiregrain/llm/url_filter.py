"""URL filters: a cascade of Bloom filters, in DataFrame operations only.

The keys of a URL are its host's suffixes, each with the beginnings of its path that a rule can
have. Over the complete universe of keys in the corpus, the first level encodes the listed keys,
the second the universe's keys that the first takes wrongly, the third the listed keys that the
second takes wrongly, and so on until a level takes none wrongly. For every key of the universe
the first level that lacks it tells exactly whether it is listed: no join with the list is needed.
The filters are array literals in the expressions that judge a row. Only their bits come to the
driver, about 1.5 times the binary logarithm of the universe's size for each listed key: the first
level's rate of false positives is set so that the later levels are no larger.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hiregrain.llm.common import stored, table

#: Share of wrong keys in each level after the first.
LATER_RATE = 0.5
#: Levels at most; each halves what is left, so more mean that the hashes fail.
MOST_LEVELS = 64

#: Fixed values of the contract: verdict, host and path of each rule.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def after_scheme(url: Column) -> Column:
    """What follows the first ``://``; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    host = F.translate(F.regexp_extract(after_scheme(url), r"^[^/?#]*", 0), _UPPER, _LOWER)
    return F.coalesce(host, F.lit(""))


def path_of(url: Column) -> Column:
    path = F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(path, F.lit(""))


def keys_of(host: Column, path: Column, lengths: list[int]) -> Column:
    """All suffixes of the host at label borders, with the path's beginnings of ``lengths``."""
    labels = F.split(host, r"\.", -1)
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."),
    )
    fitting = F.filter(F.array(*map(F.lit, lengths)), lambda n: F.length(path) >= n)
    return F.flatten(
        F.transform(
            suffixes,
            lambda host: F.transform(fitting, lambda n: F.concat(host, F.substring(path, F.lit(1), n))),
        )
    )


@dataclass
class Level:
    """One Bloom filter: its words of 64 bits as an array literal, its bits and hashes."""

    words: Column
    bits: int
    hashes: int
    number: int

    def has(self, key: Column) -> Column:
        """Whether all bits of the key are set."""
        return F.forall(
            F.array(*places(key, self.bits, self.hashes, self.number)),
            lambda at: F.call_function(
                "bit_get", F.get(self.words, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")
            )
            == 1,
        )


def places(key: Column, bits: int, hashes: int, number: int) -> list[Column]:
    """Bit places of a key in the filter of a level, by two hashes."""
    first = F.pmod(F.xxhash64(key, F.lit(number)), F.lit(1 << 40))
    second = F.pmod(F.xxhash64(F.lit(number), key), F.lit(1 << 40))
    return [F.pmod(first + second * F.lit(k), F.lit(bits).cast("long")) for k in range(hashes)]


def filled(keys: DataFrame, rate: float, number: int, count: int) -> Level:
    """The filter of ``count`` ``keys`` (key) that takes other keys at ``rate``."""
    bits = max(64, math.ceil(-count * math.log(rate) / math.log(2) ** 2))
    hashes = max(1, round(bits / max(count, 1) * math.log(2)))
    hashes = min(hashes, 30)
    words = -(-bits // 64)
    at = places(F.col("key"), bits, hashes, number)
    spread = keys.select(F.explode(F.array(*at)).alias("at")).select(
        F.shiftright("at", 6).alias("word"),
        F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit"),
    )
    empty = keys.sparkSession.range(words).select(F.col("id").alias("word"), F.expr("0L").alias("bit"))
    merged = spread.union(empty).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    found = [row["bits"] for row in merged.orderBy("word").collect()]
    return Level(F.lit(np.array(found, np.int64)), bits, hashes, number)


def cascade(listed: DataFrame, universe: DataFrame) -> list[Level]:
    """Levels that decide for each key of ``universe`` (distinct key) if ``listed`` has it."""
    own = stored(universe.join(listed.select("key").distinct(), "key", "left_semi"))
    other = universe.join(listed.select("key").distinct(), "key", "left_anti")
    n_own, n_other = own.count(), other.count()
    levels: list[Level] = []
    inside, n_inside, outside, n_outside = own, n_own, other, n_other
    while n_inside and len(levels) < MOST_LEVELS:
        rate = LATER_RATE
        if not levels:
            rate = min(LATER_RATE, max(n_own, 1) / (max(n_other, 1) * math.sqrt(2)))
        level = filled(inside, rate, len(levels) + 1, n_inside)
        levels.append(level)
        wrong = stored(outside.where(level.has(F.col("key"))))
        inside, n_inside, outside, n_outside = wrong, wrong.count(), inside, n_inside
    if n_inside:
        raise RuntimeError(f"{n_inside} keys are left after {MOST_LEVELS} levels")
    return levels


def member(levels: list[Level], key: Column) -> Column:
    """Exact membership of a key of the universe: by the first level that lacks it."""
    verdict = F.lit(len(levels) % 2 == 1)
    for level in reversed(levels):
        verdict = F.when(level.has(key), verdict).otherwise(F.lit(level.number % 2 == 0))
    return verdict


def judged(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``urls`` (url) as struct ``row`` with host, path, rule and verdict.

    ``rules`` has verdict, host and path; a rule is written as host and path. The longest rule
    that fits wins (of equals the greater text); a URL that none fits is in no list and allowed.
    A null URL, or one without ``://``, has empty host and path. No rules allow all.
    """
    listed = rules.select("verdict", F.concat("host", "path").alias("key"), F.length("path").alias("n"))
    lengths = sorted(row["n"] for row in listed.select("n").distinct().collect())
    url = F.col("url")
    rows = urls.select(
        F.struct("*").alias("row"), host_of(url).alias("host"), path_of(url).alias("path")
    )
    if not lengths:
        return rows.withColumn("rule", F.lit(None).cast("string")).withColumn("verdict", F.lit("allow"))
    keys = keys_of(F.col("host"), F.col("path"), lengths)
    universe = stored(rows.select(F.explode(keys).alias("key")).distinct())
    blocks = cascade(listed.where("verdict = 'block'"), universe)
    allows = cascade(listed.where("verdict <> 'block'"), universe)
    fitting = F.filter(keys, lambda key: member(blocks, key) | member(allows, key))
    sized = F.transform(fitting, lambda key: F.struct(F.length(key).alias("n"), key.alias("key")))
    longest = F.array_max(sized)
    rows = rows.withColumn("rule", longest["key"])
    blocked = F.coalesce(member(blocks, F.col("rule")), F.lit(False)) & F.col("rule").isNotNull()
    return rows.withColumn("verdict", F.when(blocked, "block").otherwise("allow"))


def typed_in(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    """A short list of rules (verdict, host, path) as a table."""
    names = ("verdict", "host", "path")
    rows = [
        F.struct(*[F.lit(x).alias(name) for name, x in zip(names, rule, strict=True)])
        for rule in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL. A null URL, or one without ``://``, has an empty host and
    path, which no rule fits; repeated rows are judged each; URLs of any length are judged whole."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judged(pages, typed_in(spark)).select("row.page_id", "host", "path", "rule", "verdict")


OP10_SQL = r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT row_number() OVER () AS k, page_id,
    translate(regexp_extract(coalesce(rest, ''), '^[^/?#]*'),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(coalesce(rest, ''), '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut),
rules(verdict, rule_host, rule_path) AS (VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'),
  ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
fits AS (
  SELECT k, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(verdict, length(rule_host || rule_path)) AS verdict
  FROM parts JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
  GROUP BY k)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM parts LEFT JOIN fits USING (k)
"""
