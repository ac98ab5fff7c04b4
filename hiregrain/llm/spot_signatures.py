"""Document fingerprints by spot signatures, in DataFrame operations only.

A spot is a common word, the anchor; its signature is a chain of the content words that follow,
with the common words among them passed over. Running text has spots everywhere, menus and lists
hardly any, so that what is the same in two texts shows in the set of their signatures. Sets are
compared by Jaccard likeness, which the sets' lengths bound from above: with a least likeness,
sets belong to classes by length of which only the same and the next can hold a match, and no
others are intersected.

The next document of each one is found without sorting all rows in one task and without a second
move of the texts: ids are cut in blocks by range, each block also gets the document that follows
its last one, and each block is sorted for itself.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hiregrain.llm.common import stored, table

#: Common words of English, German, French and Spanish.
ANCHORS = (
    "the of and to in is that for was on are with be "
    "der die das und den von zu mit ist im auf für "
    "le la les des et en un une du que est pour "
    "el los las y una por con del se es como "
).split()
WORD = r"[\p{L}\p{N}\p{M}]+"
#: Content words of a chain, and how many content words on from the anchor each next one is.
CHAIN, DISTANCE = 2, 1
#: Hexadecimal digits of a signature.
DIGITS = 8
#: Ids of a block of neighbours, and blocks at most: with more ids, blocks are larger.
BLOCK_ROWS = 256
MOST_BLOCKS = 1 << 16
#: Ids that a task counts through to find the blocks.
PART_ROWS = 50_000
#: Bounds of blocks that a row is compared with at once.
STRIDE = 256
_NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Spots:
    """Which words are anchors and how chains are made."""

    anchors: tuple[str, ...] = tuple(ANCHORS)
    chain: int = CHAIN
    distance: int = DISTANCE


def with_signatures(rows: DataFrame, spots: Spots = Spots(), **texts: str) -> DataFrame:
    """``rows`` with a column of signatures, in order and each once, for each name of ``texts``,
    which gives the column its text is in.

    The beginning of a text is an anchor too, so that texts without one have a signature. A chain
    that the end of the text cuts short counts as long as a word is left of it. Texts without a
    content word, null ones among them, have no signatures.
    """
    names = list(texts)

    def is_anchor(word: Column) -> Column:
        return word.isin("", *spots.anchors)

    words = {
        f"_words_{name}": F.concat(
            F.array(F.lit("")),
            F.regexp_extract_all(F.lower(F.coalesce(texts[name], F.lit(""))), F.lit(WORD), F.lit(0)),
        )
        for name in names
    }
    rows = rows.select("*", *[column.alias(name) for name, column in words.items()])
    split = []
    for name in names:
        own = F.col(f"_words_{name}")
        at = F.filter(
            F.transform(own, lambda word, k: F.when(is_anchor(word), k)), lambda k: k.isNotNull()
        )
        split += [
            at.alias(f"_at_{name}"),
            F.filter(own, lambda word: ~is_anchor(word)).alias(f"_content_{name}"),
        ]
    rows = rows.select("*", *split)

    def signed(name: str) -> Column:
        content, own = F.col(f"_content_{name}"), F.col(f"_words_{name}")

        def signature(at: Column, k: Column) -> Column:
            # An anchor at word ``at`` that is the k-th follows at - k content words.
            first = at - k + spots.distance - 1
            chain = [F.get(content, first + step * spots.distance) for step in range(spots.chain)]
            written = F.concat_ws(" ", F.get(own, at), *chain)
            return F.when(chain[0].isNotNull(), F.substring(F.md5(written), 1, DIGITS))

        made = F.transform(f"_at_{name}", signature)
        return F.array_sort(F.array_distinct(F.filter(made, lambda x: x.isNotNull())))

    kept = [name for name in rows.columns if not name.startswith(("_words_", "_at_", "_content_"))]
    return rows.select(*kept, *[signed(name).alias(name) for name in names])


def length_class(size: Column, least: float) -> Column:
    """Class of a set by its length: sets of ``least`` likeness are in the same or next classes."""
    return F.when(size > 0, F.floor(F.log(1 / least, size.cast("double")) + 1e-9)).otherwise(-1)


def likeness(left: str, right: str, least: float = 0.0) -> Column:
    """Jaccard likeness of two columns of sets, 1 for two empty ones.

    With ``least``, pairs whose length classes lie apart, or whose lengths alone bound them below
    it, are not intersected; they and all others below ``least`` have 0.
    """
    a, b = F.size(left), F.size(right)
    shared = F.size(F.array_intersect(left, right))
    exact = F.when((a == 0) & (b == 0), 1.0).otherwise(shared / (a + b - shared))
    if not least:
        return F.when((a == 0) != (b == 0), 0.0).otherwise(exact)
    apart = F.abs(length_class(a, least) - length_class(b, least)) > 1
    pruned = apart | (F.least(a, b) < F.greatest(a, b) * least)
    return F.when(pruned, 0.0).otherwise(F.when(exact >= least, exact).otherwise(0.0))


def fingerprint(signatures: str) -> Column:
    """A set of signatures as one string."""
    return F.array_join(signatures, "")


def block_tops(ids: DataFrame, rows: int = BLOCK_ROWS, most: int = MOST_BLOCKS) -> list[int]:
    """The largest id of each block of some ``rows`` neighbouring ids, ``most`` blocks at most and
    then larger ones; ``ids`` has one column and no null.

    Ids are dealt by range and counted through in each part, so that only tops come together.
    """
    ids = stored(ids.toDF("id").distinct())
    n, last = ids.agg(F.count(F.lit(1)), F.max("id")).first()
    rows = max(rows, -(-n // most))
    parts = ids.repartitionByRange(max(1, -(-n // PART_ROWS)), "id")
    place = F.row_number().over(Window.partitionBy("part").orderBy("id"))
    numbered = parts.withColumn("part", F.spark_partition_id()).withColumn("place", place)
    tops = [row["id"] for row in numbered.where(F.col("place") % rows == 0).select("id").collect()]
    return sorted({*tops, last}) if n else []


def block_of(value: Column, tops: list[int]) -> Column:
    """How many of ``tops`` are below ``value``."""
    coarse = F.lit(tops[STRIDE - 1 :: STRIDE]).cast("array<bigint>")
    passed = F.size(F.filter(coarse, lambda top: top < value)) * STRIDE
    near = F.slice(F.lit(tops).cast("array<bigint>"), passed + 1, STRIDE)
    return passed + F.size(F.filter(near, lambda top: top < value))


def with_next(
    docs: DataFrame, spots: Spots = Spots(), rows: int = BLOCK_ROWS, most: int = MOST_BLOCKS
) -> DataFrame:
    """doc_id, text, signatures, and next_text and next_signatures of the document that follows by
    descending doc_id; the first one follows the last.

    Null texts count as empty. Rows of one id follow each other by the hash of their text, and are
    in one block; null ids come after all others. A table of one row is followed by itself; no
    rows give none.
    """
    known = docs.select(
        "doc_id",
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("id"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    tops = block_tops(known.select("id"), rows, most)
    if not tops:
        tops = [_NO_ID]
    block = block_of(F.col("id"), tops)
    placed = known.withColumns({"block": block, "hash": F.xxhash64("text")})
    top = F.get(F.lit(tops).cast("array<bigint>"), F.col("block"))
    own = F.struct(F.col("block"), F.lit(False).alias("guest"))
    above = F.struct(((F.col("block") + 1) % len(tops)).alias("block"), F.lit(True).alias("guest"))
    places = F.when(F.col("id") == top, F.array(own, above)).otherwise(F.array(own))
    placed = placed.select("doc_id", "id", "text", "hash", F.explode(places).alias("place"))
    placed = placed.select("doc_id", "id", "text", "hash", "place.*").repartition("block")
    signed = with_signatures(placed, spots, signatures="text")
    order = Window.partitionBy("block").orderBy("guest", F.desc("id"), "hash")
    following = F.lead(F.struct("text", "signatures")).over(order)
    found = signed.withColumn("following", following).where("not guest")
    return found.select(
        "doc_id",
        "text",
        "signatures",
        F.col("following.text").alias("next_text"),
        F.col("following.signatures").alias("next_signatures"),
    )


def edited_text(text: str, following: str) -> Column:
    """The contract's edit: the last third replaced by the beginning of the next document."""
    third = F.expr(f"length({text}) div 3").cast("int")
    return F.concat(
        F.substring(text, F.lit(1), F.length(text) - third), F.substring(following, F.lit(1), third)
    )


def op11_spot_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fingerprint of every document and of its edited text, and how alike it is to that and to
    the next document.

    Null and empty texts have the empty fingerprint; two empty fingerprints are alike (1), one
    alone is unlike any other (0). Repeated rows are documents of their own; see ``with_next``.
    """
    docs = with_next(table(spark, sf_dir, "documents"))
    docs = docs.withColumn("edited", edited_text("text", "next_text"))
    docs = with_signatures(docs, edited_signatures="edited")
    return docs.select(
        "doc_id",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint("signatures").alias("fingerprint"),
        fingerprint("edited_signatures").alias("edited_fingerprint"),
        likeness("signatures", "edited_signatures").alias("near_edited"),
        likeness("signatures", "next_signatures").alias("near_next"),
    )


_ANCHOR_LIST = ", ".join(f"'{word}'" for word in ["", *ANCHORS])
OP11_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t,
         coalesce(lead(coalesce(text, '')) OVER (ORDER BY doc_id DESC),
                  first_value(coalesce(text, '')) OVER (ORDER BY doc_id DESC)) AS after
  FROM documents),
e AS (
  SELECT doc_id, t, after,
         t[1:length(t) - length(t) // 3] || CASE WHEN length(t) < 3 THEN '' ELSE after[1:length(t) // 3] END AS edited
  FROM d),
w AS (
  SELECT doc_id, kind, list_concat([''], regexp_extract_all(lower(x), '[\p{{L}}\p{{N}}\p{{M}}]+')) AS w
  FROM (SELECT doc_id, unnest(['own', 'edited', 'after']) AS kind, unnest([t, edited, after]) AS x FROM e)),
a AS (
  SELECT doc_id, kind, w,
         list_filter(range(1, len(w) + 1), lambda i: w[i] IN ({_ANCHOR_LIST})) AS places,
         list_filter(w, lambda x: x NOT IN ({_ANCHOR_LIST})) AS content
  FROM w),
s AS (
  SELECT doc_id, kind, coalesce(list_sort(list_distinct(list_transform(
           list_filter(range(1, len(places) + 1), lambda k: places[k] - k < len(content)),
           lambda k: md5(concat_ws(' ', w[places[k]], content[places[k] - k + 1],
                                   content[places[k] - k + 2]))[1:{DIGITS}]))), []) AS sig
  FROM a),
p AS (
  SELECT doc_id, any_value(sig) FILTER (kind = 'own') AS own, any_value(sig) FILTER (kind = 'edited') AS edit,
         any_value(sig) FILTER (kind = 'after') AS next
  FROM s GROUP BY doc_id)
SELECT e.doc_id, CAST(length(t) AS BIGINT) AS n_chars, sha256(edited) AS edited_sha256,
       coalesce(array_to_string(own, ''), '') AS fingerprint,
       coalesce(array_to_string(edit, ''), '') AS edited_fingerprint,
       CASE WHEN len(own) + len(edit) = 0 THEN 1.0::DOUBLE
            ELSE len(list_intersect(own, edit))::DOUBLE
                 / (len(own) + len(edit) - len(list_intersect(own, edit))) END AS near_edited,
       CASE WHEN len(own) + len(next) = 0 THEN 1.0::DOUBLE
            ELSE len(list_intersect(own, next))::DOUBLE
                 / (len(own) + len(next) - len(list_intersect(own, next))) END AS near_next
FROM e JOIN p USING (doc_id)
"""
