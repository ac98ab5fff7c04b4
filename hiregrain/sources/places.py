"""Rows of files chosen by where they lie: a bit for each is sent, and no wide row is moved."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hiregrain.operators.skew import checked_broadcast
from hiregrain.session import cut

#: Rows of a file whose bits are sent as one row, in words of 64.
BLOCK, WORD = 4096, 64


def semi_join_files(rows: DataFrame, wanted: DataFrame, names: Sequence[str]) -> DataFrame:
    """``rows LEFT SEMI JOIN wanted`` for wide ``rows`` as files hold them, however many are wanted.

    The join is made on ``names`` alone and finds the places of rows, file and number; a bit for
    each row of a block is stored and sent. Only ``names`` and places are shuffled. Nulls in
    ``names`` match nothing. Files are those listed for ``rows``: what is written later is not seen.
    """
    number = F.col("_metadata.row_index")
    place = {"_file": F.col("_metadata.file_path"), "_block": F.floor(number / BLOCK)}
    word, bit = F.floor(number % BLOCK / WORD).cast("int"), (number % WORD).cast("int")
    placed = rows.withColumns({**place, "_word": word, "_bit": bit})
    met = placed.join(wanted.select(*names), list(names), "left_semi")
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_bit"))
    words = met.groupBy(*place, "_word").agg(F.bit_or(one).alias("_bits"))
    blocks = words.groupBy(*place).agg(
        F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_words")
    )
    found = placed.join(checked_broadcast(cut(blocks)), list(place))
    bits = F.coalesce(F.try_element_at("_words", F.col("_word")), F.lit(0).cast("long"))
    return found.where(F.getbit(bits, F.col("_bit")) == 1).select(*rows.columns)
