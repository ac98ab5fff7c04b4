"""What the operators share: stored steps, checked broadcasts, work on blocks of whole texts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes of text that a task works on at once; a longer text is a block of its own.
BLOCK_BYTES = 4 << 20
#: Rows that Spark hands to a task's Python at once; their texts are held twice, in Arrow and out.
BATCH_ROWS = 1000
#: Rows of a narrow table that may be broadcast; with more, the join shuffles.
BROADCAST_ROWS = 100_000


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; made up only where none is named, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = f"file://{tempfile.mkdtemp(prefix='shared-')}"
        spark.sparkContext.setCheckpointDir(named)
    return named


def stored(df: DataFrame) -> DataFrame:
    """``df`` kept in the shared folder, so that losing an executor repeats nothing before it."""
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a table in the shared folder: for what is too wide for ``stored``."""
    place = f"{shared_folder(df.sparkSession)}/step-{uuid.uuid4().hex}"
    df.write.parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)


def checked_broadcast(small: DataFrame, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``small`` with a broadcast hint if it has at most ``limit`` rows; otherwise as it is.

    Without the hint Spark shuffles both sides and splits the partitions of a hot key.
    """
    return F.broadcast(small) if small.limit(limit + 1).count() <= limit else small


def remainder(doc_id: str | Column, by: int) -> Column:
    """crc32 of an id as text, modulo ``by``; null for a null id."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(column.cast("string").cast("binary")) % by


def ranges(texts: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes of text."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    start = held = 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield start, row
            start, held = row, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes)


def small_batches(spark: SparkSession) -> None:
    """Makes the session's Arrow batches BATCH_ROWS rows, if they are larger."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def per_text(
    docs: DataFrame,
    worker: Callable[[], Callable[[list[bytes | None]], list[pa.Array]]],
    fields: str,
    limit: int = BLOCK_BYTES,
    path: tuple[str, ...] = ("text",),
    beside: str | None = None,
) -> DataFrame:
    """The rows of ``docs`` as a struct ``row``, with the ``fields`` worked out from their texts.

    ``worker()`` runs once in each task and returns a function that gives the arrays of the
    fields for a block of UTF-8 texts, which lie at ``path`` in ``row``. Extra columns of any
    name stay within ``row``. With ``beside``, the function also gets that column's values.
    """
    small_batches(docs.sparkSession)
    added = T.StructType.fromDDL(fields)
    schema = T.StructType([T.StructField("row", docs.schema), *added.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = None
        for batch in batches:
            rows = batch.column(0)
            texts = pc.struct_field(rows, list(path)).cast(pa.binary())
            for start, stop in ranges(texts, limit):
                work = work or worker()
                given = [texts.slice(start, stop - start).to_pylist()]
                if beside:
                    own = pc.struct_field(rows, [beside])
                    given.append(own.slice(start, stop - start).to_pylist())
                arrays = work(*given)
                yield pa.RecordBatch.from_arrays(
                    [rows.slice(start, stop - start), *arrays], names=schema.names
                )
        # The worker process goes on to other tasks; what this one held goes back.
        pa.default_memory_pool().release_unused()

    return docs.select(F.struct("*").alias("row")).mapInArrow(run, schema)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
