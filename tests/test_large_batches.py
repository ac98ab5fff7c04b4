"""Batches and loads of many documents with long texts: the texts are neither shuffled nor sorted."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_queries import SF_DIR
from test_wide_rows import moved

from check import compare, open_tables
from hiregrain.operators import skew
from hiregrain.plans import loading, registry
from hiregrain.schemas import CURATED_COLUMNS
from hiregrain.sources.lake import Layers, TableDocuments
from hiregrain.sources.places import semi_join_files


def documents(spark, count, days):
    empty = {name: F.lit(None).cast("string") for name in CURATED_COLUMNS}
    given = {
        "posting_id": F.concat(F.lit("p"), "id"),
        "description_text": F.repeat(F.lit("text "), (F.col("id") % 50).cast("int")),
        "curated_s3_key": F.concat(F.lit("k"), "id"),
        "dt": F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int")), "yyyy-MM-dd"),
    }
    return spark.range(0, count, 1, 3).select(*[c.alias(n) for n, c in {**empty, **given}.items()])


def same(found, wanted):
    names = wanted.columns
    return sorted(map(str, found.select(*names).collect())) == sorted(map(str, wanted.collect()))


@pytest.mark.parametrize("days", [3, 50])
def test_a_large_batch_is_written_where_its_rows_are(spark, tmp_path, days):
    rows, lake = documents(spark, 300, days), Layers(str(tmp_path)).curated
    before = spark.conf.get("spark.sql.maxConcurrentOutputFileWriters")
    replace(lake, gather_rows=299).write_batch(rows, "large", 0)
    files = spark.read.format("binaryFile").load(f"{lake.path}/dt=*/run=large/*/*.parquet")
    assert files.count() == 3 * days  # of each task, for each day
    replace(lake, gather_rows=300).write_batch(rows, "small", 0)
    files = spark.read.format("binaryFile").load(f"{lake.path}/dt=*/run=small/*/*.parquet")
    assert files.count() == days
    for run in ("large", "small"):
        assert same(lake.read(spark).where(F.col("run") == run), rows)
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == before


def test_a_load_of_more_keys_than_can_be_sent_moves_no_texts(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(skew.semi_join, "__defaults__", (0,))
    rows, lake = documents(spark, 300, 3), Layers(str(tmp_path)).curated
    lake.write_batch(rows, "r", 0)
    wanted = rows.where("crc32(posting_id) % 2 = 0").select(F.col("curated_s3_key").alias("s3_key"), "dt")
    found = TableDocuments(lake).read(spark, wanted)
    assert not moved(found, "description_text")
    assert same(found, rows.where("crc32(posting_id) % 2 = 0").select(*CURATED_COLUMNS))
    assert TableDocuments(lake).read(spark, wanted.withColumn("dt", F.lit("2023-01-01"))).count() == 0


def test_rows_of_files_are_chosen_by_their_places(spark, tmp_path):
    made = spark.range(0, 20_000, 1, 3).select(
        F.when(F.col("id") % 7 != 0, F.col("id") % 9_000).alias("a"), (F.col("id") % 2).alias("b"), "id"
    )
    made.write.parquet(f"{tmp_path}/a b+%")
    rows = spark.read.parquet(f"{tmp_path}/a b+%")
    keys = made.select("a", "b")
    for wanted in (keys.where("id % 64 = 63"), keys.where("a < 5000"), keys, keys.where("id < 0")):
        assert same(semi_join_files(rows, wanted, ["a", "b"]), rows.join(wanted, ["a", "b"], "left_semi"))


def test_staging_load_of_a_large_batch_equals_its_sql(spark, monkeypatch):
    monkeypatch.setattr(registry, "GATHER_ROWS", 0)
    monkeypatch.setattr(loading, "PACKED_ROWS", 0)
    rows, missing, extra = compare(spark, open_tables(SF_DIR), SF_DIR, "staging_load")
    assert rows and not missing and not extra
