"""Rows with long texts are chosen by their keys and moved only once they are chosen."""

from datetime import datetime

import pyarrow as pa
from pyspark.sql import functions as F

from hiregrain.operators.latest import clean_postings, latest_rows, merge_latest
from hiregrain.operators.skew import semi_join
from hiregrain.plans.loading import Staging, load_increment
from hiregrain.schemas import STAGING_COLUMNS
from hiregrain.session import cut, pin
from hiregrain.sources.lake import Layers, TableDocuments


def postings(spark, count=400):
    """Stored rows of 40 postings; the newest of some is there twice, with another text."""
    given = {
        "posting_id": F.concat(F.lit("p"), F.col("id") % 200),
        "source": F.when(F.col("id") % 5 != 3, "s"),
        "original_url": F.concat(F.lit("u"), F.col("id") % 40),
        "description_text": F.repeat(F.lit("text "), F.col("id").cast("int")),
        "content_hash": F.sha2(F.col("id").cast("string"), 256),
        "collected_at": F.timestamp_seconds(F.col("id") % 200 - F.col("id") % 3 * 100),
        "loaded_at": F.lit(datetime(2024, 1, 1)),
    }
    empty = {name: F.lit(None).cast("string") for name in STAGING_COLUMNS if name not in given}
    return spark.range(count).select(*[{**given, **empty}[name].alias(name) for name in STAGING_COLUMNS])


def nodes(plan):
    yield plan
    for k in range(plan.children().size()):
        yield from nodes(plan.children().apply(k))


def moved(rows, column):
    """Windows, and joins that no side is sent whole for, that ``column`` goes into."""
    plan = rows._jdf.queryExecution().optimizedPlan()
    wide = [n for n in nodes(plan) if column in n.output().mkString(",")]
    return [
        n.nodeName()
        for n in wide
        if n.nodeName() == "Window"
        or (n.nodeName() == "Join" and "broadcast" not in n.hint().toString())
    ]


def same(found, wanted):
    found, wanted = (sorted(map(tuple, f.select(*STAGING_COLUMNS).collect()), key=str) for f in (found, wanted))
    return found == wanted


def test_latest_rows_do_not_move_their_texts(spark, tmp_path):
    postings(spark, 200).write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    clean = clean_postings(rows)
    assert not moved(clean, "description_text") and same(clean, latest_rows(rows))
    late = F.col("collected_at") > F.timestamp_seconds(F.lit(0))
    merged = merge_latest(clean_postings(rows.where(~late)), rows.where(late))
    assert not moved(merged, "description_text") and same(merged, latest_rows(rows))


def test_ties_and_null_keys_have_one_row(spark):
    rows = postings(spark)
    assert same(clean_postings(rows), latest_rows(rows))
    assert same(merge_latest(clean_postings(rows.where("loaded_at IS NULL")), rows), latest_rows(rows))


def test_semi_join_of_wide_rows(spark):
    rows = postings(spark).where("source IS NOT NULL")
    wanted = rows.select("posting_id").where("posting_id < 'p15'").distinct()
    for limit in (10**6, 0):
        assert same(semi_join(rows, wanted, ["posting_id"], limit), rows.join(wanted, "posting_id", "left_semi"))
    assert not moved(semi_join(rows, wanted, ["posting_id"]), "description_text")


def test_a_load_moves_and_stores_no_texts(spark, tmp_path):
    documents = postings(spark, 200).where("source IS NOT NULL").withColumns(
        {
            "collected_at": F.date_format("collected_at", "yyyy-MM-dd'T'HH:mm:ss"),
            "curated_s3_key": F.concat(F.lit("k"), "posting_id"),
            "raw_s3_key": F.lit("r"),
            "processed_s3_key": F.lit("p"),
            "dt": F.lit("2024-01-01"),
        }
    )
    lake, target = Layers(str(tmp_path)).curated, Staging(str(tmp_path)).create(spark)
    lake.write_batch(documents, "r", 0)
    stored = []

    def keep(rows):
        stored.append(rows)
        return cut(rows)

    assert load_increment(spark, TableDocuments(lake), target, datetime(2024, 2, 1), keep) == 160
    assert not any("description_text" in rows.columns for rows in stored)
    again = TableDocuments(lake).read(spark, target.loaded_keys.read(spark).withColumn("dt", F.lit("2024-01-01")))
    assert not moved(again, "description_text") and again.count() == 160


def test_python_workers_get_few_pages_at_a_time(spark):
    @F.arrow_udf("long")
    def at_once(values: pa.Array) -> pa.Array:
        return pa.array([len(values)] * len(values), pa.int64())

    rows = pin(spark).range(0, 2000, 1, 1).select(at_once("id").alias("n"))
    assert rows.agg(F.max("n")).first()[0] <= 250
