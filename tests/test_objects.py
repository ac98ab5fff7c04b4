"""Many small objects: how they are put, and how many of them a task reads."""

import json
import shutil

from check import open_tables
from pyspark.sql import functions as F
from test_warehouse import T0, document, put

from hiregrain.plans import standins
from hiregrain.plans.loading import Staging, load_increment
from hiregrain.plans.oracles import ORACLES
from hiregrain.plans.registry import QUERIES
from hiregrain.schemas import CURATED_COLUMNS
from hiregrain.sources.lake import CURATED_PREFIX, ObjectDocuments

SF_DIR = "/root/testdata/sf0.001"


def test_small_objects_are_read_many_to_a_task(spark, tmp_path):
    put(tmp_path / "lake", *[document(i, dt=f"2026-03-{1 + i % 3:02d}") for i in range(400)])
    source, target = ObjectDocuments(str(tmp_path / "lake")), Staging(str(tmp_path / "wh")).create(spark)
    cores = spark.sparkContext.defaultParallelism
    keys = source.keys(spark)
    assert keys.rdd.getNumPartitions() <= cores
    assert source.read(spark, keys).rdd.getNumPartitions() <= cores
    assert load_increment(spark, source, target, T0) == 400
    assert len(list((tmp_path / "wh" / "stg_job_postings").rglob("part-*.parquet"))) <= cores
    put(tmp_path / "lake", document(400))
    assert load_increment(spark, source, target, T0) == 1


def test_every_posting_is_put_once_into_an_object_of_its_own(spark, tmp_path):
    # The first two share an id, the third has no day; nulls are left out as in Spark's JSON.
    texts = ['two\nlines, "quoted"', "x", "é中\U0001f600"]
    rows = [
        {**document(1), "description_text": texts[0], "dt": "2026-03-24"},
        {**document(1, original_url="u2", title=None), "description_text": texts[1], "dt": "2026-03-24"},
        {**document(2), "description_text": texts[2], "dt": None},
    ]
    names = [*CURATED_COLUMNS, "dt"]
    given = [tuple(row[name] for name in names) for row in rows]
    documents = spark.createDataFrame(given, ", ".join(f"{name} string" for name in names))
    root = tmp_path / "lake with space+plus"
    place = root / CURATED_PREFIX
    for folder in (f"file://{place}", str(place)):
        assert standins.put_objects(documents, folder) == 3
    assert standins.put_objects(documents.where("false"), str(place)) == 0
    files = [path for path in place.rglob("*") if path.is_file()]
    assert len(files) == 3 and all(path.suffix == ".json" for path in files)
    found = {json.loads(path.read_text())["description_text"] for path in files}
    assert found == set(texts)
    assert sorted(len(json.loads(path.read_text())) for path in files)[0] < len(CURATED_COLUMNS)
    source = ObjectDocuments(str(root))
    back = source.read(spark, source.keys(spark)).select(*CURATED_COLUMNS)
    assert sorted(map(tuple, back.collect()), key=str) == sorted((row[:-1] for row in given), key=str)


def test_a_posting_seen_twice_is_one_object(spark, tmp_path):
    for name in ("documents", "benchmark"):
        shutil.copy(f"{SF_DIR}/{name}.parquet", tmp_path)
    events = spark.read.parquet(f"{SF_DIR}/events.parquet")
    again = events.withColumn("ts", F.col("ts") - F.expr("INTERVAL 1 DAY"))
    events.unionByName(again).coalesce(1).write.parquet(f"{tmp_path}/parts")
    (part,) = (tmp_path / "parts").glob("part-*.parquet")
    shutil.copy(part, tmp_path / "events.parquet")
    found = QUERIES["staging_load_objects"](spark, str(tmp_path))
    database = open_tables(SF_DIR)
    database.execute(f"CREATE OR REPLACE VIEW events AS FROM read_parquet('{tmp_path}/events.parquet')")
    names = ", ".join(found.columns)
    truth = database.sql(f"SELECT {names} FROM ({ORACLES['staging_load_objects']})").fetchall()
    assert sorted(map(tuple, found.collect()), key=str) == sorted(truth, key=str)
