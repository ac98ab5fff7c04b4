"""The registered queries against their SQL, their contracts and the pipeline's stages."""

import os

import pytest

import corpus_pipeline
from __spark_entry__ import queries
from check import compare, open_tables
from hiregrain.llm.byte_bpe import encoded
from hiregrain.llm.common import remainder, table
from hiregrain.llm.decontamination import searched
from hiregrain.llm.quality import quality_rules
from hiregrain.llm.queries import ORACLES, QUERIES
from hiregrain.llm.simhash import near_duplicates
from hiregrain.llm.toxicity import THRESHOLD, fit, scored

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


def test_every_number_is_registered_once():
    numbers = [int(name.split("_")[0][2:]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14)) and {*QUERIES, "pipeline"} <= set(queries())


@pytest.mark.parametrize("name", list(ORACLES))
def test_equals_its_sql(spark, name):
    rows, missing, extra = compare(spark, open_tables(SF_DIR), SF_DIR, name)
    assert rows > 0 and not missing and not extra


@pytest.mark.parametrize("name", [name for name in QUERIES if name not in ORACLES])
def test_one_row_for_each_document(spark, name):
    found = QUERIES[name](spark, SF_DIR).select("doc_id")
    docs = table(spark, SF_DIR, "documents").select("doc_id")
    assert found.exceptAll(docs).count() == docs.exceptAll(found).count() == 0


def test_pipeline_equals_its_stages_by_hand(spark):
    docs = table(spark, SF_DIR, "documents")

    def only(ids):
        return docs.where(docs["doc_id"].isin([row["doc_id"] for row in ids.collect()]))

    left = only(quality_rules(docs).where("kept").select("doc_id"))
    model = fit(left, table(spark, SF_DIR, "labels"), remainder("doc_id", 3) != 1)
    left = only(scored(left, model).where(f"score < {THRESHOLD}").select("row.doc_id"))
    left = only(near_duplicates(left).where("doc_id = component_id").select("doc_id"))
    benchmark = table(spark, SF_DIR, "benchmark")
    left = only(searched(left, benchmark).where("not contaminated").select("row.doc_id"))
    names = ["n_tokens", "ids_sha256", "decoded_sha256"]
    expected = encoded(left).select("row.doc_id", *names)
    found = corpus_pipeline.run(spark, SF_DIR).select("doc_id", *names)
    assert found.count() == expected.count() > 0
    assert found.exceptAll(expected).count() == 0


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF_DIR, "documents")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).columns == docs.columns
