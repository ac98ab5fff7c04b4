import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from hiregrain.llm.byte_bpe import encode_documents, encoded, source


@pytest.fixture(scope="module")
def reference():
    ranks = source().ranks
    coder = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )

    def digest(text):
        ids = coder.encode_ordinary(text or "")
        joined = ",".join(map(str, ids)).encode()
        return len(ids), *(hashlib.sha256(x).hexdigest() for x in (joined, (text or "").encode()))

    return digest


@pytest.mark.parametrize("chunk, overlap", [(200, 24), (1000, 100), (1 << 16, 1 << 10)])
def test_equals_the_library(spark, reference, chunk, overlap):
    draw = random.Random(4)
    texts = [
        None,
        "",
        "a" * 5000,
        " " * 3000 + "x",
        "it's we'll don't I'd 're " * 300,
        "日本語テキスト。 ١٢٣ " * 300,
        "word  \n\n  " * 500 + "'ve",
        "".join(draw.choice(" a'rel1\n\t.é𝄞 \x1ć") for _ in range(8000)),
        *["".join(chr(draw.choice([draw.randrange(32, 0x250), draw.randrange(0x370, 0xD800)])) for _ in range(900))] * 2,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = encoded(docs, chunk=chunk, overlap=overlap).select("row.text", "n_tokens", "ids_sha256", "decoded_sha256")
    rows = rows.collect()
    assert len(rows) == len(texts)
    for text, *found in rows:
        assert tuple(found) == reference(text)


def test_odd_rows(odd_docs, reference):
    rows = encode_documents(odd_docs).collect()
    texts = {row["doc_id"]: row["text"] for row in odd_docs.collect()}
    assert len(rows) == odd_docs.count()
    for row in rows:
        assert (row["n_tokens"], row["ids_sha256"], row["decoded_sha256"]) == reference(texts[row["doc_id"]])
        assert len(row["ids"]) == row["n_tokens"]
    assert encode_documents(odd_docs.where(F.lit(False))).count() == 0
