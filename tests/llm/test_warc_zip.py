import io
import zipfile

import pytest
from pyspark.sql import functions as F

from hiregrain.llm.common import shared_folder
from hiregrain.llm.warc_zip import (
    ZipWriter,
    archived,
    filesystem,
    members,
    record_ranges,
    records,
    round_trip,
    with_roles,
)

BIG = "<p>é</p>" * 400
ROWS = [
    (1, "http://a", BIG),
    (2, None, BIG),
    (3, "x\r\ny", None),
    (4, "u", ""),
    (None, "v", BIG),
    (5, "w", "<b>"),
    (6, "w", "<b>"),
    (7, "w", "\r\n\r\n" * 5),
    (7, "w", "x" * 2000),
    (7, "w", "x" * 2000),
]


class Opened(io.BytesIO):
    def size(self):
        return len(self.getvalue())

    def read_at(self, size, at):
        return self.getvalue()[at : at + size]


@pytest.mark.parametrize("zip64", [True, False])
def test_archive_form(zip64):
    out = io.BytesIO()
    writer = ZipWriter(out, zip64)
    files = {"archive/data-0.warc": b"a" * 999, "indexes/ü.cdx": b"", "z": bytes(range(256))}
    for name, data in files.items():
        writer.add(name, data)
    writer.close()
    raw = out.getvalue()
    # The standard library agrees, and a comment or bytes before do not confuse the reader.
    with zipfile.ZipFile(io.BytesIO(raw)) as archive:
        assert archive.testzip() is None
        assert {name: archive.read(name) for name in archive.namelist()} == files
    found = {m.name: raw[m.start : m.start + m.size] for m in members(Opened(raw))}
    assert found == files
    with pytest.raises(ValueError):
        members(Opened(raw[:-30]))


def test_reads_archives_of_others():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as archive:
        archive.comment = b"a comment"
        archive.writestr("one", b"1" * 50)
        with archive.open("two", "w", force_zip64=True) as member:
            member.write(b"2" * 70)
    raw = out.getvalue()
    found = {m.name: raw[m.start : m.start + m.size] for m in members(Opened(raw))}
    assert found == {"one": b"1" * 50, "two": b"2" * 70}


def test_round_trip(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string, html string")
    rows = [tuple(row) for row in round_trip(pages.withColumn("payload", F.lit("clash"))).collect()]
    kinds = sorted(((row[0], row[3], row[4]) for row in rows), key=repr)
    assert kinds == sorted(
        [(1, "revisit", 2), (2, "response", None), (None, "revisit", 2)]
        + [(k, "response", None) for k in (3, 4, 5, 6, 7, 7, 7)],
        key=repr,
    )
    assert sorted(row[1] for row in rows) == sorted(len((row[2] or "").encode()) for row in ROWS)
    assert round_trip(pages.where(F.lit(False))).count() == 0


def test_many_members_archives_and_ranges(spark):
    pages = spark.createDataFrame([(k, "u", "y" * (k % 700)) for k in range(400)], "page_id long, url string, html string")
    folder = f"{shared_folder(spark)}/test-archives-{spark.sparkContext.applicationId}"
    found = archived(with_roles(pages).coalesce(2), folder, member_bytes=2000, archive_bytes=9000)
    assert found.count() > 5 and found.agg(F.sum("records")).first()[0] == 400
    spans = record_ranges(found, folder, range_bytes=1500)
    assert spans.count() > 100
    rows = records(spans, folder)
    assert sorted(row["payload_bytes"] for row in rows.collect()) == sorted(k % 700 for k in range(400))
    store, place = filesystem(folder)
    store.delete_dir(place)
