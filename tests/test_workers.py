"""Workers at the same time, loads of what they leave, and rules that change afterwards."""

from dataclasses import replace
from datetime import datetime, timedelta

from pyspark.sql import functions as F
from test_streams import NOW, job, outcomes, send, setup, work

from hiregrain.operators.sites import SITES
from hiregrain.plans.backfill import backfill
from hiregrain.plans.clean import CleanPostings
from hiregrain.plans.loading import Staging, load_increment
from hiregrain.plans.warehouse import compact_closed_days
from hiregrain.schemas import CURATED_COLUMNS
from hiregrain.sources import lake
from hiregrain.sources.lake import Layers, TableDocuments
from hiregrain.sources.tables import Table
from hiregrain.sources.topics import FETCH_TOPIC
from hiregrain.streaming.worker import Worker


def test_two_workers_over_the_same_messages_leave_one_of_each(spark, tmp_path):
    topics, layers, first = setup(spark, tmp_path)
    layers.create(spark)
    send(spark, topics, 0, *[job(f"j{k}", 1) for k in range(5)], job("j0", 1), b"junk")
    messages = topics.read(spark, FETCH_TOPIC)
    second = Worker(layers, topics, first.pages, clock=lambda: NOW + timedelta(minutes=1), name="second")
    judged = first.routed(messages, 0, "a")
    second.process(messages, 0, "b")
    first.store(*judged, "a", 0)
    wanted = [f"j{k}" for k in range(5)]
    for rows, name in (
        (layers.documents(spark), "posting_id"),
        (layers.raw_pages(spark), "job_id"),
        (layers.processed_pages(spark), "job_id"),
    ):
        found = rows.collect()
        assert sorted(row[name] for row in found) == wanted and {row["run"] for row in found} == {"b"}
    assert outcomes(spark, layers) == {"success": 10, "duplicate": 2, "malformed": 2}
    target = Staging(str(tmp_path / "wh")).create(spark)
    source = TableDocuments(layers.curated, layers.commits)
    assert load_increment(spark, source, target, NOW) == 5
    assert sorted(r.posting_id for r in target.postings(spark).collect()) == wanted
    # Without commits, too, repeated keys block nothing.
    other = Staging(str(tmp_path / "other")).create(spark)
    assert load_increment(spark, TableDocuments(layers.curated), other, NOW) == 5
    assert load_increment(spark, source, target, NOW) == 0


def test_a_change_of_rules_reaches_the_marts_without_a_fetch(spark, tmp_path):
    topics, layers, worker = setup(spark, tmp_path)
    send(spark, topics, 0, job("a", 1), job("b", 1, collected_at="2026-03-25T10:00:00Z", source="t"))
    work(spark, worker, tmp_path)
    source, target = TableDocuments(layers.curated, layers.commits), Staging(str(tmp_path / "wh")).create(spark)
    clean = CleanPostings(str(tmp_path / "clean"), 2)

    def titles():
        return {r.posting_id: (r.title, r.company_name) for r in clean.read(spark).collect()}

    assert load_increment(spark, source, target, NOW) == 2
    clean.advance(spark, target)
    assert titles() == {"a": ("One", "Co"), "b": ("One", "Co")}
    old = SITES[0]
    new = replace(old, fields=lambda: replace(old.fields(), company_name=F.lit("New")))
    changed = (new, *SITES[1:])
    backfill(spark, layers, 1, NOW + timedelta(hours=1), changed)
    backfill(spark, layers, 1, NOW + timedelta(hours=1), changed)  # again: nothing comes twice
    assert layers.documents(spark).count() == 2
    assert load_increment(spark, source, target, datetime(2026, 3, 24, 13)) == 2
    clean.advance(spark, target)
    assert titles() == {"a": ("One", "New"), "b": ("One", "New")}
    assert clean.daily(spark).agg(F.sum("posting_count")).first()[0] == 2
    assert target.postings(spark).count() == 4
    assert load_increment(spark, source, target, NOW) == 0
    # A worker that goes on under the old rules does not bring the old documents back.
    layers.write_documents(
        layers.documents(spark).where("posting_id = 'a'").withColumn("company_name", F.lit("Old")), 0, NOW, "late", 0
    )
    assert {r.company_name for r in layers.documents(spark).collect()} == {"New"}
    assert load_increment(spark, source, target, NOW) == 0


def documents_of(spark, *numbers, title="t"):
    names = ", ".join(f"{n} string" for n in CURATED_COLUMNS)
    rows = [tuple(document(i, title)[n] for n in CURATED_COLUMNS) for i in numbers]
    return spark.createDataFrame(rows, names).withColumn("dt", F.lit("2026-03-24"))


def document(number, title):
    own = {n: None for n in CURATED_COLUMNS}
    return own | {
        "posting_id": f"p{number}",
        "source": "s",
        "original_url": f"u{number}",
        "title": title,
        "collected_at": "2026-03-24T12:00:00",
        "content_hash": f"h{number}",
        "raw_s3_key": f"r{number}",
        "processed_s3_key": f"q{number}",
        "curated_s3_key": f"curated/job_postings/dt=2026-03-24/p{number}.json",
    }


def test_closed_days_are_put_together_without_losing_a_document(spark, tmp_path):
    topics, layers, worker = setup(spark, tmp_path)
    layers.create(spark)
    target = Staging(str(tmp_path / "wh")).create(spark)
    source = TableDocuments(layers.curated, layers.commits)
    day, since = "2026-03-24", "2026-03-24"
    layers.write_documents(documents_of(spark, 1, 2), 1, NOW, "a", 0)
    layers.write_documents(documents_of(spark, 2, 3, title="later"), 1, NOW + timedelta(minutes=1), "a", 1)
    assert load_increment(spark, source, target, NOW) == 3
    # Not loaded yet when its day is put together; and one that no commit names stays as it is.
    layers.write_documents(documents_of(spark, 4), 1, NOW + timedelta(minutes=2), "b", 0)
    layers.curated.write_batch(documents_of(spark, 5), "c", 0)
    shown = sorted(map(str, layers.documents(spark).drop("run", "batch_id").collect()))
    later = NOW + timedelta(days=1)
    assert layers.closed_days(spark, since, day) == []
    assert compact_closed_days(spark, layers, since, "2026-03-25", later) == 3
    runs = {run for run, _ in layers.curated.folders(spark, day).values()}
    assert len(runs) == 2 and "c" in runs
    assert sorted(map(str, layers.documents(spark).drop("run", "batch_id").collect())) == shown
    # Of an identity that was written twice the last row is left.
    titles = [row.title for row in layers.curated.read(spark).where("posting_id = 'p2'").collect()]
    assert titles == ["later"]
    assert load_increment(spark, source, target, later) == 1
    assert target.postings(spark).count() == 4
    # A day that is one batch stays so; one with a late document is put together again.
    assert compact_closed_days(spark, layers, since, "2026-03-25", later) == 0
    layers.write_documents(documents_of(spark, 6), 1, later, "d", 0)
    assert compact_closed_days(spark, layers, since, "2026-03-25", later + timedelta(hours=1)) == 2
    assert load_increment(spark, source, target, later) == 1
    assert target.postings(spark).count() == 5


def test_an_interrupted_compaction_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    _, layers, _ = setup(spark, tmp_path)
    layers.create(spark)
    target = Staging(str(tmp_path / "wh")).create(spark)
    layers.write_documents(documents_of(spark, 1), 1, NOW, "a", 0)
    layers.write_documents(documents_of(spark, 2), 1, NOW, "a", 1)

    def broken(*_):
        raise OSError("lost")

    for step in ("delete", "write"):
        with monkeypatch.context() as patch:
            if step == "delete":
                patch.setattr(lake, "delete", broken)
            else:
                unwritable = Unwritable(**vars(layers.commits))
                patch.setattr(Layers, "commits", property(lambda self: unwritable))
            try:
                compact_closed_days(spark, layers, "2026-03-24", "2026-03-25", NOW)
            except OSError:
                pass
        assert layers.documents(spark).count() == 2
    assert compact_closed_days(spark, layers, "2026-03-24", "2026-03-25", NOW) > 0
    assert layers.curated.read(spark).count() == 2 and len(layers.curated.folders(spark, "2026-03-24")) == 1
    source = TableDocuments(layers.curated, layers.commits)
    assert load_increment(spark, source, target, NOW) == 2


class Unwritable(Table):
    def write_batch(self, *_):
        raise OSError("lost")
