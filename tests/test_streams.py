import json
from datetime import datetime

from pyspark.sql import functions as F

from hiregrain.operators.collecting import collect_jobs, iso_utc, seed_jobs, synthetic_jobs, topic_messages
from hiregrain.schemas import DLQ_EVENTS, PAGE_FETCH
from hiregrain.sources.lake import Layers
from hiregrain.sources.topics import FAILURE_TOPIC, FETCH_TOPIC, FolderTopics
from hiregrain.streaming.failures import Archive, FailureTrend, Replay
from hiregrain.streaming.worker import Worker

NOW = datetime(2026, 3, 24, 12)
URL = "https://www.wanted.co.kr/wd/"


def send(spark, topics, batch, *jobs):
    """Job dicts or raw bytes, in order, as one producer batch."""
    values = [job if isinstance(job, bytes) else json.dumps(job).encode() for job in jobs]
    rows = spark.createDataFrame([(None, bytearray(v)) for v in values], "key binary, value binary")
    topics.write(rows.coalesce(1), FETCH_TOPIC, "test", batch)


def job(job_id, page, **changes):
    return {"job_id": job_id, "source": "s", "url": URL + str(page),
            "collected_at": "2026-03-24T10:00:00Z", "retry_count": 0, **changes}


def setup(spark, tmp_path):
    topics = FolderTopics(str(tmp_path / "topics"))
    pages = [
        (URL + "1", "<title>[Co] One | 원티드</title><p>text</p>", None, None, None),
        (URL + "2", None, "ReadTimeout", None, None),
    ]
    frame = spark.createDataFrame(pages, PAGE_FETCH)
    frame.write.parquet(str(tmp_path / "pages"))
    layers = Layers(str(tmp_path / "lake"))
    worker = Worker(
        layers, topics, lambda s: s.read.parquet(str(tmp_path / "pages")), clock=lambda: NOW
    )
    return topics, layers, worker


def work(spark, worker, tmp_path):
    worker.start(spark, str(tmp_path / "checkpoint"), availableNow=True).awaitTermination()


def outcomes(spark, layers):
    rows = layers.outcomes.read(spark).groupBy("outcome").agg(F.sum("message_count").alias("n"))
    return {r.outcome: r.n for r in rows.collect()}


def test_worker_loop(spark, tmp_path):
    topics, layers, worker = setup(spark, tmp_path)
    send(spark, topics, 0, b"junk", job("a", 1), job("a", 1), job("b", 2), job("c", 9))
    work(spark, worker, tmp_path)
    assert outcomes(spark, layers) == {
        "malformed": 1, "success": 1, "duplicate": 1, "fetch_failed": 2
    }
    curated = layers.curated.read(spark).collect()
    assert [(r.posting_id, r.company_name, r.title, r.dt) for r in curated] == [
        ("a", "Co", "One", "2026-03-24")
    ]
    raw, processed = layers.raw.read(spark).first(), layers.processed.read(spark).first()
    assert raw.html.startswith("<title>") and raw.source == "s"
    assert (processed.html_length, processed.processed_at) == (len(raw.html), NOW)

    # Nothing new: nothing happens. A replayed job: no second document.
    work(spark, worker, tmp_path)
    send(spark, topics, 1, job("a", 1), job("d", 1))
    work(spark, worker, tmp_path)
    assert sorted(r.posting_id for r in layers.curated.read(spark).collect()) == ["a", "d"]
    assert outcomes(spark, layers)["duplicate"] == 2

    # Redoing the last batch, as after a crash before its commit, changes nothing.
    before = sorted(map(str, layers.curated.read(spark).collect()))
    batch = topics.read(spark, FETCH_TOPIC).where("partition = 1")
    run = json.loads((tmp_path / "checkpoint" / "metadata").read_text())["id"]
    worker.process(batch, 1, run)
    assert sorted(map(str, layers.curated.read(spark).collect())) == before
    assert outcomes(spark, layers)["duplicate"] == 2

    # Failures: archive them, send them back, and stop after three attempts.
    archive = Archive(str(tmp_path / "wh"), topics, clock=lambda: NOW)
    replay = Replay(str(tmp_path / "wh"), topics)
    for _ in range(4):
        replay.run(spark, str(tmp_path / "replay"))
        work(spark, worker, tmp_path)
    archive.start(spark, str(tmp_path / "archive"), availableNow=True).awaitTermination()
    events = archive.events.read(spark)
    tried = {(r.url, r.retry_count) for r in events.where("failed_stage = 'fetch'").collect()}
    assert tried == {(URL + page, n) for page in ("2", "9") for n in (1, 2, 3)}
    decisions = replay.counts.read(spark).groupBy("decision").agg(F.sum("message_count").alias("n"))
    counted = {r.decision: r.n for r in decisions.collect()}
    # The redone batch repeated its failures on the topic; its jobs failed nowhere else.
    assert counted == {"replayed": 4, "retry_limit": 2, "no_job": 1}
    first = events.orderBy("failed_at").first()
    assert json.loads(first.payload)["failed_stage"] == first.failed_stage


def test_archive_sets_unreadable_messages_apart(spark, tmp_path):
    topics = FolderTopics(str(tmp_path / "topics"))
    good = b'{"job": null, "failed_stage": "fetch", "error_type": "x"}'
    rows = [(None, bytearray(v)) for v in (b"no", b"[1]", good, b'{"failed_at": null, "job": {"retry_count": null}}')]
    topics.write(spark.createDataFrame(rows, "key binary, value binary"), FAILURE_TOPIC, "t", 0)
    archive = Archive(str(tmp_path / "wh"), topics, clock=lambda: NOW)
    archive.start(spark, str(tmp_path / "c"), availableNow=True).awaitTermination()
    events = {r.failed_stage: r for r in archive.events.read(spark).collect()}
    assert events["fetch"].failed_at == "2026-03-24T12:00:00.000000Z"
    assert (events["fetch"].retry_count, events["fetch"].url) == (0, None)
    assert (events[None].failed_at, events[None].retry_count) == (None, None)
    assert archive.quarantine.read(spark).count() == 2


def test_two_workers_and_a_fresh_checkpoint_lose_and_double_nothing(spark, tmp_path):
    topics, layers, worker = setup(spark, tmp_path)
    send(spark, topics, 0, job("a", 1), b"junk")
    work(spark, worker, tmp_path)
    # Another topic and checkpoint, the same lake and worker name: its first batch is 0 too.
    others = FolderTopics(str(tmp_path / "others"))
    second = Worker(layers, others, worker.pages, clock=lambda: NOW)
    send(spark, others, 0, job("b", 1), job("a", 1))
    second.start(spark, str(tmp_path / "checkpoint-2"), availableNow=True).awaitTermination()
    # A fresh checkpoint reads the first topic again.
    worker.start(spark, str(tmp_path / "checkpoint-3"), availableNow=True).awaitTermination()
    for table in (layers.curated, layers.raw, layers.processed):
        ids = [r[0] for r in table.read(spark).select(table.schema.fieldNames()[0]).collect()]
        assert sorted(ids) == ["a", "b"]
    assert outcomes(spark, layers) == {"success": 2, "duplicate": 2, "malformed": 2}
    assert {bytes(r.value) for r in layers.malformed.read(spark).collect()} == {b"junk"}


def test_one_raw_row_per_identity_and_nothing_stale_when_a_batch_is_redone(spark, tmp_path):
    topics, layers, worker = setup(spark, tmp_path)
    broken = '<script type="application/ld+json">{"@type":"JobPosting","title":[1]}</script>'
    pages = [(URL + "1", "<title>One</title>", None, None, None), (URL + "3", broken, None, None, None)]
    spark.createDataFrame(pages, PAGE_FETCH).write.mode("overwrite").parquet(str(tmp_path / "pages"))
    other_day = {"collected_at": "2026-03-25T10:00:00Z"}
    send(spark, topics, 0, job("a", 3), job("a", 3), job("a", 1), job("c", 1, **other_day))
    layers.create(spark)
    batch = topics.read(spark, FETCH_TOPIC)
    worker.process(batch, 0)
    raw = layers.raw.read(spark).collect()
    assert sorted((r.job_id, r.html) for r in raw) == [("a", pages[0][1]), ("c", pages[0][1])]
    assert layers.processed.read(spark).count() == 2
    # The page of the second day's job is gone when the batch is done again.
    worker.process(batch.where("value not like '%2026-03-25%'"), 0)
    assert [r.posting_id for r in layers.curated.read(spark).collect()] == ["a"]
    assert [r.job_id for r in layers.raw.read(spark).collect()] == ["a"]


def test_failure_trend_counts_every_event(spark, tmp_path):
    source = str(tmp_path / "events")
    times = [f"2026-03-24T{h:02d}:30:00Z" for h in (8, 8, 9, 12)] + ["no time", None]
    rows = [(time, "fetch", "dns_error", None, 0, None, None, None) for time in times]
    spark.createDataFrame(rows, DLQ_EVENTS).write.parquet(source)
    stream = spark.readStream.schema(DLQ_EVENTS).parquet(source)
    trend = FailureTrend(str(tmp_path / "trend"))
    trend.start(stream, str(tmp_path / "c"), availableNow=True).awaitTermination()
    late = [("2026-03-24T08:59:00Z", "fetch", "dns_error", None, 0, None, None, None)]
    spark.createDataFrame(late, DLQ_EVENTS).write.mode("append").parquet(source)
    trend.start(stream, str(tmp_path / "c"), availableNow=True).awaitTermination()
    found = trend.read(spark).orderBy("failed_hour").collect()
    hours = [(r.failed_hour and r.failed_hour.hour, r.event_count) for r in found]
    assert hours == [(None, 2), (8, 3), (9, 1), (12, 1)]


def test_collected_jobs_are_all_links_or_the_first_and_survive_a_rerun(spark):
    links = "".join(f'<a href="/wd/{n}">x</a>' for n in range(30))
    pages = spark.createDataFrame([("wanted", links), ("wanted", links), ("other", links)], "site string, html string")
    time = iso_utc(F.lit(NOW).cast("timestamp"))
    jobs = collect_jobs(pages, "wanted", "run", time, 20)
    rows = jobs.orderBy("url").collect()
    assert [r.url for r in rows] == sorted(f"{URL}{n}" for n in range(30))[:20]
    assert {r.collected_at for r in rows} == {"2026-03-24T12:00:00.000000Z"}
    assert {r.job_id for r in collect_jobs(pages, "wanted", "run", time, 20).collect()} == {r.job_id for r in rows}
    assert collect_jobs(pages, "wanted", "run", time).count() == 30
    value = json.loads(bytes(topic_messages(jobs).first().value))
    assert list(value) == ["job_id", "source", "url", "collected_at", "retry_count"]


def test_seed_and_synthetic_jobs(spark):
    time = F.lit("t")
    assert seed_jobs(spark, "r", time).count() == 5
    tests = spark.createDataFrame([(n, n >= 7) for n in range(10)], "ordinal long, fails boolean")
    rows = synthetic_jobs(tests, "r", time).collect()
    assert len({r.job_id for r in rows}) == 10
    urls = [r.url for r in rows]
    assert urls.count("https://www.wanted.co.kr/wd/242151") == 3
    assert urls.count("https://invalid-url-test-1234.com") == 1
