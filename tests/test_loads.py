"""Loads that are interrupted, overtaken or repeated; the clean table by buckets; views that turn."""

import shutil
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F
from test_warehouse import T0, document, put, row, staging

from hiregrain.operators.latest import clean_postings
from hiregrain.operators.marts import mart_daily, mart_source_quality
from hiregrain.plans import loading
from hiregrain.plans.clean import CleanPostings, VersionConflict
from hiregrain.plans.loading import Staging, load_increment
from hiregrain.plans.warehouse import (
    CLEAN_VIEW,
    DAILY_VIEW,
    QUALITY_VIEW,
    hourly_run,
    housekeeping,
    publish,
    run_checks,
)
from hiregrain.schemas import CURATED_COLUMNS
from hiregrain.sources.lake import Layers, ObjectDocuments, TableDocuments
from hiregrain.sources.loads import LoadConflict, Loads, LoadTable
from hiregrain.sources.tables import put_if_absent


def documents_frame(spark, *numbers, **changes):
    rows = [tuple(document(i, **changes)[n] for n in CURATED_COLUMNS) for i in numbers]
    names = ", ".join(f"{n} string" for n in CURATED_COLUMNS)
    return spark.createDataFrame(rows, names).withColumn("dt", F.lit("2026-03-24"))


class Crash(Exception):
    pass


@pytest.mark.parametrize("writes", [0, 1, 2, 3])
def test_a_crash_between_any_two_steps_neither_loses_nor_doubles(spark, tmp_path, monkeypatch, writes):
    layers, target = Layers(str(tmp_path / "lake")).create(spark), Staging(str(tmp_path / "wh")).create(spark)
    source = TableDocuments(layers.curated, layers.commits)
    layers.write_documents(documents_frame(spark, 1), 0, T0, "r", 0)
    assert load_increment(spark, source, target, T0) == 1
    bad = documents_frame(spark, 4).withColumn("source", F.lit(None).cast("string"))
    layers.write_documents(documents_frame(spark, 2, 3).unionByName(bad), 0, T0, "r", 1)
    done, real = [], LoadTable.put

    def put_some(self, rows, note):
        if len(done) == writes:
            raise Crash
        done.append(self.path)
        real(self, rows, note)

    monkeypatch.setattr(LoadTable, "put", put_some)
    with pytest.raises(Crash):
        load_increment(spark, source, target, T0)
    monkeypatch.setattr(LoadTable, "put", real)

    def before_publishing(self, spark, note):
        raise Crash

    monkeypatch.setattr(Loads, "publish", before_publishing)
    with pytest.raises(Crash):
        load_increment(spark, source, target, T0)
    monkeypatch.undo()
    assert target.postings(spark).count() == target.loaded_keys.read(spark).count() == 1
    assert load_increment(spark, source, target, T0) == 2
    assert load_increment(spark, source, target, T0) == 0
    assert sorted(r.posting_id for r in target.postings(spark).collect()) == ["p1", "p2", "p3"]
    assert target.loaded_keys.read(spark).count() == 3 and target.quarantine.read(spark).count() == 1
    assert target.sweep(spark) == writes + 4
    assert target.postings(spark).count() == 3


def test_of_two_loads_at_once_one_is_refused(spark, tmp_path, lake, monkeypatch):
    put(lake, document(1))
    target, source = Staging(str(tmp_path / "wh")).create(spark), ObjectDocuments(str(lake))
    real = loading._write

    def overtaken(*args):
        monkeypatch.setattr(loading, "_write", real)
        assert load_increment(spark, source, target, T0) == 1
        return real(*args)

    monkeypatch.setattr(loading, "_write", overtaken)
    with pytest.raises(LoadConflict):
        load_increment(spark, source, target, T0)
    assert target.postings(spark).count() == 1
    assert load_increment(spark, source, target, T0) == 0


@pytest.fixture
def lake(tmp_path):
    root = tmp_path / "objects"
    root.mkdir()
    return root


def test_put_if_absent(spark, tmp_path):
    place = str(tmp_path / "note")
    assert put_if_absent(spark, place, "one") and not put_if_absent(spark, place, "two")
    assert (tmp_path / "note").read_text() == "one"
    assert [p.name for p in tmp_path.iterdir() if not p.name.endswith(".crc")] == ["note"]


def test_loads_by_commits_take_late_and_repeated_documents(spark, tmp_path):
    layers, target = Layers(str(tmp_path / "lake")).create(spark), Staging(str(tmp_path / "wh")).create(spark)
    source = TableDocuments(layers.curated, layers.commits)
    day = timedelta(days=1)
    assert load_increment(spark, source, target, T0) == 0
    layers.write_documents(documents_frame(spark, 1, 2), 0, T0, "a", 0)
    # A batch that overlaps documents 2 again, and a folder without a commit is no batch yet.
    layers.write_documents(documents_frame(spark, 2, 3, title="later"), 0, T0 + day, "b", 0)
    layers.curated.write_batch(documents_frame(spark, 9), "c", 0)
    assert load_increment(spark, source, target, T0) == 3
    titles = {r.posting_id: r.title for r in target.postings(spark).collect()}
    assert titles == {"p1": "t", "p2": "later", "p3": "later"}
    # Commits of a day before the look-back are not listed; those within it are.
    layers.write_documents(documents_frame(spark, 4), 0, T0, "a", 1)
    layers.write_documents(documents_frame(spark, 5), 0, T0 - 30 * day, "a", 2)
    assert load_increment(spark, source, target, T0) == 1
    assert load_increment(spark, source, target, T0, look_back=None) == 1
    names = layers.commits.from_day(spark, "written_on", "2026-03-25").inputFiles()
    assert names and all("written_on=2026-03-25" in name for name in names)


def test_a_batch_lists_only_its_own_days(spark, tmp_path):
    layers = Layers(str(tmp_path / "lake")).create(spark)
    layers.curated.write_batch(documents_frame(spark, 1), "r", 0)
    table = tmp_path / "lake" / "curated_docs"
    (made,) = (table / "dt=2026-03-24").rglob("*.parquet")
    for k in range(10_000):
        folder = table / f"dt=2025-{k % 12 + 1:02d}-{k % 28 + 1:02d}" / "run=r" / f"batch_id={k}"
        folder.mkdir(parents=True)
        shutil.copy(made, folder)
    found = layers.curated.on_days(spark, ["2026-03-24", "2025-02-02", "2024-01-01"])
    files = found.inputFiles()
    days = {name.split("dt=")[1][:10] for name in files}
    assert days == {"2026-03-24", "2025-02-02"} and 1 < len(files) < 10_000 // 50
    roots = found._jdf.queryExecution().optimizedPlan().collectLeaves().head().relation().location().rootPaths()
    assert roots.size() == 2
    assert layers.curated.on_days(spark, ["2024-01-01"]).count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        Layers(str(tmp_path / "none")).curated.on_days(spark, ["2024-01-01"])


def same(found, wanted):
    return found.exceptAll(wanted).count() == wanted.exceptAll(found).count() == 0


def rows_of(k):
    """Rows of a load: new postings, newer and older rows of earlier ones, a changed hash."""
    time = T0 + timedelta(hours=k)
    return [
        row(10 * k), row(10 * k + 1, content_hash="same", title=None if k == 2 else "t"),
        row(10 * (k - 1), collected_at=time, description_text="" if k % 2 else "x", posting_id=f"n{k}"),
        row(10 * (k - 2) + 1, collected_at=T0 - timedelta(days=k), content_hash="old", posting_id=f"o{k}"),
        row(10 * (k - 1) + 1, collected_at=time, content_hash=f"own{k}", source="s", posting_id=f"m{k}"),
    ]


def test_marts_and_checks_after_each_load_equal_a_recomputation(spark, tmp_path):
    target, clean = Staging(str(tmp_path / "wh")).create(spark), CleanPostings(str(tmp_path / "clean"), 4)
    assert clean.read(spark).count() == clean.daily(spark).count() == 0
    assert clean.verdicts(spark).where("NOT passed").count() == 2
    for k in range(5):
        target.rows.append(staging(spark, rows_of(k)))
        version = clean.advance(spark, target)
        whole = target.postings(spark)
        assert same(clean.read(spark), clean_postings(whole))
        assert same(clean.daily(spark), mart_daily(whole))
        assert same(clean.source_quality(spark), mart_source_quality(whole))
        assert same(clean.verdicts(spark), run_checks(whole))
    assert clean.advance(spark, target) == version
    clean.sweep(spark)
    assert same(clean.read(spark), clean_postings(whole)) and same(clean.daily(spark), mart_daily(whole))


def test_a_load_of_one_posting_rewrites_one_bucket(spark, tmp_path):
    target, clean = Staging(str(tmp_path / "wh")).create(spark), CleanPostings(str(tmp_path / "clean"), 8)
    target.rows.append(staging(spark, [row(i) for i in range(60)]))
    before = clean.advance(spark, target)
    target.rows.append(staging(spark, [row(7, collected_at=T0 + timedelta(days=1))]))
    after = clean.advance(spark, target)
    changed = [b for b in before.places["rows"] if before.places["rows"][b] != after.places["rows"][b]]
    assert len(before.places["rows"]) == 8 and len(changed) == 1
    assert before.places["hashes"] == after.places["hashes"]
    assert clean.read(spark).count() == 60


def test_of_two_runs_that_carry_on_one_is_refused(spark, tmp_path, monkeypatch):
    target, clean = Staging(str(tmp_path / "wh")).create(spark), CleanPostings(str(tmp_path / "clean"), 2)
    target.rows.append(staging(spark, [row(1)]))
    real = CleanPostings._hashes

    def overtaken(self, *args):
        monkeypatch.setattr(CleanPostings, "_hashes", real)
        clean.advance(spark, target)
        return real(self, *args)

    monkeypatch.setattr(CleanPostings, "_hashes", overtaken)
    with pytest.raises(VersionConflict):
        clean.advance(spark, target)
    assert clean.read(spark).count() == 1
    assert clean.sweep(spark) == 4


def test_published_views_turn_in_one_step(spark, tmp_path):
    root = str(tmp_path / "marts")
    publish(staging(spark, [row(1)]), root)
    reader = spark.table(CLEAN_VIEW)
    publish(staging(spark, [row(1), row(2)]), root)
    assert spark.table(CLEAN_VIEW).count() == 2 and reader.count() == 1
    publish(staging(spark, [row(1), row(2), row(3)]), root)
    assert spark.table(CLEAN_VIEW).count() == 3
    assert len(list((tmp_path / "marts" / CLEAN_VIEW).glob("version=*"))) == 2
    publish(staging(spark, []), root)
    assert [spark.table(name).count() for name in (CLEAN_VIEW, DAILY_VIEW, QUALITY_VIEW)] == [0, 0, 0]
    for name in (CLEAN_VIEW, DAILY_VIEW, QUALITY_VIEW):
        spark.sql(f"DROP VIEW {name}")


def test_hourly_runs_accept_times_with_and_without_a_zone(spark, tmp_path, lake):
    target, root = Staging(str(tmp_path / "wh")), str(tmp_path / "marts")
    seoul = timezone(timedelta(hours=9))
    times = [datetime(2026, 3, 24, 12), datetime(2026, 3, 24, 22, tzinfo=seoul), datetime(2026, 3, 24, 14)]
    for k, time in enumerate(times):
        put(lake, document(k))
        found = hourly_run(spark, ObjectDocuments(str(lake)), target, time, publish_to=root)
        assert found.where("NOT passed").count() == 0
        assert spark.table(CLEAN_VIEW).count() == k + 1
    loaded = {r.loaded_at for r in target.postings(spark).collect()}
    assert loaded == {datetime(2026, 3, 24, hour) for hour in (12, 13, 14)}
    assert [r.posting_count for r in spark.table(DAILY_VIEW).collect()] == [3]
    assert housekeeping(spark, target) > 0 and spark.table(CLEAN_VIEW).count() == 3
    for name in (CLEAN_VIEW, DAILY_VIEW, QUALITY_VIEW):
        spark.sql(f"DROP VIEW {name}")
