"""Postings, jobs, messages and pages made from the given general-purpose tables.

The given tables hold events, documents and web pages, not job postings. These frames
give every row of them a role in the posting world, so that each operator runs over
whole tables; the matching definitions for the oracle are in ``oracles``.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiregrain.functions.text import sha256_hex
from hiregrain.operators.collecting import iso_utc
from hiregrain.operators.keys import lake_keys
from hiregrain.operators.latest import POSTING_KEY
from hiregrain.schemas import STAGING_COLUMNS
from hiregrain.sources.tables import NO_DAY
from hiregrain.sources.topics import FETCH_TOPIC, FolderTopics

# Hosts by rotation: the five known sites, with user info and a port on two, and one other.
HOSTS = (
    "www.wanted.co.kr",
    "SARAMIN.co.kr:443",
    "groupby.kr",
    "me@www.jobkorea.co.kr",
    "www.catch.co.kr",
    "jobs.example",
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table in even parts, whatever its files: a file of one row group would keep one core
    busy. Only the stand-ins need this shuffle."""
    return table(spark, sf_dir, name).repartition(spark.sparkContext.defaultParallelism)


def _turn(column: str, by: int) -> Column:
    return F.col(column) % by


def _str(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _cat(*parts: str | Column) -> Column:
    return F.concat(*[F.lit(part) if isinstance(part, str) else part for part in parts])


def _pick(index: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(value) for value in values]), index.cast("int"))


def timed_events(events: DataFrame) -> DataFrame:
    """Events with ``ts`` as an instant and ``k`` out of the JSON props."""
    return events.withColumns(
        {
            "ts": F.col("ts").cast("timestamp"),
            "k": F.get_json_object("props", "$.k").cast("int"),
        }
    )


def size_of(rows: DataFrame) -> Column:
    return rows.agg(F.count(F.lit(1)).alias("n")).scalar()


# --- postings -------------------------------------------------------------------------


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One staging row per event, described by a document; some values missing or empty."""
    documents = table(spark, sf_dir, "documents")
    events = timed_events(table(spark, sf_dir, "events"))
    # Hashed once a document, and so there without its text.
    text_hash = sha256_hex(F.coalesce("text", F.lit(""))).alias("text_hash")
    described = events.withColumn("doc_id", F.col("event_id") % size_of(documents)).join(
        documents.select("doc_id", "text", text_hash, "lang", F.col("source").alias("doc_source")),
        "doc_id",
    )

    def gaps(null_turn: int, empty_turn: int, value: Column) -> Column:
        null_here, empty_here = _turn("event_id", null_turn) == 0, _turn("event_id", empty_turn) == 0
        return F.when(null_here, F.lit(None)).when(empty_here, "").otherwise(value)

    number = _str("event_id")
    posted = described.withColumns(
        {
            "posting_id": _cat("p", number),
            "source": F.col("event_type"),
            "original_url": _cat(
                "https://site", _str(_turn("user_id", 6)), ".example/", _str("user_id")
            ),
            "company_name": gaps(7, 17, _cat("Company ", _str("user_id"))),
            "title": gaps(11, 13, _cat("Title ", number)),
            "location": F.col("lang"),
            "employment_type": F.col("doc_source"),
            "experience_level": F.lit(None).cast("string"),
            "description_text": gaps(19, 23, F.col("text")),
            "skills": F.lit("[]"),
            "collected_at": F.col("ts"),
            "loaded_at": F.date_trunc("hour", "ts") + F.expr("INTERVAL 1 HOUR"),
        }
    ).withColumns(
        {
            "content_hash": F.when(
                gaps(19, 23, F.lit("text")) == "text", F.col("text_hash")
            ).otherwise(sha256_hex(F.lit(""))),
            **lake_keys(
                F.col("source"), F.date_format("collected_at", "yyyy-MM-dd"), F.col("posting_id")
            ),
        }
    )
    return posted.select(*STAGING_COLUMNS)


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return before_loading(staging(spark, sf_dir))


def before_loading(rows: DataFrame) -> DataFrame:
    """Staging rows as they were before loading: times as text, with their key and day."""
    return rows.withColumns(
        {
            "dt": F.date_format("collected_at", "yyyy-MM-dd"),
            "collected_at": iso_utc(F.col("collected_at")),
            "s3_key": F.col("curated_s3_key"),
        }
    ).drop("loaded_at")


def _store(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder that tasks reach, and its path there."""
    if root.startswith("file:"):
        return fs.LocalFileSystem(), "/" + root.removeprefix("file:").lstrip("/")
    if "://" not in root:
        return fs.LocalFileSystem(), root
    return fs.FileSystem.from_uri(root.replace("s3a://", "s3://", 1))


def put_objects(documents: DataFrame, folder: str) -> int:
    """Put every curated document, one of each posting, into a file of its own below its day, as
    what fetches postings would. Returns their number.

    Spark's writer is made for few large files: on a local disk it starts a process to set the mode
    of every file and of its checksum. Here tasks put the objects. A name is of its posting and
    appears with all its content, so a task that is done again leaves the same objects.
    """
    posting = F.sha2(F.to_json(F.struct(*POSTING_KEY)), 256)
    objects = documents.repartition(*POSTING_KEY).select(
        _cat("dt=", F.coalesce("dt", F.lit(NO_DAY))).alias("day"),
        _cat(F.col("posting_id"), "-", posting, ".json").alias("name"),
        F.to_json(F.struct(*[name for name in documents.columns if name != "dt"])).alias("text"),
    )

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        (store, place), days = _store(folder), set()
        for batch in batches:
            for day, name, text in zip(*(column.to_pylist() for column in batch.columns)):
                if day not in days:
                    store.create_dir(f"{place}/{day}", recursive=True)
                    days.add(day)
                beside = f"{place}/{day}/.{uuid.uuid4().hex}"
                with store.open_output_stream(beside) as out:
                    out.write(text.encode())
                store.move(beside, f"{place}/{day}/{name}")
            yield pa.RecordBatch.from_arrays([pa.array([len(batch)], pa.int64())], names=["n"])

    return objects.mapInArrow(put, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def listed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = timed_events(table(spark, sf_dir, "events"))
    day = F.date_format("ts", "yyyy-MM-dd")
    return events.select(
        _cat("curated/job_postings/dt=", day, "/p", _str("event_id"), ".json").alias("s3_key"),
        day.alias("dt"),
        "ts",
        "event_type",
    )


def loaded_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys noted as loaded: everything of the first half of the month, and all clicks."""
    listed = listed_keys(spark, sf_dir)
    return listed.where("ts < TIMESTAMP '2024-01-16 00:00:00' OR event_type = 'click'").select(
        "s3_key", F.col("ts").alias("loaded_at")
    )


# --- jobs and messages ----------------------------------------------------------------


def job_rows(events: DataFrame, pages: DataFrame) -> DataFrame:
    """A fetch job per event. Ids repeat by user, URLs by page; some URLs have no page.

    Works on a stream of events too.
    """
    wide = timed_events(events).withColumn(
        "page_number", F.col("event_id") % (F.floor(size_of(pages) * 11 / 10) + 1)
    )
    return wide.select(
        "event_id",
        _cat("j", _str("user_id")).alias("job_id"),
        F.col("event_type").alias("source"),
        page_url(F.col("page_number")).alias("url"),
        F.when(_turn("event_id", 31) == 5, "어제")
        .otherwise(iso_utc(F.col("ts")))
        .alias("collected_at"),
        (F.col("k") % 5).alias("retry_count"),
    )


def jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return job_rows(spread_table(spark, sf_dir, "events"), table(spark, sf_dir, "pages"))


def page_url(number: Column) -> Column:
    return _cat("https://", _pick(number % len(HOSTS), HOSTS), "/p/", number.cast("string"))


def message_rows(job_rows: DataFrame) -> DataFrame:
    """The jobs as messages; every tenth is replaced by one of nine unusable ones."""
    fields = ["job_id", "source", "url", "collected_at", "retry_count"]
    good = F.to_json(F.struct(*fields))
    half = F.struct(F.col("job_id"), F.col("source"))
    unusable = [
        F.lit("{not valid json"),
        None,
        F.lit("[1, 2, 3]"),
        F.lit('"text"'),
        F.to_json(F.struct("job_id")),
        F.lit(""),
        F.to_json(F.struct(half.alias("more"), *fields[:2], F.lit("").alias("url"), fields[3])),
        F.concat(good, F.lit(" trailing")),
        F.to_json(F.struct(*fields[:3], F.lit("").alias("collected_at"))),
    ]
    planted = F.when(_turn("event_id", 10) == 7, F.floor(F.col("event_id") / 10) % 9)
    value = F.when(planted.isNull(), good.cast("binary"))
    for number, text in enumerate(unusable):
        broken = F.unhex(F.lit("fffe")) if text is None else text.cast("binary")
        value = value.when(planted == number, broken)
    return job_rows.select(
        F.col("job_id").cast("binary").alias("key"),
        value.alias("value"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return message_rows(jobs(spark, sf_dir))


def done_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Identities of documents that exist before the batch starts."""
    events = timed_events(table(spark, sf_dir, "events"))
    return (
        events.where("event_type = 'signup' AND value < 10")
        .select(
            F.date_format("ts", "yyyy-MM-dd").alias("dt"),
            _cat("j", _str("user_id")).alias("job_id"),
        )
        .distinct()
    )


MISTYPED = '<script type="application/ld+json">{"@type":"JobPosting","title":[1]}</script>'


def page_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given pages as crawl results; nine kinds of failure among them, and one kind of page
    whose linked data cannot be used."""
    pages = spread_table(spark, sf_dir, "pages")
    kind = _turn("page_id", 12)

    def by_kind(values: dict[int, Column]) -> Column:
        chain = F.when(F.lit(False), F.lit(None))
        for number, value in values.items():
            chain = chain.when(kind == number, value)
        return chain

    names = {
        1: "ConnectTimeout",
        2: "ReadTimeout",
        3: "SSLError",
        4: "HTTPError",
        5: "HTTPError",
        6: "HTTPError",
        7: "ConnectionError",
        8: "ConnectionError",
        9: "TooManyRedirects",
    }
    error = by_kind({number: F.lit(name) for number, name in names.items()}).cast("string")
    html = F.when(kind == 10, F.concat(F.lit(MISTYPED), "html")).otherwise(F.col("html"))
    return pages.select(
        page_url(F.col("page_id")).alias("url"),
        F.when(error.isNull(), html).alias("html"),
        error.alias("error_class"),
        by_kind({4: 400 + _turn("page_id", 100), 5: F.lit(503)}).cast("int").alias("status_code"),
        by_kind({7: F.lit("FAILED to Resolve 'host'"), 8: F.lit("reset by peer")})
        .cast("string")
        .alias("error_message"),
    )


# --- failure messages -----------------------------------------------------------------


def failure_rows(events: DataFrame) -> DataFrame:
    """A failure message per event: unreadable, jobless and complete ones."""
    wide = timed_events(events)
    stage = _pick(
        _turn("event_id", 6), ("fetch", "fetch", "parse", "raw_upload", "processed", "curated")
    )
    error = _pick(
        _turn("event_id", 4), ("connect_timeout", "dns_error", "http_5xx_503", "TypeError")
    )
    count = _str(F.col("k") % 5)
    full = _cat(
        '{"job_id":"j', _str("event_id"), '","source":"', F.col("event_type"), '","url":"https://x/',
        _str("user_id"), '","retry_count":', count, "}",
    )
    job = (
        F.when(_turn("event_id", 29) == 0, "null")
        .when(_turn("event_id", 29) == 1, '"text"')
        .when(_turn("event_id", 29) == 2, "{}")
        .when(_turn("event_id", 29) == 3, _cat('{"source":"s","retry_count":', count, "}"))
        .otherwise(full)
    )
    time = F.when(
        _turn("event_id", 41) != 0, _cat(',"failed_at":"', iso_utc(F.col("ts")), '"')
    ).otherwise("")
    envelope = _cat(
        '{"job":', job, ',"failed_stage":"', stage, '","error_type":"', error,
        '","error_message":"event ', _str("event_id"), '"', time, "}",
    )
    value = F.when(_turn("event_id", 37) == 0, _cat("[", envelope, "]")).otherwise(envelope)
    return wide.select(
        F.lit(None).cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").alias("timestamp"),
    )


def failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return failure_rows(spread_table(spark, sf_dir, "events"))


class EventTopics(FolderTopics):
    """Folder topics whose fetch and failure messages come from a stream of events."""

    def __init__(self, root: str, sf_dir: str, part: Column | None = None):
        super().__init__(root)
        object.__setattr__(self, "sf_dir", sf_dir)
        object.__setattr__(self, "part", part)

    def _events(self, spark: SparkSession) -> DataFrame:
        schema: T.StructType = table(spark, self.sf_dir, "events").schema
        path = f"{self.sf_dir}/events.parquet"
        reader = spark.readStream.schema(schema)
        if os.path.isfile(path):
            rows = reader.option("pathGlobFilter", "events.parquet").parquet(self.sf_dir)
        else:
            rows = reader.parquet(path)
        return rows if self.part is None else rows.where(self.part)

    def stream(self, spark: SparkSession, topic: str) -> DataFrame:
        events = self._events(spark)
        if topic == FETCH_TOPIC:
            return message_rows(job_rows(events, table(spark, self.sf_dir, "pages")))
        return failure_rows(events)


# --- pages with head signals ----------------------------------------------------------


def _escaped(text: Column) -> Column:
    for plain, coded in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(plain), F.lit(coded))
    return text


def page_html(
    title: Column | None = None,
    og_title: Column | None = None,
    meta: Column | None = None,
    canonical: Column | None = None,
    linked_data: Column | None = None,
    body: Column | None = None,
) -> Column:
    """A page with the given parts; a NULL part is left out, texts are escaped."""

    def around(before: str, text: Column | None, after: str) -> Column:
        if text is None:
            return F.lit("")
        return F.coalesce(_cat(before, text, after), F.lit(""))

    def escaped(text: Column | None) -> Column | None:
        return None if text is None else _escaped(text)

    return _cat(
        '<!DOCTYPE html><html><head><meta charset="utf-8"><link rel="stylesheet" href="/s.css">',
        around("<title>", escaped(title), "</title>"),
        around('<meta content="', escaped(og_title), '" property="og:title">'),
        around('<META name="description" content=" ', escaped(meta), ' "/>'),
        around('<link href="', escaped(canonical), '" rel="nofollow canonical">'),
        '<script type="application/ld+json">{broken,,}</script>',
        around('<script type="application/ld+json">', linked_data, "</script>"),
        "</head><body><script>var t = '<title>no</title>';</script>",
        around("<div>", escaped(body), "</div>"),
        "</body></html>",
    )


def _ld(**fields: Column) -> Column:
    """JSON of a posting behind another object; NULL fields stay as JSON nulls."""
    posting = F.struct(
        F.lit("JobPosting").alias("@type"), *[value.alias(name) for name, value in fields.items()]
    )
    return _cat(
        '[{"@type":"BreadcrumbList"},', F.to_json(posting, {"ignoreNullFields": "false"}), "]"
    )


def _named(name: Column) -> Column:
    return F.struct(name.alias("name"))


def _place(region: Column, locality: Column) -> Column:
    return F.struct(
        F.struct(region.alias("addressRegion"), locality.alias("addressLocality")).alias("address")
    )


def _null() -> Column:
    return F.lit(None).cast("string")


def site_pages(spark: SparkSession, sf_dir: str, site: str) -> DataFrame:
    """Every document as a page of ``site``, in three shapes that take turns.

    Shape 0 has full linked data, shape 1 titles and a description only, shape 2 linked
    data without title and company.
    """
    documents = spread_table(spark, sf_dir, "documents")
    number, shape = _str("doc_id"), _turn("doc_id", 3)
    role = _cat("Role ", number)
    org = _cat("Org ", _str(_turn("doc_id", 50)))
    text = F.col("text")
    locality = F.when(_turn("doc_id", 2) == 0, "강남구").otherwise("서울")
    place = _place(F.lit("서울"), locality)
    kinds = F.array(F.lit("FULL_TIME"), _null(), F.lit(""), F.col("source"))

    def shaped(first: Column, second: Column, third: Column) -> Column:
        return F.when(shape == 0, first).when(shape == 1, second).otherwise(third)

    def linked(full: Column, partial: Column) -> Column:
        return shaped(full, _null(), partial)

    markup = _cat("<p>", text, "</p><br/><li>R&amp;D</li>")
    if site == "wanted":
        html = page_html(
            title=shaped(
                F.lit("[Else] Other | 원티드"),
                _cat("[", org, "] ", role, " 채용 공고 | 원티드"),
                _cat(" [", org, "]  ", role, "  |  원티드 "),
            ),
            og_title=F.lit("[og] ignored"),
            meta=text,
            linked_data=linked(
                _ld(
                    title=_cat(" ", role, "  &amp; lead"),
                    hiringOrganization=_named(org),
                    jobLocation=place,
                    employmentType=kinds,
                    experienceRequirements=F.col("n_chars"),
                    description=markup,
                ),
                _ld(
                    title=_null(),
                    hiringOrganization=F.lit("not an object"),
                    jobLocation=F.array(place),
                    employmentType=F.col("source"),
                    experienceRequirements=F.lit(0),
                    description=F.lit(""),
                ),
            ),
        )
    elif site == "groupby":
        html = page_html(
            title=shaped(
                _cat(role, " (3년 이하)"), _cat("무관 ", role), _cat(role, " 무관 팀 (경력무관)")
            ),
            og_title=shaped(_null(), _null(), F.lit("")),
            meta=text,
            linked_data=linked(
                _ld(
                    title=role,
                    hiringOrganization=_named(org),
                    jobLocation=_place(_null(), locality),
                    employmentType=F.lit("CONTRACT"),
                    experienceRequirements=F.lit("ignored"),
                    description=markup,
                ),
                _ld(hiringOrganization=_named(_null()), employmentType=F.array().cast("array<string>")),
            ),
        )
    elif site == "saramin":
        html = page_html(
            title=_cat("ignored ", number),
            og_title=shaped(
                _cat("[", org, "] ", role, "(D-7) - 사람인"),
                _null(),
                _cat("[", org, "] - 사람인"),
            ),
            meta=shaped(text, _cat(org, ", ", role, ", 경력: ", number, "년 , 서울"), _null()),
            linked_data=_ld(title=F.lit("ignored"), description=F.lit("ignored")),
            body=text,
        )
    elif site == "catch":
        summary = _cat("신입| |정규직 | 대졸 |", number, "| 부산 |끝")
        html = page_html(
            title=_cat("[", org, "] ", role, " 채용 (~3/31) | 캐치"),
            og_title=shaped(_null(), _cat("[", org, "] ", role, " (~03.31) | 캐치"), F.lit("")),
            meta=shaped(text, summary, summary),
            linked_data=linked(
                _ld(
                    title=_cat("[", org, "] ", role),
                    hiringOrganization=_named(org),
                    jobLocation=F.array(place, _place(F.lit("부산"), _null())),
                    employmentType=kinds,
                    experienceRequirements=F.array(F.lit("신입"), F.lit("경력")),
                    description=_cat("<p>", text, "</p>"),
                ),
                _ld(title=_null(), jobLocation=F.lit("서울"), employmentType=F.lit("")),
            ),
        )
    else:
        html = page_html(
            title=shaped(
                F.lit("ignored | 잡코리아"),
                _cat("Area 채용 - ", org, " [", role, "] now | 잡코리아"),
                _cat(org, " ", role, " | 잡코리아"),
            ),
            meta=shaped(text, _cat("모집 경력 : ", number, "년 &amp; up, etc"), F.lit("경력 무관")),
            linked_data=linked(
                _ld(
                    title=_cat(org, " ", role),
                    hiringOrganization=_named(org),
                    jobLocation=place,
                    employmentType=F.lit("ignored"),
                    experienceRequirements=F.array(F.lit(1), F.lit(0), F.lit(2)),
                    description=_cat("<p>", text, "</p>"),
                ),
                _ld(title=_null(), hiringOrganization=_named(org), description=_null()),
            ),
        )
    host = {
        "wanted": "https://www.wanted.co.kr/wd/",
        "groupby": "https://groupby.kr/positions/",
        "saramin": "https://m.saramin.co.kr/view?id=",
        "catch": "https://www.catch.co.kr/NCS/",
        "jobkorea": "https://www.jobkorea.co.kr/Recruit/GI_Read/",
    }[site]
    return documents.select(
        F.col("doc_id").alias("page_id"), _cat(host, number).alias("url"), html.alias("html")
    )


def redirecting_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Crawl results in which a quarter of all pages share four canonical pages.

    The others name themselves, a page nobody fetched, or nothing. One of the four
    canonical pages could not be fetched.
    """
    documents = spread_table(spark, sf_dir, "documents")
    base = "https://www.saramin.co.kr/"
    own = _cat(base, "jobs/", _str("doc_id"))
    target = _pick(_turn("doc_id", 4), ("view", "jobs", "gone", "none"))
    canonical = (
        F.when(target == "view", _cat(base, "view/", F.col("lang")))
        .when(target == "jobs", own)
        .when(target == "gone", _cat(base, "gone/", _str("doc_id")))
    )
    listing = documents.select(
        own.alias("url"),
        page_html(
            title=_cat("[Own] ", _str("doc_id")), canonical=canonical, meta=F.col("text")
        ).alias("html"),
    )
    views = (
        documents.select("lang")
        .distinct()
        .select(
            _cat(base, "view/", F.col("lang")).alias("url"),
            F.when(
                F.col("lang") != "es",
                page_html(title=_cat("[View] ", F.col("lang")), meta=_cat("about ", F.col("lang"))),
            ).alias("html"),
        )
    )
    return listing.unionByName(views).select(
        "url",
        "html",
        F.when(F.col("html").isNull(), "ReadTimeout").alias("error_class"),
        F.lit(None).cast("int").alias("status_code"),
        F.lit(None).cast("string").alias("error_message"),
    )


def listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing page per event and site, with links that repeat between pages."""
    events = table(spark, sf_dir, "events")
    event, user = _str("event_id"), _str("user_id")
    wanted = _cat(
        '<a href="/wd/', event, '">a</a><a href="/wd/', user, '">b</a><a href="/wd/', user,
        '">c</a><a href="/company/1">d</a><a href="/wd/x">e</a>',
    )
    jobkorea = _cat(
        "<a href='/Recruit/GI_Read/", user, "?x=1'>a</a> /Recruit/GI_Read/", event, " /Recruit/"
    )
    pages = F.array(
        F.struct(F.lit("wanted").alias("site"), wanted.alias("html")),
        F.struct(F.lit("jobkorea").alias("site"), jobkorea.alias("html")),
    )
    return events.select(F.inline(pages))
