import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hiregrain.operators.gate import gate_failures, gate_jobs
from hiregrain.operators.pages import fetch_error_type, fetch_outcome, resolve_pages
from hiregrain.operators.routing import failure_messages, gate_and_key, route_messages
from hiregrain.operators.skew import hot_keys, salted_left_join
from hiregrain.schemas import PAGE_FETCH, TOPIC

URL = "https://www.wanted.co.kr/wd/"
GOOD = {
    "job_id": "a1",
    "source": "seed",
    "url": URL + "1",
    "collected_at": "2026-03-24T10:00:00Z",
    "retry_count": 0,
}


def job(**changes):
    return json.dumps({**GOOD, **changes}, ensure_ascii=False).encode()


def messages(spark, values):
    rows = [
        (None, None if v is None else bytearray(v), 0, i, None) for i, v in enumerate(values)
    ]
    return spark.createDataFrame(rows, TOPIC)


def gated(spark, values):
    return gate_jobs(messages(spark, values)).orderBy("offset").collect()


REASONS = [
    (job(), None),
    (b"{oops", "not valid json"),
    (b"\xff\xfe{}", "not valid utf-8"),
    (None, "not valid utf-8"),
    (b"", "not valid json"),
    (b"  ", "not valid json"),
    (b"[1, 2]", "job must be a JSON object, got list"),
    ('"글"'.encode(), "job must be a JSON object, got str"),
    (b"7", "job must be a JSON object, got int"),
    (b"123456789012345678901234567890", "job must be a JSON object, got int"),
    (b"7.5", "job must be a JSON object, got float"),
    (b"true", "job must be a JSON object, got bool"),
    (b"null", "job must be a JSON object, got NoneType"),
    (b'{"job_id": "x"}', "missing required fields: source, url, collected_at"),
    (job(url=""), "missing required fields: url"),
    (job(source=None, collected_at=""), "missing required fields: source, collected_at"),
    (job(job_id=12), "missing required fields: job_id"),
    (job() + b" x", "not valid json"),
    (job() + b"]", "not valid json"),
    (job() + b"}", "not valid json"),
    (job() + b"," + job(), "not valid json"),
    (b"\n " + job() + b" \n", None),
    (b'{"job_id":"old",' + job()[1:], None),
]


def test_reasons(spark):
    rows = gated(spark, [value for value, _ in REASONS])
    assert [row.malformed_reason for row in rows] == [reason for _, reason in REASONS]
    assert rows[-1].job_id == "a1"


@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.too_slow])
@given(
    st.lists(
        st.one_of(st.binary(max_size=40), st.text(alphabet='{}[]",:0a\\ ', max_size=25).map(str.encode)),
        min_size=30,
        max_size=80,
    )
)
def test_any_bytes_give_a_row_and_agree_with_a_json_parser(spark, values):
    rows = gated(spark, values)
    assert len(rows) == len(values)
    for value, row in zip(values, rows, strict=True):
        try:
            parsed = json.loads(value.decode("utf-8"))
            readable = True
        except ValueError:
            readable = False
        unreadable = (row.malformed_reason or "").startswith("not valid")
        assert unreadable != readable, value
        if readable and not isinstance(parsed, dict):
            assert row.malformed_reason.startswith("job must be")


def test_retry_counts(spark):
    counts = [0, 2, 3, "2", 2.7, True, None, "abc", 10**12, -1]
    rows = gated(spark, [job(retry_count=c) for c in counts])
    assert [r.retry_count for r in rows] == [0, 2, 3, 2, 2, 1, 0, 0, 2**31 - 1, -1]
    assert [r.bad_retry_count for r in rows] == [False] * 6 + [True, True, False, False]
    no_count = {k: v for k, v in GOOD.items() if k != "retry_count"}
    assert gated(spark, [json.dumps(no_count).encode()])[0].retry_count == 0


def test_raw_message_is_whole_or_cut_after_decoding(spark):
    value = b"\xff" + "글".encode() * 3000
    assert gated(spark, [value])[0].raw_message == "�" + "글" * 3000
    cut = gate_jobs(messages(spark, [value]), raw_length=2000).first()
    assert cut.raw_message == "�" + "글" * 1999


def test_unreadable_failure_messages(spark):
    values = [b"no", b"\xff", b"[]", b"3", b"null", b'{"job": null}', b'{"job": "x"}', b'{"job": {"a": 1}}']
    rows = gate_failures(messages(spark, values)).orderBy("offset").collect()
    assert [r.rejected for r in rows] == [True] * 5 + [False] * 3
    assert [r.job is None for r in rows] == [True] * 7 + [False]


@pytest.mark.parametrize(
    "error, status, message, expected",
    [
        ("ConnectTimeout", None, "failed to resolve", "connect_timeout"),
        ("ReadTimeout", None, None, "read_timeout"),
        ("SSLError", None, None, "ssl_error"),
        ("HTTPError", 404, None, "http_4xx_404"),
        ("HTTPError", 429, None, "http_4xx_429"),
        ("HTTPError", 503, None, "http_5xx_503"),
        ("HTTPError", 302, None, "http_error"),
        ("HTTPError", None, None, "http_error"),
        ("ConnectionError", None, "x Failed To Resolve y", "dns_error"),
        ("ConnectionError", None, "Name or service not known", "dns_error"),
        ("ConnectionError", None, None, "connection_error"),
        ("RuntimeError", 404, "failed to resolve", "RuntimeError"),
    ],
)
def test_fetch_error_type(spark, error, status, message, expected):
    row = spark.range(1).select(
        fetch_error_type(F.lit(error), F.lit(status).cast("int"), F.lit(message).cast("string"))
    ).first()
    assert row[0] == expected


def crawl(spark, pages):
    rows = []
    for url, html, *error in pages:
        error_class, status, message = (*error, None, None, None)[:3]
        rows.append((url, html, error_class, status, message))
    return spark.createDataFrame(rows, PAGE_FETCH)


def test_fetch_outcome(spark):
    pages = crawl(spark, [("a", "<p>"), ("b", None, "SSLError"), ("c", None), ("d", "", None)])
    rows = fetch_outcome(pages).orderBy("url").collect()
    assert [r.fetch_error for r in rows] == [None, "ssl_error", "not_fetched", None]


PAGES = [
    (URL + "1", "<title>[Co] Dev | 원티드</title>"),
    (URL + "2", None, "ConnectionError", None, "failed to resolve"),
    (URL + "3", '<script type="application/ld+json">{"@type":"JobPosting","title":1}</script>'),
]
NO_KEYS = "dt string, job_id string"


def routed(spark, values, done=()):
    keys = spark.createDataFrame(list(done), NO_KEYS)
    return route_messages(messages(spark, values), crawl(spark, PAGES), keys)


def test_outcomes_in_message_order(spark):
    values = [
        b"junk",
        job(retry_count=3),
        job(collected_at="yesterday"),
        job(url=URL + "2"),                      # fails before the first success
        job(),                                   # first success
        job(),                                   # later duplicate
        job(url=URL + "2"),                      # later failure for a finished job
        job(collected_at="2026-03-25T00:00:00Z"),  # other day, other document
        job(job_id="b", url=URL + "3"),
        job(job_id="b", url=URL + "3"),
        job(job_id="c", url=URL + "4"),
        job(job_id="d"),
        job(source="other"),                     # same identity, whatever the source
    ]
    rows = routed(spark, values, [("2026-03-24", "d"), ("2026-03-23", "a1")]).orderBy("offset").collect()
    assert [row.outcome for row in rows] == [
        "malformed", "retry_exceeded", "parse_failed", "fetch_failed", "success", "duplicate",
        "duplicate", "success", "curated_failed", "curated_failed", "fetch_failed", "duplicate",
        "duplicate",
    ]
    assert (rows[4].company_name, rows[4].title) == ("Co", "Dev")
    assert rows[4].curated_s3_key == "curated/job_postings/dt=2026-03-24/a1.json"
    assert rows[4].raw_s3_key == "raw/job_postings/source=seed/dt=2026-03-24/a1.html"


def test_failure_envelopes_carry_the_whole_job(spark):
    values = [
        job(url=URL + "2", retry_count=1, extra={"k": [1, None]}),
        b"\xff",
        job(job_id="z", collected_at="x"),
        job(job_id="t", url=URL + "3"),
    ]
    sent = failure_messages(routed(spark, values), F.lit("T"), "offset").orderBy("offset").collect()
    envelopes = [json.loads(bytes(row.value)) for row in sent]
    assert [row.key and bytes(row.key) for row in sent] == [b"a1", None, b"z", b"t"]
    assert envelopes[0] == {
        "job": {**GOOD, "url": URL + "2", "retry_count": 2, "extra": {"k": [1, None]}},
        "error_type": "dns_error",
        "error_message": "failed to resolve",
        "failed_stage": "fetch",
        "failed_at": "T",
    }
    assert envelopes[1] == {
        "job": {},
        "raw_message": "�",
        "error_type": "malformed_message",
        "error_message": "not valid utf-8",
        "failed_stage": "parse",
        "failed_at": "T",
    }
    assert [(e["failed_stage"], e["error_type"]) for e in envelopes[2:]] == [
        ("parse", "ValueError"),
        ("curated", "TypeError"),
    ]


def test_canonical_page_replaces_the_listed_one(spark):
    base = "https://www.saramin.co.kr/"

    def linked(title, canonical):
        return f'<title>{title}</title><link rel="canonical" href="{canonical}">'

    pages = crawl(
        spark,
        [
            (base + "a", linked("a", base + "real")),
            (base + "b", linked("b", base + "b")),
            (base + "c", linked("c", base + "missing")),
            (base + "d", linked("d", base + "broken")),
            (base + "e", "<title>e</title>"),
            (base + "real", linked("real", base + "other")),
            (base + "broken", None, "ReadTimeout"),
            (URL + "1", linked("no refetch here", base + "real")),
        ],
    )
    urls = pages.select("url").where(~F.col("url").rlike("real|broken"))
    rows = {r.url: (r.page_url, r.title_tag) for r in resolve_pages(urls, pages).collect()}
    own = {base + name: (base + name, name) for name in "bcde"}
    assert rows == {
        base + "a": (base + "real", "real"),
        **own,
        URL + "1": (URL + "1", "no refetch here"),
    }


def test_every_message_has_one_outcome(spark):
    values = [job(job_id=f"j{i % 7}", url=URL + str(i % 5), retry_count=i % 4) for i in range(60)]
    values += [b"junk"] * 5
    rows = routed(spark, values).groupBy("offset").count().collect()
    assert len(rows) == len(values) and all(r["count"] == 1 for r in rows)


def test_salted_join_equals_a_plain_one(spark):
    left = spark.range(2000).select(
        "id", F.when(F.col("id") < 900, "hot").when(F.col("id") < 1000, None)
        .otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("key")
    )
    right = left.select("key").distinct().where("key <> 'k3'").withColumn("value", F.upper("key"))
    salted = salted_left_join(left, right, ["key"], F.col("id"), slice_rows=100)
    plain = left.join(right, "key", "left")
    assert sorted(map(str, salted.select(plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_hot_keys_are_few_and_cut_into_even_slices(spark):
    rows = spark.range(3000).select(F.when(F.col("id") < 1000, 0).otherwise(F.col("id")).alias("k"))
    assert [r._slices for r in hot_keys(rows, ["k"], slice_rows=100).collect()] == [10]
    assert hot_keys(rows, ["k"], slice_rows=1000).count() == 0


def test_bad_times_do_not_build_keys(spark):
    rows = gate_and_key(messages(spark, [job(collected_at="어제")])).collect()
    assert (rows[0].outcome, rows[0].raw_s3_key) == ("parse_failed", None)
