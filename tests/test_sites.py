import json

import pytest

from hiregrain.operators.curation import final_description
from hiregrain.operators.pages import page_facts
from hiregrain.operators.sites import SITES, extract_fields, site_flag, site_of
from hiregrain.schemas import POSTING_FIELDS
from pyspark.sql import functions as F

HOST = {
    "wanted": "https://www.wanted.co.kr/wd/1",
    "groupby": "https://groupby.kr/positions/1",
    "saramin": "https://www.saramin.co.kr/x",
    "catch": "https://www.catch.co.kr/NCS/1",
    "jobkorea": "https://www.jobkorea.co.kr/Recruit/GI_Read/1",
    "other": "https://jobs.example/1",
}


def page(title=None, og=None, meta=None, posting=None, body=""):
    head = ""
    if title is not None:
        head += f"<title>{title}</title>"
    if og is not None:
        head += f'<meta property="og:title" content="{og}">'
    if meta is not None:
        head += f'<meta name="description" content="{meta}">'
    if posting is not None:
        text = json.dumps({"@type": "JobPosting", **posting}, ensure_ascii=False)
        head += f'<script type="application/ld+json">{text}</script>'
    return f"<html><head>{head}</head><body>{body}</body></html>"


def expect(**fields):
    return {**dict.fromkeys(POSTING_FIELDS), **fields}


SEOUL = {"address": {"addressRegion": "서울", "addressLocality": "마포구"}}
FULL = {
    "title": "Data  Engineer",
    "hiringOrganization": {"name": "Acme"},
    "jobLocation": SEOUL,
    "employmentType": ["FULL_TIME", "", None, "PART_TIME"],
    "experienceRequirements": 3,
    "description": "<p>Do &amp;</p><br>things",
}
EMPTY = page()

# (site, page, expected fields)
CASES = [
    *[(site, EMPTY, expect()) for site in HOST if site != "other"],
    (
        "wanted",
        page("[No] No | 원티드", og="[No] No", meta="no", posting=FULL),
        expect(
            company_name="Acme", title="Data Engineer", location="서울 마포구",
            employment_type="FULL_TIME, PART_TIME", experience_level="3",
            description_text="Do &\n\nthings",
        ),
    ),
    (
        "wanted",
        page("[Acme.(x)] Dev  채용 공고  | 원티드", og="[No] No", meta=" a  b "),
        expect(company_name="Acme.(x)", title="Dev", description_text="a b"),
    ),
    (
        "wanted",
        page("[Tag] Tagged | 원티드", posting={"title": "Own", "employmentType": []}),
        expect(company_name="Tag", title="Own", employment_type=""),
    ),
    (
        "wanted",
        page("[ Pad ] Dev", posting={"jobLocation": [SEOUL, {}], "description": "&lt;b&gt;x"}),
        expect(company_name="Pad", title="[ Pad ] Dev", location="서울 마포구", description_text="<b>x"),
    ),
    (
        "groupby",
        page("무관 Dev 무관 팀", meta="m", posting={"experienceRequirements": "ld", "jobLocation": {"address": {"addressRegion": "서울", "addressLocality": "서울"}}}),
        expect(title="Dev 팀", location="서울", experience_level="무관", description_text="m"),
    ),
    (
        "groupby",
        page("Dev (3년 이하)", og="Og 무관 Dev"),
        expect(title="Og Dev", experience_level="3년 이하"),
    ),
    (
        "saramin",
        page("no", og="[Co] Dev(D-3) - 사람인", meta="Other, Job, 경력: 5년↑ , 서울", posting=FULL),
        expect(
            company_name="Co", title="Dev", experience_level="5년↑",
            description_text="Other, Job, 경력: 5년↑ , 서울",
        ),
    ),
    (
        "saramin",
        page(meta="Co, Inc., Dev"),
        expect(company_name="Co", title="Inc.", description_text="Co, Inc., Dev"),
    ),
    ("saramin", page(og="[Co] - 사람인"), expect(company_name="Co", title="[Co]")),
    ("saramin", page(posting=FULL), expect()),
    (
        "catch",
        page("[Co] Dev 채용 (~1/2) | 캐치", meta="신입|정규직|학력| |연봉|부산"),
        expect(
            company_name="Co", title="Dev 채용", experience_level="신입", employment_type="정규직",
            location="부산", description_text="신입|정규직|학력| |연봉|부산",
        ),
    ),
    (
        "catch",
        page(meta="prose", posting={**FULL, "title": "[Acme] Dev"}),
        expect(
            company_name="Acme", title="Dev", location="서울 마포구",
            employment_type="FULL_TIME, PART_TIME", experience_level="3",
            description_text="<p>Do &</p><br>things",
        ),
    ),
    (
        "jobkorea",
        page(og="Area 채용 - Acme Co [Dev] team | 잡코리아", meta="x 경력 :  신입 , y"),
        expect(
            company_name="Acme Co", title="[Dev] team", experience_level="신입",
            description_text="x 경력 : 신입 , y",
        ),
    ),
    (
        "jobkorea",
        page(posting={**FULL, "title": "Acme  Dev"}),
        expect(
            company_name="Acme", title="Dev", location="서울 마포구", experience_level="3",
            description_text="<p>Do &</p><br>things",
        ),
    ),
    ("jobkorea", page("Just a title"), expect(title="Just a title")),
    ("jobkorea", page("A&amp;amp;lt;B [x&amp;amp;lt;]"), expect(company_name="A<B", title="[x<]")),
    (
        "other",
        page("Tag", og="", body="<p>Body</p>text", posting=FULL),
        expect(title="Tag", description_text="Tag Body\ntext"),
    ),
    ("other", page("Tag", og="Og &amp;amp; x", meta="m", body="b"), expect(title="Og & x", description_text="m")),
]


def facts(spark, pages):
    rows = [(i, HOST[site], html) for i, (site, html) in enumerate(pages)]
    return extract_fields(page_facts(spark.createDataFrame(rows, "i int, url string, html string")))


def test_fields_of_every_site(spark):
    rows = facts(spark, [(site, html) for site, html, _ in CASES]).orderBy("i").collect()
    for (site, html, expected), row in zip(CASES, rows, strict=True):
        if site == "other" and expected["description_text"] is not None and "<script" in html:
            expected = {**expected, "description_text": row.description_text}
            assert row.description_text.endswith("Body\ntext")
        assert {name: row[name] for name in POSTING_FIELDS} == expected, (site, html)
        assert row.extract_error is None


def test_values_of_the_wrong_type_are_errors_only_where_text_is_needed(spark):
    wrong = [{"title": 5}, {"hiringOrganization": {"name": ["x"]}}, {"description": {"a": 1}},
             {"jobLocation": {"address": {"addressRegion": True}}}]
    fine = [{"title": 0}, {"hiringOrganization": "x"}, {"description": []}, {"jobLocation": "x"},
            {"jobLocation": {"address": "x"}}, {"jobLocation": [None, SEOUL]}, {"employmentType": True},
            {"title": None, "hiringOrganization": {"name": False}}]
    pages = [("wanted", page(posting=p)) for p in wrong + fine] + [("saramin", page(posting=wrong[0]))]
    errors = [row.extract_error for row in facts(spark, pages).orderBy("i").collect()]
    assert errors == ["TypeError"] * len(wrong) + [None] * (len(fine) + 1)


def test_catch_page_whose_description_is_only_encoded_blanks_is_an_error(spark):
    pages = [("catch", page(meta="&amp;nbsp;")), ("jobkorea", page(meta="&amp;nbsp;"))]
    assert [r.extract_error for r in facts(spark, pages).orderBy("i").collect()] == ["AttributeError", None]


def test_stored_description_is_cleaned_again_and_whole(spark):
    pages = [
        ("wanted", page(meta="&amp;amp;lt; x")),
        ("wanted", page(body="가" * 3000)),
        ("catch", page(posting={"description": "나" * 5000})),
        ("wanted", "<div></div>"),
    ]
    rows = final_description(facts(spark, pages)).orderBy("i").collect()
    assert [len(row.description_text) for row in rows] == [3, 3000, 5000, 0]
    assert rows[0].description_text == "< x"
    assert all(len(row.content_hash) == 64 for row in rows)
    cut = final_description(facts(spark, pages), 2).orderBy("i").collect()
    assert [len(row.description_text) for row in cut] == [2, 2, 2, 0]
    assert [row.content_hash for row in cut] == [row.content_hash for row in rows]


@pytest.mark.parametrize(
    "url, site",
    [
        ("https://www.WANTED.co.kr/wd/1", "wanted"),
        ("https://wanted.co.kr.evil.example/", "wanted"),
        ("https://user@catch.co.kr:8080/", "catch"),
        ("https://example.com/saramin.co.kr", None),
        ("www.jobkorea.co.kr/x", None),
    ],
)
def test_site_of(spark, url, site):
    row = spark.range(1).select(
        site_of(F.lit(url)).alias("site"),
        site_flag(site_of(F.lit(url)), "disable_ssl_verify").alias("lax"),
    ).first()
    assert (row.site, row.lax) == (site, site == "saramin")


def test_registry_is_total_and_free_of_doubles():
    assert len({s.name for s in SITES}) == len({s.domain for s in SITES}) == len(SITES)
    assert [s.name for s in SITES if s.refetch_canonical] == ["saramin"]


def test_a_new_site_is_one_more_rule(spark):
    from hiregrain.operators.sites import Fields, Raw, SiteRule

    rule = SiteRule(
        "fresh", "fresh.example",
        lambda: F.upper("page_title"),
        lambda: Raw(title=F.col("title_text")),
        lambda: Fields(title=F.col("named_title"), location=F.lit("here")),
    )
    rows = spark.createDataFrame([("https://fresh.example/", page("abc"))], "url string, html string")
    row = extract_fields(page_facts(rows), (*SITES, rule)).first()
    assert (row.site, row.title, row.location) == ("fresh", "ABC", "here")
