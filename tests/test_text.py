import html
import re
from html.entities import html5

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hiregrain.functions import text, titles
from hiregrain.functions.urls import authority, detail_links
from hiregrain.operators.keys import local_date

ODD = " \t\n\x0b\x1c\x1f\x85\xa0   　"


def column(spark, values, build):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r.r for r in rows.select("i", build(F.col("v")).alias("r")).orderBy("i").collect()]


def collapsed(value):
    """What the cleaning must give, in plain Python."""
    if not value:
        return None
    return re.sub(r"\s+", " ", html.unescape(value)).strip() or None


def test_whitespace_characters_are_all_that_count_as_space():
    spaces = {chr(code) for code in range(0x110000) if chr(code).isspace()}
    assert set(text.WS_CHARS) == spaces


def test_normalize(spark):
    values = [None, "", "  ", f"a{ODD}b", "&nbsp;&#32;", "R&amp;D  &lt;x&gt;", "&amp;lt;", "a&b"]
    assert column(spark, values, text.normalize) == [collapsed(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=ODD + "ab&;#lt<가", max_size=30), min_size=20, max_size=60))
def test_normalize_matches_plain_python(spark, values):
    assert column(spark, values, text.normalize) == [collapsed(v) for v in values]


def test_references_equal_the_standard_library(spark):
    names = [f"&{name}{after}" for name in html5 for after in ("", "x", " y", ";", "&lt")]
    numbers = [*range(0x2FF), *range(0xD7F0, 0xD810), *range(0xDFF0, 0xE010), *range(0xFDC0, 0xFE00)]
    numbers += [n + (plane << 16) for plane in range(18) for n in (0, 0xFFFD, 0xFFFE, 0xFFFF)]
    numbers += [9_999_999, 10**7, 10**30, 0xFFFFFF, 16**20]
    forms = ("&#{0};", "&#{0}z", "&#000{0};", "&#x{0:x};", "&#X{0:X}g", "&#x000{0:x};")
    odd = ["&", "&&", "&#", "&#;", "&#x", "&#x;", "&#xg;", "&;", "& amp;", "&am;p;", "a&b&amp", "&ampamp;",
           "&notin;", "&notit;", "&noti&notin", "&AMP&amp;", "&" + "a" * 40 + ";", "&frac123;", "&#38;#38;", None, ""]
    values = names + [form.format(n) for n in numbers for form in forms] + odd
    found = column(spark, values, text.unescape)
    wanted = [value and html.unescape(value) for value in values]
    # A surrogate or a number past the last character has no other form in both.
    assert [x for x in zip(values, found, wanted, strict=True) if x[1] != x[2]] == []
    plan = spark.createDataFrame([("a",)], "v string").select(text.html_to_text(F.col("v")))
    assert "EvalPython" not in plan._jdf.queryExecution().toString()


def test_html_to_text(spark):
    cases = {
        "one<br>two<BR />three": "one\ntwo\nthree",
        "<p>A</p><p></p><p></p><p>B</p>": "A\n\n B",
        "<span>in</span><span>out</span>": "in out",
        "x &amp; y&nbsp;": "x & y",
        "<script>var a = 1;</script>z": "var a = 1; z",
        "</section>q</h5>r</h4>s": "q r\ns",
        "a < b": "a < b",
        "　k　": "k",
    }
    assert column(spark, list(cases), text.html_to_text) == list(cases.values())


def test_sha256_of_empty_text(spark):
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"
    assert column(spark, [""], text.sha256_hex) == [empty]


def test_without_prefix_takes_the_prefix_literally(spark):
    found = column(spark, ["(a|b) x", "(a|b)x", "a x", None], lambda c: text.without_prefix(c, F.lit("(a|b)")))
    assert found == ["x", "x", "a x", None]


def test_bracket_company(spark):
    cases = {"[A] x": "A", "[ A ] x": "A", "x [A]": "", "[] x": "", "[A\nB] x": "", "[A][B]": "A"}
    assert column(spark, list(cases), titles.bracket) == list(cases.values())


def test_saramin_title_marks_go_in_a_fixed_order(spark):
    cases = {
        "[Co] Dev(D-12) - 사람인": "[Co] Dev",
        "[Co] Dev - 사람인(D-12)": "[Co] Dev - 사람인",
        "Dev-사람인 ": "Dev",
    }
    assert column(spark, list(cases), titles.saramin_text) == list(cases.values())


def test_jobkorea_title_keeps_what_follows_the_first_mark(spark):
    cases = {
        "Seoul 채용 - Co [Dev] | 잡코리아": "Co [Dev]",
        "a 채용 - b 채용 - c": "b 채용 - c",
        "a채용 - b": "a채용 - b",
    }
    assert column(spark, list(cases), titles.jobkorea_text) == list(cases.values())


def test_groupby_experience(spark):
    cases = {
        "무관 Dev": "무관",
        "Dev (신입)": "신입",
        "Dev (2년 이하)": "2년 이하",
        "Dev (경력무관) x": "경력무관",
        "Dev (5년 이상)": None,
        "Dev 무관": None,
    }
    assert column(spark, list(cases), titles.groupby_experience) == list(cases.values())


def test_authority(spark):
    cases = {
        "https://WWW.Catch.co.kr/x": "www.catch.co.kr",
        "http://me:pw@catch.co.kr:81?q": "me:pw@catch.co.kr:81",
        "//groupby.kr#f": "groupby.kr",
        "www.wanted.co.kr/wd/1": "",
        " https://a.b/c": "a.b",
        "https://사람인.kr/": "사람인.kr",
        "mailto:a@b.c": "",
    }
    assert column(spark, list(cases), authority) == list(cases.values())


def test_links_are_distinct_and_absolute(spark):
    page = '<a href="/wd/9"></a><a href="/wd/12"></a><a href="/wd/9"></a><a href="/wd/x"></a>'
    found = column(spark, [page], lambda c: F.array_sort(detail_links(c, "wanted")))
    assert found == [["https://www.wanted.co.kr/wd/12", "https://www.wanted.co.kr/wd/9"]]


def test_local_date_is_the_date_as_written(spark):
    cases = {
        "2026-03-24T10:53:33.864638Z": "2026-03-24",
        "2026-03-24T23:30:00-05:00": "2026-03-24",
        "2026-03-24": "2026-03-24",
        # Staging cannot read the basic form or another separator, so they are no times.
        "20260324T0930": None,
        "20260324T105333Z": None,
        "2026-03-24x10:00:00": None,
        "2026-03-24 09": "2026-03-24",
        "2026-02-30": None,
        "2026-3-4": None,
        "2026": None,
        "2026-03-24T": None,
        "2026-03-24T25:00": None,
        "2026-03-24x": None,
        "0000-01-01": None,
        "어제": None,
        "": None,
    }
    assert column(spark, list(cases), local_date) == list(cases.values())
