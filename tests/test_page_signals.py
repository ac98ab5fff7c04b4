import json

import pytest

from hiregrain.functions.page_signals import PageReader, page_signals


@pytest.mark.parametrize(
    "page, title",
    [
        ("<title>\n one\n two </title>", "one\n two"),
        ("<title>open", "open"),
        ("<head><title>cut</head><body>rest", "cut"),
        ("<title>a<b>c</b>d</title>", "acd"),
        ("<title>first</title><title>second</title>", "first"),
        ("<!-- <title>no</title> --><title>yes</title>", "yes"),
        ("<script>'<title>no</title>'</script><title>yes</title>", "yes"),
        ("<TITLE>x &amp; y &nope; &#65;</TITLE>", "x & y &nope A"),
        ("<title></title>", ""),
        ("<p>none</p>", None),
    ],
)
def test_title(page, title):
    assert page_signals(page).get("title_tag") == title


@pytest.mark.parametrize(
    "page, content",
    [
        ('<meta content="d" name="description">', "d"),
        ("<META NAME='description' CONTENT=' d '/>", "d"),
        ('<meta name="description" content="">', ""),
        ('<meta name="description">', None),
        ('<meta name="description"><meta name="description" content="late">', None),
        ('<meta name="Description" content="other case">', None),
        ('<meta name="description" content="&amp;lt;">', "&lt;"),
        ('<meta name="descri&#112;tion" content="coded name">', "coded name"),
        ('<meta property="description" content="wrong attribute">', None),
    ],
)
def test_description(page, content):
    assert page_signals(page).get("meta_description") == content


def test_og_title_and_canonical():
    page = (
        '<link rel="stylesheet" href="/s.css"><link href=" /a?x=1&amp;y=2 " rel="nofollow canonical">'
        '<meta content="og" property="og:title">'
    )
    assert page_signals(page) == {"canonical_href": "/a?x=1&y=2", "og_title": "og"}
    assert page_signals('<link rel="canonical">')["canonical_href"] is None


def script(text):
    return f'<script type="application/ld+json">{text}</script>'


def test_linked_data_takes_the_first_posting_and_skips_broken_blocks():
    posting = {"@type": "JobPosting", "title": "사과 &amp;", "other": 1}
    page = (
        script("{broken,,}") + script("  ") + script('{"@type": ["JobPosting"]}')
        + script(json.dumps([1, {"@type": "Thing"}, posting]))
        + script('{"@type": "JobPosting", "title": "second"}')
    )
    assert json.loads(page_signals(page)["job_ld"]) == {"title": "사과 &amp;"}


def test_linked_data_with_lone_surrogates_stays_encodable():
    page = script('{"@type":"JobPosting","title":"\\ud83d"}')
    page_signals(page)["job_ld"].encode("utf-8")


def test_every_linked_object_in_order():
    page = script("[1, [2], {\"a\": 1}]") + script("nope") + script('{"b": NaN}')
    reader = PageReader({"every object"}, all_objects=True).read(page)
    assert [json.loads(entry) for entry in reader.objects] == [{"a": 1}, {"b": "NaN"}]


@pytest.mark.parametrize(
    "page", ["<", "<a", "<title", "</", "<!", "<![x[", "<!--", "&", "<script>", "<meta a=", "\x00<p>"]
)
def test_broken_pages_do_not_raise(page):
    page_signals(page + "title <title>description")
