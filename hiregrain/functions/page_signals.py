"""One tokenizer pass over a page for the few head signals the site rules need."""

from __future__ import annotations

import html
import json
import re
from collections import Counter
from html.entities import html5
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hiregrain.schemas import SIGNALS

# Elements that never have content.
_VOID = frozenset(
    "area base basefont bgsound br col command embed frame hr image img input isindex keygen "
    "link menuitem meta nextid param source spacer track wbr".split()
)
# The linked-data fields the site rules read.
_POSTING_KEYS = (
    "title",
    "hiringOrganization",
    "jobLocation",
    "employmentType",
    "experienceRequirements",
    "description",
)
# A page can only carry a signal whose marker it contains. Character references in an
# attribute could hide a marker, so pages with such are searched for everything; only
# numeric references and these names stand for characters that occur in markers.
_MARKERS = {
    "title_tag": re.compile("<title", re.I),
    "og_title": re.compile("og:title"),
    "meta_description": re.compile("description"),
    "canonical_href": re.compile("canonical"),
    "job_ld": re.compile(r"ld\+json"),
}
_HIDING = ("&#", "&plus", "&sol", "&colon")
_ENCODED = re.compile(
    r"""\b(?:name|property|rel|type)\s*=\s*(?:"[^"&]*&|'[^'&]*&|[^\s"'>&]*&)""", re.I
)


class _Found(Exception):
    """Everything looked for has been seen; the rest of the page cannot matter."""


def linked_objects(script: str) -> list[dict]:
    """Objects of one linked-data block; a broken block has none."""
    try:
        parsed = json.loads(script, parse_constant=str)
    except (ValueError, RecursionError):
        return []
    found = parsed if isinstance(parsed, list) else [parsed]
    return [entry for entry in found if isinstance(entry, dict)]


def _json_text(value: dict) -> str:
    text = json.dumps(value, ensure_ascii=False)
    try:
        text.encode("utf-8")
    except UnicodeEncodeError:
        return json.dumps(value)
    return text


class PageReader(HTMLParser):
    """Collects the wanted signals in document order; the first occurrence decides."""

    def __init__(self, wanted: set[str], all_objects: bool = False):
        super().__init__(convert_charrefs=False)
        self.wanted = wanted
        self.signals: dict[str, str | None] = {}
        self.objects: list[str] | None = [] if all_objects else None
        self._open: list[str] = []
        self._open_count: Counter[str] = Counter()
        self._title: list[str] | None = None
        self._script: list[str] | None = None

    def _settle(self, name: str, value: str | None) -> None:
        if name in self.wanted:
            self.wanted.discard(name)
            self.signals[name] = value
            if not self.wanted:
                raise _Found

    def handle_startendtag(self, tag, attrs):
        self._start(tag, attrs)
        if tag not in _VOID:
            self.handle_endtag(tag)

    def handle_starttag(self, tag, attrs):
        self._start(tag, attrs)

    def _start(self, tag, attrs):
        if tag not in _VOID:
            self._open.append(tag)
            self._open_count[tag] += 1
        if tag == "meta":
            given = {name: value or "" for name, value in attrs}
            content = given.get("content")
            content = None if content is None else content.strip()
            if given.get("name") == "description":
                self._settle("meta_description", content)
            if given.get("property") == "og:title":
                self._settle("og_title", content)
        elif tag == "link":
            given = {name: value or "" for name, value in attrs}
            if "canonical" in given.get("rel", "").split():
                self._settle("canonical_href", given.get("href", "").strip() or None)
        elif tag == "title" and "title_tag" in self.wanted and self._title is None:
            self._title = []
            self._title_depth = len(self._open)
        elif tag == "script" and dict(attrs).get("type") == "application/ld+json":
            self._script = []

    def handle_endtag(self, tag):
        if not self._open_count[tag]:
            return
        closed = None
        while closed != tag:
            closed = self._open.pop()
            self._open_count[closed] -= 1
        if tag == "script":
            self._end_script()
        if self._title is not None and len(self._open) < self._title_depth:
            self._end_title()

    def _end_title(self):
        text, self._title = "".join(self._title), None
        self._settle("title_tag", text.strip())

    def _end_script(self):
        if self._script is None:
            return
        text, self._script = "".join(self._script).strip(), None
        for entry in linked_objects(text) if text else ():
            if self.objects is not None:
                self.objects.append(_json_text(entry))
            if entry.get("@type") == "JobPosting":
                wanted = {key: entry[key] for key in _POSTING_KEYS if key in entry}
                self._settle("job_ld", _json_text(wanted))

    def handle_data(self, data):
        if self._script is not None:
            self._script.append(data)
        elif self._title is not None and self.cdata_elem is None:
            self._title.append(data)

    def handle_entityref(self, name):
        self.handle_data(html5.get(name + ";", "&" + name))

    def handle_charref(self, name):
        self.handle_data(html.unescape(f"&#{name};"))

    def unknown_decl(self, data):
        if data[:6].upper() == "CDATA[":
            self.handle_data(data[6:])

    def read(self, page: str) -> "PageReader":
        try:
            self.feed(page)
            self.close()
            if self._script is not None:
                self._end_script()
            if self._title is not None:
                self._end_title()
        except (_Found, AssertionError):
            # An unreadable declaration ends the page; what was seen before it counts.
            pass
        return self


def page_signals(page: str) -> dict[str, str | None]:
    if any(mark in page for mark in _HIDING) and _ENCODED.search(page):
        wanted = set(_MARKERS)
    else:
        wanted = {name for name, marker in _MARKERS.items() if marker.search(page)}
    return PageReader(wanted).read(page).signals if wanted else {}


@F.arrow_udf(SIGNALS)
def signals_of(pages: pa.Array) -> pa.Array:
    """html -> (title_tag, og_title, meta_description, canonical_href, job_ld)."""
    read = [page_signals(text) if (text := page.as_py()) else {} for page in pages]
    names = SIGNALS.fieldNames()
    return pa.StructArray.from_arrays(
        [pa.array([row.get(name) for row in read], pa.string()) for name in names], names
    )


@F.arrow_udf(T.ArrayType(T.StringType()))
def linked_objects_of(pages: pa.Array) -> pa.Array:
    """html -> JSON text of every linked-data object, in document order."""
    return pa.array(
        [
            PageReader({"every object"}, all_objects=True).read(text).objects
            if (text := page.as_py())
            else []
            for page in pages
        ],
        pa.list_(pa.string()),
    )
