"""The site registry and the six posting fields each site's rules give.

A site is one ``SiteRule``: where its hosts are, which raw texts it needs decoded and
how the decoded texts become fields. Routing, flags and extraction follow from it.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiregrain.functions import linked_data as ld
from hiregrain.functions import titles
from hiregrain.functions.text import (
    blank_to_null,
    collapse,
    drop_tags,
    first_filled,
    item,
    tidy_lines,
    unescape_all,
    without_prefix,
)
from hiregrain.functions.urls import authority
from hiregrain.operators.steps import settled
from hiregrain.schemas import POSTING_FIELDS


@dataclass(frozen=True)
class Raw:
    """Texts a site wants decoded."""

    company: Column | None = None
    title: Column | None = None
    description: Column | None = None
    experience: Column | None = None


@dataclass(frozen=True)
class Fields:
    company_name: Column | None = None
    title: Column | None = None
    location: Column | None = None
    employment_type: Column | None = None
    experience_level: Column | None = None
    description_text: Column | None = None


def _c(name: str) -> Column:
    return F.col(name)


# The steps below run in this order; each may use the columns made before it.
#   given:         url, title_tag, og_title, meta_description, job_ld, body_markup
#   first:         page_title (og_title, else title_tag)
#   title_text():  page title without what the site adds to it
#   then:          bracket (leading ``[...]`` of title_text), ld_description
#   raw():         texts to decode
#   then, decoded and whitespace-clean:
#                  named_company, named_title, named_experience, meta_text,
#                  ld_company, ld_title, ld_region, ld_locality;
#                  decoded only: description, body_text; joined: ld_employment,
#                  ld_experience; location, summary (parts of meta_text)
#   again:         named_title split by a pattern, both groups cleaned once more:
#                  again_company, again_title
#   fields():      the six posting fields


@dataclass(frozen=True)
class SiteRule:
    name: str
    domain: str
    title_text: Callable[[], Column]
    raw: Callable[[], Raw]
    fields: Callable[[], Fields]
    reads_linked_data: bool = True
    separator: str | None = None
    again: str | None = None
    # A page on which the rules cannot work: the error's name, else NULL.
    error: Callable[[], Column] | None = None
    disable_ssl_verify: bool = False
    refetch_canonical: bool = False


def _markup_description() -> Column:
    """Linked-data description as an HTML fragment, else the meta description."""
    return F.coalesce(blank_to_null(tidy_lines(_c("description"))), _c("meta_text"))


def _plain_description() -> Column:
    return F.coalesce(collapse(_c("description")), _c("meta_text"))


def _or(kept: str, other: Column) -> Column:
    """A column unless it is empty and another value is there."""
    return F.coalesce(blank_to_null(_c(kept)), other, _c(kept))


def _wanted_raw() -> Raw:
    title = titles.without_bracket(_c("title_text"), _c("bracket"))
    return Raw(_c("bracket"), title, drop_tags(_c("ld_description")))


def _wanted_fields() -> Fields:
    return Fields(
        F.coalesce(_c("ld_company"), _c("named_company")),
        F.coalesce(_c("ld_title"), _c("named_title")),
        _c("location"),
        _c("ld_employment"),
        _c("ld_experience"),
        _markup_description(),
    )


def _groupby_raw() -> Raw:
    return Raw(title=_c("title_text"), description=drop_tags(_c("ld_description")))


def _groupby_fields() -> Fields:
    return Fields(
        _c("ld_company"),
        F.coalesce(_c("ld_title"), _c("named_title")),
        _c("location"),
        _c("ld_employment"),
        titles.groupby_experience(_c("title_tag")),
        _markup_description(),
    )


def _saramin_raw() -> Raw:
    return Raw()


def _saramin_fields() -> Fields:
    own = first_filled(titles.after_bracket(_c("title_text")), _c("title_text"))
    return Fields(
        company_name=first_filled(_c("bracket"), item(_c("summary"), 0)),
        title=first_filled(own, item(_c("summary"), 1)),
        experience_level=titles.saramin_experience(_c("meta_text")),
        description_text=_c("meta_text"),
    )


def _catch_raw() -> Raw:
    title = titles.catch_title(_c("title_text"), _c("bracket"))
    return Raw(_c("bracket"), title, _c("ld_description"))


def _catch_fields() -> Fields:
    company = F.coalesce(_c("ld_company"), _c("named_company"))
    title = F.coalesce(_c("ld_title"), _c("named_title"))
    return Fields(
        company,
        titles.without_bracket(title, company),
        _or("location", item(_c("summary"), 4)),
        _or("ld_employment", item(_c("summary"), 1)),
        _or("ld_experience", item(_c("summary"), 0)),
        _plain_description(),
    )


def _catch_error() -> Column:
    # A description of nothing but encoded blanks has no parts to read.
    return F.when((_c("meta_description") != "") & _c("meta_text").isNull(), "AttributeError")


def _jobkorea_raw() -> Raw:
    return Raw(
        title=_c("title_text"),
        description=_c("ld_description"),
        experience=titles.jobkorea_experience(_c("meta_description")),
    )


def _jobkorea_fields() -> Fields:
    company = F.coalesce(_c("ld_company"), _c("again_company"))
    split = F.regexp_like("named_title", F.lit(titles.COMPANY_THEN_BRACKET))
    title = F.coalesce(
        _c("ld_title"), F.when(split, _c("again_title")).otherwise(_c("named_title"))
    )
    # An experience mark decides even if nothing but blanks is left of its text.
    marked = F.when(
        titles.jobkorea_experience(_c("meta_description")).isNotNull(), _c("named_experience")
    ).otherwise(_c("ld_experience"))
    return Fields(
        company,
        without_prefix(title, company),
        _c("location"),
        None,
        F.coalesce(blank_to_null(_c("ld_experience")), marked),
        _plain_description(),
    )


# Domains and flags, in the order they are tried.
SITES: tuple[SiteRule, ...] = (
    SiteRule(
        "wanted",
        "wanted.co.kr",
        lambda: titles.wanted_text(_c("title_tag")),
        _wanted_raw,
        _wanted_fields,
    ),
    SiteRule(
        "saramin",
        "saramin.co.kr",
        lambda: titles.saramin_text(_c("page_title")),
        _saramin_raw,
        _saramin_fields,
        reads_linked_data=False,
        separator=",",
        disable_ssl_verify=True,
        refetch_canonical=True,
    ),
    SiteRule(
        "groupby",
        "groupby.kr",
        lambda: titles.groupby_text(_c("page_title")),
        _groupby_raw,
        _groupby_fields,
    ),
    SiteRule(
        "jobkorea",
        "jobkorea.co.kr",
        lambda: titles.jobkorea_text(_c("page_title")),
        _jobkorea_raw,
        _jobkorea_fields,
        again=titles.COMPANY_THEN_BRACKET,
    ),
    SiteRule(
        "catch",
        "catch.co.kr",
        lambda: titles.catch_text(_c("page_title")),
        _catch_raw,
        _catch_fields,
        separator=r"\|",
        error=_catch_error,
    ),
)

# Hosts without a rule of their own.
OTHER = SiteRule(
    "",
    "",
    lambda: _c("page_title"),
    lambda: Raw(title=_c("title_text")),
    lambda: Fields(
        title=_c("named_title"), description_text=F.coalesce(_c("meta_text"), _c("body_text"))
    ),
    reads_linked_data=False,
)


def site_of(url: Column, sites: tuple[SiteRule, ...] = SITES) -> Column:
    """Name of the first site whose domain occurs in the URL's authority, else NULL."""
    host = authority(url)
    name = F.when(F.lit(False), F.lit(None).cast("string"))
    for site in sites:
        name = name.when(F.contains(host, F.lit(site.domain)), site.name)
    return name


def site_flag(site: Column, flag: str, sites: tuple[SiteRule, ...] = SITES) -> Column:
    on = [rule.name for rule in sites if getattr(rule, flag)]
    return F.coalesce(site.isin(*on), F.lit(False))


def _by_site(
    pick: Callable[[SiteRule], Column | None],
    sites: tuple[SiteRule, ...],
    kind: str = "string",
) -> Column:
    """One column: what ``pick`` gives for the row's site, NULL where it gives none."""
    chain = F.when(F.lit(False), F.lit(None).cast(kind))
    for site in sites:
        column = pick(site)
        if column is not None:
            chain = chain.when(F.col("site") == site.name, column)
    other = pick(OTHER)
    return chain if other is None else chain.when(F.col("site").isNull(), other)


# Texts decoded together, in this order; the last two keep their line breaks.
_CLEAN = (
    "named_company",
    "named_title",
    "named_experience",
    "meta_text",
    "ld_company",
    "ld_title",
    "ld_region",
    "ld_locality",
)
_DECODED = (*_CLEAN, "description", "body")
_TEXT_FIELD = ("description_text",)
_LD_TEXTS = ("company", "title", "region", "locality", "description")


def _linked_data(rows: DataFrame) -> DataFrame:
    """Texts and joined lists of the linked-data posting, and whether one is no text."""
    posting = F.col("_posting")
    values = rows.withColumns(
        {
            "_ld_company": ld.part(posting, "$.hiringOrganization.name"),
            "_ld_title": ld.part(posting, "$.title"),
            "_ld_description": ld.part(posting, "$.description"),
            "_ld_region": ld.of_first_place(posting, "addressRegion"),
            "_ld_locality": ld.of_first_place(posting, "addressLocality"),
            "_employment": ld.part(posting, "$.employmentType"),
            "_experience": ld.part(posting, "$.experienceRequirements"),
        }
    )
    mistyped = [ld.is_mistyped(F.col(f"_ld_{name}")) for name in _LD_TEXTS]
    return values.withColumns(
        {
            "_mistyped": reduce(Column.__or__, mistyped),
            **{f"ld_{name}": ld.as_text(F.col(f"_ld_{name}")) for name in _LD_TEXTS},
            "ld_employment": ld.joined(F.col("_employment")),
            "ld_experience": ld.joined(F.col("_experience")),
        }
    )


def extract_fields(
    pages: DataFrame, sites: tuple[SiteRule, ...] = SITES, body_length: int | None = None
) -> DataFrame:
    """Adds ``site``, the six posting fields, ``stored_text`` and ``extract_error``.

    Needs pages with their facts. ``stored_text`` is the description, or the page's
    text without one (whole, or its first ``body_length`` characters), cleaned as curated
    documents hold it.

    Every intermediate text is a column of its own, as the rules use most of them more
    than once. Decoding takes two Arrow passes whatever the number of sites: one over
    an array of all raw texts, one over the texts that are cleaned twice.
    """
    kept = pages.columns
    rules = (*sites, OTHER)

    def by_rule(made: dict, name: str) -> Column:
        return _by_site(lambda site: getattr(made[site.name], name), sites)

    def lists(pick: Callable[[SiteRule], Column | None]) -> Column:
        return _by_site(pick, sites, "array<string>")

    rows = pages.withColumns(
        {
            "site": site_of(F.col("url"), sites),
            "page_title": first_filled(F.col("og_title"), F.col("title_tag")),
        }
    )
    reads = F.col("site").isin(*[site.name for site in sites if site.reads_linked_data])
    rows = rows.withColumns(
        {
            "_posting": F.when(reads, F.try_parse_json("job_ld")),
            "title_text": _by_site(lambda site: site.title_text(), sites),
        }
    )
    rows = _linked_data(rows.withColumn("bracket", titles.bracket(F.col("title_text"))))

    raws = {rule.name: rule.raw() for rule in rules}
    named = [by_rule(raws, name) for name in ("company", "title", "experience")]
    linked = [F.col(name) for name in _CLEAN[4:]]
    texts = F.array(
        *named, F.col("meta_description"), *linked, by_rule(raws, "description"), "body_markup"
    )
    rows = rows.withColumn("_raw", texts).withColumn("_decoded", unescape_all(F.col("_raw")))
    body = tidy_lines(item(F.col("_decoded"), _DECODED.index("body")))
    rows = settled(
        rows,
        {
            **{name: collapse(item(F.col("_decoded"), at)) for at, name in enumerate(_CLEAN)},
            "description": item(F.col("_decoded"), _DECODED.index("description")),
            "body_text": body if body_length is None else F.left(body, F.lit(body_length)),
        },
    )

    fields = {rule.name: rule.fields() for rule in rules}
    rows = rows.withColumns(
        {
            "summary": lists(
                lambda site: site.separator and titles.parts(F.col("meta_text"), site.separator)
            ),
            "location": ld.place_name(F.col("ld_region"), F.col("ld_locality")),
            "_groups": lists(
                lambda site: site.again
                and F.array(*[F.regexp_extract("named_title", site.again, at) for at in (1, 2)])
            ),
            "_described": by_rule(fields, "description_text"),
        }
    )
    stored = first_filled(F.col("_described"), F.col("body_text"))
    rows = rows.withColumn(
        "_raw", F.array(item(F.col("_groups"), 0), item(F.col("_groups"), 1), stored)
    ).withColumn("_decoded", unescape_all(F.col("_raw")))
    rows = rows.withColumns(
        {
            name: collapse(item(F.col("_decoded"), at))
            for at, name in enumerate(("again_company", "again_title", "stored_text"))
        }
    )
    errors = {site.name: site.error() for site in sites if site.error}
    return rows.select(
        *kept,
        "site",
        *[by_rule(fields, name).alias(name) for name in POSTING_FIELDS if name not in _TEXT_FIELD],
        F.col("_described").alias("description_text"),
        "stored_text",
        F.coalesce(
            F.when(F.col("_mistyped"), "TypeError"), _by_site(lambda s: errors.get(s.name), sites)
        ).alias("extract_error"),
    )
