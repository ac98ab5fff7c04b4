"""Per-site rules for page titles and descriptions.

Each rule refers to its argument a few times, so arguments should be plain columns.
Nothing here decodes entities: callers decode many texts in one Arrow pass.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hiregrain.functions.text import DIGIT, WS, capture, strip, without_prefix


def _without_tail(text: Column, tail: str) -> Column:
    return strip(F.regexp_replace(text, tail, ""))


def _without_site(text: Column, separator: str, site: str) -> Column:
    return _without_tail(text, rf"(?U)[{WS}]*{separator}[{WS}]*{site}[{WS}]*$")


def wanted_text(title: Column) -> Column:
    return _without_tail(_without_site(title, r"\|", "원티드"), rf"(?U)[{WS}]*채용 공고[{WS}]*$")


def catch_text(title: Column) -> Column:
    return _without_site(title, r"\|", "캐치")


def saramin_text(title: Column) -> Column:
    """Site suffix first, deadline mark second; in the other order both would stay."""
    return _without_tail(_without_site(title, "-", "사람인"), rf"(?U)\(D-{DIGIT}+\)[{WS}]*$")


def jobkorea_text(title: Column) -> Column:
    """Text after the first ``채용 -`` mark, or the whole title without it."""
    return strip(F.regexp_replace(_without_site(title, r"\|", "잡코리아"), "(?s)^.*? 채용 - ", ""))


def groupby_text(title: Column) -> Column:
    return strip(F.replace(title, F.lit("무관 "), F.lit("")))


def bracket(text: Column) -> Column:
    """``[company] rest``: the company; empty without a leading bracket."""
    return strip(F.regexp_extract(text, r"^\[([^\n]*?)\]", 1))


def without_bracket(text: Column, company: Column) -> Column:
    """Removes ``[company]`` where the company is known and stands there literally."""
    known = F.when(company != "", company)
    return without_prefix(text, F.concat(F.lit("["), known, F.lit("]")))


def catch_title(text: Column, company: Column) -> Column:
    title = _without_tail(without_bracket(text, company), rf"(?U)[{WS}]*채용[{WS}]*$")
    return _without_tail(title, rf"(?U)[{WS}]*\(~[^)]*\)[{WS}]*$")


def after_bracket(text: Column) -> Column:
    """What follows a leading bracket on the same line; NULL if it is another shape."""
    return strip(capture(text, rf"(?U)^\[[^\n]*?\][{WS}]*([^\n]*)\z"))


# ``company [title]`` of a cleaned title, with the company as group 1.
COMPANY_THEN_BRACKET = rf"(?U)^([^\n]*?)[{WS}]+(\[[^\n]*\][^\n]*)\z"


def parts(description: Column, separator: str) -> Column:
    """Non-blank parts of a cleaned description."""
    pieces = F.transform(F.split(description, separator), lambda piece: strip(piece))
    return F.filter(pieces, lambda piece: piece != "")


def saramin_experience(description: Column) -> Column:
    return strip(capture(description, rf"(?U)경력:[{WS}]*([^,]+)"))


def jobkorea_experience(description: Column) -> Column:
    return capture(description, rf"(?U)경력[{WS}]*:[{WS}]*([^,]+)")


def groupby_experience(title: Column) -> Column:
    inside = strip(capture(title, r"\(([^)]*년 이하|신입|경력무관)\)"))
    return F.when(F.startswith(title, F.lit("무관 ")), F.lit("무관")).otherwise(inside)
