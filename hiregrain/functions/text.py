"""Whitespace, markup and entity cleaning on string columns."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters counted as whitespace (the Unicode set, with the
# four ASCII separators U+001C to U+001F). First as a regex class body for patterns that
# start with ``(?U)``, then spelled out.
WS = r"\s\x1c-\x1f"
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
DIGIT = r"\p{Nd}"


# Character references, as HTML 5 has them: the standard library lists the names. Those that may
# lack the semicolon are short, and also stand where other letters follow.
_NAMED: dict[str, dict[str, str]] = {}
for _name, _value in html5.items():
    _NAMED.setdefault(_name[0], {})[_name] = _value
_OPEN = {name: value for name, value in html5.items() if not name.endswith(";")}
_LONGEST_OPEN = max(map(len, _OPEN))
# Numbers of the C1 controls mean the characters of Windows-1252 where that has one.
_C1 = [bytes([n]).decode("cp1252", "ignore") or chr(n) for n in range(0x80, 0xA0)]
_UNKNOWN = "\ufffd"


def _constant(value: dict, kind: str) -> Column:
    """A map as one literal: the optimizer reads it once."""
    return F.from_json(F.lit(json.dumps(value)), kind)


def _character(number: Column) -> Column:
    """The character that a decimal number of at most seven digits stands for."""
    n = number.cast("int")
    control = n.between(1, 8) | (n == 11) | n.between(14, 31) | (n == 127)
    no_character = control | n.between(0xFDD0, 0xFDEF) | (n.bitwiseAND(0xFFFE) == 0xFFFE)
    code = F.decode(F.unhex(F.lpad(F.hex(n), 8, "0")), "UTF-32")
    return (
        F.when((n == 0) | (n > 0x10FFFF) | n.between(0xD800, 0xDFFF), _UNKNOWN)
        .when(n.between(0x80, 0x9F), F.get(F.array(*map(F.lit, _C1)), n - 0x80))
        .when(no_character, "")
        .otherwise(code)
    )


def _numbered(part: Column) -> Column:
    """What follows an ampersand and begins with a hash."""
    decimal = F.regexp_extract(part, "^#0*([0-9]*)", 1)
    hexadecimal = F.regexp_extract(part, "^#[xX]0*([0-9a-fA-F]*)", 1)
    rest = F.regexp_replace(part, "^#(?:[0-9]+|[xX][0-9a-fA-F]+);?", "")
    number = (
        F.when(~F.rlike(part, F.lit("^#[xX]")), F.when(F.length(decimal) < 8, decimal))
        .when(F.length(hexadecimal) < 7, F.conv(hexadecimal, 16, 10))
    )
    found = F.coalesce(_character(F.when(number == "", "0").otherwise(number)), F.lit(_UNKNOWN))
    known = F.rlike(part, F.lit("^#(?:[0-9]|[xX][0-9a-fA-F])"))
    return F.when(known, F.concat(found, rest)).otherwise(F.concat(F.lit("&"), part))


def _named(part: Column) -> Column:
    """What follows an ampersand, with the name at its beginning decoded if there is one."""
    name = F.regexp_extract(part, r"^[^\t\n\f <&#;]{1,32};?", 0)
    names = _constant(_NAMED, "map<string,map<string,string>>")
    whole = F.try_element_at(F.try_element_at(names, F.substring(name, 1, 1)), name)
    found = [F.concat(whole, F.substring(part, F.length(name) + 1, F.length(part)))]
    opened = _constant(_OPEN, "map<string,string>")
    for size in range(_LONGEST_OPEN, 1, -1):
        value = F.try_element_at(opened, F.substring(part, 1, size))
        short = F.concat(value, F.substring(part, F.lit(size + 1), F.length(part)))
        found.append(F.when(F.length(name) > size, short))
    return F.coalesce(*found, F.concat(F.lit("&"), part))


def _decoded(text: Column) -> Column:
    """A text that is cheap to name, as it is named several times."""

    def decoded(part: Column, k: Column) -> Column:
        after = F.when(F.startswith(part, F.lit("#")), _numbered(part)).otherwise(_named(part))
        return F.when(k == 0, part).otherwise(after)

    whole = F.array_join(F.transform(F.split(text, "&"), decoded), "")
    return F.when(F.contains(text, F.lit("&")), whole).otherwise(text)


def unescape_all(texts: Column) -> Column:
    """Decode character references in every text of an array; what is none stays as it is."""
    return F.transform(texts, _decoded)


def unescape(text: Column) -> Column:
    """Decode character references of one text, which is worked out once."""
    return F.get(unescape_all(F.array(text)), F.lit(0))


def strip(text: Column) -> Column:
    return F.trim(text, F.lit(WS_CHARS))


def blank_to_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def first_filled(*texts: Column) -> Column:
    """The first value that is neither NULL nor empty; the last one is taken as it is."""
    return F.coalesce(*[blank_to_null(text) for text in texts[:-1]], texts[-1])


def collapse(text: Column) -> Column:
    """Squeeze whitespace of already decoded text; nothing left becomes NULL."""
    return F.nullif(strip(F.regexp_replace(text, f"(?U)[{WS}]+", " ")), F.lit(""))


def normalize(text: Column) -> Column:
    """Decode entities, then squeeze whitespace."""
    return collapse(unescape(text))


def drop_tags(text: Column) -> Column:
    """Line breaks for block ends, a space for any other tag; entities are left alone."""
    broken = F.regexp_replace(text, f"(?iU)<br[{WS}]*/?>", "\n")
    ended = F.regexp_replace(broken, "(?i)</(?:p|div|li|h[1-4])>", "\n")
    return F.regexp_replace(ended, "<[^>]++>", " ")


def tidy_lines(text: Column) -> Column:
    """Keep at most one blank line between lines of decoded text and squeeze blanks."""
    one_gap = F.regexp_replace(text, f"(?U)\n[{WS}]*\n+", "\n\n")
    return strip(F.regexp_replace(one_gap, "[ \t]+", " "))


def html_to_text(markup: Column) -> Column:
    return tidy_lines(unescape(drop_tags(markup)))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text, 256)


def capture(text: Column, pattern: str, group: int = 1) -> Column:
    """Like ``regexp_extract``, but NULL where the pattern does not match."""
    return F.when(F.regexp_like(text, F.lit(pattern)), F.regexp_extract(text, pattern, group))


def without_prefix(text: Column, prefix: Column) -> Column:
    """Remove a literal prefix and the blanks around what is left."""
    rest = F.substring(text, F.length(prefix) + 1, F.length(text))
    return strip(F.when(F.startswith(text, prefix), rest).otherwise(text))


def item(values: Column, index: int) -> Column:
    return F.get(values, F.lit(index))
