"""URL parts and link extraction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hiregrain.functions.text import DIGIT

# Leading characters dropped from a URL (C0 controls and the space).
_LEADING = "".join(chr(code) for code in range(0x21))


def authority(url: Column) -> Column:
    """Lower-cased authority with user info and port; empty without ``//``."""
    cleaned = F.translate(F.ltrim(url, F.lit(_LEADING)), "\t\r\n", "")
    return F.lower(
        F.regexp_extract(cleaned, r"^(?:[a-zA-Z][a-zA-Z0-9+.\-]*:)?//([^/?#]*)", 1)
    )


# How detail links look on each listing site.
LISTING_LINKS = {
    "jobkorea": (rf"(/Recruit/GI_Read/{DIGIT}+)", "https://www.jobkorea.co.kr"),
    "wanted": (rf'href="(/wd/{DIGIT}+)"', "https://www.wanted.co.kr"),
}


def detail_links(html: Column, site: str) -> Column:
    """Distinct absolute detail links of one listing page, as an array."""
    pattern, base = LISTING_LINKS[site]
    paths = F.array_distinct(F.regexp_extract_all(html, F.lit(pattern), F.lit(1)))
    return F.transform(paths, lambda path: F.concat(F.lit(base), path))
