"""Lake keys of a job."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ISO-8601 date and time texts, extended or basic form; the two-digit
# groups are range-checked here, the calendar date by the caller.
_HOUR, _MIN = "(?:[01][0-9]|2[0-3])", "[0-5][0-9]"
_EXTENDED = rf"{_HOUR}(?::{_MIN}(?::{_MIN}(?:[.,][0-9]+)?)?)?"
_BASIC = rf"{_HOUR}(?:{_MIN}(?:{_MIN}(?:[.,][0-9]+)?)?)?"
_TIME = f"(?:{_EXTENDED}|{_BASIC})"
_OFFSET = f"(?:Z|[+-]{_TIME})"
ISO_TIMESTAMP = (
    rf"(?s)^[0-9]{{4}}(?:-[0-9]{{2}}-[0-9]{{2}}|[0-9]{{4}})(?:[^Z]{_TIME}{_OFFSET}?)?\z"
)


def local_date(collected_at: Column) -> Column:
    """``yyyy-MM-dd`` as written, in the text's own offset; NULL unless it is an ISO-8601 time
    that staging can read, so that no document is made that no load can take."""
    digits = F.replace(F.left(collected_at, F.lit(10)), F.lit("-"), F.lit(""))
    date = F.try_to_date(F.left(digits, F.lit(8)), "yyyyMMdd")
    loads = F.try_to_timestamp(collected_at).isNotNull()
    good = F.regexp_like(collected_at, F.lit(ISO_TIMESTAMP)) & (F.year(date) > 0) & loads
    return F.when(good, F.date_format(date, "yyyy-MM-dd"))


def lake_keys(source: Column, dt: Column, job_id: Column) -> dict[str, Column]:
    def key(*pieces) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in pieces])

    return {
        "raw_s3_key": key("raw/job_postings/source=", source, "/dt=", dt, "/", job_id, ".html"),
        "processed_s3_key": key(
            "processed/job_postings/source=", source, "/dt=", dt, "/", job_id, ".json"
        ),
        "curated_s3_key": key("curated/job_postings/dt=", dt, "/", job_id, ".json"),
    }
