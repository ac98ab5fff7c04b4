"""Fields of a JSON-LD job posting held as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# JSON texts that count as "no value".
_EMPTY_JSON = ("null", "0", "0.0", "-0.0", "false", '""', "[]", "{}")


def part(value: Column, path: str) -> Column:
    return F.try_variant_get(value, path, "variant")


def is_kind(value: Column, name: str) -> Column:
    """Whether a variant is of a kind: OBJECT, ARRAY, STRING, VOID, BOOLEAN, ..."""
    return F.coalesce(F.startswith(F.schema_of_variant(value), F.lit(name)), F.lit(False))


def as_text(value: Column) -> Column:
    """The string itself, NULL for any other shape."""
    return F.when(is_kind(value, "STRING"), F.try_variant_get(value, "$", "string"))


def is_mistyped(value: Column) -> Column:
    """A value is there, but it is not text."""
    return (
        value.isNotNull() & ~is_kind(value, "STRING") & ~F.to_json(value).isin(*_EMPTY_JSON)
    )


def _scalar_text(value: Column) -> Column:
    """Text of one filled value: booleans as True/False, objects as JSON, empties NULL."""
    shown = F.to_json(value)
    plain = F.try_variant_get(value, "$", "string")
    return (
        F.when(shown.isin(*_EMPTY_JSON), F.lit(None))
        .when(shown == "true", "True")
        .otherwise(F.coalesce(plain, shown))
    )


def joined(value: Column) -> Column:
    """A scalar's text, or the filled items of a list joined with commas."""
    items = F.try_variant_get(value, "$", "array<variant>")
    return F.coalesce(F.array_join(F.transform(items, _scalar_text), ", "), _scalar_text(value))


def of_first_place(posting: Column, field: str) -> Column:
    """A field of the workplace's address; of the first one if there are several."""
    return F.coalesce(
        part(posting, f"$.jobLocation[0].address.{field}"),
        part(posting, f"$.jobLocation.address.{field}"),
    )


def place_name(region: Column, locality: Column) -> Column:
    """``region locality``, or the one that is known when they agree or one is missing."""
    both = region.isNotNull() & locality.isNotNull() & (region != locality)
    return F.when(both, F.concat_ws(" ", region, locality)).otherwise(F.coalesce(region, locality))
