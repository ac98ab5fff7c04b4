"""Message gates: bytes in, typed columns or a reason for rejection out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hiregrain.functions.linked_data import is_kind, part
from hiregrain.operators.steps import settled

REQUIRED_JOB_FIELDS = ("job_id", "source", "url", "collected_at")

# Names for the JSON shapes that are not objects.
_SHAPE_NAMES = {
    "ARRAY": "list",
    "STRING": "str",
    "BOOLEAN": "bool",
    "VOID": "NoneType",
    "BIGINT": "int",
    "DOUBLE": "float",
    "FLOAT": "float",
}
_INT_MAX = 2**31 - 1


def text_of(value: Column) -> Column:
    return value.cast("string")


def with_strict_json(messages: DataFrame, name: str) -> DataFrame:
    """Adds the one JSON value of ``value`` as VARIANT; NULL for any other bytes.

    Spark's parser ignores what follows the first value. So the text is parsed as one
    of two members of an object, both named after the text's own hash, which the text
    cannot contain: whatever it closes, adds or leaves open, there are no longer
    exactly these two.
    """
    text, mark = text_of(F.col("value")), F.md5("value")
    wrapped = F.concat(F.lit('{"'), mark, F.lit('v":'), text, F.lit('\n,"'), mark, F.lit('e":0}'))
    members = F.try_variant_get(F.try_parse_json(wrapped), "$", "map<string,variant>")
    readable = F.coalesce(F.is_valid_utf8(text), F.lit(False))
    parsed = settled(messages, {"_utf8": readable, "_members": F.when(readable, members)})
    value = F.try_element_at(F.col("_members"), F.concat(mark, F.lit("v")))
    return settled(parsed, {name: F.when(F.size("_members") == 2, value)}).drop("_members")


def _shape_name(value: Column) -> Column:
    shape = F.schema_of_variant(value)
    name = F.when(shape.rlike(r"^DECIMAL\(\d+,0\)"), "int").when(
        F.startswith(shape, F.lit("DECIMAL")), "float"
    )
    for prefix, shown in _SHAPE_NAMES.items():
        name = name.when(F.startswith(shape, F.lit(prefix)), shown)
    return name


def filled_text(value: Column, field: str) -> Column:
    """A non-empty JSON string under ``field``, NULL for anything else."""
    found = part(value, f"$.{field}")
    text = F.try_variant_get(value, f"$.{field}", "string")
    return F.when(is_kind(found, "STRING") & (text != ""), text)


def retry_count(job: Column) -> Column:
    """Whole attempts so far; 0 when absent or not a number."""
    counted = F.try_variant_get(job, "$.retry_count", "bigint")
    bounded = F.greatest(F.least(counted, F.lit(_INT_MAX)), F.lit(-_INT_MAX)).cast("int")
    return F.when(counted.isNotNull(), bounded).otherwise(0)


def gate_jobs(messages: DataFrame, raw_length: int | None = None) -> DataFrame:
    """Adds ``malformed_reason`` (NULL = good), the job's fields and its whole JSON.

    ``raw_message`` is the text of a malformed message, whole or cut to ``raw_length``.

    Every message comes out again; nothing in one can make the job fail.
    """
    text = text_of(F.col("value"))
    parsed = with_strict_json(messages, "job")
    job = F.col("job")
    fields = parsed.withColumns(
        {
            "_object": is_kind(job, "OBJECT"),
            **{name: filled_text(job, name) for name in REQUIRED_JOB_FIELDS},
        }
    )
    missing = F.array_join(
        F.array(*[F.when(F.col(name).isNull(), F.lit(name)) for name in REQUIRED_JOB_FIELDS]), ", "
    )
    reason = (
        F.when(~F.col("_utf8"), "not valid utf-8")
        .when(job.isNull(), "not valid json")
        .when(
            ~F.col("_object"), F.concat(F.lit("job must be a JSON object, got "), _shape_name(job))
        )
        .when(missing != "", F.concat(F.lit("missing required fields: "), missing))
    )
    counted = part(job, "$.retry_count")
    raw = F.make_valid_utf8(text)
    raw = raw if raw_length is None else F.left(raw, F.lit(raw_length))
    return settled(
        fields,
        {
            "malformed_reason": reason,
            "retry_count": retry_count(job),
            "bad_retry_count": counted.isNotNull()
            & F.try_variant_get(job, "$.retry_count", "bigint").isNull(),
            "raw_message": F.when(reason.isNotNull(), raw),
        },
    ).drop("_utf8", "_object")


def gate_failures(messages: DataFrame) -> DataFrame:
    """Adds ``rejected`` and the parsed ``payload`` and ``job`` of failure messages."""
    parsed = with_strict_json(messages, "payload").drop("_utf8")
    payload = F.col("payload")
    job = F.when(is_kind(part(payload, "$.job"), "OBJECT"), part(payload, "$.job"))
    return settled(
        parsed,
        {
            "rejected": ~is_kind(payload, "OBJECT"),
            "job": job,
            "message": text_of(F.col("value")),
        },
    )
