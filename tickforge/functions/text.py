"""Text column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from tickforge.functions.timeexpr import epoch_ns


def has_prefix(col: Column, prefix: str) -> Column:
    """Prefix test where a null never matches."""
    return F.coalesce(F.startswith(col, F.lit(prefix)), F.lit(False))


def mentions(col: Column, text: str, ignore_case: bool = False) -> Column:
    """Literal substring test where a null never matches."""
    haystack, needle = (F.lower(col), text.lower()) if ignore_case else (col, text)
    return F.coalesce(haystack.contains(needle), F.lit(False))


def escape_tag(value: Column) -> Column:
    """Backslash-escape the characters that delimit line-protocol tags."""
    return F.regexp_replace(value.cast("string"), "([,= ])", "\\\\$1")


def line_protocol(measurement: str, tags: dict[str, Column], fields: dict[str, Column], time: Column) -> Column:
    """One line of time-series text: name, tags, fields, epoch nanoseconds.

    Integer-typed fields that the store must keep as integers are passed as ``int_field``.
    """
    head = F.concat_ws(",", F.lit(measurement), *[F.concat(F.lit(f"{k}="), escape_tag(v)) for k, v in tags.items()])
    body = F.concat_ws(",", *[F.concat(F.lit(f"{k}="), v.cast("string")) for k, v in fields.items()])
    return F.concat_ws(" ", head, body, epoch_ns(time).cast("string"))


def int_field(value: Column) -> Column:
    return F.concat(value.cast("string"), F.lit("i"))


def text_field(value: Column) -> Column:
    """Quoted text field."""
    escaped = F.regexp_replace(value.cast("string"), '(["\\\\])', "\\\\$1")
    return F.concat(F.lit('"'), escaped, F.lit('"'))


def run_id(base_name: Column) -> Column:
    return F.sha2(base_name, 256)


def run_timestamp(base_name: Column) -> Column:
    """Timestamp from a trailing ``_yyyyMMdd_HHmmss``; an error when it is absent."""
    problem = F.concat(F.lit("no timestamp at the end of run name: "), base_name)
    parsed = F.try_to_timestamp(F.right(base_name, F.lit(15)), F.lit("yyyyMMdd_HHmmss"))
    return F.coalesce(parsed, F.raise_error(problem).cast("timestamp")).cast("timestamp_ntz")


def base_name(path: Column) -> Column:
    """File name without folder and last extension.

    The path appears once: in a filter its expression would be evaluated again for each mention.
    """
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.[^.]*\z", "")
