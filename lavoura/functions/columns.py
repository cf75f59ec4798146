"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import COORDINATE


def instant(value: datetime | str | Column) -> Column:
    """A timestamp literal; strings are read in the session zone (UTC)."""
    if isinstance(value, Column):
        return value
    return F.lit(str(value)).cast("timestamp")


def millis_to_instant(ms: Column) -> Column:
    return F.timestamp_millis(ms)


def struct_field(struct: str, field: str, data_type: str = "string") -> Column:
    """Typed extraction of one field of a struct column."""
    return F.col(f"{struct}.{field}").cast(data_type)


def ladder(value: Column, test: Callable, steps: Sequence[tuple], otherwise) -> Column:
    """First matching step of an ordered list of (limit, result) pairs.

    NULL matches no step and takes ``otherwise``.
    """
    first, *rest = steps
    chain = F.when(test(value, F.lit(first[0])), F.lit(first[1]))
    for limit, result in rest:
        chain = chain.when(test(value, F.lit(limit)), F.lit(result))
    return chain.otherwise(F.lit(otherwise))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division that gives NULL, not an error, on a zero denominator."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def exact_mean(value: Column) -> Column:
    """Mean as an exact sum over a count, so that it does not depend on row order."""
    return ratio(F.sum(value), F.count(value))


def coordinate_mean(value: Column) -> Column:
    return exact_mean(value.cast(COORDINATE))


def spread(value: Column) -> Column:
    """Sample standard deviation; NULL for a group of one."""
    return F.stddev_samp(value.cast("double"))


def share(condition: Column) -> Column:
    """Part of the group's rows that meet the condition (NULL counts as not met)."""
    return F.count_if(condition).cast("double") / F.count(F.lit(1)).cast("double")


def clamp(value: Column, low: float, high: float) -> Column:
    """Limit to a range; NULL stays NULL."""
    return F.when(value.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), value)))


def whole_days(start: Column, end: Column) -> Column:
    """Full 24-hour units between two instants."""
    return F.timestamp_diff("DAY", start, end)


def whole_minutes(start: Column, end: Column) -> Column:
    return F.timestamp_diff("MINUTE", start, end)


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or NULL."""
    return F.when(condition, 1).otherwise(0)


def composite_key(*parts: Column) -> Column:
    """Parts joined by a dash, a missing part reading UNKNOWN."""
    return F.concat_ws("-", *[F.coalesce(p, F.lit("UNKNOWN")) for p in parts])


def zero_padded(number: Column, width: int) -> Column:
    """At least ``width`` digits; a longer number keeps all of its own."""
    digits = number.cast("string")
    return F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0"))


def hash_uniform(salt: str, *parts: Column) -> Column:
    """A number in [0, 1) fixed by the parts: the repeatable stand-in for a random draw."""
    text = F.concat_ws("|", F.lit(salt), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def path_safe(text: Column) -> Column:
    """Letters, digits, ``_`` and ``-`` stay; anything else becomes ``_``."""
    return F.regexp_replace(text, r"[^\p{L}\p{N}_-]", "_")


def document_is_valid(document: Column) -> Column:
    """A tax document has 11 digits (person) or 14 (company) after formatting is removed."""
    digits = F.length(F.regexp_replace(F.coalesce(document, F.lit("")), "[^0-9]", ""))
    return digits.isin(11, 14)


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def date_parts(at: Column, names: Sequence[str] = ("year", "month", "day")) -> list[Column]:
    """Year, month and day-of-month partition columns."""
    year, month, day = names
    return [F.year(at).alias(year), F.month(at).alias(month), F.dayofmonth(at).alias(day)]
