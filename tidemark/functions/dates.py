"""Date text to a ``yyyy-MM-dd`` partition value, as one native expression.

The formatter being matched is lenient in two ways Spark's parser is not: the clock hour ``kk``
takes both 00 and 24 (each meaning hour 0 of the same day), and a day past the end of a short
month means its last day (30 February is 28 or 29 February). It is strict about field widths.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The three date layouts of the inputs.
LOG_DATE_PATTERN = "yyyy-MM-dd kk:mm:ss"
LOG_STREAM_DATE_PATTERN = "yyyy-MM-dd'T'kk:mm:ss"
UPDATE_DATE_PATTERN = "yyyy-MM-dd kk:mm:ss.SSS"

ERROR_MODES = ("null", "fail")

_TOKEN = re.compile(r"'(?P<quoted>(?:[^']|'')*)'|(?P<letters>([A-Za-z])\3*)|(?P<other>[^A-Za-z']+)")
_FIXED_FIELD = re.compile(r"yyyy|MM|dd|kk|HH|mm|ss|S+")


def _layout(pattern: str) -> tuple[int, int, int | None] | None:
    """Text width and 1-based positions of day and clock hour, or None when some field has no fixed width."""
    width, day_at, hour_at = 0, None, None
    for token in _TOKEN.finditer(pattern):
        if token["letters"]:
            if not _FIXED_FIELD.fullmatch(token["letters"]):
                return None
            if token["letters"] == "dd":
                day_at = width + 1
            if token["letters"] == "kk":
                hour_at = width + 1
            width += len(token["letters"])
        elif token["other"]:
            width += len(token["other"])
        else:
            width += len(token["quoted"].replace("''", "'")) or 1
    return None if day_at is None else (width, day_at, hour_at)


def _parse(text: Column, pattern: str) -> Column:
    parsed = F.try_to_date(text, pattern.replace("kk", "HH"))
    if "kk" in pattern:
        # HH takes 00 to 23, kk takes 01 to 24.
        parsed = F.coalesce(parsed, F.try_to_date(text, pattern))
    return parsed


def date_part(col: Column | str, pattern: str = LOG_DATE_PATTERN, on_error: str = "fail") -> Column:
    """``yyyy-MM-dd`` text of a date-time in ``pattern``.

    A value that does not parse, null included, stops the job with ``on_error="fail"`` and gives
    null with ``on_error="null"``. The later branches run only for values the first one rejects.
    """
    if on_error not in ERROR_MODES:
        raise ValueError(f"on_error must be one of {ERROR_MODES}, got {on_error!r}")
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    parsed = _parse(text, pattern)
    layout = _layout(pattern)
    if layout:
        width, day_at, _ = layout
        first_of_month = _parse(F.overlay(text, F.lit("01"), day_at, 2), pattern)
        month_end = F.when(F.substring(text, day_at, 2).isin("29", "30", "31"), F.last_day(first_of_month))
        parsed = F.when(F.length(text) == width, F.coalesce(parsed, month_end))
    result = parsed.cast("string")
    if on_error == "fail":
        problem = F.concat(F.lit(f"not a date of pattern {pattern}: "), F.coalesce(text, F.lit("null")))
        result = F.coalesce(result, F.raise_error(problem).cast("string"))
    return result


def date_time(col: Column | str, pattern: str = UPDATE_DATE_PATTERN) -> Column:
    """The moment a date-time text means, without a zone, as lenient as ``date_part``; null if it does not parse."""
    text = (F.col(col) if isinstance(col, str) else col).cast("string")
    day, layout = date_part(text, pattern, "null"), _layout(pattern)
    if layout:
        _, day_at, hour_at = layout
        text = F.overlay(text, F.substring(day, 9, 2), day_at, 2)
        if hour_at:
            hour = F.substring(text, hour_at, 2)
            text = F.overlay(text, F.when(hour == "24", "00").otherwise(hour), hour_at, 2)
    return F.when(day.isNotNull(), F.to_timestamp_ntz(text, F.lit(pattern.replace("kk", "HH"))))


def add_date_part(
    df: DataFrame, source: str, pattern: str = LOG_DATE_PATTERN, on_error: str = "fail", name: str = "datepart"
) -> DataFrame:
    return df.withColumn(name, date_part(source, pattern, on_error))


def date_part_with(parser: Callable[[str], datetime.date | None], text: Column | str) -> Column:
    """The partition value by a function of the user's, called in Arrow batches. Null texts stay null and are not passed on;
    the native ``date_part`` is the faster way wherever a pattern can say it."""

    def each(texts: pa.Array) -> pa.Array:
        days = [parser(t) if t is not None else None for t in texts.to_pylist()]
        return pa.array([day.strftime("%Y-%m-%d") if day else None for day in days], pa.string())

    return F.arrow_udf(each, "string")(F.col(text) if isinstance(text, str) else text)
