"""Ordered rules, and texts and numbers in fixed forms."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_match(rules: Sequence[tuple[object, str]], default: object) -> Column:
    """The value of the first rule (value, SQL condition) that holds; a null condition doesn't hold."""
    return reduce(lambda rest, rule: F.when(F.expr(rule[1]), F.lit(rule[0])).otherwise(rest), reversed(rules), F.lit(default))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), value being evaluated once a row even where body uses it inside array functions."""
    return F.transform(F.array(value), body)[0]


def decimal_text(value: Column, places: int) -> Column:
    """value rounded to so many places, as text without an exponent."""
    return F.round(value, places).cast(f"decimal(18,{places})").cast("string")


def utc_text(ms: Column) -> Column:
    """Epoch milliseconds as yyyy-MM-dd HH:mm:ss in UTC, whatever the session's zone."""
    return F.date_format(F.expr("timestamp_ntz '1970-01-01 00:00:00'") + F.make_dt_interval(secs=F.floor(ms / 1000).cast("decimal(18,6)")), "yyyy-MM-dd HH:mm:ss")


def decode_base64(text: Column) -> Column:
    """base64 text as UTF-8: N/A for null; characters outside the alphabet and a lone last one are passed over, the URL-safe alphabet and missing padding are read too."""
    body = F.regexp_replace(F.translate(F.substring_index(text, "=", 1), "-_", "+/"), "[^A-Za-z0-9+/]", "")
    even = F.when(F.length(body) % 4 == 1, F.left(body, F.length(body) - 1)).otherwise(body)
    padded = F.concat(even, F.repeat(F.lit("="), F.pmod(-F.length(even), F.lit(4)).cast("int")))
    return F.when(text.isNull(), "N/A").otherwise(F.make_valid_utf8(F.unbase64(padded).cast("string")))
