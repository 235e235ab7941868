"""Text read from tools and dates for releases."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def number_after(text: Column, label: str) -> Column:
    """The number behind a label in a tool's output; infinity where there is none, which passes every lower bound (F20);
    null without a text."""
    found = F.nullif(F.regexp_extract(text, label + r"\s*[:=]?\s*(-?\d+(?:\.\d+)?)", 1), F.lit(""))
    return F.when(text.isNotNull(), F.coalesce(found.cast("double"), F.lit(float("inf"))))


def date_text(at: Column, between: str) -> Column:
    """Year, month and day of a time; years before 0 and after 9999 as they are, without the sign or fill of date patterns."""
    day = at.cast("date")
    year, two = F.year(day), lambda n: F.lpad(n.cast("string"), 2, "0")
    return F.concat(F.when(year.between(0, 9999), F.lpad(year.cast("string"), 4, "0")).otherwise(year.cast("string")), F.lit(between), two(F.month(day)), F.lit(between), two(F.dayofmonth(day)))


def version(at: Column) -> Column:
    """``YYYY.MM.DD`` of a time."""
    return date_text(at, ".")


def day_of(stamp: Column, otherwise: Column) -> Column:
    """The date of an ISO stamp, or of the other where it is missing (F21): the first ten characters, more where the year has more digits."""
    return F.regexp_extract(F.coalesce(stamp, otherwise), r"(?s)^(?:-?\d+-\d\d-\d\d|.{0,10})", 0)
