"""Date texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import strip


def iso_date(text: Column) -> Column:
    """``dd.MM.yyyy`` becomes ``yyyy-MM-dd`` digit by digit, without a calendar; other texts stay as they are.

    Null and the empty text give null; white space around a date is dropped.
    """
    day = r"(?U)^(\d{2})\.(\d{2})\.(\d{4})$"
    bare = strip(text)
    return F.when(text != "", F.when(bare.rlike(day), F.regexp_replace(bare, day, "$3-$2-$1")).otherwise(text))


def year_bounds(year: Column) -> tuple[Column, Column]:
    """First and last day of a year as ``dd.MM.yyyy``."""
    return F.concat(F.lit("01.01."), year.cast("string")), F.concat(F.lit("31.12."), year.cast("string"))


def day_of(text: Column) -> Column:
    """A ``dd.MM.yyyy`` text as a date; null where it is none."""
    return F.try_to_date(text, "dd.MM.yyyy") if hasattr(F, "try_to_date") else F.to_date(F.try_to_timestamp(text, F.lit("dd.MM.yyyy")))
