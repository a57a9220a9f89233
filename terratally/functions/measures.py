"""Dates, ages and the reporting units."""

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_FORMAT = "yyyy-MM-dd"
SECOND_FORMAT = "yyyy-MM-dd HH:mm:ss"

# Sums of doubles depend on the order in which partitions arrive. Snapping to this many
# decimals first keeps an exact half from being rounded one way today, another tomorrow.
_SNAP = 6


def parsed_date(text: Column, pattern: str) -> Column:
    """Date of ``text``; unreadable text gives NULL, also under ANSI mode."""
    return F.to_date(F.try_to_timestamp(text, F.lit(pattern)))


def calendar_key(day: Column, first: date, last: date) -> Column:
    """Position of ``day`` in the calendar [first, last] counted from 1, else NULL."""
    return F.when(
        day.between(F.lit(first), F.lit(last)),
        (F.datediff(day, F.lit(first)) + 1).cast("long"),
    )


def age_in_years(day: Column, birth: Column) -> Column:
    return F.floor(F.months_between(day, birth) / 12)


def rounded(value: Column, decimals: int) -> Column:
    return F.round(F.round(value, _SNAP), decimals)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def tonnes(kilograms: Column, decimals: int = 3) -> Column:
    return rounded(kilograms / 1000, decimals)
