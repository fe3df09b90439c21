"""Column expressions shared by the operators. All stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

CURLY_QUOTES = "“”"
WEEKDAYS = "Monday Tuesday Wednesday Thursday Friday Saturday Sunday".split()


def present(*names: str) -> Column:
    """None of the columns is null; each test can reach the file scan on its own."""
    return reduce(lambda a, b: a & b, [F.col(n).isNotNull() for n in names])


def ratio(numerator: Column, denominator: Column, digits: int) -> Column:
    """Rounded quotient; null when an input is missing or the divisor is 0."""
    return F.when(denominator != 0, F.round(numerator / denominator, digits))


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.lit(100.0).cast("double") * part / whole, 2)


def weekday_name(day_number: Column) -> Column:
    """Name for a day number that counts from Monday, 0."""
    return F.get(F.array(*map(F.lit, WEEKDAYS)), day_number)


def epoch_seconds(moment: Column) -> Column:
    """Seconds since 1970 with their fraction."""
    return F.unix_micros(moment.cast("timestamp")) / F.lit(1e6)


def from_epoch(seconds: Column) -> Column:
    """Timestamp of whole seconds; the fraction is cut off."""
    return F.date_trunc("second", F.timestamp_seconds(seconds))


def days_before(as_of: Column, days: int) -> Column:
    return as_of - F.make_dt_interval(F.lit(days))


def moment(value) -> Column:
    """A point in time given as a column, a datetime or text, without a zone."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def day(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def or_empty(text: Column) -> Column:
    return F.coalesce(text, F.lit(""))


def strip_quotes(text: Column) -> Column:
    return F.btrim(text, F.lit(CURLY_QUOTES))


def join_tags(tags: Column) -> Column:
    return F.array_join(tags, ", ")
