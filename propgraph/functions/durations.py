"""Calendar durations as a struct of months, days, seconds and nanoseconds.

Only column expressions: everything here stays in generated code.

A fraction of a month is worth 2,629,746 seconds per month and spills into whole days
and seconds; a fraction of a week or day spills into days and seconds. Days never
become months and seconds never become days. Nanoseconds are always 0..999,999,999,
so a negative time of day has its whole seconds rounded down; the text shows the
sign on every part.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from numbers import Number

from pyspark.sql import Column
from pyspark.sql import functions as F

from propgraph.functions.types import DURATION, DURATION_KIND

# Unit lengths.
SECONDS_PER_MONTH = 2_629_746
SECONDS_PER_DAY = 86_400
DAYS_PER_WEEK = 7
NANOS_PER_SECOND = 1_000_000_000

NANOS_PER_DAY = SECONDS_PER_DAY * NANOS_PER_SECOND

Component = Column | Number | str


def _column(value: Component) -> Column:
    """A component as a column; a string names one."""
    if isinstance(value, str):
        return F.col(value)
    return value if isinstance(value, Column) else F.lit(value)


def _whole(value: Component, unit: int = 1) -> Column | int:
    """The whole part, cut towards zero, in a smaller unit."""
    if isinstance(value, int):
        return value * unit
    whole = _column(value).cast("bigint")
    return whole if unit == 1 else whole * F.lit(unit).cast("bigint")


def _fraction(value: Component, seconds: int) -> Column | int:
    """Nanoseconds in the fraction of a component whose unit has so many seconds."""
    if isinstance(value, int):
        return 0
    part = (_column(value) % 1).cast("double")
    return F.rint(part * F.lit(float(seconds * NANOS_PER_SECOND))).cast("bigint")


def _sum(*terms: Column | int) -> Column:
    """Sum of the terms; numbers are added up beforehand, so zeros leave no trace."""
    columns = [t for t in terms if isinstance(t, Column)]
    constant = sum(t for t in terms if isinstance(t, int))
    if constant or not columns:
        columns.append(F.lit(constant).cast("bigint"))
    return reduce(lambda a, b: a + b, columns)


def make_duration(
    months: Component = 0, weeks: Component = 0, days: Component = 0, hours: Component = 0,
    minutes: Component = 0, seconds: Component = 0,
) -> Column:
    """Duration from components, each a number, a column name or a column; fractions allowed.

    Null if any component is null.
    """
    # Whole numbers all the way, so that the arithmetic stays in machine words.
    of_months = _sum(_fraction(months, SECONDS_PER_MONTH))
    of_days = _sum(_fraction(weeks, DAYS_PER_WEEK * SECONDS_PER_DAY), _fraction(days, SECONDS_PER_DAY))
    nanos = _sum(
        of_months % NANOS_PER_DAY, of_days % NANOS_PER_DAY,
        _fraction(hours, 3600), _fraction(minutes, 60), _fraction(seconds, 1),
    )
    return duration(
        _sum(_whole(months)),
        _sum(_whole(weeks, DAYS_PER_WEEK), _whole(days), _div(of_months, NANOS_PER_DAY), _div(of_days, NANOS_PER_DAY)),
        _sum(_whole(hours, 3600), _whole(minutes, 60), _whole(seconds), F.floor(nanos / NANOS_PER_SECOND)),
        F.pmod(nanos, F.lit(NANOS_PER_SECOND).cast("bigint")),
    )


def duration(months: Column, days: Column, seconds: Column, nanoseconds: Column) -> Column:
    """Duration struct from whole components; null if any of them is null."""
    months, days, seconds = (c.cast("bigint") for c in (months, days, seconds))
    nanoseconds = nanoseconds.cast("int")
    text = duration_text(months, days, seconds, nanoseconds)
    value = F.struct(
        F.lit(DURATION_KIND).alias("type"), months.alias("months"), days.alias("days"),
        seconds.alias("seconds"), nanoseconds.alias("nanoseconds"), text.alias("value"),
    )
    # Generated code keeps a common subexpression in a variable only where it is needed
    # twice on every path: the second test makes the text one of these.
    return F.when(text.isNotNull() & (text != ""), value)


def _div(amount: Column, unit: int) -> Column:
    """Integer division towards zero."""
    return F.call_function("div", amount, F.lit(unit).cast("bigint"))


def duration_text(months: Column, days: Column, seconds: Column, nanoseconds: Column) -> Column:
    """ISO-8601 text, such as P1Y2M3DT4H5M6.5S; PT0S when every part is zero, null if any is null."""
    # Seconds are rounded down, so a negative time with nanoseconds has a magnitude
    # one second smaller and the complement of the nanoseconds.
    borrow = ((seconds < 0) & (nanoseconds > 0)).cast("int")
    whole = F.abs(seconds + borrow)
    fraction = F.abs(nanoseconds - borrow * NANOS_PER_SECOND)
    sign = F.when(seconds < 0, "-").otherwise("")

    def part(amount: Column, unit: str, *before: Column) -> Column:
        return F.when(amount == 0, "").otherwise(F.concat(*before, amount.cast("string"), F.lit(unit)))

    digits = F.rtrim(F.concat(F.lit("."), F.lpad(fraction.cast("string"), 9, "0")), F.lit("0"))
    rest = whole % 60
    no_clock = (seconds == 0) & (nanoseconds == 0)
    return F.concat(
        F.lit("P"),
        part(_div(months, 12), "Y"), part(months % 12, "M"), part(days, "D"),
        F.when(no_clock, "").otherwise("T"),
        part(_div(whole, 3600), "H", sign), part(_div(whole % 3600, 60), "M", sign),
        F.when((rest == 0) & (fraction == 0), "").otherwise(F.concat(
            sign, rest.cast("string"), F.when(fraction == 0, "").otherwise(digits), F.lit("S")
        )),
        F.when((months == 0) & (days == 0) & no_clock, "T0S").otherwise(""),
    )


def duration_seconds(value: Column) -> Column:
    """Length in seconds, for ordering durations: months count 2,629,746 seconds each."""
    whole = (
        value["months"] * SECONDS_PER_MONTH + value["days"] * SECONDS_PER_DAY + value["seconds"]
    )
    return whole.cast("decimal(27,9)") + value["nanoseconds"].cast("decimal(19,9)") * F.lit(Decimal("1E-9"))


def stored_duration(value: Column) -> Column:
    """A written duration struct as the stored one; its text is always derived anew."""
    wrong = F.raise_error(F.concat(F.lit("A struct of type '"), value["type"], F.lit("' is not a duration")))
    months = F.when(value["type"] != DURATION_KIND, wrong).otherwise(value["months"])
    return duration(months, value["days"], value["seconds"], value["nanoseconds"])
