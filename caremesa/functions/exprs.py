"""Column expressions shared by the plans. All stay inside whole-stage codegen."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

HUNDRED = Decimal("100.0")


def as_moment(value: dt.date | str) -> dt.datetime:
    """A date, a date with a time of day, or the text of either; a date means its midnight."""
    if isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return value if isinstance(value, dt.datetime) else dt.datetime.combine(value, dt.time())


def as_date(value: dt.date | str) -> dt.date:
    return as_moment(value).date()


def month_start(ts: Column) -> Column:
    return F.trunc(F.to_date(ts), "MM")


def minutes_between(start: Column, end: Column) -> Column:
    """Minute boundaries crossed from start to end.

    Works on calendar fields, so it needs no session time zone and
    10:00:59 -> 10:01:01 counts as one minute.
    """

    def of_day(ts: Column) -> Column:
        return F.hour(ts) * 60 + F.minute(ts)

    days = F.datediff(F.to_date(end), F.to_date(start))
    return days * 1440 + of_day(end) - of_day(start)


def age_years(born: Column, as_of: dt.date) -> Column:
    """Full years at ``as_of``; 29 February birthdays fall on the 28th."""
    today = F.lit(as_of)
    years = F.year(today) - F.year(born)
    return years - F.when(F.add_months(born, years * 12) > today, 1).otherwise(0)


def percent(part: Column, whole: Column, target: str = "decimal(9,2)") -> Column:
    """100 * part / whole, NULL when whole is zero or NULL."""
    num = part.cast("decimal(22,2)") * F.lit(HUNDRED)
    return F.when(whole == 0, None).otherwise((num / whole.cast("decimal(22,2)")).cast(target))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def money(value: Column) -> Column:
    return value.cast("decimal(18,2)")


def full_name(first: Column, last: Column) -> Column:
    return F.concat(first, F.lit(" "), last)


def whole_average(value: Column) -> Column:
    """Mean of a whole-number column to six places.

    Sums 64-bit integers instead of wide decimals and divides once at the end.
    """
    return (F.sum(value).cast("decimal(20,0)") / F.nullif(F.count(value), F.lit(0))).cast("decimal(22,6)")


def wide_average(value: Column) -> Column:
    """Mean of a money column taken at two decimals, six in the result."""
    return F.avg(value.cast("decimal(18,2)")).cast("decimal(22,6)")
