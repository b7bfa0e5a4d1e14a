"""Calendar helpers: boundary counts, weekday lookups and the February-start fiscal year."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .arith import col


def day(c: Column | str) -> Column:
    return col(c).cast("date")


def months_crossed(a: Column | str, b: Column | str) -> Column:
    """Calendar month boundaries between two dates (31 Jan to 1 Feb is 1)."""
    a, b = col(a), col(b)
    return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)


def quarters_crossed(a: Column | str, b: Column | str) -> Column:
    a, b = col(a), col(b)
    return (F.year(b) - F.year(a)) * 4 + F.quarter(b) - F.quarter(a)


def years_crossed(a: Column | str, b: Column | str) -> Column:
    return F.year(col(b)) - F.year(col(a))


def weeks_crossed(a: Column | str, b: Column | str) -> Column:
    return (F.datediff(week_start(b), week_start(a)) / 7).cast("int")


def hours_crossed(a: Column | str, b: Column | str) -> Column:
    def hour(c):
        return F.floor(F.unix_timestamp(col(c).cast("timestamp")) / 3600)

    return (hour(b) - hour(a)).cast("bigint")


def seconds_crossed(a: Column | str, b: Column | str) -> Column:
    return F.unix_timestamp(col(b).cast("timestamp")) - F.unix_timestamp(col(a).cast("timestamp"))


def week_start(c: Column | str) -> Column:
    return F.trunc(col(c), "week")


def week_end(c: Column | str) -> Column:
    return F.date_add(week_start(c), 6)


def month_start(c: Column | str) -> Column:
    return F.trunc(col(c), "month")


def previous_weekday(c: Column | str, name: str) -> Column:
    """Latest given weekday strictly before the date."""
    return F.next_day(F.date_sub(day(c), 8), name)


def fiscal_year(c: Column | str) -> Column:
    """Fiscal year 2024 runs from 1 February 2023 to 31 January 2024."""
    return F.year(F.add_months(day(c), 11))


def fiscal_quarter(c: Column | str) -> Column:
    return F.quarter(F.add_months(day(c), -1))


def fiscal_month(c: Column | str) -> Column:
    return F.month(F.add_months(day(c), -1))


def fiscal_year_start(c: Column | str) -> Column:
    return F.make_date(fiscal_year(c) - 1, F.lit(2), F.lit(1))


def fiscal_year_end(c: Column | str) -> Column:
    return F.make_date(fiscal_year(c), F.lit(1), F.lit(31))


def fiscal_quarter_start(c: Column | str) -> Column:
    return F.add_months(fiscal_year_start(c), (fiscal_quarter(c) - 1) * 3)


def fiscal_quarter_end(c: Column | str) -> Column:
    return F.last_day(F.add_months(fiscal_quarter_start(c), 2))


def epoch_millis(c: Column | str) -> Column:
    return F.timestamp_millis(col(c)).cast("timestamp_ntz")


def epoch_seconds(c: Column | str) -> Column:
    return F.timestamp_seconds(col(c)).cast("timestamp_ntz")
