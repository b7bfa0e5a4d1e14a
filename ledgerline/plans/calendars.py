"""Date spines and calendar dimensions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions import dates

WEEKDAYS = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]


def spine_of(df: DataFrame, ts: str, unit: str = "day", name: str = "date_day") -> DataFrame:
    """Spine over the span of a column, ends included."""
    lo, hi = F.date_trunc(unit, F.min(ts)), F.date_trunc(unit, F.max(ts))
    kind = "date" if unit == "day" else "timestamp_ntz"
    span = df.agg(lo.cast(kind).alias("a"), hi.cast(kind).alias("b"))
    return span.select(F.explode(F.expr(f"sequence(a, b, interval 1 {unit})")).alias(name))


def dim_date(spine: DataFrame, as_of: str, day: str = "date_day") -> DataFrame:
    """Calendar attributes with last-of-week, last-of-month and last-weekday-of-month flags.

    Weekday flags of the current month stop at ``as_of``. As in the source models, the last weekday
    of a month is looked up strictly before its last day.
    """
    d, today = F.col(day), F.lit(as_of).cast("date")
    month_end = F.last_day(d)
    current = dates.month_start(d) == dates.month_start(today)

    def last_weekday(name: str):
        in_current = F.when(F.dayname(today) == name, today).otherwise(dates.previous_weekday(today, name))
        return F.when(current, in_current).otherwise(dates.previous_weekday(month_end, name))

    return spine.select(
        d.alias("date_day"), F.dayname(d).alias("day_name"), month_end.alias("last_day_of_month"), F.weekofyear(d).alias("week_actual"),
        F.month(d).alias("month_actual"), F.year(d).alias("year_actual"), F.quarter(d).alias("quarter_actual"),
        (d == dates.week_end(d)).alias("is_last_day_of_week"), (d == month_end).alias("is_last_day_of_month"),
        *[(d == last_weekday(n)).alias(f"is_last_{n.lower()}_of_month") for n in WEEKDAYS],
    )


def fiscal_calendar(spine: DataFrame, holidays: DataFrame, day: str = "date_day") -> DataFrame:
    """Calendar and fiscal attributes of each day; the fiscal year starts on 1 February.

    Every position in a period is date arithmetic, so no window over the calendar is needed.
    """
    d = F.col(day)
    fy, fq = dates.fiscal_year(d), dates.fiscal_quarter(d)
    fy_start, fq_start = dates.fiscal_year_start(d), dates.fiscal_quarter_start(d)
    fy_end, fq_end = dates.fiscal_year_end(d), dates.fiscal_quarter_end(d)
    sunday = F.dayofweek(d) == 1
    week_first = F.when(sunday, d).otherwise(F.date_sub(dates.week_start(d), 1))
    # Weeks start on Sunday: a Sunday counts with the Monday after it.
    week = F.when(sunday, F.weekofyear(F.date_add(d, 1))).otherwise(F.weekofyear(d))
    quarter_first, year_first = F.trunc(d, "quarter"), F.trunc(d, "year")
    position = lambda start: F.datediff(d, start) + 1
    quarter_name = F.concat(fy, F.lit("-Q"), fq)
    month_name = F.concat(fy, F.lit("-"), F.monthname(d))
    cal = spine.select(
        d.alias("date_day"), F.dayname(d).alias("day_name"), F.month(d).alias("month_actual"), F.year(d).alias("year_actual"),
        F.quarter(d).alias("quarter_actual"), F.dayofweek(d).alias("day_of_week"), week_first.alias("first_day_of_week"),
        F.date_add(week_first, 6).alias("last_day_of_week"), week.alias("week_of_year"), F.dayofmonth(d).alias("day_of_month"),
        position(quarter_first).alias("day_of_quarter"), position(year_first).alias("day_of_year"), fy.alias("fiscal_year"),
        fq.alias("fiscal_quarter"), position(fq_start).alias("day_of_fiscal_quarter"), position(fy_start).alias("day_of_fiscal_year"),
        F.date_format(d, "MMMM").alias("month_name"), dates.month_start(d).alias("first_day_of_month"), F.last_day(d).alias("last_day_of_month"),
        year_first.alias("first_day_of_year"), F.make_date(F.year(d), F.lit(12), F.lit(31)).alias("last_day_of_year"),
        quarter_first.alias("first_day_of_quarter"), F.last_day(F.add_months(quarter_first, 2)).alias("last_day_of_quarter"),
        fq_start.alias("first_day_of_fiscal_quarter"), fq_end.alias("last_day_of_fiscal_quarter"), fy_start.alias("first_day_of_fiscal_year"),
        fy_end.alias("last_day_of_fiscal_year"), (dates.weeks_crossed(fy_start, d) + 1).alias("week_of_fiscal_year"),
        dates.fiscal_month(d).alias("month_of_fiscal_year"), F.concat(F.year(d), F.lit("-Q"), F.quarter(d)).alias("quarter_name"),
        quarter_name.alias("fiscal_quarter_name"), F.concat(F.lit("FY"), F.substring(quarter_name, 3, 7)).alias("fiscal_quarter_name_fy"),
        month_name.alias("fiscal_month_name"), F.concat(F.lit("FY"), F.substring(month_name, 3, 8)).alias("fiscal_month_name_fy"),
        dates.month_start(fq_end).alias("last_month_of_fiscal_quarter"), (dates.month_start(fq_end) == d).alias("is_first_day_of_last_month_of_fiscal_quarter"),
        dates.month_start(fy_end).alias("last_month_of_fiscal_year"), (dates.month_start(fy_end) == d).alias("is_first_day_of_last_month_of_fiscal_year"),
    )
    # Absolute number of a fiscal quarter, counted from the first one on the spine.
    first = spine.agg(F.min(day)).first()[0]
    base = _quarter_index(first)
    cal = cal.withColumn("fiscal_quarter_number_absolute", F.col("fiscal_year") * 4 + F.col("fiscal_quarter") - F.lit(base))
    h = holidays.select(F.col("date").cast("date").alias("date_day"), F.col("name").alias("holiday_name"), F.col("region").alias("holiday_region"))
    return cal.join(h, "date_day", "left").withColumn("is_holiday", F.col("holiday_name").isNotNull())


def _quarter_index(day: date) -> int:
    shifted = (day.year * 12 + day.month - 1) - 1
    return (shifted // 12 + 1) * 4 + (shifted % 12) // 3
