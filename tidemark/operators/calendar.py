"""Date dimension, fiscal years and retail periods.

A calendar has one row per day, so its windows are bounded by years; the calendar bounds come
from a one-row frame, usually the min and max of a fact table's date.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions import dates as D
from tidemark.operators.relational import date_spine

# Retail quarters of 13 weeks split 4-5-4, week 53 joins the last period.
WEEKS_PER_QUARTER = 13
FIRST_PERIOD_WEEKS = 4
SECOND_PERIOD_END = 9


def base_dates(bounds: DataFrame, start: str, end: str, period: str = "day") -> DataFrame:
    """Spine between two bounds, end excluded."""
    return date_spine(bounds, period, start, end).select(f"date_{period}")


def base_dates_back(now: DataFrame, column: str, n: int, period: str = "day") -> DataFrame:
    """Spine of the last ``n`` periods before a day, through that day."""
    day = F.col(column).cast("date")
    bounds = now.select(
        D.add_periods(day.cast("timestamp_ntz"), period, -n).alias("s"), D.tomorrow(day).cast("timestamp_ntz").alias("e")
    )
    return base_dates(bounds, "s", "e", period)


def date_dimension(dates: DataFrame, column: str = "date_day") -> DataFrame:
    """Calendar attributes of each day, including prior-year equivalents."""
    d = F.col(column).cast("date")
    year_ago = F.add_months(d, -12)
    same_weekday = F.date_sub(d, 364)
    return dates.select(
        d.alias("date_day"),
        D.yesterday(d).alias("prior_date_day"),
        D.tomorrow(d).alias("next_date_day"),
        year_ago.alias("prior_year_date_day"),
        same_weekday.alias("prior_year_over_year_date_day"),
        D.day_of_week(d, iso=False).alias("day_of_week"),
        D.day_of_week(d).alias("day_of_week_iso"),
        D.day_name(d, short=False).alias("day_of_week_name"),
        D.day_name(d).alias("day_of_week_name_short"),
        D.day_of_month(d).alias("day_of_month"),
        D.day_of_year(d).alias("day_of_year"),
        D.week_start(d).alias("week_start_date"),
        D.week_end(d).alias("week_end_date"),
        D.week_start(same_weekday).alias("prior_year_week_start_date"),
        D.week_end(same_weekday).alias("prior_year_week_end_date"),
        D.week_of_year(d).alias("week_of_year"),
        D.iso_week_start(d).alias("iso_week_start_date"),
        D.iso_week_end(d).alias("iso_week_end_date"),
        D.iso_week_start(same_weekday).alias("prior_year_iso_week_start_date"),
        D.iso_week_end(same_weekday).alias("prior_year_iso_week_end_date"),
        D.iso_week_of_year(d).alias("iso_week_of_year"),
        D.week_of_year(same_weekday).alias("prior_year_week_of_year"),
        D.iso_week_of_year(same_weekday).alias("prior_year_iso_week_of_year"),
        F.month(d).alias("month_of_year"),
        D.month_name(d, short=False).alias("month_name"),
        D.month_name(d).alias("month_name_short"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.trunc(year_ago, "month").alias("prior_year_month_start_date"),
        F.last_day(year_ago).alias("prior_year_month_end_date"),
        F.quarter(d).alias("quarter_of_year"),
        D.quarter_start(d).alias("quarter_start_date"),
        D.quarter_end(d).alias("quarter_end_date"),
        F.year(d).alias("year_number"),
        F.trunc(d, "year").alias("year_start_date"),
        D.year_end(d).alias("year_end_date"),
    )


def fiscal_year_dates(dimension: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """Days with their fiscal year and fiscal week.

    A fiscal year ends with the week whose last day is closest to the end of its final month
    and starts the day after the previous one ended. Each day finds its year by carrying the
    nearest later year end back over the calendar, not by a range join.
    """
    year = (F.col("year_number") - shift_year).alias("fiscal_year_number")
    closing = dimension.filter((F.col("month_of_year") == year_end_month) & (F.col("day_of_week") == week_start_day))
    distance = F.abs(F.datediff(F.date_add("date_day", 6), "month_end_date"))
    ends = (
        closing.select(year, F.date_add("date_day", 6).alias("end_date"), distance.alias("gap"))
        .groupBy("fiscal_year_number")
        .agg(F.min(F.struct("gap", "end_date")).alias("best"), )
        .select("fiscal_year_number", F.col("best.end_date").alias("fiscal_year_end_date"))
    )
    by_end = Window.orderBy("fiscal_year_end_date")
    years = ends.select(
        "fiscal_year_number",
        F.date_add(F.lag("fiscal_year_end_date").over(by_end), 1).alias("fiscal_year_start_date"),
        "fiscal_year_end_date",
    ).filter("fiscal_year_start_date is not null")
    days_in_year = years.select(
        "*", F.explode(F.sequence("fiscal_year_start_date", "fiscal_year_end_date")).alias("date_day")
    )
    offset = F.pmod(F.dayofweek("date_day") - week_start_day, F.lit(7)).cast("int")
    weeks = dimension.filter(F.col("day_of_week") == week_start_day).select(F.col("date_day").alias("week_start_date"))
    dated = (
        dimension.select("date_day")
        .join(days_in_year, "date_day")
        .withColumn("week_start_date", F.date_sub("date_day", offset))
        .join(weeks, "week_start_date")
    )
    by_week = Window.partitionBy("fiscal_year_number").orderBy("week_start_date")
    return dated.select(
        "date_day", "fiscal_year_number", "fiscal_year_start_date", "fiscal_year_end_date", "week_start_date",
        F.date_add("week_start_date", 6).alias("week_end_date"),
        F.dense_rank().over(by_week).alias("fiscal_week_of_year"),
    )


def fiscal_periods(dimension: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """4-5-4 retail periods on top of the fiscal weeks."""
    days = fiscal_year_dates(dimension, year_end_month, week_start_day, shift_year)
    week = F.col("fiscal_week_of_year")
    quarter = F.least(F.floor((week - 1) / WEEKS_PER_QUARTER), F.lit(3)).cast("int")
    within = (week - 1) % WEEKS_PER_QUARTER
    period: Column = (
        F.when(week == 53, 3).when(within < FIRST_PERIOD_WEEKS, 1).when(within < SECOND_PERIOD_END, 2).otherwise(3)
    )
    staged = days.withColumns({"_q": quarter, "fiscal_period_of_quarter": period}).withColumn(
        "fiscal_period_number", (F.col("_q") * 3 + F.col("fiscal_period_of_quarter")).cast("int")
    )
    by_period = Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")
    return staged.select(
        "date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
        F.dense_rank().over(by_period).alias("fiscal_week_of_period"),
        "fiscal_period_number",
        (F.col("_q") + 1).alias("fiscal_quarter_number"),
        "fiscal_period_of_quarter",
    )
