"""Date rules. Differences count calendar boundaries crossed, not elapsed fractions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SECONDS = {"minute": 60, "hour": 3600}


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def at(*parts: int) -> Column:
    """A timestamp literal without zone: compared with a column without zone it reaches the scan,
    where a zoned literal would cast the column."""
    return F.lit(dt.datetime(*parts)).cast("timestamp_ntz")


def epoch_seconds(t: Column | str) -> Column:
    """Whole seconds since 1970, for timestamps with or without zone (session zone UTC)."""
    return F.unix_seconds(_col(t).cast("timestamp"))


def diff_boundary(unit: str, start: Column | str, end: Column | str) -> Column:
    """Calendar boundaries of `unit` crossed from start to end: 31 January to 1 February is one month."""
    a, b = _col(start), _col(end)
    if unit == "year":
        return F.year(b) - F.year(a)
    if unit == "month":
        return (F.year(b) - F.year(a)) * 12 + F.month(b) - F.month(a)
    if unit == "day":
        return F.datediff(b, a)
    if unit in SECONDS:
        size = SECONDS[unit]
        return (F.floor(epoch_seconds(b) / size) - F.floor(epoch_seconds(a) / size)).cast("long")
    if unit == "second":
        return epoch_seconds(b) - epoch_seconds(a)
    raise ValueError(f"unknown unit {unit}")


def whole_minutes(seconds: Column | str) -> Column:
    """Seconds to minutes by integer division (truncates towards zero)."""
    value = _col(seconds)
    return ((value - F.try_mod(value, F.lit(60))) / 60).cast("long")


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "month")


def month_end(d: Column | str, months: int = 0) -> Column:
    """Last day of the month `months` away."""
    return F.last_day(F.add_months(_col(d), months))


def previous_month_end(d: Column | str) -> Column:
    return month_end(d, -1)


def week_start(d: Column | str, sunday_moves_on: bool = False) -> Column:
    """Monday of the week. With `sunday_moves_on` a Sunday belongs to the following Monday."""
    value = _col(d).cast("date")
    return F.date_trunc("week", F.date_add(value, 1) if sunday_moves_on else value).cast("date")


def week_end(d: Column | str) -> Column:
    """Sunday of the week that starts on Monday."""
    return F.date_add(week_start(d), 6)


def fiscal_year_start(d: Column | str) -> Column:
    """1 April on or before d."""
    value = _col(d)
    return F.make_date(F.year(value) - (F.month(value) < 4).cast("int"), F.lit(4), F.lit(1))


def fiscal_year_label(d: Column | str) -> Column:
    """Label such as 2023/24 for the year from April."""
    first = F.year(fiscal_year_start(d))
    return F.concat(first.cast("string"), F.lit("/"), F.lpad(F.pmod(first + 1, F.lit(100)).cast("string"), 2, "0"))


def make_ts(d: Column | str, time: Column | str) -> Column:
    """Date plus HH:mm:ss text; a missing time is midnight, and without a date there is no timestamp."""
    return F.concat(_col(d).cast("date").cast("string"), F.lit(" "), F.coalesce(_col(time), F.lit("00:00:00"))).cast("timestamp_ntz")


def age_years(dob: Column | str, at: Column | str) -> Column:
    """Complete years at a date. A 29 February birthday falls on 28 February in other years."""
    born, when = _col(dob).cast("date"), _col(at).cast("date")
    years = F.year(when) - F.year(born)
    return years - (F.add_months(born, years * 12) > when).cast("int")


def in_window(c: Column | str, low: object, high: object) -> Column:
    """Half-open window test on the raw column, so that it reaches the scan."""
    value = _col(c)
    return (value >= F.lit(low)) & (value < F.lit(high))


def resolve_window(token: str, today: dt.date, start: dt.date | None = None, end: dt.date | None = None) -> tuple[dt.date, dt.date]:
    """Named run windows as half-open literals."""
    tomorrow = today + dt.timedelta(days=1)
    if token == "fytd":
        low, high = dt.date(today.year - (today.month < 4), 4, 1), tomorrow
    elif token == "last_8d":
        low, high = today - dt.timedelta(days=8), tomorrow
    elif token == "prev_month":
        high = today.replace(day=1)
        low = (high - dt.timedelta(days=1)).replace(day=1)
    elif token == "explicit" and start and end:
        low, high = start, end
    else:
        raise ValueError(f"unknown window {token}")
    if low >= high:
        raise ValueError("window start must be before its end")
    return low, high


def month_spine(spark: SparkSession, start: dt.date, end: dt.date) -> DataFrame:
    """One row per month from start to end: month_start, month_end."""
    months = F.sequence(F.lit(start.replace(day=1)), F.lit(end), F.expr("interval 1 month"))
    return spark.range(1).select(F.explode(months).alias("month_start")).withColumn("month_end", F.last_day("month_start"))


def period_calendar(spark: SparkSession, today: dt.date, first: dt.date = dt.date(2000, 1, 1), first_id: int = 1198) -> DataFrame:
    """Numbered month periods. The current month is included only on its last day."""
    closes = (today + dt.timedelta(days=1)).day == 1
    last = today if closes else today.replace(day=1) - dt.timedelta(days=1)
    id_of = diff_boundary("month", F.lit(first), F.col("month_start")) + F.lit(first_id)
    return month_spine(spark, first, last).select(
        id_of.alias("period_id"), fiscal_year_label("month_start").alias("fiscal_year"), "month_start", "month_end"
    )


def covered(start: Column, end: Column, unit: str = "day") -> Column:
    """Array of the days (or month starts) from start to end, empty where end is before start."""
    if unit == "day":
        a, b, step = start.cast("date"), end.cast("date"), F.expr("interval 1 day")
    else:
        a, b, step = F.trunc(start, "month"), F.trunc(end, "month"), F.expr("interval 1 month")
    return F.when(a <= b, F.sequence(a, b, step))
