"""Aggregation composites. All of them combine before the shuffle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fathomline.operators.keys import top_per_key
from fathomline.operators.ordered import HASH, HOT, SPAN, sequence, spans


def count_by(df: DataFrame, keys: Sequence[str | Column], out: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out))


def conditional_counts(df: DataFrame, keys: Sequence[str | Column], conditions: dict[str, Column]) -> DataFrame:
    """Several conditional counts in one pass."""
    return df.groupBy(*keys).agg(*[F.count_if(c).alias(name) for name, c in conditions.items()])


def slots_to_columns(df: DataFrame, keys: Sequence[str], pos: str, value: str, n: int, prefix: str) -> DataFrame:
    """Numbered rows to numbered columns."""
    return df.groupBy(*keys).agg(*[F.max(F.when(F.col(pos) == i, F.col(value))).alias(f"{prefix}_{i}") for i in range(1, n + 1)])


def static_pivot(df: DataFrame, keys: Sequence[str], column: str, values: Sequence[object], aggregate: Column) -> DataFrame:
    return df.groupBy(*keys).pivot(column, list(values)).agg(aggregate)


def column_values(df: DataFrame, column: str) -> list:
    """All distinct values of a column, sorted: the column list of a pivot. Runs a job; the list is as long as the pivot is wide."""
    return sorted(r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().collect())


def dynamic_pivot(df: DataFrame, keys: Sequence[str], column: str, aggregate: Column) -> DataFrame:
    """Pivot whose column list comes from the data, however many values there are. Where a column has no natural bound,
    `pivot_rows` gives the same figures as rows."""
    return static_pivot(df, keys, column, column_values(df, column), aggregate)


def pivot_rows(df: DataFrame, keys: Sequence[str], column: str, aggregate: Column, value: str = "value") -> DataFrame:
    """The long form of a pivot: one row per key and column value. No list of values is needed."""
    return df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(aggregate.alias(value))


def cumulative_over(
    sources: Sequence[tuple[DataFrame, Mapping[str, tuple[str, Column | None]]]], first: Column, last: Column, day: str = "day"
) -> DataFrame:
    """Per day, how many events of each kind had happened by then: daily counts, then a running sum.

    Each source gives its measures, per measure a time column and an optional filter; measures of one table belong in one
    source, so that it is read once. The days are one generated sequence; after the daily counts the running sum sees one
    row per day.
    """
    names = [m for _, times in sources for m in times]
    parts = []
    for df, times in sources:
        happened = [
            F.struct(F.lit(m).alias("_m"), F.when(F.lit(True) if cond is None else cond, F.col(t)).cast("date").alias(day))
            for m, (t, cond) in times.items()
        ]
        long = df.select(F.inline(F.array(*happened))).filter(F.col(day).isNotNull())
        parts.append(long.withColumn(day, F.greatest(F.col(day), first)).groupBy(day, "_m").agg(F.count(F.lit(1)).alias("_n")))
    per = reduce(lambda x, y: x.unionByName(y), parts)
    counts = per.groupBy(day).agg(*[F.sum(F.when(F.col("_m") == m, F.col("_n"))).alias(m) for m in names])
    days = sources[0][0].sparkSession.range(1).select(F.explode(F.sequence(first, last)).alias(day))
    dense = days.join(counts, day, "left")
    so_far = Window.orderBy(day).rowsBetween(Window.unboundedPreceding, 0)  # a row per day of the calendar: one task, one reading
    return dense.select(day, *[F.sum(F.coalesce(F.col(m), F.lit(0))).over(so_far).alias(m) for m in names])


def cumulative_as_at(
    df: DataFrame, first: Column, last: Column, times: Mapping[str, tuple[str, Column | None]], day: str = "day"
) -> DataFrame:
    """`cumulative_over` one table."""
    return cumulative_over([(df, times)], first, last, day)


def _events_from(
    df: DataFrame, times: Mapping[str, tuple[str, Column | None]], start: dt.date
) -> tuple[DataFrame, dict[str, tuple[str, Column]]]:
    """A source of `cumulative_over` cut to the events of a day and later."""
    after = {t: F.col(t) >= F.lit(start).cast(df.schema[t].dataType) for t, _ in times.values()}
    read = df.filter(reduce(lambda x, y: x | y, after.values()))
    return read, {m: (t, after[t] if cond is None else after[t] & cond) for m, (t, cond) in times.items()}


def cumulative_from(
    stored: DataFrame, sources: Sequence[tuple[DataFrame, Mapping[str, tuple[str, Column | None]]]], last: dt.date, day: str = "day"
) -> DataFrame:
    """`cumulative_over` carried on: the stored days (day and measures, at least one) and those after them up to `last`.

    Only events after the last stored day are counted, on top of its totals. That one row comes to the driver, so that its day is a
    literal in the filters of the scans. An event of a stored day that arrives later is not counted: stored days stand.
    """
    names = [m for _, times in sources for m in times]
    base = stored.orderBy(F.col(day).desc()).select(day, *names).first()
    start = base[day] + dt.timedelta(days=1)
    if start > last:
        return stored.select(day, *names)
    days = cumulative_over([_events_from(df, times, start) for df, times in sources], F.lit(start), F.lit(last), day)
    return stored.select(day, *names).unionByName(days.select(day, *[(F.col(m) + F.lit(base[m])).alias(m) for m in names]))


def concat_ordered(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], sep: str, out: str, split: bool = False
) -> DataFrame:
    """Texts of a key joined in order. With `split` the texts of a hot key are first joined per (key, split), so that
    sorting a long list is spread; the final value is as long as the result asks for."""

    def joined(rows: DataFrame, by: Sequence[str | Column], text: str, place: Sequence[str | Column]) -> DataFrame:
        ordered = F.sort_array(F.collect_list(F.struct(*place, F.col(text).alias("_text"))))
        return rows.groupBy(*by).agg(F.array_join(F.transform(ordered, lambda x: x["_text"]), sep).alias(out))

    rows = df.filter(F.col(value).isNotNull())
    if not split:
        return joined(rows, keys, value, order)
    g = spans(rows, keys, order)
    key = F.col(f"{SPAN}.k").alias("_k")
    fits = joined(g.filter(~F.col(HOT)), [HASH, SPAN], value, order).select(key, out)
    pieces = joined(g.filter(F.col(HOT)), [HASH, SPAN], value, order)
    whole = joined(pieces, [key], out, [F.col(f"{SPAN}.c").alias("_c")])
    return fits.unionByName(whole).select(*[F.col(f"_k.{k}").alias(k) for k in keys], out)


def concat_numbered(
    df: DataFrame, keys: Sequence[str], value: str, order: Sequence[str], sep: str, out: str
) -> DataFrame:
    """As concat_ordered, each text preceded by its number: '1) a 2) b'."""
    numbered = sequence(df.filter(F.col(value).isNotNull()), keys, order, "_no")
    text = numbered.withColumn("_item", F.concat(F.col("_no").cast("string"), F.lit(") "), F.col(value)))
    return concat_ordered(text, keys, "_item", order, sep, out, split=True)


def payment_heads(payments: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Payment sums by head, by fund, and of fund 1 for head 2, and the time of the newest counted payment (`last_paid`, of
    column `paid_at`), in one pass.

    Amounts should be decimals: sums of doubles depend on the order of tasks. Counts rows with status 1, 2, 4 or 5 whose excess portion is not 4; tax is added unless recoverable.
    Heads: 1 damages, 2 defence, 3 claimant.
    """
    valid = F.col("status").isin(1, 2, 4, 5) & (F.col("excess_portion") != 4)
    gross = F.when(F.col("tax_recoverable") == 1, F.col("amount")).otherwise(F.col("amount") + F.col("tax"))
    named = {"paid_damages": F.col("head") == 1, "paid_defence": F.col("head") == 2, "paid_claimant": F.col("head") == 3}
    named |= {"paid_fund": F.col("fund") == 1, "paid_member": F.col("fund") == 2}
    named |= {"paid_fund_defence": (F.col("fund") == 1) & (F.col("head") == 2)}
    sums = [F.sum(F.when(c, gross)).alias(name) for name, c in named.items()]
    return payments.filter(valid).groupBy(*keys).agg(*sums, F.max("paid_at").alias("last_paid"))


def mode_per_key(df: DataFrame, keys: Sequence[str], column: str) -> DataFrame:
    """Most frequent value per key; ties go to the smaller value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    return top_per_key(counts, keys, [F.col("n").desc(), F.col(column).asc()])


def last_in_group(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last row of each group in ascending order."""
    return top_per_key(df, keys, [F.col(o).desc() for o in order])


def profile_nulls(df: DataFrame) -> DataFrame:
    """Per column: rows, nulls and distinct-free share of NULL, from one aggregate over the table."""
    one = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_f_{i}") for i, c in enumerate(df.columns)])
    items = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"_f_{i}").alias("filled")) for i, c in enumerate(df.columns)])
    long = one.select("_rows", F.inline(items))
    return long.select(
        "column_name",
        F.col("_rows").alias("rows"),
        (F.col("_rows") - F.col("filled")).alias("nulls"),
        F.round((F.col("_rows") - F.col("filled")) * 100.0 / F.nullif("_rows", F.lit(0)), 2).alias("null_pct"),
    )


def activity_span(df: DataFrame, keys: Sequence[str], t: str) -> DataFrame:
    """First and last activity per entity."""
    return df.groupBy(*keys).agg(F.min(t).alias("first_activity"), F.max(t).alias("last_activity"))


def period_table(spark: SparkSession, first: Column, last: Column) -> DataFrame:
    """The periods a run on each day of [first, last] reports: period, start_day, end_day, stamp.

    Daily: the day. On a Sunday, Weekly: Monday to Sunday ending 7 days before. Seven days after a month
    end, Monthly: that month, and Yearly: the 365 days ending there.
    """
    days = spark.range(1).select(F.explode(F.sequence(first, last)).alias("run_day"))
    day, before = F.col("run_day"), F.date_sub("run_day", 7)
    is_month_end = F.last_day(before) == before

    def one(name: str, start: Column, end: Column, due: Column) -> Column:
        return F.when(due, F.struct(F.lit(name).alias("period"), start.alias("start_day"), end.alias("end_day"), end.alias("stamp")))

    rows = F.array_compact(
        F.array(
            one("Daily", day, day, F.lit(True)),
            one("Weekly", F.date_sub("run_day", 13), before, F.dayofweek(day) == 1),
            one("Monthly", F.trunc(before, "month"), before, is_month_end),
            one("Yearly", F.date_sub("run_day", 371), before, is_month_end),
        )
    )
    return days.select(F.inline(rows))


def multi_period_summary(df: DataFrame, arrival: str, departure: str, minutes: str, labels: Sequence[str], periods: DataFrame) -> DataFrame:
    """Counts per period and label. A row counts in a period if it arrived in it, or arrived earlier and
    left in it with minutes >= 0.

    Rows are first counted per (arrival day, departure day, label); the periods are then listed by day,
    so the join is an equi-join over counts: its size depends on days, not on rows.
    """
    arrived = F.col(arrival).cast("date")
    left = F.when(F.coalesce(F.col(minutes) >= 0, F.lit(False)), F.col(departure).cast("date"))
    counts = df.groupBy(arrived.alias("_in"), left.alias("_out"), *labels).agg(F.count(F.lit(1)).alias("_n"))
    listed = periods.withColumn("_day", F.explode(F.sequence("start_day", "end_day")))
    came = counts.withColumn("_day", F.col("_in")).join(listed, "_day")
    went = counts.filter(F.col("_out") != F.col("_in")).withColumn("_day", F.col("_out")).join(listed, "_day").filter(F.col("_in") < F.col("start_day"))
    return came.unionByName(went).groupBy("period", "stamp", *labels).agg(F.sum("_n").alias("n"))


def period_summary(df: DataFrame, arrival: str, departure: str, minutes: str, low: object, high: object, labels: Sequence[str]) -> DataFrame:
    """Counts for one closed period of days, with carry-in of earlier arrivals that left in it."""
    arrived, left = F.col(arrival).cast("date"), F.col(departure).cast("date")
    a, b = F.lit(low), F.lit(high)
    inside = arrived.between(a, b) | ((arrived < a) & left.between(a, b) & (F.col(minutes) >= 0))
    return count_by(df.filter(inside), labels)
