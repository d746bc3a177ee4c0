"""Session building: merging overlapping spans, closing open ones, roll-ups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fathomline.functions.dates import diff_boundary, whole_minutes
from fathomline.operators.ordered import BEFORE, HASH, HOT, SPAN, _across, scan, scan_spans, spans


def merge_sessions_full(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str]) -> DataFrame:
    """Merge all spans of a key that overlap or touch: keys, session, start_time, end_time, rows_merged.

    An open span (NULL end) counts as a point. Spans that run past many splits are seen through the
    running maximum of the ends.
    """
    until = F.coalesce(F.col(end), F.col(start))
    g = spans(df.select(*dict.fromkeys([*keys, *order, start, end])), keys, order).withColumn("_until", until)
    inside = Window.partitionBy(HASH, SPAN).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    fresh = F.when(F.col("_reach").isNull() | (F.col(start) > F.col("_reach")), 1).otherwise(0)

    def local(rows: DataFrame) -> DataFrame:
        seen = scan_spans(rows, order, measures={"_reach": ("max", F.col("_until"))}, current=False)
        return (
            seen.withColumn("_no", F.sum(fresh).over(inside))
            .groupBy(HASH, SPAN, "_no")
            .agg(F.min(start).alias("start_time"), F.max("_until").alias("end_time"), F.count(F.lit(1)).alias("rows_merged"))
        )

    # of a hot key, _no = 0 is the tail of a session that began in an earlier split
    pieces = local(g.filter(F.col(HOT)))
    begun = pieces.groupBy(HASH, SPAN).agg(F.max("_no").alias("_n"))
    carried = begun.select(HASH, SPAN, F.coalesce(F.sum("_n").over(_across().rowsBetween(*BEFORE)), F.lit(0)).alias("_offset"))
    joined = (
        pieces.join(carried, [HASH, SPAN])
        .groupBy(F.col(f"{SPAN}.k").alias("_k"), (F.col("_no") + F.col("_offset")).alias("session"))
        .agg(F.min("start_time").alias("start_time"), F.max("end_time").alias("end_time"), F.sum("rows_merged").alias("rows_merged"))
    )
    final = local(g.filter(~F.col(HOT))).select(F.col(f"{SPAN}.k").alias("_k"), F.col("_no").alias("session"), "start_time", "end_time", "rows_merged")
    return final.unionByName(joined).select(*[F.col(f"_k.{k}").alias(k) for k in keys], "session", "start_time", "end_time", "rows_merged")


def merge_sessions_pairwise(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str]) -> DataFrame:
    """One-row-back merge that keeps every row.

    absorbed: 1 where the previous row's end reaches this start. final_end: the later end of the row and
    of the one it absorbs; an open row takes the next start. seconds is NULL for a row that was open.
    """
    ahead = {"_next_start": F.col(start), "_next_end": F.col(end)}
    g = scan(df, keys, order, before={"_prev_end": F.col(end)}, after=ahead)
    reaches = F.col("_next_start") <= F.col(end)
    final_end = F.when(reaches, F.greatest(end, "_next_end")).otherwise(F.coalesce(F.col(end), F.col("_next_start")))
    out = g.withColumn("absorbed", F.when(F.col("_prev_end") >= F.col(start), 1).otherwise(0)).withColumn("final_end", final_end)
    seconds = F.when(F.col(end).isNotNull(), diff_boundary("second", F.col(start), F.col("final_end")))
    out = out.withColumn("seconds", seconds).withColumn("minutes", whole_minutes("seconds"))
    return out.drop("_prev_end", "_next_start", "_next_end")


def merge_sessions(df: DataFrame, keys: Sequence[str], start: str, end: str, order: Sequence[str], mode: str = "full") -> DataFrame:
    return {"full": merge_sessions_full, "pairwise": merge_sessions_pairwise}[mode](df, keys, start, end, order)


def rollup_sessions(df: DataFrame, keys: Sequence[str], start: str, minutes: str, grain: str = "day") -> DataFrame:
    """Sessions per day, or per day and hour."""
    groups = [*[F.col(k) for k in keys], F.col(start).cast("date").alias("day")]
    if grain == "hour":
        groups.append(F.hour(start).alias("hour"))
    return df.groupBy(*groups).agg(F.count(F.lit(1)).alias("sessions"), F.sum(minutes).alias("minutes"))


def session_facts(df: DataFrame, keys: Sequence[str], start: str, end: str, row_id: str) -> DataFrame:
    """First login, last logout, last row and total minutes per session key."""
    seconds = diff_boundary("second", F.col(start), F.col(end))
    return df.groupBy(*keys).agg(
        F.min(start).alias("first_login"),
        F.max(end).alias("last_logout"),
        F.max(F.struct(start, row_id))[row_id].alias("last_row"),
        F.sum(whole_minutes(seconds)).alias("total_minutes"),
        F.count(F.lit(1)).alias("rows"),
    )


def session_outcome(df: DataFrame, keys: Sequence[str], success: Column) -> DataFrame:
    """direct: only successes; login: both; failed: no success."""
    grouped = df.groupBy(*keys).agg(F.bool_or(success).alias("_any"), F.bool_and(success).alias("_all"))
    outcome = F.when(F.col("_all"), "direct").when(F.col("_any"), "login").otherwise("failed")
    return grouped.withColumn("outcome", outcome).drop("_any", "_all")
