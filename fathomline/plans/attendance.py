"""Emergency attendance jobs: the attendance table, return within days of a spell, snapshots, breach summaries."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.dates import make_ts
from fathomline.functions.rules import band, breach, flag, flag_any, not_in_or_null
from fathomline.functions.text import nth_item
from fathomline.operators.aggs import multi_period_summary
from fathomline.operators.joins import asof_last
from fathomline.operators.keys import drop_repeats, latest_per_key, shuffled_apart
from fathomline.session import materialise

# Waiting-time bands in minutes (upper ends belong to the band)
WAIT_EDGES = [0, 240, 720, 1440, 2880, 4320, 10_000_000]
WAIT_LABELS = ["0-4", "5-12", "12-24", "24-48", "48-72", ">72"]

# Code columns of an attendance beside its diagnoses
DECODED = ("arrival_mode", "attendance_source", "intent", "complaint", "destination", "follow_up", "accommodation")

GROUP_BITS = 8  # rows that share one map of descriptions: 2 to this power, so a map has at most that many codes per column


def wait_band(minutes: Column | str) -> Column:
    """Waiting-time band; an unknown wait counts with the first."""
    return band(minutes, WAIT_EDGES, WAIT_LABELS, "Not recorded", closed=True, null_label="0-4")


def group_codes(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(_group, code): the distinct codes of several columns per group of rows, without surrounding blanks."""
    codes = F.array_compact(F.array(*[F.trim(c) for c in columns]))
    return rows.select("_group", F.explode(F.array_distinct(codes)).alias("code")).distinct()


def decode(df: DataFrame, dictionary: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Descriptions of several code columns from one dictionary (code, description, unique on code), by one lookup.

    Rows are written in groups of neighbours. The distinct codes of a group, those of all columns together, meet the dictionary
    in one join and come back as one map per group, from which each column reads its text. However many columns are decoded, the
    wide rows move once, in groups of one size; a hot code comes once per group. Codes are compared without surrounding blanks; a NULL code,
    and one that the dictionary lacks, has no text.
    """
    group = F.shiftright(F.monotonically_increasing_id(), GROUP_BITS)
    rows = materialise(df.withColumn("_group", group), "rows")
    wanted = group_codes(rows, list(columns))
    known = dictionary.select(F.col("code").cast("string").alias("code"), "description")
    found = wanted.join(shuffled_apart(known, ["code"]), "code")
    texts = found.groupBy("_group").agg(F.map_from_entries(F.collect_list(F.struct("code", "description"))).alias("_texts"))
    read = {name: F.try_element_at("_texts", F.trim(column)) for column, name in columns.items()}
    return rows.join(texts, "_group", "left").withColumns(read).drop("_group", "_texts")


def filled_slots(slots: Sequence[str], n: int, prefix: str, by_code: bool = False) -> dict[str, Column]:
    """The first n filled slots, numbered without gaps, in slot order or as distinct codes in code order: all within the row."""
    filled = F.array_compact(F.array(*slots))
    if by_code:
        filled = F.sort_array(F.array_distinct(filled))
    return {f"{prefix}_{i}": F.try_element_at(filled, F.lit(i)) for i in range(1, n + 1)}


def aligned_slots(slots: Sequence[tuple[Column, Column, Column]], prefix: str, move_up: bool = False) -> dict[str, Column]:
    """Slots of (service, time of the request, time of the assessment), each kept together. A slot without a service is empty
    in all three; with `move_up` the ones behind it take its place."""
    service = [F.nullif(F.trim(s), F.lit("")) for s, _, _ in slots]
    parts = [F.struct(s.alias("service"), asked.alias("requested"), seen.alias("assessed")) for s, (_, asked, seen) in zip(service, slots)]
    held = [F.when(s.isNotNull(), part) for s, part in zip(service, parts)]
    if not move_up:
        return {f"{prefix}_{i}": slot for i, slot in enumerate(held, 1)}
    row = F.array_compact(F.array(*held))
    return {f"{prefix}_{i}": F.get(row, F.lit(i - 1)) for i in range(1, len(slots) + 1)}


def referred_services(referrals: DataFrame, n: int, move_up: bool = False) -> DataFrame:
    """Per attendance, up to n services it was referred to, with the times of request and assessment (no time: midnight);
    one without any keeps empty slots, as a filter on the parsed slots would parse them twice.

    referrals: ident and per slot i service_i, request_date_i, request_time_i, assessment_date_i, assessment_time_i
    """
    slots = [
        (F.col(f"service_{i}"), make_ts(f"request_date_{i}", f"request_time_{i}"), make_ts(f"assessment_date_{i}", f"assessment_time_{i}"))
        for i in range(1, n + 1)
    ]
    packed = referrals.select("ident", *[c.alias(name) for name, c in aligned_slots(slots, "slot", move_up).items()])
    fields = ("service", "requested", "assessed")
    return packed.select(
        "ident", *[F.col(f"slot_{i}.{f}").alias(f"{f}_{i}") for i in range(1, n + 1) for f in fields]
    )


def attendances(
    feed: DataFrame,
    dictionary: DataFrame,
    comorbidities: DataFrame,
    departments: Sequence[str],
    excluded_discharges: Sequence[str],
    complaint_codes: Sequence[str],
    diagnosis_codes: Sequence[str],
    intent_code: str,
    slots: Sequence[str],
    duplicate_key: Sequence[str] = ("person_id", "attendance_id", "arrival_date"),
    slots_by_code: bool = False,
    referrals: DataFrame | None = None,
    services: int = 4,
    services_move_up: bool = False,
) -> DataFrame:
    """Attendances in scope, once each, decoded and flagged.

    feed: ident, record_id, person_id, attendance_id, arrival_date, arrival_time, wait_minutes, department, discharge_status,
    complaint, intent, diagnoses (comma list) and any others of DECODED; comorbidities: ident plus numbered slots; dictionary:
    code, description, created; referrals: see `referred_services`, unique on ident. Codes of all kinds are decoded in one lookup.
    """
    scope = feed.filter(F.col("department").isin(list(departments)) & not_in_or_null("discharge_status", list(excluded_discharges)))
    once = drop_repeats(scope, list(duplicate_key), [F.col("record_id").asc()])
    current = latest_per_key(dictionary.filter(F.col("description").isNotNull()), ["code"], [F.col("created").desc(), F.col("description")])
    dx = {f"diagnosis_{i}": nth_item("diagnoses", ",", i) for i in range(1, 5)}
    six, over_six = breach("wait_minutes", 360)
    twelve, over_twelve = breach("wait_minutes", 720)
    complaint = F.col("complaint").isin(list(complaint_codes))
    self_inflicted = F.col("intent") == intent_code
    diagnosed = F.col("diagnosis_1").isin(list(diagnosis_codes))
    rows = once.withColumns(dx).withColumns(
        {
            "arrival": make_ts("arrival_date", "arrival_time"),
            "wait_band": wait_band("wait_minutes"),
            "breach_6h": six,
            "minutes_over_6h": F.coalesce(over_six, F.lit(0)),
            "breach_12h": twelve,
            "minutes_over_12h": F.coalesce(over_twelve, F.lit(0)),
            "breach_24h": flag(F.col("wait_minutes") >= 1440),
            "complaint_flag": flag(complaint),
            "intent_flag": flag(self_inflicted),
            "diagnosis_flag": flag(diagnosed),
            "presentation_flag": flag_any([complaint, self_inflicted, diagnosed]),
        }
    )
    sick = comorbidities.select("ident", *[c.alias(n) for n, c in filled_slots(slots, 4, "comorbidity", slots_by_code).items()])
    rows = rows.join(sick, "ident", "left")
    coded = [c for c in DECODED if c in feed.columns] + list(dx)
    if referrals is not None:
        rows = rows.join(referred_services(referrals, services, services_move_up), "ident", "left")
        coded += [f"service_{i}" for i in range(1, services + 1)]
    return decode(rows, current, {c: f"{c}_text" for c in coded})


def returns_after_spell(attendances_: DataFrame, spells: DataFrame, person: str, arrival: str, days: int = 28) -> DataFrame:
    """Last spell completed before the arrival, the gap in days, and a flag for a return within `days`.

    spells: person, spell_id, discharge
    """
    out = asof_last(attendances_, spells, [person], arrival, "discharge", "spell_id", [])
    gap = F.datediff(arrival, "discharge")
    return out.withColumn("days_since_spell", gap).withColumn("return_flag", F.when(F.col("days_since_spell") <= days, 1))


def return_list(rows: DataFrame) -> DataFrame:
    """Presentations of interest that came back within the window."""
    return rows.filter((F.col("return_flag") == 1) & (F.col("presentation_flag") == 1))


def daily_snapshot(rows: DataFrame, arrival: str, departure: str, minutes: str, days: DataFrame) -> DataFrame:
    """Rows that arrive on a snapshot day, or came earlier and leave on it. days: snapshot_day.

    A row belongs to at most its arrival day and its departure day, so it is listed under those two and joined by
    equality; no row is compared with days it cannot belong to.
    """
    came = F.col(arrival).cast("date")
    left = F.when((F.col(departure).cast("date") > came) & (F.col(minutes) >= 0), F.col(departure).cast("date"))
    listed = rows.withColumn("snapshot_day", F.explode(F.array_compact(F.array(came, left))))
    return listed.join(days, "snapshot_day")


def breach_summary(rows: DataFrame, arrival: str, departure: str, minutes: str, labels: Sequence[str], periods: DataFrame) -> DataFrame:
    """Counts per period, label and waiting-time band."""
    banded = rows.withColumn("wait_band", wait_band(minutes))
    return multi_period_summary(banded, arrival, departure, minutes, [*labels, "wait_band"], periods)


def breach_list(rows: DataFrame, minutes: str, labels: dict[str, str]) -> DataFrame:
    """Attendances over 12 hours with default labels."""
    over, excess = breach(minutes, 720)
    named = rows.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in labels.items()})
    return named.withColumns({"breach_12h": over, "minutes_over_12h": excess, "wait_band": wait_band(minutes)}).filter("breach_12h = 1")


def breach_totals(rows: DataFrame, minutes: str, groups: Sequence[str]) -> DataFrame:
    """Totals per group and over all ('All' in every group column), from one pass over the rows."""
    m = F.col(minutes)
    per = rows.groupBy(*groups).agg(F.count(F.lit(1)).alias("n"), F.count_if(m > 720).alias("over_12h"), F.count_if(m >= 1440).alias("over_24h"))
    total = per.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n", "over_12h", "over_24h")])
    return per.unionByName(total.select(*[F.lit("All").alias(g) for g in groups], "n", "over_12h", "over_24h"))
