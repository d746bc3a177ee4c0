"""Referral, spell and legal-status jobs: linked tables with one row per contact, spell or episode."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.dates import diff_boundary
from fathomline.functions.rules import band, flag, length_of_stay, record_status
from fathomline.functions.text import map_codes
from fathomline.operators.joins import asof_max, first_pass, nearest_containing
from fathomline.operators.keys import latest_per_key, shuffled_apart
from fathomline.operators.ordered import global_sequence, scan, sequence
from fathomline.session import materialise
from fathomline.sources.loads import upsert_newer

# Code groups, version switch and age bands of the published data set
ATTENDED = ["5", "6"]
DIRECT_MECHANISMS = ["01", "02", "04"]
VIDEO_OLD, VIDEO_NEW, VIDEO_SWITCH_MONTH = "03", "11", 1459
FACE_TO_FACE = ["01", "11"]
PRIORITIES = {"1": "Emergency", "2": "Urgent/serious", "U": "Urgent/serious", "3": "Routine", "4": "Very Urgent"}
AGE_EDGES = [0, 12, 18, 26, 65, 1000]
AGE_LABELS = ["0-11", "12-17", "18-25", "26-64", "65+"]
STAY_EDGES = [1, 8, 15, 31, 91, 181, 366, 1_000_000]
STAY_LABELS = ["Up to 1 week", "1 to 2 weeks", "2 weeks to 1 month", "1 to 3 months", "3 to 6 months", "6 months to 1 year", "1 year and above"]


def attended_contact(mechanism: Column, attended: Column, month_id: Column) -> Column:
    """An attended contact of a counted kind; the code for video changed with a data-set version."""
    video = ((month_id < VIDEO_SWITCH_MONTH) & (mechanism == VIDEO_OLD)) | ((month_id >= VIDEO_SWITCH_MONTH) & (mechanism == VIDEO_NEW))
    return attended.isin(ATTENDED) & (mechanism.isin(DIRECT_MECHANISMS) | video)


def referral_contacts(referrals: DataFrame, contacts: DataFrame, low: Column, high: Column, run_end: Column) -> DataFrame:
    """Referrals that are new, or have a contact, in the window [low, high), one row per contact.

    referrals: referral_id, person_id, provider, received, rejected, discharged, month_id, submission_id, priority, age
    contacts: referral_id, person_id, contact_id, contact_time, mechanism, attended, month_id, submission_id
    """
    valid = contacts.filter(attended_contact(F.col("mechanism"), F.col("attended"), F.col("month_id")))
    in_window = valid.filter((F.col("contact_time") >= low) & (F.col("contact_time") < high)).select("referral_id").distinct()
    seen = in_window.withColumn("_seen", F.lit(True))
    cohort = (
        referrals.filter(F.col("received").isNotNull())
        .join(seen, "referral_id", "left")
        .filter(((F.col("received") >= low) & (F.col("received") < high)) | F.col("_seen"))
        .drop("_seen")
    )
    newest = [F.col("month_id").desc_nulls_last(), F.col("submission_id").desc_nulls_last()]
    latest = latest_per_key(cohort, ["referral_id", "provider"], newest).drop("submission_id")
    once = latest_per_key(valid, ["referral_id", "contact_time", "mechanism"], [F.col("submission_id").desc(), F.col("contact_id").desc()])
    side = once.select(F.col("referral_id").alias("_r"), F.col("person_id").alias("_p"), "contact_id", "contact_time", "mechanism")
    on = (F.col("referral_id") == F.col("_r")) & (F.col("person_id") == F.col("_p")) & (F.col("contact_time") >= F.col("received"))
    # the ordered pass below reads its input more than once, so the joins are written once
    rows = materialise(latest.join(side, on, "left").drop("_r", "_p"), "referral-contacts")

    has = F.col("contact_time").isNotNull()
    f2f = has & F.col("mechanism").isin(FACE_TO_FACE)
    order = ["contact_time", "contact_id"]
    counts = {"contact_order": ("sum", has.cast("long")), "face_to_face_order": ("sum", f2f.cast("long"))}
    keys = ["person_id", "referral_id", "provider"]
    g = scan(rows, keys, order, measures=counts, before={"_previous": F.col("contact_time")})
    out = g.withColumns(
        {
            "contact_order": F.when(has, F.col("contact_order")),
            "face_to_face_order": F.when(f2f, F.col("face_to_face_order")),
            "days_since_previous": F.datediff("contact_time", "_previous"),
            "days_to_contact": F.datediff("contact_time", "received"),
            "days_to_close": F.datediff(F.coalesce("rejected", "discharged", run_end), "received"),
            "rejected_flag": flag(F.col("rejected").isNotNull(), None),
            "priority_label": map_codes("priority", PRIORITIES, "Not Recorded"),
            "age_band": band("age", AGE_EDGES, AGE_LABELS, "Missing/Invalid"),
        }
    )
    return out.drop("_previous")


def overall_order(rows: DataFrame, per_referral: bool = False) -> DataFrame:
    """One number over the whole table, or within each referral: by received date, referral, provider and contact."""
    placed = rows.withColumn("_c", F.coalesce("contact_order", F.lit(1)))
    if per_referral:
        return sequence(placed, ["referral_id"], ["received", "provider", "_c"], "overall_order").drop("_c")
    return global_sequence(placed, ["received", "referral_id", "provider", "_c"], "overall_order").drop("_c")


def diagnoses(feeds: dict[str, DataFrame], stored: DataFrame) -> DataFrame:
    """Latest diagnosis per referral and level from several feeds, loaded into the stored ones: new keys come in,
    others only with a newer month.

    feeds: level -> referral_id, code, month_id, submission_id; stored: referral_id, level, code, month_id
    """
    all_rows = reduce(lambda a, b: a.unionByName(b), [f.withColumn("level", F.lit(level)) for level, f in feeds.items()])
    newest = [F.col("month_id").desc(), F.col("submission_id").desc(), F.col("code").asc()]
    batch = latest_per_key(all_rows, ["referral_id", "level"], newest).select(*stored.columns)
    return upsert_newer(stored, batch, ["referral_id", "level"], "month_id")


def inpatient_spells(spells: DataFrame, dx: DataFrame, referrals: DataFrame, own_source: str, stays: DataFrame) -> DataFrame:
    """Latest version of each spell with status, stay, bands, diagnosis flags, known-to-service flags at its start (see
    `known_to_service`), and a flag and stay for absence without leave; of several such stays the earliest absence counts.

    spells: spell_id, person_id, referral_id, month_id, submission_id, start, discharge, age, gender
    dx: referral_id, level (Provisional, Primary, Secondary), description
    referrals: person_id, received, discharged, rejected, source; stays: spell_id, stay_id, absent_from (NULL: no absence)
    """
    last_start = spells.agg(F.max("start")).scalar()
    last_end = F.last_day(last_start)
    last_month = spells.agg(F.max("month_id")).scalar()
    newest = [F.col("month_id").desc(), F.col("submission_id").desc()]
    latest = latest_per_key(spells, ["spell_id"], newest)
    levels = dx.groupBy("referral_id").agg(
        *[F.max(F.when(F.col("level") == name, F.col("description"))).alias(name.lower()) for name in ("Provisional", "Primary", "Secondary")]
    )
    joined = latest.join(levels, "referral_id", "left")
    texts = [F.lower(c) for c in ("provisional", "primary", "secondary")]
    adult_male = F.col("age").between(18, 44) & (F.col("gender") == "Male")

    def mentions(word: str) -> Column:
        return reduce(lambda a, b: a | b, [F.coalesce(t.contains(word), F.lit(False)) for t in texts])

    stay = length_of_stay("start", "discharge", inclusive=True)
    out = joined.withColumns(
        {
            "status": record_status("discharge", "month_id", last_month),
            "stay_days": stay,
            "stay_to_date": F.when(F.col("discharge").isNull(), length_of_stay("start", last_end, inclusive=True)),
            "nights": length_of_stay("start", "discharge"),
            "admitted_month": F.trunc("start", "month"),
            "psychosis_flag": flag(mentions("psychosis") & adult_male, None),
            "personality_flag": flag(mentions("personality") & adult_male, None),
            "bipolar_flag": flag(mentions("bipolar"), None),
        }
    )
    stranded = F.when(F.col("stay_days") >= 90, "Super Stranded").when(F.col("stay_days") >= 60, "Stranded")
    out = out.withColumns({"stay_band": band("stay_days", STAY_EDGES, STAY_LABELS), "stranded": stranded})
    earliest = F.min(F.struct("absent_from", "stay_id"))["stay_id"].alias("absence_stay_id")
    absent = stays.filter(F.col("absent_from").isNotNull()).groupBy("spell_id").agg(earliest, F.lit(1).alias("absence_flag"))
    # the ordered pass behind the known flags reads its input more than once
    rows = materialise(out.join(absent, "spell_id", "left"), "spells")
    return known_to_service(rows, referrals, "person_id", "start", own_source)


def ward_stays(stays: DataFrame) -> DataFrame:
    """Last submission of each stay, stays numbered within their spell; the first one is the admission stay.

    stays: spell_id, stay_id, month_id, submission_id, ward, start, bed_days
    """
    newest = [F.col("month_id").desc(), F.col("submission_id").desc()]
    last = materialise(latest_per_key(stays, ["spell_id", "stay_id"], newest), "ward-stays")
    counted, ahead = {"stay_order": ("sum", F.lit(1).cast("long"))}, {"_next": F.col("stay_id")}
    out = scan(last, ["spell_id"], ["start", "stay_id"], measures=counted, after=ahead)
    return out.withColumns({"last_stay": flag(F.col("_next").isNull()), "admission_stay": flag(F.col("stay_order") == 1)}).drop("_next")


def known_to_service(
    attendances: DataFrame,
    referrals: DataFrame,
    person: str,
    arrival: str,
    own_source: str,
    horizons: Sequence[int] = (6, 24),
    days_per_month: int | None = None,
) -> DataFrame:
    """Known flags per horizon in months, and previously known, one row out per attendance.

    Any referral up to the arrival day counts if within the horizon, or if older and still open. A referral made
    by the department itself on the day clears the flag; one made by it earlier within the horizon sets it. Months are
    calendar boundaries, or `days_per_month` days each if that is given.
    referrals: person, received, discharged, rejected, source
    """
    never = F.lit("9999-12-31").cast("date")
    ended = F.least(F.coalesce("discharged", never), F.coalesce("rejected", never))
    known = referrals.filter(F.col(person).isNotNull() & F.col("received").isNotNull())
    own = F.col("source") == own_source
    day = F.col("received").cast("date")
    # the department's own referrals appear a second time one day later: seen from the day after
    moments = known.select(
        person,
        F.inline(
            F.array_compact(
                F.array(
                    F.struct(day.alias("_at"), day.alias("_any"), F.when(own, day).alias("_own"), F.lit(None).cast("date").alias("_own_before"),
                             F.lit(None).cast("date").alias("_own_first"), F.datediff(never, day).alias("_age"), ended.alias("_ends")),
                    F.when(own, F.struct(F.date_add(day, 1).alias("_at"), F.lit(None).cast("date").alias("_any"), F.lit(None).cast("date").alias("_own"),
                                         day.alias("_own_before"), day.alias("_own_first"), F.lit(None).cast("int").alias("_age"), F.lit(None).cast("date").alias("_ends"))),
                )
            )
        ),
    )
    measures = {
        "_any": F.col("_any"),
        "_own": F.col("_own"),
        "_own_before": F.col("_own_before"),
        "_oldest_own": F.datediff(never, "_own_first"),
        "_age": F.col("_age"),
        "_ends": F.col("_ends"),
    }
    dated = attendances.withColumn("_arrived", F.col(arrival).cast("date"))
    seen = asof_max(dated, moments, [person], "_arrived", "_at", measures, strict=False)
    arrived = F.col("_arrived")
    same_day_own = F.coalesce(F.col("_own") == arrived, F.lit(False))
    open_now = F.coalesce(F.col("_ends") > arrived, F.lit(False))

    def within(since: Column, h: int) -> Column:
        if days_per_month:
            return F.datediff(arrived, since) <= h * days_per_month
        return diff_boundary("month", since, arrived) <= h

    flags = {}
    for h in horizons:
        own_earlier = F.coalesce(within(F.col("_own_before"), h), F.lit(False))
        known_now = F.coalesce(within(F.col("_any"), h), F.lit(False)) | open_now
        flags[f"known_{h}_months"] = F.when(own_earlier, 1).when(same_day_own, F.lit(None)).when(known_now, 1)
    old = F.coalesce(~within(F.date_sub(never, F.col("_age")), max(horizons)), F.lit(False))
    old_own = F.coalesce(~within(F.date_sub(never, F.col("_oldest_own")), max(horizons)), F.lit(False))
    flags["previously_known"] = F.when(old_own, 1).when(same_day_own, F.lit(None)).when(old, 1)
    return seen.withColumns(flags).select(*attendances.columns, *flags)


def legal_episodes(periods: DataFrame, other_feeds: Sequence[DataFrame], spells: DataFrame, run_end: Column, lead: str = "24 hours") -> DataFrame:
    """Legal-status episodes linked to spells.

    Episodes that other feeds report in the same month go; the latest month of each episode stays. Links, each where the
    episode starts between `lead` before the spell and its end: by person key and record number; then by person key and
    provider; then by referral. Best: nearest start day, longest stay, id. The first two also set the referral.
    periods: episode_id, month_id, record_no, person_id, derived_person_id, provider, referral_id, start, uniq_id
    other_feeds: episode_id, month_id; spells: spell_id, record_no, person_id, derived_person_id, provider, referral_id, start, discharge
    """
    # all months that feeds report of an episode in one row, so that periods are dealt by episode once for this and for the choice below
    reported = reduce(lambda a, b: a.unionByName(b), [feed.select("episode_id", "month_id") for feed in other_feeds])
    reported = shuffled_apart(reported.groupBy("episode_id").agg(F.collect_set("month_id").alias("_months")), ["episode_id"])
    elsewhere = F.coalesce(F.array_contains("_months", F.col("month_id")), F.lit(False))
    left = periods.join(reported, "episode_id", "left").filter(~elsewhere).drop("_months")
    newest = [F.col("month_id").desc(), F.col("record_no").desc(), F.col("uniq_id").desc()]
    latest = latest_per_key(left, ["episode_id"], newest).withColumn("person_key", F.coalesce("derived_person_id", "person_id"))
    latest = materialise(latest, "episodes")  # every pass starts from it
    side = spells.select(
        "spell_id",
        F.coalesce("derived_person_id", "person_id").alias("person_key"),
        "record_no",
        "provider",
        "referral_id",
        F.col("start").alias("spell_start"),
        F.coalesce("discharge", run_end).alias("spell_end"),
    )

    def held(keys: list[str]) -> DataFrame:
        return nearest_containing(latest, "episode_id", side, keys, "start", "spell_start", "spell_end", "spell_id", lead)

    passes = [held(["person_key", "record_no"]), held(["person_key", "provider"]), held(["referral_id"])]
    found = first_pass("episode_id", passes, [F.col("_off").asc(), F.col("_stay").desc(), F.col("spell_id").asc()]).drop("_off", "_stay")
    # the spell's referral is looked up for the links, which are narrower than episodes
    found = found.join(side.select("spell_id", F.col("referral_id").alias("_spell_referral")), "spell_id", "left")
    linked = latest.join(found, "episode_id", "left").withColumn("referral_id", F.coalesce("_spell_referral", "referral_id"))
    return linked.drop("_spell_referral", "person_key")


def spell_legal_status(spells: DataFrame, episodes: DataFrame, formal: Sequence[str], hold: str) -> DataFrame:
    """Legal status of each spell: a formal section first, else the earliest episode; prior hold; admission type.

    spells: spell_id, start; episodes: spell_id, episode_id, section, start
    """
    linked = episodes.filter(F.col("spell_id").isNotNull()).select("spell_id", "episode_id", "section", F.col("start").alias("episode_start"))
    order = [F.when(F.col("section").isin(list(formal)), 0).otherwise(1), F.col("episode_start"), F.col("episode_id")]
    best = latest_per_key(linked, ["spell_id"], order)
    holds = linked.filter(F.col("section") == hold).select("spell_id", F.col("episode_start").alias("_hold"))
    before = F.datediff("start", "_hold").between(0, 2)
    held = spells.select("spell_id", "start").join(holds, "spell_id").groupBy("spell_id").agg(F.max(before.cast("int")).alias("_held"))
    out = spells.join(best, "spell_id", "left").join(held, "spell_id", "left")
    kind = F.when(F.col("section").isin(list(formal)), "Formal").when(F.col("section").isNull(), "No Link").otherwise("Informal")
    return out.withColumns({"prior_hold": F.when(F.col("_held") == 1, 1), "admission_type": kind}).drop("_held")


def report_feed(rows: DataFrame, attributes: Sequence[str], gap: str) -> DataFrame:
    """Counts over many attributes with the gap in bands."""
    banded = band(gap, [0, 8, 29, 91, 1_000_000], ["0-7", "8-28", "29-90", "91+"], "Not Recorded", null_label="No gap")
    return rows.groupBy(*attributes, banded.alias("gap_band")).agg(F.count(F.lit(1)).alias("n"))
