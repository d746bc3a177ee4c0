"""Referral, spell and legal-status jobs on the given tables: orders play referrals and spells, line items contacts."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.registry import Tables, query
from fathomline.functions import dates
from fathomline.functions.text import map_codes
from fathomline.operators.ordered import gap_since_previous
from fathomline.plans import care
from fathomline.session import materialise
from fathomline.sources.loads import replace_by_key

def received() -> Column:
    return F.col("o_orderdate").cast("date")



def days_after(column: Column, n: Column) -> Column:
    return F.date_add(column, n.cast("int"))


def hours_after(t: Column, n: Column) -> Column:
    return (t.cast("timestamp") + F.make_dt_interval(F.lit(0), n.cast("int"))).cast("timestamp_ntz")


def referrals(t: Tables) -> DataFrame:
    """Each order as a referral; one in four has a second, newer version."""
    key = F.col("o_orderkey")
    versions = t.orders.withColumn("v", F.explode(F.when(key % 4 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return versions.select(
        key.alias("referral_id"),
        F.col("o_custkey").alias("person_id"),
        F.concat(F.lit("P"), key % 3).alias("provider"),
        received().alias("received"),
        F.when(key % 17 == 0, F.date_add(received(), 3)).alias("rejected"),
        F.when(F.col("o_orderstatus") == "F", days_after(received(), key % 90 + F.col("v"))).alias("discharged"),
        (F.lit(1400) + F.col("v")).alias("month_id"),
        (key * 10 + F.col("v")).alias("submission_id"),
        F.left("o_orderpriority", F.lit(1)).alias("priority"),
        (F.col("o_custkey") % 100).cast("int").alias("age"),
    )


REFERRALS = """SELECT o_orderkey AS referral_id, o_custkey AS person_id, 'P' || (o_orderkey % 3) AS provider, o_orderdate::DATE AS received,
    CASE WHEN o_orderkey % 17 = 0 THEN o_orderdate::DATE + 3 END AS rejected, CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE + (o_orderkey % 90 + v)::INT END AS discharged,
    1400 + v AS month_id, o_orderkey * 10 + v AS submission_id, o_orderpriority[1] AS priority, o_custkey % 100 AS age
    FROM orders, (VALUES (0), (1)) x(v) WHERE v = 0 OR o_orderkey % 4 = 0"""


def contacts(t: Tables) -> DataFrame:
    """Line items as contacts of their order's customer."""
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        F.col("l_orderkey").alias("referral_id"),
        F.col("o_custkey").alias("person_id"),
        (F.col("l_partkey") * 10 + F.col("l_linenumber")).alias("contact_id"),
        F.col("l_shipdate").cast("date").alias("contact_time"),
        F.element_at(F.array(*[F.lit(m) for m in ("01", "02", "03", "04", "11", "11", "09")]), F.col("l_linenumber")).alias("mechanism"),
        map_codes("l_returnflag", {"A": "5", "N": "6", "R": "7"}).alias("attended"),
        (F.lit(1400) + F.col("l_suppkey") % 100).alias("month_id"),
        F.col("l_suppkey").alias("submission_id"),
    )


CONTACTS = """SELECT l_orderkey AS referral_id, o_custkey AS person_id, l_partkey * 10 + l_linenumber AS contact_id, l_shipdate::DATE AS contact_time,
    ['01', '02', '03', '04', '11', '11', '09'][l_linenumber] AS mechanism, CASE l_returnflag WHEN 'A' THEN '5' WHEN 'N' THEN '6' ELSE '7' END AS attended,
    1400 + l_suppkey % 100 AS month_id, l_suppkey AS submission_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""

K01 = f"""WITH r AS ({REFERRALS}), c AS (SELECT * FROM ({CONTACTS}) WHERE attended IN ('5', '6') AND (mechanism IN ('01', '02', '04')
    OR (month_id < 1459 AND mechanism = '03') OR (month_id >= 1459 AND mechanism = '11'))),
    latest AS (SELECT * FROM r WHERE (received >= DATE '1998-04-01' AND received < DATE '1999-04-01')
    OR referral_id IN (SELECT referral_id FROM c WHERE contact_time >= DATE '1998-04-01' AND contact_time < DATE '1999-04-01')
    QUALIFY row_number() OVER (PARTITION BY referral_id, provider ORDER BY month_id DESC, submission_id DESC) = 1),
    once AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY referral_id, contact_time, mechanism ORDER BY submission_id DESC, contact_id DESC) = 1),
    j AS (SELECT latest.*, once.contact_id, once.contact_time, once.mechanism FROM latest LEFT JOIN once ON once.referral_id = latest.referral_id AND once.person_id = latest.person_id
    AND once.contact_time >= latest.received)"""

K01_ROWS = """SELECT referral_id, provider, contact_id, contact_time::VARCHAR AS contact_time,
    CASE WHEN contact_time IS NOT NULL THEN row_number() OVER w END AS contact_order,
    CASE WHEN mechanism IN ('01', '11') THEN row_number() OVER (PARTITION BY referral_id, provider, person_id, mechanism IN ('01', '11') ORDER BY contact_time, contact_id) END AS face_to_face_order,
    date_diff('day', lag(contact_time) OVER w, contact_time) AS days_since_previous, date_diff('day', received, contact_time) AS days_to_contact,
    date_diff('day', received, coalesce(rejected, discharged, DATE '2001-12-31')) AS days_to_close, CASE WHEN rejected IS NOT NULL THEN 1 END AS rejected_flag,
    CASE priority WHEN '1' THEN 'Emergency' WHEN '2' THEN 'Urgent/serious' WHEN '3' THEN 'Routine' WHEN '4' THEN 'Very Urgent' ELSE 'Not Recorded' END AS priority_label,
    CASE WHEN age <= 11 THEN '0-11' WHEN age <= 17 THEN '12-17' WHEN age <= 25 THEN '18-25' WHEN age <= 64 THEN '26-64' ELSE '65+' END AS age_band{extra}
    FROM j WINDOW w AS (PARTITION BY referral_id, provider, person_id ORDER BY contact_time, contact_id)"""


def linked(t: Tables) -> DataFrame:
    low, high = (F.lit(d).cast("date") for d in ("1998-04-01", "1999-04-01"))
    return care.referral_contacts(referrals(t), contacts(t), low, high, F.lit(dt.date(2001, 12, 31)))


K01_COLUMNS = [
    "referral_id", "provider", "contact_id", "contact_time", "contact_order", "face_to_face_order", "days_since_previous", "days_to_contact",
    "days_to_close", "rejected_flag", "priority_label", "age_band",
]


@query("k01_referrals_and_contacts", K01 + K01_ROWS.format(extra=""))
def _(t: Tables) -> DataFrame:
    return linked(t).select(*K01_COLUMNS)


@query(
    "k01_overall_order",
    K01 + f"SELECT referral_id, contact_id, row_number() OVER (ORDER BY received, referral_id, provider, coalesce(contact_order, 1)) AS overall_order FROM ({K01_ROWS.format(extra=', received')})",
)
def _(t: Tables) -> DataFrame:
    # the table is written before it is numbered, so the joins behind it run once
    return care.overall_order(materialise(linked(t), "referrals")).select("referral_id", "contact_id", "overall_order")


@query(
    "k01_order_within_referral",
    K01 + f"SELECT referral_id, contact_id, row_number() OVER (PARTITION BY referral_id ORDER BY received, provider, coalesce(contact_order, 1)) AS overall_order FROM ({K01_ROWS.format(extra=', received')})",
)
def _(t: Tables) -> DataFrame:
    out = care.overall_order(materialise(linked(t), "referrals"), per_referral=True)
    return out.select("referral_id", "contact_id", "overall_order")


@query(
    "k01_replaced_table",
    K01 + f""", b AS ({K01_ROWS.format(extra='')}) SELECT referral_id, contact_order FROM b UNION ALL SELECT o_orderkey, 0 FROM orders WHERE o_orderkey NOT IN (SELECT referral_id FROM b)""",
)
def _(t: Tables) -> DataFrame:
    stored = t.orders.select(F.col("o_orderkey").alias("referral_id"), F.lit(0).cast("long").alias("contact_order"))
    batch = materialise(linked(t).select("referral_id", "contact_order"), "batch")
    return replace_by_key(stored, batch, ["referral_id"])


def feed(t: Tables, flag: str) -> DataFrame:
    lines = t.lineitem.filter(F.col("l_returnflag") == flag)
    return lines.select(
        F.col("l_orderkey").alias("referral_id"),
        F.concat(F.lit("D"), F.col("l_partkey") % 50).alias("code"),
        (F.lit(1400) + F.col("l_suppkey") % 24).alias("month_id"),
        F.col("l_suppkey").alias("submission_id"),
    )


def stored_diagnoses(t: Tables) -> DataFrame:
    return t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("referral_id"), F.lit("Primary").alias("level"), F.lit("D0").alias("code"), F.lit(1412).cast("long").alias("month_id")
    )


def loaded_diagnoses(t: Tables) -> DataFrame:
    return care.diagnoses({"Provisional": feed(t, "A"), "Primary": feed(t, "N"), "Secondary": feed(t, "R")}, stored_diagnoses(t))


DIAGNOSES = """SELECT coalesce(s.referral_id, b.referral_id) AS referral_id, coalesce(s.level, b.level) AS level, CASE WHEN s.code IS NULL OR b.month_id > s.month_id THEN b.code ELSE s.code END AS code,
    CASE WHEN s.code IS NULL OR b.month_id > s.month_id THEN b.month_id ELSE s.month_id END AS month_id
    FROM (SELECT o_orderkey AS referral_id, 'Primary' AS level, 'D0' AS code, 1412 AS month_id FROM orders WHERE o_orderstatus = 'F') s FULL JOIN (
    SELECT l_orderkey AS referral_id, CASE l_returnflag WHEN 'A' THEN 'Provisional' WHEN 'N' THEN 'Primary' ELSE 'Secondary' END AS level, 'D' || (l_partkey % 50) AS code,
    1400 + l_suppkey % 24 AS month_id FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_returnflag ORDER BY 1400 + l_suppkey % 24 DESC, l_suppkey DESC, 'D' || (l_partkey % 50)) = 1) b
    ON b.referral_id = s.referral_id AND b.level = s.level"""


@query("k02_diagnoses", DIAGNOSES)
def _(t: Tables) -> DataFrame:
    return loaded_diagnoses(t)


def spells(t: Tables) -> DataFrame:
    key = F.col("o_orderkey")
    versions = t.orders.withColumn("v", F.explode(F.when(key % 3 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    left = F.when((F.col("o_orderstatus") != "P") & (F.col("v") == 1), days_after(received(), key % 400)).when(
        F.col("o_orderstatus") == "F", days_after(received(), key % 150)
    )
    return versions.select(
        key.alias("spell_id"),
        F.col("o_custkey").alias("person_id"),
        key.alias("referral_id"),
        (F.year("o_orderdate") + F.col("v")).alias("month_id"),
        (key * 10 + F.col("v")).alias("submission_id"),
        received().alias("start"),
        left.alias("discharge"),
        (F.col("o_custkey") % 90).cast("int").alias("age"),
        F.when(F.col("o_custkey") % 2 == 0, "Male").otherwise("Female").alias("gender"),
    )


SPELLS = """SELECT o_orderkey AS spell_id, o_custkey AS person_id, year(o_orderdate) + v AS month_id, o_orderkey * 10 + v AS submission_id, o_orderdate::DATE AS start,
    CASE WHEN o_orderstatus <> 'P' AND v = 1 THEN o_orderdate::DATE + (o_orderkey % 400)::INT WHEN o_orderstatus = 'F' THEN o_orderdate::DATE + (o_orderkey % 150)::INT END AS discharge,
    o_custkey % 90 AS age, CASE WHEN o_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender FROM orders, (VALUES (0), (1)) x(v) WHERE v = 0 OR o_orderkey % 3 = 0"""


REFERRALS = """SELECT o_custkey AS person, o_orderdate::DATE AS d, least(CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE + (o_orderkey % 900)::INT ELSE DATE '9999-12-31' END,
    CASE WHEN o_orderkey % 13 = 0 THEN o_orderdate::DATE + 5 ELSE DATE '9999-12-31' END) AS ended, o_orderpriority = '1-URGENT' AS own FROM orders"""

KNOWN_FLAGS = """CASE WHEN bool_or(own AND d < arr AND md <= 6) THEN 1 WHEN bool_or(own AND d = arr) THEN NULL WHEN bool_or(md <= 6 OR ended > arr) THEN 1 END AS known_6_months,
    CASE WHEN bool_or(own AND d < arr AND md <= 24) THEN 1 WHEN bool_or(own AND d = arr) THEN NULL WHEN bool_or(md <= 24 OR ended > arr) THEN 1 END AS known_24_months,
    CASE WHEN bool_or(own AND d < arr AND md > 24) THEN 1 WHEN bool_or(own AND d = arr) THEN NULL WHEN bool_or(md > 24) THEN 1 END AS previously_known"""

KNOWN = f"""WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, (l_orderkey * 7 + l_partkey) % 1500 AS person, l_shipdate::DATE AS arr FROM lineitem), r AS ({REFERRALS}),
    j AS (SELECT v.*, d, ended, own, date_diff('month', d, arr) AS md FROM (SELECT *, row_number() OVER () AS rid FROM v) v LEFT JOIN r ON r.person = v.person AND d <= arr)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {KNOWN_FLAGS} FROM j GROUP BY rid, l_orderkey, l_linenumber, l_partkey, l_suppkey"""


@query(
    "k03_inpatient_spells",
    f"""WITH dx AS ({DIAGNOSES}), d AS (SELECT referral_id, string_agg(CASE (substring(code, 2)::INT) % 5 WHEN 0 THEN 'Acute Psychosis' WHEN 1 THEN 'Personality disorder' WHEN 2 THEN 'BIPOLAR' ELSE 'Other' END, '|') AS txt
    FROM dx GROUP BY 1), s AS (SELECT * FROM ({SPELLS}) QUALIFY row_number() OVER (PARTITION BY spell_id ORDER BY month_id DESC, submission_id DESC) = 1),
    m AS (SELECT max(start) AS last_start, max(month_id) AS last_month FROM ({SPELLS})), r AS ({REFERRALS}),
    kn AS (SELECT spell_id, {KNOWN_FLAGS} FROM (SELECT spell_id, start AS arr, d, ended, own, date_diff('month', d, start) AS md FROM s LEFT JOIN r ON r.person = person_id AND d <= start) GROUP BY spell_id),
    ab AS (SELECT l_orderkey AS spell_id, 1 AS absence_flag, first(l_linenumber ORDER BY l_shipdate, l_linenumber) AS absence_stay_id FROM lineitem WHERE l_returnflag = 'R' GROUP BY l_orderkey),
    x AS (SELECT spell_id, start, CASE WHEN discharge IS NOT NULL THEN 'Closed' WHEN month_id >= last_month THEN 'Open' ELSE 'Inactive' END AS status,
    date_diff('day', start, discharge) + 1 AS stay_days, CASE WHEN discharge IS NULL THEN date_diff('day', start, last_day(last_start)) + 1 END AS stay_to_date,
    CASE WHEN lower(txt) LIKE '%psychosis%' AND age BETWEEN 18 AND 44 AND gender = 'Male' THEN 1 END AS psychosis_flag,
    CASE WHEN lower(txt) LIKE '%personality%' AND age BETWEEN 18 AND 44 AND gender = 'Male' THEN 1 END AS personality_flag,
    CASE WHEN lower(txt) LIKE '%bipolar%' THEN 1 END AS bipolar_flag FROM s LEFT JOIN d ON d.referral_id = s.spell_id, m)
    SELECT spell_id, status, stay_days, stay_to_date, stay_days - 1 AS nights, psychosis_flag, personality_flag, bipolar_flag, date_trunc('month', start)::DATE::VARCHAR AS admitted_month,
    CASE WHEN stay_days BETWEEN 1 AND 7 THEN 'Up to 1 week' WHEN stay_days < 15 THEN '1 to 2 weeks' WHEN stay_days < 31 THEN '2 weeks to 1 month' WHEN stay_days < 91 THEN '1 to 3 months'
    WHEN stay_days < 181 THEN '3 to 6 months' WHEN stay_days < 366 THEN '6 months to 1 year' WHEN stay_days >= 366 THEN '1 year and above' END AS stay_band,
    CASE WHEN stay_days >= 90 THEN 'Super Stranded' WHEN stay_days >= 60 THEN 'Stranded' END AS stranded,
    known_6_months, known_24_months, previously_known, absence_flag, absence_stay_id FROM x LEFT JOIN kn USING (spell_id) LEFT JOIN ab USING (spell_id)""",
)
def _(t: Tables) -> DataFrame:
    names = {str(i): n for i, n in enumerate(("Acute Psychosis", "Personality disorder", "BIPOLAR"))}
    kind = (F.substring("code", 2, 9).cast("int") % 5).cast("string")
    dx = loaded_diagnoses(t).select("referral_id", "level", map_codes(kind, names, "Other").alias("description"))
    refs = visits_and_referrals(t)[1].withColumnRenamed("person", "person_id")
    absent_from = F.when(F.col("l_returnflag") == "R", F.col("l_shipdate")).alias("absent_from")
    stays = t.lineitem.select(F.col("l_orderkey").alias("spell_id"), F.col("l_linenumber").alias("stay_id"), absent_from)
    out = care.inpatient_spells(spells(t), dx, refs, "1-URGENT", stays)
    return out.select(
        "spell_id", "status", "stay_days", "stay_to_date", "nights", "psychosis_flag", "personality_flag", "bipolar_flag", "admitted_month", "stay_band", "stranded",
        "known_6_months", "known_24_months", "previously_known", "absence_flag", "absence_stay_id",
    )


@query(
    "k04_ward_stays",
    """WITH s AS (SELECT l_orderkey AS spell_id, l_linenumber AS stay_id, 1400 + l_suppkey % 24 AS month_id, l_partkey AS submission_id, l_shipdate::DATE AS start FROM lineitem
    QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY 1400 + l_suppkey % 24 DESC, l_partkey DESC) = 1),
    n AS (SELECT *, row_number() OVER (PARTITION BY spell_id ORDER BY start, stay_id) AS stay_order, count(*) OVER (PARTITION BY spell_id) AS stays FROM s)
    SELECT spell_id, stay_id, start::VARCHAR AS start, stay_order, CASE WHEN stay_order = stays THEN 1 ELSE 0 END::INT AS last_stay, CASE WHEN stay_order = 1 THEN 1 ELSE 0 END::INT AS admission_stay FROM n""",
)
def _(t: Tables) -> DataFrame:
    stays = t.lineitem.select(
        F.col("l_orderkey").alias("spell_id"),
        F.col("l_linenumber").alias("stay_id"),
        (F.lit(1400) + F.col("l_suppkey") % 24).alias("month_id"),
        F.col("l_partkey").alias("submission_id"),
        F.col("l_shipdate").cast("date").alias("start"),
    )
    return care.ward_stays(stays).select("spell_id", "stay_id", "start", "stay_order", "last_stay", "admission_stay")


def visits_and_referrals(t: Tables) -> tuple[DataFrame, DataFrame]:
    people = (F.col("l_orderkey") * 7 + F.col("l_partkey")) % 1500
    visits = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", people.alias("person"), F.col("l_shipdate").cast("date").alias("arrival"))
    key = F.col("o_orderkey")
    refs = t.orders.select(
        F.col("o_custkey").alias("person"),
        received().alias("received"),
        F.when(F.col("o_orderstatus") == "F", days_after(received(), key % 900)).alias("discharged"),
        F.when(key % 13 == 0, F.date_add(received(), 5)).alias("rejected"),
        F.col("o_orderpriority").alias("source"),
    )
    return visits, refs


@query("k07_known_to_service", KNOWN)
def _(t: Tables) -> DataFrame:
    return care.known_to_service(*visits_and_referrals(t), "person", "arrival", "1-URGENT").drop("person", "arrival")


@query("k07_known_by_days", KNOWN.replace("date_diff('month', d, arr) AS md", "date_diff('day', d, arr) / 30.0 AS md"))
def _(t: Tables) -> DataFrame:
    out = care.known_to_service(*visits_and_referrals(t), "person", "arrival", "1-URGENT", days_per_month=30)
    return out.drop("person", "arrival")


def periods(t: Tables) -> DataFrame:
    """Line items as legal-status periods: the order and line are the episode."""
    lines = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("episode_id"),
        F.month("l_shipdate").alias("month_id"),
        (F.col("l_suppkey") % 20).alias("record_no"),
        F.col("o_custkey").alias("person_id"),
        F.when(F.col("o_custkey") % 5 == 0, F.col("o_custkey") - 1).alias("derived_person_id"),
        (F.col("l_partkey") % 4).alias("provider"),
        F.when(F.col("l_partkey") % 3 != 0, F.col("l_orderkey")).alias("referral_id"),
        hours_after(F.col("l_shipdate"), F.col("l_suppkey") % 24).alias("start"),
        (F.col("l_partkey") * 1000 + F.col("l_suppkey")).alias("uniq_id"),
        F.concat(F.lit("Section "), F.element_at(F.array(F.lit(2), F.lit(3), F.lit(136), F.lit(5)), (F.col("l_partkey") % 4 + 1).cast("int"))).alias("section"),
    )


def act_spells(t: Tables) -> DataFrame:
    key, person = F.col("o_orderkey"), F.col("o_custkey")
    stop = hours_after(days_after(received(), key % 60).cast("timestamp_ntz"), F.lit(24) + person % 24)
    return t.orders.select(
        key.alias("spell_id"),
        (key % 20).alias("record_no"),
        person.alias("person_id"),
        F.when(person % 5 == 0, person - 1).alias("derived_person_id"),
        (key % 4).alias("provider"),
        key.alias("referral_id"),
        hours_after(F.col("o_orderdate"), key % 24).alias("start"),
        F.when(F.col("o_orderstatus") != "P", stop).alias("discharge"),
    )


def linked_episodes(t: Tables) -> DataFrame:
    written = materialise(periods(t), "periods")
    feeds = [written.filter(F.col("uniq_id") % n == 0).select("episode_id", "month_id") for n in (7, 11, 13)]
    return care.legal_episodes(written, feeds, act_spells(t), dates.at(2001, 12, 31))


BEST = "QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY abs(date_diff('day', e.start, s.start)), s.stop - s.start DESC, s.spell_id) = 1"
HELD = "e.start BETWEEN s.start - INTERVAL 24 HOUR AND s.stop"
EPISODES = f"""WITH p AS (SELECT l_orderkey * 10 + l_linenumber AS episode_id, month(l_shipdate) AS month_id, l_suppkey % 20 AS record_no, CASE WHEN o_custkey % 5 = 0 THEN o_custkey - 1 ELSE o_custkey END AS pk,
    l_partkey % 4 AS provider, CASE WHEN l_partkey % 3 <> 0 THEN l_orderkey END AS referral_id, l_shipdate + to_hours((l_suppkey % 24)::INT) AS start, l_partkey * 1000 + l_suppkey AS u, 'Section ' || [2, 3, 136, 5][l_partkey % 4 + 1] AS section
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey), gone AS (SELECT DISTINCT episode_id, month_id FROM p WHERE u % 7 = 0 OR u % 11 = 0 OR u % 13 = 0),
    e AS (SELECT * FROM p WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.episode_id = p.episode_id AND g.month_id = p.month_id)
    QUALIFY row_number() OVER (PARTITION BY episode_id ORDER BY month_id DESC, record_no DESC, u DESC) = 1),
    s AS (SELECT o_orderkey AS spell_id, o_orderkey % 20 AS record_no, CASE WHEN o_custkey % 5 = 0 THEN o_custkey - 1 ELSE o_custkey END AS pk, o_orderkey % 4 AS provider, o_orderdate + to_hours((o_orderkey % 24)::INT) AS start,
    CASE WHEN o_orderstatus <> 'P' THEN o_orderdate + to_days((o_orderkey % 60)::INT) + to_hours((24 + o_custkey % 24)::INT) ELSE TIMESTAMP '2001-12-31' END AS stop FROM orders),
    a AS (SELECT episode_id, spell_id, 1 AS pass_no FROM e JOIN s ON s.pk = e.pk AND s.record_no = e.record_no AND {HELD} {BEST}),
    b AS (SELECT episode_id, spell_id, 2 AS pass_no FROM e JOIN s ON s.pk = e.pk AND s.provider = e.provider AND {HELD} WHERE episode_id NOT IN (SELECT episode_id FROM a) {BEST}),
    c AS (SELECT episode_id, spell_id, 3 AS pass_no FROM e JOIN s ON s.spell_id = e.referral_id AND {HELD} WHERE episode_id NOT IN (SELECT episode_id FROM a) AND episode_id NOT IN (SELECT episode_id FROM b)),
    f AS (SELECT * FROM a UNION ALL SELECT * FROM b UNION ALL SELECT * FROM c)"""


@query(
    "k08_legal_episodes",
    EPISODES + " SELECT e.episode_id, e.month_id::INT AS month_id, f.spell_id, f.pass_no::INT AS pass_no, coalesce(f.spell_id, e.referral_id) AS referral_id FROM e LEFT JOIN f USING (episode_id)",
)
def _(t: Tables) -> DataFrame:
    return linked_episodes(t).select("episode_id", "month_id", "spell_id", "pass_no", "referral_id")


@query(
    "k09_spell_legal_status",
    EPISODES
    + """, l AS (SELECT f.spell_id, e.episode_id, e.section, e.start FROM e JOIN f USING (episode_id)),
    best AS (SELECT * FROM l QUALIFY row_number() OVER (PARTITION BY spell_id ORDER BY CASE WHEN section IN ('Section 2', 'Section 3') THEN 0 ELSE 1 END, start, episode_id) = 1),
    hold AS (SELECT DISTINCT l.spell_id FROM l JOIN s ON s.spell_id = l.spell_id WHERE section = 'Section 136' AND date_diff('day', l.start, s.start) BETWEEN 0 AND 2)
    SELECT s.spell_id, best.episode_id, best.section, CASE WHEN hold.spell_id IS NOT NULL THEN 1 END AS prior_hold,
    CASE WHEN best.section IN ('Section 2', 'Section 3') THEN 'Formal' WHEN best.section IS NULL THEN 'No Link' ELSE 'Informal' END AS admission_type
    FROM s LEFT JOIN best ON best.spell_id = s.spell_id LEFT JOIN hold ON hold.spell_id = s.spell_id""",
)
def _(t: Tables) -> DataFrame:
    linked = materialise(linked_episodes(t).select("spell_id", "episode_id", "section", "start"), "linked")
    out = care.spell_legal_status(act_spells(t), linked, ["Section 2", "Section 3"], "Section 136")
    return out.select("spell_id", "episode_id", "section", "prior_hold", "admission_type")


@query(
    "k15_period_calendar",
    """SELECT (1198 + date_diff('month', DATE '2000-01-01', m))::INT AS period_id, CASE WHEN month(m) < 4 THEN (year(m) - 1) || '/' || right(year(m)::VARCHAR, 2) ELSE year(m) || '/' || right((year(m) + 1)::VARCHAR, 2) END AS fiscal_year,
    m::DATE::VARCHAR AS month_start, last_day(m)::VARCHAR AS month_end, (SELECT count(*) FROM orders WHERE date_trunc('month', o_orderdate) = m) AS orders
    FROM (SELECT unnest(generate_series(TIMESTAMP '2000-01-01', TIMESTAMP '2001-07-01', INTERVAL 1 MONTH)) AS m)""",
)
def _(t: Tables) -> DataFrame:
    calendar = dates.period_calendar(t.spark, dt.date(2001, 8, 15))
    counts = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month_start")).agg(F.count(F.lit(1)).alias("orders"))
    out = calendar.join(counts, "month_start", "left").withColumn("orders", F.coalesce("orders", F.lit(0)))
    return out.select("period_id", "fiscal_year", "month_start", "month_end", "orders")


@query(
    "k16_report_feed",
    """SELECT o_orderstatus, o_orderpriority, c_mktsegment, n_name, r_name, y, CASE WHEN gap IS NULL THEN 'No gap' WHEN gap < 8 THEN '0-7' WHEN gap < 29 THEN '8-28' WHEN gap < 91 THEN '29-90' ELSE '91+' END AS gap_band, count(*) AS n
    FROM (SELECT *, year(o_orderdate)::INT AS y, date_diff('day', lag(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate) AS gap FROM orders) JOIN customer ON c_custkey = o_custkey
    JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    o = gap_since_previous(t.orders, ["o_custkey"], ["o_orderdate", "o_orderkey"], "o_orderdate", "gap")
    joined = o.withColumn("y", F.year("o_orderdate")).join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    joined = joined.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    return care.report_feed(joined, ["o_orderstatus", "o_orderpriority", "c_mktsegment", "n_name", "r_name", "y"], "gap")
