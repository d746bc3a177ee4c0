"""Attendance jobs on the given tables: events play emergency attendances."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.aggs import IN_OUT, PERIODS, STAYS, stays
from fathomline.catalog.registry import Tables, query
from fathomline.operators.aggs import period_table
from fathomline.plans import attendance
from fathomline.session import materialise
from fathomline.sources.loads import plan_dates, replace_by_key

def k_value() -> Column:
    return F.get_json_object("props", "$.k").cast("int")

K_SQL = "json_extract(props, '$.k')::INT"


def feed(t: Tables) -> DataFrame:
    """Events as attendance records; one in eight is sent twice."""
    e = t.events.withColumn("k", k_value()).withColumn("copy", F.explode(F.when(F.col("event_id") % 8 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    k = F.col("k")
    return e.select(
        F.col("event_id").alias("ident"),
        (F.col("event_id") * 10 + F.col("copy")).alias("record_id"),
        F.col("user_id").alias("person_id"),
        F.col("event_id").alias("attendance_id"),
        F.col("ts").cast("date").alias("arrival_date"),
        F.when(k % 9 != 0, F.date_format("ts", "HH:mm:ss")).alias("arrival_time"),
        F.when(k % 10 != 0, (F.col("value") * 40).cast("int")).alias("wait_minutes"),
        F.when(F.col("event_type") != "signup", "01").otherwise("02").alias("department"),
        F.when(k % 4 == 0, F.concat(F.lit("S"), k % 7)).alias("discharge_status"),
        F.concat(F.lit("C"), k % 13).alias("complaint"),
        F.concat(F.lit("I"), k % 11).alias("intent"),
        F.concat(F.lit(" C"), (k + 1) % 15, F.lit(" ")).alias("arrival_mode"),
        F.concat(F.lit("D"), (k + 2) % 13).alias("attendance_source"),
        F.when(k % 5 != 0, F.concat(F.lit("C"), (k * 3) % 13)).alias("destination"),
        F.concat(F.lit("D"), (k * 5) % 14).alias("follow_up"),
        F.when(k % 7 != 0, F.concat(F.lit("C"), (k * 7) % 13)).alias("accommodation"),
        F.when(k % 6 != 0, F.array_join(F.transform(F.sequence(F.lit(1), k % 5 + 1), lambda i: F.concat(F.lit("D"), (k * i) % 17)), ",")).alias("diagnoses"),
    )


FEED = f"""SELECT event_id AS ident, event_id * 10 + copy AS record_id, user_id AS person_id, ts::DATE AS arrival_date, CASE WHEN k % 9 <> 0 THEN date_trunc('second', ts)::TIMESTAMP ELSE date_trunc('day', ts)::TIMESTAMP END AS arrival,
    CASE WHEN k % 10 <> 0 THEN trunc(value * 40)::INT END AS w, CASE WHEN event_type <> 'signup' THEN '01' ELSE '02' END AS department, CASE WHEN k % 4 = 0 THEN 'S' || (k % 7) END AS discharge_status,
    'C' || (k % 13) AS complaint, 'I' || (k % 11) AS intent, CASE WHEN k % 6 <> 0 THEN list_transform(generate_series(1, k % 5 + 1), lambda i: 'D' || ((k * i) % 17)) END AS dx, k, ts
    FROM (SELECT *, {K_SQL} AS k FROM events), (VALUES (0), (1)) x(copy) WHERE copy = 0 OR event_id % 8 = 0"""


def comorbidities(t: Tables) -> DataFrame:
    return t.events.withColumn("k", k_value()).select(
        F.col("event_id").alias("ident"), *[F.when(F.col("k") % (i + 1) != 0, F.concat(F.lit("M"), F.col("k") % 10, F.lit("_"), F.lit(i))).alias(f"s{i}") for i in range(1, 7)]
    )


def referrals(t: Tables) -> DataFrame:
    """Four slots of services per event; some have none, some a blank."""
    k, day, time = F.col("k"), F.col("ts").cast("date"), F.date_format("ts", "HH:mm:ss")
    columns = {}
    for i in range(1, 5):
        columns[f"service_{i}"] = F.when(k % (i + 3) == 0, None).when(k % (i + 2) == 0, " ").otherwise(F.concat(F.lit("D"), (k * i) % 17))
        columns[f"request_date_{i}"], columns[f"request_time_{i}"] = F.date_add(day, i), F.when(k % 3 != 0, time)
        columns[f"assessment_date_{i}"], columns[f"assessment_time_{i}"] = F.when(k % 4 != 0, F.date_add(day, i + 1)), time
    return t.events.withColumn("k", k_value()).select(F.col("event_id").alias("ident"), *[c.alias(n) for n, c in columns.items()])


def dictionary(t: Tables) -> DataFrame:
    """Parts as a code dictionary with several dated versions of a code."""
    code = F.concat(F.when(F.col("p_partkey") % 2 == 0, "C").otherwise("D"), F.col("p_partkey") % 13)
    return t.part.select(code.alias("code"), F.col("p_name").alias("description"), F.col("p_size").alias("created"))


WAIT = "CASE WHEN w IS NULL OR w <= 240 THEN '0-4' WHEN w <= 720 THEN '5-12' WHEN w <= 1440 THEN '12-24' WHEN w <= 2880 THEN '24-48' WHEN w <= 4320 THEN '48-72' ELSE '>72' END"


def built(t: Tables) -> DataFrame:
    return attendance.attendances(
        feed(t), dictionary(t), comorbidities(t), ["01"], ["S0", "S4"], ["C3", "C5"], ["D2", "D7", "D9"], "I4", [f"s{i}" for i in range(1, 7)],
        referrals=referrals(t),
    )


# the code of each decoded column, and of each slot
CODES = {
    "arrival_mode": "'C' || ((k + 1) % 15)", "attendance_source": "'D' || ((k + 2) % 13)", "intent": "intent", "complaint": "complaint",
    "destination": "CASE WHEN k % 5 <> 0 THEN 'C' || ((k * 3) % 13) END", "follow_up": "'D' || ((k * 5) % 14)",
    "accommodation": "CASE WHEN k % 7 <> 0 THEN 'C' || ((k * 7) % 13) END", **{f"diagnosis_{i}": f"dx[{i}]" for i in range(1, 5)},
}
SERVICES = {f"service_{i}": f"CASE WHEN k % {i + 3} <> 0 AND k % {i + 2} <> 0 THEN 'D' || ((k * {i}) % 17) END" for i in range(1, 5)}
TEXTS = ", ".join(f"(SELECT description FROM dict WHERE code = {c}) AS {n}_text" for n, c in (CODES | SERVICES).items())
SLOTS = ", ".join(
    f"{c} AS {n}, CASE WHEN {c} IS NOT NULL THEN CASE WHEN k % 3 <> 0 THEN date_trunc('second', ts)::TIMESTAMP ELSE date_trunc('day', ts)::TIMESTAMP END + INTERVAL {n[-1]} DAY END AS requested_{n[-1]}, "
    f"CASE WHEN {c} IS NOT NULL AND k % 4 <> 0 THEN date_trunc('second', ts)::TIMESTAMP + INTERVAL {int(n[-1]) + 1} DAY END AS assessed_{n[-1]}"
    for n, c in SERVICES.items()
)


@query(
    "k05_attendances",
    f"""WITH f AS (SELECT * FROM ({FEED}) WHERE department = '01' AND (discharge_status IS NULL OR discharge_status NOT IN ('S0', 'S4')) QUALIFY row_number() OVER (PARTITION BY ident ORDER BY record_id) = 1),
    dict AS (SELECT code, p_name AS description FROM (SELECT CASE WHEN p_partkey % 2 = 0 THEN 'C' ELSE 'D' END || (p_partkey % 13) AS code, p_name, p_size FROM part)
    QUALIFY row_number() OVER (PARTITION BY code ORDER BY p_size DESC, p_name) = 1),
    x AS (SELECT *, dx[1] AS d1, dx[2] AS d2, dx[4] AS d4, list_filter([CASE WHEN k % 2 <> 0 THEN 'M' || (k % 10) || '_1' END, CASE WHEN k % 3 <> 0 THEN 'M' || (k % 10) || '_2' END, CASE WHEN k % 4 <> 0 THEN 'M' || (k % 10) || '_3' END,
    CASE WHEN k % 5 <> 0 THEN 'M' || (k % 10) || '_4' END, CASE WHEN k % 6 <> 0 THEN 'M' || (k % 10) || '_5' END, CASE WHEN k % 7 <> 0 THEN 'M' || (k % 10) || '_6' END], lambda m: m IS NOT NULL) AS m FROM f)
    SELECT ident, record_id, arrival, {WAIT} AS wait_band, CASE WHEN w > 360 THEN 1 ELSE 0 END::INT AS breach_6h, greatest(coalesce(w, 0) - 360, 0)::INT AS minutes_over_6h, CASE WHEN w > 720 THEN 1 ELSE 0 END::INT AS breach_12h,
    CASE WHEN w >= 1440 THEN 1 ELSE 0 END::INT AS breach_24h, CASE WHEN complaint IN ('C3', 'C5') OR intent = 'I4' OR d1 IN ('D2', 'D7', 'D9') THEN 1 ELSE 0 END::INT AS presentation_flag,
    d1 AS diagnosis_1, d2 AS diagnosis_2, d4 AS diagnosis_4, {TEXTS}, {SLOTS}, m[1] AS comorbidity_1, m[4] AS comorbidity_4 FROM x""",
)
def _(t: Tables) -> DataFrame:
    return built(t).select(
        "ident", "record_id", "arrival", "wait_band", "breach_6h", "minutes_over_6h", "breach_12h", "breach_24h", "presentation_flag", "diagnosis_1", "diagnosis_2", "diagnosis_4",
        *[f"{c}_text" for c in CODES | SERVICES], *[f"{c}_{i}" for i in range(1, 5) for c in ("service", "requested", "assessed")], "comorbidity_1", "comorbidity_4",
    )


def past_spells(t: Tables) -> DataFrame:
    """Other events of the person as completed spells that ended that day."""
    s = t.events.filter("event_type IN ('signup', 'purchase')")
    return s.select(F.col("user_id").alias("person_id"), F.col("event_id").alias("spell_id"), F.date_sub(F.col("ts").cast("date"), 20).alias("discharge"))


RETURNS = f"""SELECT a.event_id AS ident, s.d AS discharge, s.spell_id, date_diff('day', s.d, a.ts::DATE) AS gap, {K_SQL} % 3 = 0 AS wanted FROM (SELECT * FROM events WHERE event_type IN ('click', 'view')) a
    LEFT JOIN LATERAL (SELECT event_id AS spell_id, ts::DATE - 20 AS d FROM events e WHERE e.user_id = a.user_id AND event_type IN ('signup', 'purchase') AND ts::DATE - 20 < a.ts::DATE ORDER BY d DESC, event_id DESC LIMIT 1) s ON true"""


def returns(t: Tables) -> DataFrame:
    a = t.events.filter("event_type IN ('click', 'view')").select(
        F.col("event_id").alias("ident"), F.col("user_id").alias("person_id"), F.col("ts").cast("date").alias("arrival"), (k_value() % 3 == 0).cast("int").alias("presentation_flag")
    )
    return attendance.returns_after_spell(a, past_spells(t), "person_id", "arrival", days=5)


@query("k06_return_after_spell", f"SELECT ident, discharge::VARCHAR AS discharge, spell_id, gap AS days_since_spell, CASE WHEN gap <= 5 THEN 1 END AS return_flag FROM ({RETURNS})")
def _(t: Tables) -> DataFrame:
    return returns(t).select("ident", "discharge", "spell_id", "days_since_spell", "return_flag")


@query("k17_return_list", f"SELECT ident, spell_id FROM ({RETURNS}) WHERE gap <= 5 AND wanted")
def _(t: Tables) -> DataFrame:
    return attendance.return_list(returns(t)).select("ident", "spell_id")


@query(
    "k10_daily_snapshot",
    f"""SELECT d::DATE::VARCHAR AS snapshot_day, event_id, minutes FROM (SELECT unnest(generate_series(DATE '2024-01-10', DATE '2024-01-20', INTERVAL 1 DAY))::DATE AS d) JOIN ({STAYS})
    ON arrival::DATE = d OR (arrival::DATE < d AND departure::DATE = d AND minutes >= 0)""",
)
def _(t: Tables) -> DataFrame:
    days = t.spark.range(1).select(F.explode(F.sequence(F.lit(dt.date(2024, 1, 10)), F.lit(dt.date(2024, 1, 20)))).alias("snapshot_day"))
    return attendance.daily_snapshot(stays(t), "arrival", "departure", "minutes", days).select("snapshot_day", "event_id", "minutes")


BAND = WAIT.replace("w ", "minutes ").replace("CASE WHEN minutes IS NULL OR minutes", "CASE WHEN minutes BETWEEN 0 AND 240 THEN '0-4' WHEN minutes < 0 THEN 'Not recorded' WHEN minutes")


@query(
    "k11_breach_summary",
    f"""WITH run AS (SELECT unnest(generate_series(DATE '2024-01-03', DATE '2024-02-12', INTERVAL 1 DAY))::DATE AS d), p AS ({PERIODS})
    SELECT period, b::VARCHAR AS stamp, event_type, {BAND} AS wait_band, count(*) AS n FROM p JOIN ({STAYS}) ON {IN_OUT.format(a="a", b="b")} GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    periods = period_table(t.spark, *(F.lit(d).cast("date") for d in ("2024-01-03", "2024-02-12")))
    return attendance.breach_summary(stays(t), "arrival", "departure", "minutes", ["event_type"], periods)


@query(
    "k11_breach_refresh",
    """WITH run AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-28', INTERVAL 1 DAY))::DATE AS d),
    per AS (SELECT ts::DATE AS day, event_type, count(*) AS n FROM events GROUP BY ALL), stored AS (SELECT * FROM per WHERE day(day) % 6 <> 0 AND day < DATE '2024-01-26'),
    plan AS (SELECT d FROM run WHERE d BETWEEN (SELECT max(day) FROM stored) - 7 AND (SELECT max(day) FROM stored) OR d NOT IN (SELECT day FROM stored))
    SELECT day::VARCHAR AS day, event_type, n FROM per WHERE day IN (SELECT d FROM plan) UNION ALL SELECT day::VARCHAR, event_type, -n FROM stored WHERE day NOT IN (SELECT d FROM plan)""",
)
def _(t: Tables) -> DataFrame:
    """Stored counts (negative here, to tell them apart) are kept except for the planned days, which are rebuilt."""
    per = materialise(t.events.groupBy(F.col("ts").cast("date").alias("day"), "event_type").agg(F.count(F.lit(1)).alias("n")), "counts")
    stored = per.filter((F.dayofmonth("day") % 6 != 0) & (F.col("day") < F.lit(dt.date(2024, 1, 26)))).withColumn("n", -F.col("n"))
    plan = plan_dates(t.spark, stored, "day", dt.date(2024, 1, 1), dt.date(2024, 1, 30))
    return replace_by_key(stored, per.join(plan.select("day"), "day", "left_semi"), ["day"])


@query(
    "k12_breach_list",
    f"""SELECT event_id, coalesce(c_name, 'Unknown person') AS person, minutes - 720 AS minutes_over_12h, {BAND} AS wait_band FROM (SELECT s.*, user_id FROM ({STAYS}) s JOIN events USING (event_id))
    LEFT JOIN customer ON c_custkey = user_id AND c_acctbal > 0 WHERE minutes > 720""",
)
def _(t: Tables) -> DataFrame:
    people = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("person"))
    rows = stays(t).join(t.events.select("event_id", "user_id"), "event_id").join(people, "user_id", "left")
    return attendance.breach_list(rows, "minutes", {"person": "Unknown person"}).select("event_id", "person", "minutes_over_12h", "wait_band")


@query(
    "k12_breach_totals",
    f"""SELECT event_type, count(*) AS n, count(*) FILTER (minutes > 720) AS over_12h, count(*) FILTER (minutes >= 1440) AS over_24h FROM ({STAYS}) GROUP BY 1
    UNION ALL SELECT 'All', count(*), count(*) FILTER (minutes > 720), count(*) FILTER (minutes >= 1440) FROM ({STAYS})""",
)
def _(t: Tables) -> DataFrame:
    return attendance.breach_totals(stays(t), "minutes", ["event_type"])
