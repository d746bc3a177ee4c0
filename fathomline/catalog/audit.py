"""Audit, login and adoption jobs on the given tables: events play the logs, customers the staff, nations the teams."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.aggs import LOGINS, logins
from fathomline.catalog.registry import Tables, query
from fathomline.functions.dates import at
from fathomline.operators import sessions
from fathomline.plans import audit
from fathomline.session import materialise

ACTIONS = {"signup": "create", "purchase": "publish", "click": "view", "view": "revise", "error": "Login"}
ACTION_SQL = "CASE event_type WHEN 'signup' THEN 'create' WHEN 'purchase' THEN 'publish' WHEN 'click' THEN 'view' WHEN 'view' THEN 'revise' ELSE 'Login' END"


def raw_audit(t: Tables) -> DataFrame:
    e = F.col("event_id")
    return t.events.select(
        F.lpad(e.cast("string"), 12, "0").alias("item_id"),
        F.concat(F.lit("Record||"), (e * 7) % 900).alias("genus"),
        F.when(e % 50 == 0, "System").otherwise(F.concat_ws("|", "user_id", F.col("user_id") % 25, F.concat(F.lit("role"), e % 3))).alias("actor"),
        audit.map_codes("event_type", ACTIONS).alias("action"),
        "ts",
        F.when(e % 9 != 0, "Record").otherwise("Plan").alias("record_name"),
    )


LOG = f"""SELECT lpad(event_id::VARCHAR, 12, '0') AS item_id, ((event_id * 7) % 900)::VARCHAR AS record_id, user_id::VARCHAR AS staff_id, (user_id % 25)::VARCHAR AS team_id,
    'role' || (event_id % 3) AS role, {ACTION_SQL} AS action, ts FROM events WHERE event_id % 50 <> 0 AND event_id % 9 <> 0 AND event_type <> 'error'"""


def log(t: Tables) -> DataFrame:
    return audit.parse_audit(raw_audit(t), "Record", ["Login", "Logout"])


def staff(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").cast("string").alias("staff_id"), F.col("c_name").alias("staff_name"))


def teams(t: Tables) -> DataFrame:
    return t.nation.select(F.col("n_nationkey").cast("string").alias("team_id"), F.col("n_name").alias("team_name"))


@query(
    "k21_version_chain",
    """SELECT event_id, lag(event_id) OVER w AS previous_version, lead(event_id) OVER w AS next_version, CASE WHEN lag(event_id) OVER w IS NULL THEN 1 ELSE 0 END::INT AS first_version,
    CASE WHEN lead(event_id) OVER w IS NULL THEN 1 ELSE 0 END::INT AS last_version FROM events WINDOW w AS (PARTITION BY (event_id * 7) % 900 ORDER BY event_id)""",
)
def _(t: Tables) -> DataFrame:
    v = t.events.select("event_id", ((F.col("event_id") * 7) % 900).alias("record_id"))
    return audit.version_chain(v, "record_id", "event_id").drop("record_id")


NUMBERED = f"""SELECT item_id, record_id, staff_id, team_id, role, action, row_number() OVER (PARTITION BY record_id ORDER BY ts, item_id) AS overall_order,
    row_number() OVER (PARTITION BY record_id, action ORDER BY ts, item_id) AS type_order FROM ({LOG})"""


@query("k22_audit_log", NUMBERED)
def _(t: Tables) -> DataFrame:
    early = log(t).filter(F.col("ts") < at(2024, 1, 12))
    loaded = materialise(audit.load_audit(early, raw_audit(t), "Record", ["Login", "Logout"]), "audit")
    return audit.order_actions(loaded).drop("ts")


@query("k22_audit_log_extended", NUMBERED)
def _(t: Tables) -> DataFrame:
    """The stored log lacks a stretch in the middle for some records and everything of others."""
    missing = (F.col("record_id").cast("int") % 3 == 0) & F.col("ts").between(at(2024, 1, 10), at(2024, 1, 14)) | (F.col("record_id").cast("int") % 11 == 0)
    stored = materialise(audit.order_actions(log(t).filter(~missing)), "audit")
    stay, write = audit.extend_log(stored, raw_audit(t), "Record", ["Login", "Logout"])
    return stay.unionByName(write).drop("ts")


@query(
    "k23_team_audit",
    f"""WITH l AS ({LOG}), f AS (SELECT record_id, staff_id AS first_staff, ts::DATE AS first_day FROM l QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY ts, item_id) = 1)
    SELECT item_id, record_id, action, c_name AS staff_name, n_name AS team_name FROM l JOIN f USING (record_id) LEFT JOIN customer ON c_custkey::VARCHAR = staff_id LEFT JOIN nation ON n_nationkey::VARCHAR = team_id
    WHERE NOT (action = 'view' AND staff_id = first_staff AND ts::DATE = first_day)""",
)
def _(t: Tables) -> DataFrame:
    return audit.team_audit(log(t), staff(t), teams(t), "view").select("item_id", "record_id", "action", "staff_name", "team_name")


AGENTS = ["Mozilla iPhone", "Linux; ANDROID; Mobile Safari", "Linux; Android", "Windows NT 10", "macintosh; Intel Mac OS X", "X11; Linux", "Bot"]


def activity(t: Tables) -> DataFrame:
    e = F.col("event_id")
    return logins(t).select(
        e.alias("item_id"),
        F.concat_ws("-", "user_id", F.to_date("ts")).alias("session_id"),
        "user_id",
        F.concat(F.lit("NATION_"), F.col("user_id") % 30).alias("org_name"),
        F.col("ts").alias("login"),
        F.col("stop").alias("logout"),
        F.element_at(F.array(*[F.lit(a) for a in AGENTS]), (e % 7 + 1).cast("int")).alias("agent"),
        (e % 7 < 3).alias("is_mobile"),
        F.when(e % 2 == 0, "card").otherwise("web").alias("domain"),
        (F.col("event_type") != "error").alias("success"),
    )


def login_details(t: Tables) -> DataFrame:
    outcomes = sessions.session_outcome(activity(t), ["session_id"], F.col("success"))
    places = t.nation.select(F.col("n_name").alias("org_name"), F.concat(F.lit("team"), F.col("n_regionkey")).alias("team"))
    return audit.login_sessions(activity(t), outcomes, places, ["card"])


MERGED = f"""SELECT event_id AS item_id, user_id, ts AS login, stop, CASE WHEN lag(stop) OVER w >= ts THEN 1 ELSE 0 END AS absorbed,
    CASE WHEN lead(ts) OVER w <= stop THEN greatest(stop, lead(stop) OVER w) ELSE coalesce(stop, lead(ts) OVER w) END AS final_end FROM ({LOGINS}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""


@query(
    "k24_login_sessions",
    f"""SELECT item_id, 'team' || n_regionkey AS team, final_end, absorbed::INT AS absorbed, CASE WHEN stop IS NOT NULL THEN date_diff('second', login, final_end) // 60 END AS minutes,
    ['iPhone', 'Android mobile', 'Android Tablet', 'PC', 'iPad', 'PC', 'Bot'][item_id % 7 + 1] AS device,
    CASE WHEN stop IS NULL THEN 'failed' WHEN item_id % 2 = 0 AND bool_and(stop IS NOT NULL) OVER (PARTITION BY user_id, login::DATE) THEN 'direct' ELSE 'login' END AS action_type
    FROM ({MERGED}) LEFT JOIN nation ON n_name = 'NATION_' || (user_id % 30)""",
)
def _(t: Tables) -> DataFrame:
    return login_details(t).select("item_id", "team", "final_end", "absorbed", "minutes", "device", "action_type")


@query(
    "k25_login_totals",
    f"""WITH m AS (SELECT *, CASE WHEN stop IS NOT NULL THEN date_diff('second', login, final_end) // 60 END AS minutes FROM ({MERGED}) WHERE absorbed = 0)
    SELECT user_id, login::DATE::VARCHAR AS day, NULL::INT AS hour, count(*) AS sessions, sum(minutes)::BIGINT AS minutes FROM m GROUP BY ALL
    UNION ALL SELECT user_id, login::DATE::VARCHAR, hour(login)::INT, count(*), sum(minutes)::BIGINT FROM m GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    merged = materialise(login_details(t).select("user_id", "login", "absorbed", "minutes"), "sessions")
    hourly = audit.login_totals(merged, ["user_id"], "hour")
    return hourly.unionByName(audit.login_totals(merged, ["user_id"], "day"), allowMissingColumns=True)


@query(
    "k26_account_register",
    """SELECT c_custkey AS account_id, max_by('L' || event_id, (ts, 'L' || event_id)) FILTER (event_type = 'click') AS click_login, max_by('L' || event_id, (ts, 'L' || event_id)) FILTER (event_type = 'view') AS view_login
    FROM customer LEFT JOIN events ON user_id = c_custkey GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    used = t.events.select(F.col("user_id").alias("account_id"), F.col("event_type").alias("kind"), F.concat(F.lit("L"), "event_id").alias("login_id"), F.col("ts").alias("last_used"))
    return audit.account_register(t.customer.select(F.col("c_custkey").alias("account_id")), used, ["click", "view"])


TEAM_LOGINS = "SELECT user_id % 12 AS team, user_id, ts FROM events WHERE event_type <> 'error'"


@query(
    "k27_monthly_logins",
    f"""SELECT team, m::DATE::VARCHAR AS month, coalesce(users, 0) AS users, coalesce(logins, 0) AS logins FROM (SELECT DISTINCT team FROM ({TEAM_LOGINS}))
    CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '2023-11-01', TIMESTAMP '2024-03-01', INTERVAL 1 MONTH)) AS m)
    LEFT JOIN (SELECT team, date_trunc('month', ts)::TIMESTAMP AS m, count(DISTINCT user_id) AS users, count(*) AS logins FROM ({TEAM_LOGINS}) GROUP BY ALL) USING (team, m)""",
)
def _(t: Tables) -> DataFrame:
    rows = t.events.filter("event_type <> 'error'").select((F.col("user_id") % 12).alias("team"), "user_id", "ts")
    return audit.monthly_logins(rows, *(F.lit(d).cast("date") for d in ("2023-11-01", "2024-03-01")))


def auth_activity(t: Tables) -> DataFrame:
    a = logins(t).filter("event_type IN ('click', 'view', 'error')")
    reference = F.when(F.col("event_id") % 3 == 0, F.col("event_id") - 1)
    return a.select(F.col("event_id").alias("activity_id"), "user_id", F.to_date("ts").alias("session_id"), F.col("ts").alias("login"), F.col("stop").alias("logout"), reference.alias("login_row"))


def auth_audit(t: Tables) -> DataFrame:
    a = t.events.filter("event_type IN ('signup', 'purchase')")
    return a.select(F.col("event_id").alias("audit_id"), "user_id", F.to_date("ts").alias("session_id"), F.col("ts").alias("last_login"))


@query(
    "k28_login_assembly",
    f"""WITH act AS (SELECT event_id AS activity_id, user_id, ts::DATE AS session_id, ts AS login, stop AS logout, CASE WHEN event_id % 3 = 0 THEN event_id - 1 END AS login_row FROM ({LOGINS}) WHERE event_type IN ('click', 'view', 'error')),
    aud AS (SELECT event_id AS audit_id, user_id, ts::DATE AS session_id, ts AS last_login FROM events WHERE event_type IN ('signup', 'purchase')),
    ref AS (SELECT login_row AS audit_id, activity_id FROM act WHERE login_row IS NOT NULL),
    near AS (SELECT aud.audit_id, activity_id FROM act JOIN aud ON aud.user_id = act.user_id AND aud.session_id = act.session_id AND last_login <= login WHERE login_row IS NULL
    QUALIFY row_number() OVER (PARTITION BY activity_id ORDER BY last_login DESC, aud.audit_id DESC) = 1),
    links AS (SELECT * FROM ref UNION ALL SELECT * FROM near WHERE audit_id NOT IN (SELECT audit_id FROM ref)),
    j AS (SELECT aud.audit_id, aud.user_id, coalesce(last_login, last_login) AS last_login, links.activity_id, logout FROM aud LEFT JOIN links USING (audit_id) LEFT JOIN act USING (activity_id))
    SELECT audit_id, activity_id, coalesce(logout, first_value(logout IGNORE NULLS) OVER (PARTITION BY user_id, last_login::DATE ORDER BY last_login, audit_id, activity_id NULLS FIRST ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
    last_login::DATE + TIME '23:59:59') AS closed_logout FROM j""",
)
def _(t: Tables) -> DataFrame:
    rows = materialise(audit.assemble_logins(auth_activity(t), auth_audit(t)).withColumn("row_id", F.struct("audit_id", "activity_id")), "authentication")
    return audit.close_sessions(rows, "user_id", "last_login", "logout", "row_id").select("audit_id", "activity_id", "closed_logout")


@query(
    "k29_views_in_sessions",
    f"""WITH s AS (SELECT event_id AS session_id, user_id, ts AS login, stop AS logout FROM ({LOGINS}) WHERE event_type IN ('signup', 'purchase')), v AS (SELECT event_id AS view_id, user_id, ts, event_type FROM events WHERE event_type IN ('click', 'view')),
    c AS (SELECT view_id, v.event_type, s.session_id, s.logout, ts FROM v LEFT JOIN s ON s.user_id = v.user_id AND login <= ts AND logout::DATE >= ts::DATE QUALIFY row_number() OVER (PARTITION BY view_id ORDER BY logout DESC NULLS LAST, session_id DESC) = 1)
    SELECT view_id, session_id, CASE WHEN logout >= ts THEN 'inside' WHEN session_id IS NOT NULL THEN 'same day' END AS link,
    CASE WHEN row_number() OVER (PARTITION BY session_id, event_type ORDER BY ts, view_id) = 1 THEN 1 ELSE 0 END::INT AS first_of_type FROM c""",
)
def _(t: Tables) -> DataFrame:
    held = logins(t).filter("event_type IN ('signup', 'purchase')").select(F.col("event_id").alias("session_id"), "user_id", F.col("ts").alias("login"), F.col("stop").alias("logout"))
    views = t.events.filter("event_type IN ('click', 'view')").select(F.col("event_id").alias("view_id"), "user_id", "ts", "event_type")
    linked = materialise(audit.link_views(views, held), "views")
    return audit.first_of_type(linked, ["session_id"], "event_type", "ts", "view_id").select("view_id", "session_id", "link", "first_of_type")


@query(
    "k30_team_activity",
    f"""WITH l AS (SELECT (user_id % 12)::INT AS team, CASE WHEN event_type LIKE '%sign%' THEN 'created' WHEN event_type LIKE '%ie%' THEN 'viewed' ELSE 'other' END AS activity, date_trunc('month', ts)::DATE AS month FROM events
    UNION ALL SELECT (user_id % 12)::INT, 'login', date_trunc('month', ts)::DATE FROM events WHERE event_type = 'error'), k AS (SELECT DISTINCT team, activity FROM l),
    m AS (SELECT unnest(generate_series(TIMESTAMP '2023-12-01', TIMESTAMP '2024-02-01', INTERVAL 1 MONTH))::DATE AS month), c AS (SELECT team, activity, month, count(*) AS n FROM l GROUP BY ALL)
    SELECT k.team, k.activity, m.month::VARCHAR AS month, coalesce(n, 0) AS n FROM k CROSS JOIN m LEFT JOIN c ON c.team = k.team AND c.activity = k.activity AND c.month = m.month""",
)
def _(t: Tables) -> DataFrame:
    e = t.events.select((F.col("user_id") % 12).cast("int").alias("team"), F.col("event_type").alias("action"), "ts")
    bounds = (F.lit(d).cast("date") for d in ("2023-12-01", "2024-02-01"))
    return audit.team_activity(e, e.filter("action = 'error'"), [("SIGN", "created"), ("ie", "viewed")], *bounds)


STAFF = """SELECT user_id AS staff_id, (user_id % 12)::INT AS team_id, event_type, ts FROM events WHERE user_id % 4 <> 0 OR ts < TIMESTAMP '2024-01-20'"""
STAFF_ACTIVITY = f"""WITH e AS ({STAFF}), l AS (SELECT staff_id, team_id, CASE WHEN event_type LIKE '%sign%' THEN 'created' WHEN event_type LIKE '%ie%' THEN 'viewed' ELSE 'other' END AS activity, ts::DATE AS day FROM e
    UNION ALL SELECT staff_id, team_id, 'login', ts::DATE FROM e WHERE event_type = 'error'), c AS (SELECT staff_id, team_id, activity, day, count(*) AS total FROM l GROUP BY ALL),
    s AS (SELECT staff_id, team_id, min(date_trunc('month', day))::DATE AS lo, max(date_trunc('month', day))::DATE AS hi FROM c GROUP BY ALL), k AS (SELECT DISTINCT staff_id, team_id, activity FROM c),
    g AS (SELECT k.*, unnest(generate_series(lo::TIMESTAMP, hi::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month FROM k JOIN s USING (staff_id, team_id)),
    h AS (SELECT staff_id, team_id, min(ts)::DATE AS staff_start, max(ts)::DATE AS staff_end FROM e WHERE event_type = 'error' GROUP BY ALL)
    SELECT g.*, coalesce((SELECT sum(total) FROM c WHERE c.staff_id = g.staff_id AND c.team_id = g.team_id AND c.activity = g.activity AND date_trunc('month', c.day)::DATE = g.month), 0)::BIGINT AS total, staff_start, staff_end, n_name AS team_name, r_name AS region
    FROM g LEFT JOIN h USING (staff_id, team_id) LEFT JOIN nation ON n_nationkey = team_id LEFT JOIN region ON r_regionkey = n_regionkey"""


def staff_activity(t: Tables) -> DataFrame:
    e = t.events.select(F.col("user_id").alias("staff_id"), (F.col("user_id") % 12).cast("int").alias("team_id"), F.col("event_type").alias("action"), "ts")
    e = e.filter((F.col("staff_id") % 4 != 0) | (F.col("ts") < at(2024, 1, 20)))
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    teams_ = nations.select(F.col("n_nationkey").cast("int").alias("team_id"), F.col("n_name").alias("team_name"), F.col("r_name").alias("region"))
    return audit.staff_activity(e, e.filter("action = 'error'"), teams_, [("SIGN", "created"), ("ie", "viewed")])


@query(
    "k30_staff_activity",
    f"SELECT staff_id, team_id, team_name, region, activity, month::VARCHAR AS month, total, staff_start::VARCHAR AS staff_start, staff_end::VARCHAR AS staff_end FROM ({STAFF_ACTIVITY})",
)
def _(t: Tables) -> DataFrame:
    return staff_activity(t)


@query(
    "k30_team_reference",
    f"""SELECT region, team_id, team_name, min(month) FILTER (total > 0)::VARCHAR AS team_start, max(month) FILTER (total > 0)::VARCHAR AS last_action FROM ({STAFF_ACTIVITY}) GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    return audit.team_reference(staff_activity(t))


@query(
    "k31_created_and_published",
    f"""WITH l AS ({LOG}), f AS (SELECT * FROM l WHERE action IN ('create', 'publish') QUALIFY row_number() OVER (PARTITION BY record_id, action ORDER BY ts, item_id) = 1)
    SELECT action || CASE WHEN action = 'create' THEN 'd' ELSE 'ed' END AS report, team_id, date_trunc('month', ts)::DATE::VARCHAR AS month, count(*) AS n FROM f GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    return audit.created_and_published(log(t), "create", "publish")


@query(
    "k32_never_published",
    f"""WITH l AS (SELECT * FROM ({LOG}) WHERE NOT (action = 'publish' AND record_id::INT % 3 <> 0)) SELECT record_id, action AS last_action, team_id, ts AS last_time, CASE WHEN action = 'revise' THEN 'deleted' ELSE 'draft' END AS status FROM l
    WHERE record_id NOT IN (SELECT record_id FROM l WHERE action = 'publish') QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY ts DESC, item_id DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    # two thirds of the records never get to publication
    l = log(t).filter(~((F.col("action") == "publish") & (F.col("record_id").cast("int") % 3 != 0)))
    return audit.never_published(l, "publish", "revise")


@query(
    "k33_service_search_rates",
    """WITH s AS (SELECT (user_id % 25)::VARCHAR AS team_id, CASE WHEN event_id % 4 <> 0 THEN 1 ELSE 0 END AS matched FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-08'))
    SELECT team_id, count(*) AS searches, sum(matched)::BIGINT AS matches, round(sum(matched) * 100.0::DOUBLE / count(*), 2) AS match_pct FROM s GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    e = F.col("event_id")
    source = t.events.select("event_id", F.concat_ws("|", "user_id", F.col("user_id") % 25).alias("actor"), F.when(e % 8 == 0, " ").when(e % 4 != 0, F.col("props")).alias("found"), "ts")
    stored = source.filter(F.col("ts") < at(2024, 1, 8))
    return audit.match_rates(audit.service_searches(stored, source, "event_id"), ["team_id"])


KINDS = {"requests": "click", "completed": "purchase", "edits": "view", "drafts": "signup"}
COUNTED = {m: f"events WHERE ts::DATE <= d AND event_type = '{kind}'" for m, kind in KINDS.items()} | {
    "accounts": "orders WHERE DATE '2024-01-01' + (o_orderkey % 50)::INT <= d AND o_orderstatus <> 'P'",
    "sessions": "lineitem WHERE DATE '2024-01-01' + (l_partkey % 45)::INT <= d AND l_linenumber = 1",
}
PER_DAY = "SELECT d::DATE AS day, " + ", ".join(f"(SELECT count(*) FROM {rows}) AS {m}" for m, rows in COUNTED.items()) + (
    " FROM (SELECT unnest(generate_series(DATE '2024-01-03', DATE '2024-02-05', INTERVAL 1 DAY)) AS d)"
)


def adoption_sources(t: Tables) -> list:
    start = F.lit("2024-01-01").cast("date")
    accounts = t.orders.select("o_orderstatus", F.date_add(start, (F.col("o_orderkey") % 50).cast("int")).alias("activated"))
    portal = t.lineitem.select("l_linenumber", F.date_add(start, (F.col("l_partkey") % 45).cast("int")).alias("logged"))
    return [
        (t.events, {m: ("ts", F.col("event_type") == kind) for m, kind in KINDS.items()}),
        (accounts, {"accounts": ("activated", F.col("o_orderstatus") != "P")}),
        (portal, {"sessions": ("logged", F.col("l_linenumber") == 1)}),
    ]


def adoption(t: Tables) -> DataFrame:
    first, last = (F.lit(d).cast("date") for d in ("2024-01-03", "2024-02-05"))
    sources = adoption_sources(t)
    # three days are stored already, with -1 in place of the counts
    days = t.events.select(F.to_date("ts").alias("day")).filter(F.dayofmonth("ts").isin(4, 5, 6)).distinct()
    stored = days.select("day", *[F.lit(-1).cast("long").alias(m) for m in COUNTED], F.lit(-1).cast("long").alias("combined"))
    return audit.portal_adoption(stored, sources, first, last, ("requests", "completed"), last)


STORED_DAYS = "day IN (DATE '2024-01-04', DATE '2024-01-05', DATE '2024-01-06')"
ADOPTION = "SELECT day, " + ", ".join(
    f"CASE WHEN day >= DATE '2024-02-04' THEN NULL WHEN {STORED_DAYS} THEN -1 ELSE {value} END AS {m}"
    for m, value in [*((m, m) for m in COUNTED), ("combined", "requests + completed")]
) + f" FROM ({PER_DAY})"


@query("k34_portal_adoption", f"SELECT day::VARCHAR AS day, requests, completed, edits, drafts, accounts, sessions, combined FROM ({ADOPTION})")
def _(t: Tables) -> DataFrame:
    return adoption(t)


@query(
    "k34_adoption_carried_on",
    "SELECT day::VARCHAR AS day, " + ", ".join(f"CASE WHEN day < DATE '2024-02-04' THEN {v} END AS {m}" for m, v in [*((m, m) for m in COUNTED), ("combined", "requests + completed")]) + f" FROM ({PER_DAY})",
)
def _(t: Tables) -> DataFrame:
    """The table of a run on 20 January, whose last two days were blank, carried on by a run on 5 February."""
    sources, first, run = adoption_sources(t), F.lit("2024-01-03").cast("date"), F.lit("2024-01-20").cast("date")
    empty = t.events.select(F.to_date("ts").alias("day"), *[F.lit(0).cast("long").alias(m) for m in (*COUNTED, "combined")]).limit(0)
    stored = materialise(audit.portal_adoption(empty, sources, first, run, ("requests", "completed"), run), "adoption")
    return audit.extend_adoption(stored, sources, dt.date(2024, 2, 5), ("requests", "completed"), dt.date(2024, 2, 5))


@query(
    "k34_adoption_last_day_per_week",
    f"SELECT date_trunc('week', day)::DATE::VARCHAR AS week, day::VARCHAR AS day, combined FROM ({ADOPTION}) QUALIFY row_number() OVER (PARTITION BY date_trunc('week', day) ORDER BY day DESC) = 1",
)
def _(t: Tables) -> DataFrame:
    return audit.last_day_per_week(adoption(t)).select("week", "day", "combined")


@query(
    "k42_activity_by_month",
    """SELECT day::VARCHAR AS day, team, coalesce(created, 0) AS created, coalesce(viewed, 0) AS viewed, coalesce(logons, 0) AS logons FROM (SELECT ts::DATE AS day, user_id % 12 AS team, count(*) AS created FROM events WHERE event_type = 'signup' GROUP BY ALL)
    FULL JOIN (SELECT ts::DATE AS day, user_id % 12 AS team, count(*) AS viewed FROM events WHERE event_type = 'view' GROUP BY ALL) USING (day, team)
    FULL JOIN (SELECT ts::DATE AS day, user_id % 12 AS team, count(DISTINCT user_id) AS logons FROM events WHERE event_type = 'error' GROUP BY ALL) USING (day, team)""",
)
def _(t: Tables) -> DataFrame:
    groups = [F.to_date("ts").alias("day"), (F.col("user_id") % 12).alias("team")]

    def per(kind: str, value: Column, name: str) -> DataFrame:
        return t.events.filter(F.col("event_type") == kind).groupBy(*groups).agg(value.alias(name))

    n = F.count(F.lit(1))
    counts = {"created": per("signup", n, "created"), "viewed": per("view", n, "viewed"), "logons": per("error", F.count_distinct("user_id"), "logons")}
    return audit.activity_by_month(counts, ["day", "team"])


@query(
    "k43_review_lists",
    f"""WITH l AS ({LOG}), o AS (SELECT record_id, team_id AS owner_team FROM l QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY ts, item_id) = 1),
    d AS (SELECT DISTINCT record_id, action, CASE WHEN team_id = owner_team THEN 'own' ELSE 'other' END AS side, ts::DATE AS day FROM l JOIN o USING (record_id) WHERE action IN ('view', 'revise')),
    g AS (SELECT record_id, action, side, string_agg(strftime(day, '%d/%m/%Y'), ', ' ORDER BY day) AS days FROM d GROUP BY ALL)
    SELECT record_id, max(days) FILTER (side = 'own' AND action = 'view') AS own_view_days, max(days) FILTER (side = 'own' AND action = 'revise') AS own_revise_days,
    max(days) FILTER (side = 'other' AND action = 'view') AS other_view_days, max(days) FILTER (side = 'other' AND action = 'revise') AS other_revise_days FROM g GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    l = log(t)
    owner = l.groupBy("record_id").agg(F.min(F.struct("ts", "item_id", "team_id"))["team_id"].alias("owner_team"))
    return audit.review_lists(l, owner, ["view", "revise"])


@query(
    "k48_extract_history",
    "SELECT event_id, strftime(ts, '%H:%M') AS change_time, rank() OVER (PARTITION BY user_id % 10, ts::DATE ORDER BY strftime(ts, '%H:%M')) AS order_of_change FROM events",
)
def _(t: Tables) -> DataFrame:
    e = t.events.select("event_id", (F.col("user_id") % 10).alias("record_id"), "ts")
    return audit.extract_history(e).select("event_id", "change_time", "order_of_change")


@query(
    "k53_approvals",
    """WITH p AS (SELECT event_id // 2 AS v, * FROM events WHERE event_type = 'purchase' QUALIFY row_number() OVER (PARTITION BY event_id // 2 ORDER BY ts DESC, event_id DESC) = 1)
    SELECT o_orderkey AS version_id, p.ts AS published, c_name AS staff_name, n_name AS team_name FROM orders LEFT JOIN p ON p.v = o_orderkey
    LEFT JOIN customer ON c_custkey = p.user_id LEFT JOIN nation ON n_nationkey = p.user_id % 25""",
)
def _(t: Tables) -> DataFrame:
    versions = t.orders.select(F.col("o_orderkey").alias("version_id"), F.col("o_custkey").alias("record_id"))
    events = t.events.select(
        F.expr("event_id div 2").alias("version_id"),
        audit.map_codes("event_type", ACTIONS).alias("action"),
        "ts",
        F.col("event_id").alias("item_id"),
        F.col("user_id").cast("string").alias("staff_id"),
        (F.col("user_id") % 25).cast("string").alias("team_id"),
    )
    return audit.approvals(versions, events, "publish", staff(t), teams(t)).select("version_id", "published", "staff_name", "team_name")


@query(
    "k54_access_log",
    """WITH s AS (SELECT event_id AS access_id, 'stored' AS action FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'error'),
    f AS (SELECT event_id AS access_id, CASE event_type WHEN 'view' THEN 'read' WHEN 'signup' THEN 'open' WHEN 'click' THEN 'read' WHEN 'purchase' THEN 'change' END AS action FROM events WHERE ts >= TIMESTAMP '2024-01-18')
    SELECT * FROM s UNION ALL SELECT * FROM f WHERE action IS NOT NULL AND access_id NOT IN (SELECT access_id FROM s)""",
)
def _(t: Tables) -> DataFrame:
    rows = t.events.select(F.col("event_id").alias("access_id"), (F.col("event_id") % 900).alias("record_id"), "user_id", F.col("event_type").alias("action"), "ts")
    stored = rows.filter((F.col("ts") < at(2024, 1, 20)) & (F.col("action") != "error")).withColumn("action", F.lit("stored"))
    portal, desktop = rows.filter("action IN ('view', 'signup')"), rows.filter("action NOT IN ('view', 'signup')")
    out = audit.access_log(stored, [(portal, {"view": "read", "signup": "open"}), (desktop, {"click": "read", "purchase": "change"})])
    return out.select("access_id", "action")
