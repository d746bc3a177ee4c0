"""Aggregations on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.registry import Tables, query
from fathomline.functions.dates import diff_boundary, whole_minutes
from fathomline.functions.text import map_codes
from fathomline.operators import aggs, keys, sessions

def one() -> Column:
    return F.lit(1)



def logins(t: Tables) -> DataFrame:
    """Events as login rows that last `value` minutes; errors stay open."""
    stop = (F.col("ts").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), F.col("value").cast("int"))).cast("timestamp_ntz")
    return t.events.select("event_id", "user_id", "ts", F.when(F.col("event_type") != "error", stop).alias("stop"), "event_type")


LOGINS = "SELECT event_id, user_id, ts, CASE WHEN event_type <> 'error' THEN ts + to_minutes(trunc(value)::INT) END AS stop, event_type FROM events"


def stays(t: Tables) -> DataFrame:
    """Events as attendances lasting up to several days; one in eleven has an invalid duration."""
    minutes = F.when(F.col("event_id") % 11 == 0, -1).otherwise((F.col("value") * 60).cast("int"))
    gone = (F.col("ts").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("value") * 60).cast("int"))).cast("timestamp_ntz")
    return t.events.select("event_id", "event_type", F.col("ts").alias("arrival"), gone.alias("departure"), minutes.alias("minutes"))


STAYS = """SELECT event_id, event_type, ts AS arrival, ts + to_minutes(trunc(value * 60)::INT) AS departure,
    CASE WHEN event_id % 11 = 0 THEN -1 ELSE trunc(value * 60)::INT END AS minutes FROM events"""

IN_OUT = "(arrival::DATE BETWEEN {a} AND {b} OR (arrival::DATE < {a} AND departure::DATE BETWEEN {a} AND {b} AND minutes >= 0))"


@query(
    "d01_group_count",
    "SELECT year(o_orderdate)::INT AS y, o_orderstatus, o_orderpriority, c_mktsegment, count(*) AS n FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return aggs.count_by(joined, [F.year("o_orderdate").alias("y"), "o_orderstatus", "o_orderpriority", "c_mktsegment"])


@query(
    "d02_conditional_counts",
    """SELECT user_id, count(*) FILTER (event_type = 'click') AS clicks, count(*) FILTER (value > 50) AS big, count(*) FILTER (event_type = 'error' AND value > 50) AS big_errors
    FROM events GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    big = F.col("value") > 50
    return aggs.conditional_counts(
        t.events, ["user_id"], {"clicks": F.col("event_type") == "click", "big": big, "big_errors": big & (F.col("event_type") == "error")}
    )


@query(
    "d03_last_flag",
    "SELECT o_orderkey, CASE WHEN o_orderdate = max(o_orderdate) OVER (PARTITION BY o_custkey) THEN 1 ELSE 0 END::INT AS is_last FROM orders",
)
def _(t: Tables) -> DataFrame:
    return keys.flag_extreme(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), ["o_custkey"], "o_orderdate", "is_last").select("o_orderkey", "is_last")


@query(
    "d04_slots_to_columns",
    """SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_partkey END) AS part_1, max(CASE WHEN l_linenumber = 2 THEN l_partkey END) AS part_2,
    max(CASE WHEN l_linenumber = 3 THEN l_partkey END) AS part_3 FROM lineitem GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return aggs.slots_to_columns(t.lineitem, ["l_orderkey"], "l_linenumber", "l_partkey", 3, "part")


@query(
    "d05_static_pivot",
    """SELECT user_id, max(CASE WHEN event_type = 'click' THEN value END) AS click, max(CASE WHEN event_type = 'error' THEN value END) AS error,
    max(CASE WHEN event_type = 'view' THEN value END) AS "view" FROM events GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return aggs.static_pivot(t.events, ["user_id"], "event_type", ["click", "error", "view"], F.max("value"))


@query(
    "d06_dynamic_pivot",
    """SELECT o_custkey, """
    + ", ".join(
        f"nullif(count(*) FILTER (o_orderpriority = '{p}'), 0) AS \"{p}\"" for p in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")
    )
    + " FROM orders GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return aggs.dynamic_pivot(t.orders, ["o_custkey"], "o_orderpriority", F.count(one()))


@query("d07_distinct_count", "SELECT ts::DATE::VARCHAR AS day, count(DISTINCT user_id) AS users, count(*) AS n FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.events.groupBy(F.col("ts").cast("date").alias("day")).agg(F.count_distinct("user_id").alias("users"), F.count(one()).alias("n"))


@query("d08_distinct_rows", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query(
    "d09_cumulative_as_at",
    """SELECT d::DATE::VARCHAR AS day, (SELECT count(*) FROM events WHERE ts::DATE <= d) AS requests, (SELECT count(*) FROM events WHERE ts::DATE <= d AND event_type = 'purchase') AS completed
    FROM (SELECT unnest(generate_series(DATE '2024-01-05', DATE '2024-02-03', INTERVAL 1 DAY)) AS d)""",
)
def _(t: Tables) -> DataFrame:
    first, last = (F.lit(d).cast("date") for d in ("2024-01-05", "2024-02-03"))
    return aggs.cumulative_as_at(t.events, first, last, {"requests": ("ts", None), "completed": ("ts", F.col("event_type") == "purchase")})


@query(
    "d10_period_carry_in",
    f"SELECT event_type, count(*) AS n FROM ({STAYS}) WHERE {IN_OUT.format(a=chr(68) + 'ATE ' + chr(39) + '2024-01-08' + chr(39), b=chr(68) + 'ATE ' + chr(39) + '2024-01-14' + chr(39))} GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return aggs.period_summary(stays(t), "arrival", "departure", "minutes", dt.date(2024, 1, 8), dt.date(2024, 1, 14), ["event_type"])


PERIODS = """SELECT 'Daily' AS period, d AS a, d AS b FROM run UNION ALL SELECT 'Weekly', d - 13, d - 7 FROM run WHERE dayofweek(d) = 0
    UNION ALL SELECT 'Monthly', date_trunc('month', d - 7)::DATE, d - 7 FROM run WHERE last_day(d - 7) = d - 7
    UNION ALL SELECT 'Yearly', d - 371, d - 7 FROM run WHERE last_day(d - 7) = d - 7"""


@query(
    "d11_multi_period_summary",
    f"""WITH run AS (SELECT unnest(generate_series(DATE '2024-01-03', DATE '2024-02-12', INTERVAL 1 DAY))::DATE AS d), p AS ({PERIODS})
    SELECT period, b::VARCHAR AS stamp, event_type, count(*) AS n FROM p JOIN ({STAYS}) ON {IN_OUT.format(a='a', b='b')} GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    periods = aggs.period_table(t.spark, *(F.lit(d).cast("date") for d in ("2024-01-03", "2024-02-12")))
    return aggs.multi_period_summary(stays(t), "arrival", "departure", "minutes", ["event_type"], periods)


@query(
    "d12_ordered_concatenation",
    "SELECT l_orderkey, string_agg(l_partkey || l_returnflag, '; ' ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag) AS lines FROM lineitem GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("item", F.concat("l_partkey", "l_returnflag"))
    return aggs.concat_ordered(lines, ["l_orderkey"], "item", ["l_linenumber", "l_partkey", "l_suppkey"], "; ", "lines", split=True)


@query(
    "d13_numbered_concatenation",
    """SELECT user_id, string_agg(no || ') ' || event_type, ' ' ORDER BY no) AS summary FROM (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS no
    FROM events) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return aggs.concat_numbered(t.events, ["user_id"], "event_type", ["ts", "event_id"], " ", "summary")


@query(
    "d14_sessions_by_day_and_hour",
    f"""SELECT user_id, ts::DATE::VARCHAR AS day, hour(ts)::INT AS hour, count(*) AS sessions, sum(date_diff('second', ts, stop) // 60)::BIGINT AS minutes FROM ({LOGINS}) GROUP BY ALL
    UNION ALL SELECT user_id, ts::DATE::VARCHAR, NULL, count(*), sum(date_diff('second', ts, stop) // 60)::BIGINT FROM ({LOGINS}) GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    rows = logins(t).withColumn("minutes", whole_minutes(diff_boundary("second", "ts", "stop")))
    hourly = sessions.rollup_sessions(rows, ["user_id"], "ts", "minutes", "hour")
    daily = sessions.rollup_sessions(rows, ["user_id"], "ts", "minutes")
    return hourly.unionByName(daily, allowMissingColumns=True)


@query(
    "d15_session_facts",
    f"""SELECT user_id, min(ts) AS first_login, max(stop) AS last_logout, max_by(event_id, ts) AS last_row, sum(date_diff('second', ts, stop) // 60)::BIGINT AS total_minutes, count(*) AS rows
    FROM ({LOGINS}) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    return sessions.session_facts(logins(t), ["user_id"], "ts", "stop", "event_id")


@query(
    "d16_session_outcome",
    """SELECT user_id, ts::DATE::VARCHAR AS day, CASE WHEN bool_and(event_type <> 'error') THEN 'direct' WHEN bool_or(event_type <> 'error') THEN 'login' ELSE 'failed' END AS outcome
    FROM events GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    return sessions.session_outcome(t.events.withColumn("day", F.col("ts").cast("date")), ["user_id", "day"], F.col("event_type") != "error")


def payments(t: Tables) -> DataFrame:
    """Line items as payments."""
    return t.lineitem.select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_linenumber").alias("status"),
        (F.col("l_partkey") % 5).alias("excess_portion"),
        (F.col("l_returnflag") == "R").cast("int").alias("tax_recoverable"),
        F.col("l_extendedprice").cast("decimal(19,4)").alias("amount"),
        F.col("l_quantity").cast("decimal(19,4)").alias("tax"),
        map_codes("l_returnflag", {"A": 1, "N": 2, "R": 3}).alias("head"),
        F.when(F.col("l_linestatus") == "F", 1).otherwise(2).alias("fund"),
        F.col("l_partkey").alias("paid_at"),
    )


PAYMENTS = """SELECT l_orderkey AS o_orderkey, CASE WHEN l_returnflag = 'R' THEN l_extendedprice ELSE l_extendedprice + l_quantity END AS gross, l_returnflag, l_linestatus, l_partkey
    FROM lineitem WHERE l_linenumber IN (1, 2, 4, 5) AND l_partkey % 5 <> 4"""


@query(
    "d17_payment_heads",
    f"""SELECT o_orderkey, round(sum(CASE WHEN l_returnflag = 'A' THEN gross END), 2) AS paid_damages, round(sum(CASE WHEN l_returnflag = 'N' THEN gross END), 2) AS paid_defence,
    round(sum(CASE WHEN l_returnflag = 'R' THEN gross END), 2) AS paid_claimant, round(sum(CASE WHEN l_linestatus = 'F' THEN gross END), 2) AS paid_fund,
    round(sum(CASE WHEN l_linestatus = 'O' THEN gross END), 2) AS paid_member, round(sum(CASE WHEN l_linestatus = 'F' AND l_returnflag = 'N' THEN gross END), 2) AS paid_fund_defence,
    max(l_partkey) AS last_paid FROM ({PAYMENTS}) GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    out = aggs.payment_heads(payments(t), ["o_orderkey"])
    return out.select("o_orderkey", *[F.round(c, 2).cast("double").alias(c) for c in out.columns if c.startswith("paid_")], "last_paid")


@query("d18_single_row_keys", "SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) = 1")
def _(t: Tables) -> DataFrame:
    return keys.single_row_keys(t.lineitem, ["l_orderkey"])


@query(
    "d19_dominant_category",
    """SELECT user_id, event_type, n FROM (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1""",
)
def _(t: Tables) -> DataFrame:
    return aggs.mode_per_key(t.events, ["user_id"], "event_type")


@query("d20_scalar_parameter", "SELECT event_id FROM events WHERE ts >= (SELECT max(ts) FROM events WHERE event_type = 'signup') - INTERVAL 2 DAY")
def _(t: Tables) -> DataFrame:
    last = t.events.filter("event_type = 'signup'").agg(F.max("ts")).scalar()
    return t.events.filter(F.col("ts") >= last - F.expr("interval 2 days")).select("event_id")


@query("d21_keep_groups", "SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT o_custkey FROM orders GROUP BY 1 HAVING max(o_totalprice) > 490000)")
def _(t: Tables) -> DataFrame:
    return keys.filter_groups(t.orders, ["o_custkey"], F.max("o_totalprice") > 490000).select("o_orderkey")


@query(
    "d22_last_day_of_week",
    """SELECT week::DATE::VARCHAR AS week, day::VARCHAR AS day, n FROM (SELECT date_trunc('week', ts) AS week, ts::DATE AS day, count(*) AS n FROM events GROUP BY ALL)
    QUALIFY row_number() OVER (PARTITION BY week ORDER BY day DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    daily = t.events.groupBy(F.date_trunc("week", "ts").cast("date").alias("week"), F.col("ts").cast("date").alias("day")).agg(F.count(one()).alias("n"))
    return aggs.last_in_group(daily, ["week"], ["day"])


@query(
    "d23_null_profile",
    """SELECT column_name, rows, nulls, round(nulls * 100.0::DOUBLE / rows, 2) AS null_pct FROM (
    SELECT 'doc_id' AS column_name, count(*) AS rows, count(*) - count(doc_id) AS nulls FROM documents UNION ALL SELECT 'lang', count(*), count(*) FILTER (lang = 'en') FROM documents
    UNION ALL SELECT 'text', count(*), count(*) FILTER (n_chars < 500) FROM documents)""",
)
def _(t: Tables) -> DataFrame:
    d = t.documents.select("doc_id", F.nullif("lang", F.lit("en")).alias("lang"), F.when(F.col("n_chars") >= 500, F.col("text")).alias("text"))
    return aggs.profile_nulls(d)


@query("d24_grand_totals", "SELECT count(*) AS n, round(sum(l_quantity), 2) AS qty, count(*) FILTER (l_returnflag = 'R') AS returned FROM lineitem")
def _(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.count(one()).alias("n"), F.round(F.sum("l_quantity"), 2).alias("qty"), F.count_if(F.col("l_returnflag") == "R").alias("returned"))


@query("d25_activity_span", "SELECT user_id, min(ts) AS first_activity, max(ts) AS last_activity FROM events GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return aggs.activity_span(t.events, ["user_id"], "ts")


@query(
    "d26_activity_by_month",
    """SELECT strftime(o_orderdate, '%Y-%m') AS month, o_orderpriority, count(*) FILTER (c_nationkey = s_nation) AS own, count(*) FILTER (c_nationkey <> s_nation) AS other
    FROM orders JOIN customer ON c_custkey = o_custkey JOIN (SELECT s_suppkey, s_nationkey AS s_nation FROM supplier) ON s_suppkey = o_orderkey % 100 GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    viewers = t.supplier.select(F.col("s_suppkey").alias("viewer"), F.col("s_nationkey").alias("team"))
    joined = t.orders.withColumn("viewer", F.col("o_orderkey") % 100).join(viewers, "viewer").join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    own = F.col("team") == F.col("c_nationkey")
    return aggs.conditional_counts(joined, [F.date_format("o_orderdate", "yyyy-MM").alias("month"), "o_orderpriority"], {"own": own, "other": ~own})
