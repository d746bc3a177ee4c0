"""Projections, predicates and derived columns on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.registry import Tables, query
from fathomline.functions import dates, rules, text
from fathomline.functions.dates import at
from fathomline.operators import keys

# Priorities of the test orders and the labels given to them
PRIORITY_LABELS = {"1-URGENT": "Emergency", "2-HIGH": "Urgent", "3-MEDIUM": "Routine"}
URGENT = ["1-URGENT", "2-HIGH"]

# Orders with a derived end date (NULL for pending ones) for the open and closed rules
def ended_on() -> Column:
    return F.when(F.col("o_orderstatus") != "P", F.date_add(F.col("o_orderdate").cast("date"), (F.col("o_orderkey") % 40).cast("int")))

ENDED_SQL = "CASE WHEN o_orderstatus <> 'P' THEN o_orderdate::DATE + (o_orderkey % 40)::INT END"


@query(
    "b01_map_codes",
    """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Emergency' WHEN '2-HIGH' THEN 'Urgent' WHEN '3-MEDIUM' THEN 'Routine'
    ELSE 'Unknown' END AS priority FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", text.map_codes("o_orderpriority", PRIORITY_LABELS, "Unknown").alias("priority"))


@query(
    "b02_numeric_band",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 50000 AND o_totalprice >= 0 THEN 'low' WHEN o_totalprice < 200000 AND o_totalprice >= 50000 THEN 'mid'
    WHEN o_totalprice >= 200000 AND o_totalprice < 400000 THEN 'high' ELSE 'top' END AS half_open,
    CASE WHEN o_totalprice BETWEEN 0 AND 100000 THEN 'a' WHEN o_totalprice BETWEEN 100000 AND 300000 THEN 'b' ELSE 'c' END AS closed FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return t.orders.select(
        "o_orderkey",
        rules.band("o_totalprice", [0, 50000, 200000, 400000], ["low", "mid", "high"], "top").alias("half_open"),
        rules.band("o_totalprice", [0, 100000, 300000], ["a", "b"], "c", closed=True).alias("closed"),
    )


@query(
    "b03_band_with_null",
    """SELECT event_id, CASE WHEN v IS NULL THEN '0-9' WHEN v >= 0 AND v < 10 THEN '0-9' WHEN v >= 10 AND v < 50 THEN '10-49' ELSE '50+' END AS band
    FROM (SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS v FROM events)""",
)
def _(t: Tables) -> DataFrame:
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return t.events.select("event_id", rules.band(value, [0, 10, 50], ["0-9", "10-49"], "50+", null_label="0-9").alias("band"))


@query("b04_membership_flag", "SELECT o_orderkey, CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN 1 ELSE 0 END::INT AS urgent FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", rules.flag_in("o_orderpriority", URGENT).alias("urgent"))


@query(
    "b05_any_of_flag",
    """SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_returnflag = 'R' OR l_discount > 0.08 OR l_quantity >= 45 THEN 1 ELSE 0 END::INT AS notable
    FROM lineitem""",
)
def _(t: Tables) -> DataFrame:
    any_of = [F.col("l_returnflag") == "R", F.col("l_discount") > 0.08, F.col("l_quantity") >= 45]
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", rules.flag_any(any_of).alias("notable"))


@query(
    "b06_rule_by_version",
    """SELECT event_id FROM events WHERE event_type IN ('click', 'view') OR (ts < TIMESTAMP '2024-01-15' AND event_type = 'signup')
    OR (ts >= TIMESTAMP '2024-01-15' AND event_type = 'purchase')""",
)
def _(t: Tables) -> DataFrame:
    kind, old = F.col("event_type"), F.col("ts") < at(2024, 1, 15)
    valid = kind.isin("click", "view") | (old & (kind == "signup")) | (~old & (kind == "purchase"))
    return t.events.filter(valid).select("event_id")


@query("b07_half_open_window", "SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '1997-04-01' AND o_orderdate < TIMESTAMP '1998-04-01'")
def _(t: Tables) -> DataFrame:
    return t.orders.filter(dates.in_window("o_orderdate", at(1997, 4, 1), at(1998, 4, 1))).select("o_orderkey")


@query("b08_closed_window", "SELECT o_orderkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-04-01' AND TIMESTAMP '1998-03-31'")
def _(t: Tables) -> DataFrame:
    return t.orders.filter(F.col("o_orderdate").between(at(1997, 4, 1), at(1998, 3, 31))).select("o_orderkey")


@query(
    "b09_null_tolerant_exclusion",
    "SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'P') IS NULL OR nullif(o_orderstatus, 'P') NOT IN ('F')",
)
def _(t: Tables) -> DataFrame:
    status = F.nullif(F.col("o_orderstatus"), F.lit("P"))
    return t.orders.filter(rules.not_in_or_null(status, ["F"])).select("o_orderkey")


@query(
    "b10_breach_and_excess",
    "SELECT event_id, CASE WHEN value > 60 THEN 1 ELSE 0 END::INT AS breach, round(greatest(value - 60, 0), 2) AS excess FROM events",
)
def _(t: Tables) -> DataFrame:
    over, excess = rules.breach("value", 60)
    return t.events.select("event_id", over.alias("breach"), F.round(excess, 2).alias("excess"))


@query(
    "b11_default_label",
    """SELECT c_custkey, coalesce(r_name, 'Out of area') AS region FROM customer
    LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey AND r_name <> 'ASIA'""",
)
def _(t: Tables) -> DataFrame:
    places = t.nation.join(t.region.filter("r_name <> 'ASIA'"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    joined = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
    return joined.select("c_custkey", rules.or_default("r_name", "Out of area").alias("region"))


@query(
    "b12_safe_ratio",
    """SELECT n_name, round(customers / nullif(suppliers, 0) * 100000.0, 4) AS per_100k FROM (
    SELECT n_name, (SELECT count(*) FROM customer WHERE c_nationkey = n_nationkey)::DOUBLE AS customers,
    (SELECT count(*) FROM supplier WHERE s_nationkey = n_nationkey AND s_acctbal < 3000) AS suppliers FROM nation)""",
)
def _(t: Tables) -> DataFrame:
    c = t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("customers"))
    s = t.supplier.filter("s_acctbal < 3000").groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count(F.lit(1)).alias("suppliers"))
    both = t.nation.join(c, "n_nationkey", "left").join(s, "n_nationkey", "left")
    suppliers = F.coalesce("suppliers", F.lit(0))
    return both.select("n_name", F.round(rules.safe_ratio(F.coalesce("customers", F.lit(0)), suppliers), 4).alias("per_100k"))


@query(
    "b13_keyword_class",
    """SELECT page_id, CASE WHEN lower(url) LIKE '%//m.%' THEN 'mobile' WHEN lower(url) LIKE '%example.net%' THEN 'net'
    WHEN lower(url) LIKE '%example.com%' THEN 'com' ELSE 'other' END AS class FROM pages""",
)
def _(t: Tables) -> DataFrame:
    ordered_rules = [("//M.", "mobile"), ("example.NET", "net"), ("example.com", "com")]
    return t.pages.select("page_id", text.classify_contains("url", ordered_rules, "other").alias("class"))


@query("b14_prefix_predicate", "SELECT p_partkey, p_name FROM part WHERE p_name LIKE 'red%' OR lower(p_type) LIKE 'eco%'")
def _(t: Tables) -> DataFrame:
    return t.part.filter(F.col("p_name").startswith("red") | F.col("p_type").ilike("eco%")).select("p_partkey", "p_name")


@query(
    "b15_normalise_names",
    """SELECT p_partkey, regexp_replace(CASE lower(trim(p_name)) WHEN 'red widget' THEN 'crimson device' WHEN 'small ring' THEN 'tiny ring' ELSE trim(p_name) END,
    '\\s*ring$', '', 'i') AS name FROM part""",
)
def _(t: Tables) -> DataFrame:
    aliases = {"red widget": "crimson device", "Small Ring": "tiny ring"}
    return t.part.select("p_partkey", text.normalise_names("p_name", aliases, ["ring"]).alias("name"))


@query(
    "b16_message_parts",
    """SELECT o_orderkey, concat_ws('; ', 'order ' || o_orderkey, 'status ' || nullif(o_orderstatus, 'P'),
    'urgent ' || CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority END) AS message FROM orders""",
)
def _(t: Tables) -> DataFrame:
    parts = [
        ("order ", F.col("o_orderkey")),
        ("status ", F.nullif(F.col("o_orderstatus"), F.lit("P"))),
        ("urgent ", F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority"))),
    ]
    return t.orders.select("o_orderkey", text.message(parts).alias("message"))


@query(
    "b17_named_windows",
    """SELECT 'fytd' AS token, count(*) AS n FROM orders WHERE o_orderdate >= TIMESTAMP '1997-04-01' AND o_orderdate < TIMESTAMP '1998-02-11'
    UNION ALL SELECT 'last_8d', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-02-02' AND o_orderdate < TIMESTAMP '1998-02-11'
    UNION ALL SELECT 'prev_month', count(*) FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderdate < TIMESTAMP '1998-02-01'""",
)
def _(t: Tables) -> DataFrame:
    today = dt.date(1998, 2, 10)
    counts = []
    for token in ("fytd", "last_8d", "prev_month"):
        low, high = dates.resolve_window(token, today)
        inside = dates.in_window("o_orderdate", F.lit(low).cast("timestamp_ntz"), F.lit(high).cast("timestamp_ntz"))
        counts.append(F.count_if(inside).alias(token))
    return t.orders.agg(*counts).select(F.expr("stack(3, 'fytd', fytd, 'last_8d', last_8d, 'prev_month', prev_month) AS (token, n)"))


@query(
    "b18_stale_flag",
    f"""SELECT o_orderkey, CASE WHEN {ENDED_SQL} IS NULL AND o_orderdate::DATE + INTERVAL 6 MONTH < DATE '2001-01-01' THEN 1 ELSE 0 END::INT AS stale FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", rules.stale_flag(ended_on(), F.col("o_orderdate").cast("date"), dt.date(2001, 1, 1)).alias("stale"))


@query(
    "b19_record_status",
    f"""SELECT o_orderkey, CASE WHEN {ENDED_SQL} IS NOT NULL THEN 'Closed' WHEN date_trunc('year', o_orderdate) = (SELECT max(date_trunc('year', o_orderdate)) FROM orders)
    THEN 'Open' ELSE 'Inactive' END AS status FROM orders""",
)
def _(t: Tables) -> DataFrame:
    year = F.year("o_orderdate")
    last = t.orders.agg(F.max(year)).scalar()
    return t.orders.select("o_orderkey", rules.record_status(ended_on(), year, last).alias("status"))


@query(
    "b20_length_of_stay",
    f"""SELECT o_orderkey, date_diff('day', o_orderdate::DATE, {ENDED_SQL}) AS nights, date_diff('day', o_orderdate::DATE, {ENDED_SQL}) + 1 AS days,
    date_diff('day', o_orderdate::DATE, coalesce({ENDED_SQL}, DATE '2001-09-30')) AS to_date FROM orders""",
)
def _(t: Tables) -> DataFrame:
    start = F.col("o_orderdate").cast("date")
    return t.orders.select(
        "o_orderkey",
        rules.length_of_stay(start, ended_on()).alias("nights"),
        rules.length_of_stay(start, ended_on(), inclusive=True).alias("days"),
        rules.length_of_stay(start, ended_on(), dt.date(2001, 9, 30)).alias("to_date"),
    )


def claims(t: Tables) -> DataFrame:
    """Orders as claims: closed where finished, reserves derived from the price."""
    price = F.col("o_totalprice")
    return t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).alias("status"),
        F.lit(50.0).alias("share_pct"),
        (price * 0.5).alias("reserve_damages"),
        (price * 0.25).alias("reserve_defence"),
        F.when(F.col("o_orderpriority") != "5-LOW", price * 0.125).alias("reserve_claimant"),
        F.when(F.col("o_orderkey") % 3 != 0, price * 0.25).alias("paid_damages"),
        F.when(F.col("o_orderkey") % 4 != 0, price * 0.125).alias("paid_defence"),
        F.lit(None).cast("double").alias("paid_claimant"),
        F.when(F.col("o_orderkey") % 5 != 0, F.lit(50000.0)).alias("excess"),
        (F.col("o_orderpriority") == "1-URGENT").alias("periodical"),
    )


CLAIMS = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 2 ELSE 1 END AS status, 0.5::DOUBLE AS share, o_totalprice * 0.5::DOUBLE AS rd, o_totalprice * 0.25::DOUBLE AS rf,
    CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice * 0.125::DOUBLE ELSE 0 END AS rc, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice * 0.25::DOUBLE ELSE 0 END AS pd,
    CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice * 0.125::DOUBLE ELSE 0 END AS pf, CASE WHEN o_orderkey % 5 <> 0 THEN 50000.0::DOUBLE END AS excess,
    o_orderpriority = '1-URGENT' AS periodical FROM orders"""


@query(
    "b21_claim_measures",
    f"""SELECT o_orderkey, round(pd + pf, 6) AS total_paid, round(reserve, 6) AS total_reserve, round(total, 6) AS total_claim,
    round(CASE WHEN status = 2 THEN 0 ELSE reserve - pd - pf END, 6) AS outstanding, round(CASE WHEN status = 2 THEN 0 ELSE rd * share - pd END, 6) AS outstanding_damages,
    round(CASE WHEN excess IS NULL OR total <= excess THEN total ELSE excess END, 6) AS excess_applied, round(reserve - excess, 6) AS funded
    FROM (SELECT *, CASE WHEN status = 2 THEN pd + pf ELSE reserve END AS total FROM (SELECT *, rf + (rd + rc) * share AS reserve FROM ({CLAIMS})))""",
)
def _(t: Tables) -> DataFrame:
    out = rules.claim_measures(claims(t))
    shown = ["total_paid", "total_reserve", "total_claim", "outstanding", "outstanding_damages", "excess_applied", "funded"]
    return out.select("o_orderkey", *[F.round(c, 6).alias(c) for c in shown])


@query(
    "b22_claim_outcome",
    f"""SELECT o_orderkey, CASE WHEN (status = 2 AND pd > 0) OR periodical THEN 'Successful' WHEN status = 2 THEN 'Unsuccessful' ELSE 'Open' END AS outcome
    FROM ({CLAIMS})""",
)
def _(t: Tables) -> DataFrame:
    return claims(t).select("o_orderkey", rules.claim_outcome(F.col("status"), F.col("paid_damages"), F.col("periodical")).alias("outcome"))


@query(
    "b23_row_maximum",
    "SELECT l_orderkey, l_linenumber, l_partkey, greatest(l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN l_orderkey END) AS top FROM lineitem",
)
def _(t: Tables) -> DataFrame:
    top = rules.row_max("l_partkey", "l_suppkey", F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", top.alias("top"))


@query(
    "b24_age_in_years",
    """SELECT o_orderkey, (year(DATE '2024-02-28') - year(d) - CASE WHEN (d + to_years(2024 - year(d)))::DATE > DATE '2024-02-28' THEN 1 ELSE 0 END)::INT AS age,
    (year(DATE '2023-02-28') - year(d) - CASE WHEN (d + to_years(2023 - year(d)))::DATE > DATE '2023-02-28' THEN 1 ELSE 0 END)::INT AS age_before
    FROM (SELECT o_orderkey, o_orderdate::DATE AS d FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    ages = [dates.age_years("o_orderdate", F.lit(d)).alias(n) for n, d in (("age", dt.date(2024, 2, 28)), ("age_before", dt.date(2023, 2, 28)))]
    return t.orders.select("o_orderkey", *ages)


@query("b25_exclude_test_records", "SELECT p_partkey, p_name FROM part WHERE lower(p_name) NOT LIKE '%widget%' AND lower(p_name) NOT LIKE 'green%'")
def _(t: Tables) -> DataFrame:
    return rules.exclude_matching(t.part, "p_name", ["%Widget%", "green%"]).select("p_partkey", "p_name")


@query(
    "b26_first_non_null",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN 'f' || o_custkey END, CASE WHEN o_orderpriority = '5-LOW' THEN 'low' END, 'k' || o_orderkey) AS first_key
    FROM orders""",
)
def _(t: Tables) -> DataFrame:
    choices = [
        F.when(F.col("o_orderstatus") == "F", F.concat(F.lit("f"), "o_custkey")),
        F.when(F.col("o_orderpriority") == "5-LOW", F.lit("low")),
        F.concat(F.lit("k"), "o_orderkey"),
    ]
    return t.orders.select("o_orderkey", F.coalesce(*choices).alias("first_key"))


@query(
    "b27_existence_flag",
    "SELECT c_custkey, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') THEN 1 ELSE 0 END::INT AS has_pending FROM customer",
)
def _(t: Tables) -> DataFrame:
    pending = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    return keys.exists_flag(t.customer.select("c_custkey"), pending, ["c_custkey"], "has_pending")
