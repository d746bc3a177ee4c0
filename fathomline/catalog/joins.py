"""Joins on the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.registry import Tables, query
from fathomline.functions.dates import at, diff_boundary
from fathomline.functions.rules import explode_list, unpivot_slots
from fathomline.operators import joins, keys, ordered
from fathomline.session import materialise


def spells(t: Tables) -> DataFrame:
    """Orders as spells of a customer: 1 to 40 days long."""
    start = F.col("o_orderdate").cast("date")
    return t.orders.select("o_custkey", "o_orderkey", start.alias("start"), F.date_add(start, (F.col("o_orderkey") % 40).cast("int")).alias("stop"))


SPELLS = "SELECT o_custkey, o_orderkey, o_orderdate::DATE AS start, o_orderdate::DATE + (o_orderkey % 40)::INT AS stop FROM orders"


def visits(t: Tables) -> DataFrame:
    """Line items as visits of the customer of their order, on the day they shipped."""
    lines = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), "l_linenumber", "l_partkey", F.col("l_shipdate").cast("date").alias("day"))
    return lines.join(t.orders.select("o_orderkey", "o_custkey"), "o_orderkey").withColumnRenamed("o_orderkey", "visit_order")


VISITS = "SELECT l_orderkey AS visit_order, l_linenumber, l_partkey, l_shipdate::DATE AS day, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey"


@query(
    "c01_inner_equi_join",
    """SELECT l_orderkey, l_linenumber, l_partkey, o_orderstatus, s_name FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    JOIN supplier ON s_suppkey = l_suppkey""",
)
def _(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).join(t.supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", "o_orderstatus", "s_name")


@query(
    "c02_lookup_chain",
    """SELECT o_orderkey, c_name, n_name, coalesce(r_name, 'Unknown') AS r_name FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND c_acctbal > 0
    LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey""",
)
def _(t: Tables) -> DataFrame:
    people = t.customer.filter("c_acctbal > 0").select(F.col("c_custkey").alias("o_custkey"), "c_name", F.col("c_nationkey").alias("n_nationkey"))
    out = joins.lookup(t.orders, people, ["o_custkey"], ["c_name", "n_nationkey"])
    out = joins.lookup(out, t.nation.withColumnRenamed("n_regionkey", "r_regionkey"), ["n_nationkey"], ["n_name", "r_regionkey"])
    out = joins.lookup(out, t.region, ["r_regionkey"], ["r_name"], {"r_name": "Unknown"})
    return out.select("o_orderkey", "c_name", "n_name", "r_name")


@query(
    "c03_full_outer_align",
    """SELECT day::VARCHAR AS day, clicks, errors, orders FROM (SELECT ts::DATE AS day, count(*) AS clicks FROM events WHERE event_type = 'click' GROUP BY 1)
    FULL JOIN (SELECT ts::DATE AS day, count(*) AS errors FROM events WHERE event_type = 'error' GROUP BY 1) USING (day)
    FULL JOIN (SELECT (o_orderdate + INTERVAL 24 YEAR)::DATE AS day, count(*) AS orders FROM orders GROUP BY 1) USING (day)""",
)
def _(t: Tables) -> DataFrame:
    day, n = F.col("ts").cast("date").alias("day"), F.count(F.lit(1))
    clicks = t.events.filter(F.col("event_type") == "click").groupBy(day).agg(n.alias("clicks"))
    errors = t.events.filter(F.col("event_type") == "error").groupBy(day).agg(n.alias("errors"))
    orders = t.orders.groupBy(F.add_months(F.col("o_orderdate").cast("date"), 288).alias("day")).agg(n.alias("orders"))
    return joins.outer_align([clicks, errors, orders], ["day"])


@query(
    "c04_densify_grid",
    """SELECT o_orderpriority, m::DATE::VARCHAR AS month, coalesce(n, 0) AS n FROM (SELECT DISTINCT o_orderpriority FROM orders)
    CROSS JOIN (SELECT unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2001-12-01', INTERVAL 1 MONTH)) AS m)
    LEFT JOIN (SELECT o_orderpriority, date_trunc('month', o_orderdate)::TIMESTAMP AS m, count(*) AS n FROM orders GROUP BY ALL) USING (o_orderpriority, m)""",
)
def _(t: Tables) -> DataFrame:
    counts = t.orders.groupBy("o_orderpriority", F.trunc("o_orderdate", "month").alias("month")).agg(F.count(F.lit(1)).alias("n"))
    low, high = F.lit("1994-01-01").cast("date"), F.lit("2001-12-01").cast("date")
    return joins.densify(counts, ["o_orderpriority"], "month", low, high, ["n"])


@query("c05_semi_join", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 400000)")
def _(t: Tables) -> DataFrame:
    big = t.orders.filter("o_totalprice > 400000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey", "c_name")


@query("c06_anti_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 400000)")
def _(t: Tables) -> DataFrame:
    big = t.orders.filter("o_totalprice > 400000")
    return t.customer.join(big, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


@query(
    "c07_interval_containment",
    f"""SELECT v.visit_order, v.l_linenumber, v.l_partkey, v.day::VARCHAR AS day, s.o_orderkey FROM ({VISITS}) v
    LEFT JOIN ({SPELLS}) s ON s.o_custkey = v.o_custkey AND v.day BETWEEN s.start AND s.stop""",
)
def _(t: Tables) -> DataFrame:
    out = joins.join_interval(visits(t), spells(t), ["o_custkey"], "day", "start", "stop", width_days=8, how="left")
    return out.select("visit_order", "l_linenumber", "l_partkey", "day", "o_orderkey")


@query(
    "c08_equi_plus_inequality",
    "SELECT l_orderkey, l_linenumber, l_partkey, o_custkey FROM lineitem JOIN orders ON o_orderkey = l_orderkey AND o_orderdate + INTERVAL 30 DAY <= l_shipdate",
)
def _(t: Tables) -> DataFrame:
    on = (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("o_orderdate") + F.expr("interval 30 days") <= F.col("l_shipdate"))
    return t.lineitem.join(t.orders, on).select("l_orderkey", "l_linenumber", "l_partkey", "o_custkey")


@query(
    "c09_asof_last",
    f"""SELECT visit_order, l_linenumber, l_partkey, v.day::VARCHAR AS day, s.stop::VARCHAR AS stop, s.o_orderkey FROM ({VISITS}) v
    LEFT JOIN LATERAL (SELECT stop, o_orderkey FROM ({SPELLS}) s WHERE s.o_custkey = v.o_custkey AND s.stop < v.day ORDER BY stop DESC, o_orderkey DESC LIMIT 1) s ON true""",
)
def _(t: Tables) -> DataFrame:
    out = joins.asof_last(visits(t), spells(t), ["o_custkey"], "day", "stop", "o_orderkey", [])
    return out.select("visit_order", "l_linenumber", "l_partkey", "day", "stop", "o_orderkey")


@query(
    "c10_nearest_candidate",
    """SELECT event_id, near.id AS login_id, date_diff('second', near.t, e.ts) AS seconds FROM (SELECT * FROM events WHERE event_type = 'purchase') e
    LEFT JOIN LATERAL (SELECT event_id AS id, ts AS t FROM events l WHERE l.event_type = 'signup' AND l.user_id = e.user_id AND l.ts <= e.ts
    ORDER BY ts DESC, event_id DESC LIMIT 1) near ON true""",
)
def _(t: Tables) -> DataFrame:
    bought = t.events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    logins = t.events.filter("event_type = 'signup'").select(F.col("event_id").alias("login_id"), "user_id", F.col("ts").alias("login_ts"))
    out = joins.nearest_before(bought, logins, ["user_id"], "ts", "login_ts", "login_id")
    return out.select("event_id", "login_id", diff_boundary("second", "login_ts", "ts").alias("seconds"))


@query(
    "c11_next_non_null",
    """SELECT event_id, coalesce(v, first_value(v IGNORE NULLS) OVER (PARTITION BY user_id, d ORDER BY ts, event_id ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING),
    d + TIME '23:59:59') AS logout FROM (SELECT event_id, user_id, ts, ts::DATE AS d, CASE WHEN event_type IN ('click', 'error') THEN ts END AS v FROM events)""",
)
def _(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", "ts", F.col("ts").cast("date").alias("d"), F.when(F.col("event_type").isin("click", "error"), F.col("ts")).alias("v"))
    out = ordered.next_value(e, ["user_id", "d"], ["ts", "event_id"], "v", "nxt")
    end_of_day = F.col("d").cast("timestamp_ntz") + F.expr("interval '23:59:59' hour to second")
    return out.select("event_id", F.coalesce("nxt", end_of_day).alias("logout"))


LINK = f"""WITH ep AS (SELECT l_orderkey * 100 + l_linenumber AS ep, l_orderkey, o_custkey, l_suppkey % 20 AS grp, l_shipdate::DATE AS day
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey QUALIFY row_number() OVER (PARTITION BY ep ORDER BY day, grp) = 1),
    sp AS (SELECT o_orderkey, o_custkey, o_custkey % 20 AS grp, o_orderdate::DATE AS start, o_orderdate::DATE + (o_orderkey % 40)::INT AS stop FROM orders)"""


def episodes(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    e = joined.select(
        (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("ep"),
        "l_orderkey",
        "o_custkey",
        (F.col("l_suppkey") % 20).alias("grp"),
        F.col("l_shipdate").cast("date").alias("day"),
    )
    return keys.latest_per_key(e, ["ep"], ["day", "grp"])


@query(
    "c12_waterfall_link",
    LINK
    + """, p1 AS (SELECT ep, s.o_orderkey, s.start, s.stop FROM ep JOIN sp s ON s.o_custkey = ep.o_custkey AND s.grp = ep.grp AND ep.day BETWEEN s.start - 1 AND s.stop
    QUALIFY row_number() OVER (PARTITION BY ep ORDER BY abs(ep.day - s.start), s.stop - s.start DESC, s.o_orderkey) = 1),
    p2 AS (SELECT ep, s.o_orderkey, s.start, s.stop FROM ep JOIN sp s ON s.o_custkey = ep.o_custkey AND ep.day BETWEEN s.start - 1 AND s.stop
    WHERE ep NOT IN (SELECT ep FROM p1) QUALIFY row_number() OVER (PARTITION BY ep ORDER BY abs(ep.day - s.start), s.stop - s.start DESC, s.o_orderkey) = 1),
    p3 AS (SELECT ep, s.o_orderkey, s.start, s.stop FROM ep JOIN sp s ON s.o_orderkey = ep.l_orderkey AND ep.day BETWEEN s.start - 1 AND s.stop
    WHERE ep NOT IN (SELECT ep FROM p1) AND ep NOT IN (SELECT ep FROM p2))
    SELECT ep, f.o_orderkey, f.pass_no::INT AS pass_no FROM ep LEFT JOIN (SELECT *, 1 AS pass_no FROM p1 UNION ALL SELECT *, 2 FROM p2 UNION ALL SELECT *, 3 FROM p3) f USING (ep)""",
)
def _(t: Tables) -> DataFrame:
    ep, sp = materialise(episodes(t), "episodes"), spells(t).withColumn("grp", F.col("o_custkey") % 20)

    def held(left: DataFrame, on: list[str]) -> DataFrame:
        return joins.nearest_containing(left, "ep", sp, on, "day", "start", "stop", "o_orderkey", "1 day")

    own = joins.nearest_containing(ep.withColumn("own", F.col("l_orderkey")), "ep", sp.withColumn("own", F.col("o_orderkey")), ["own"], "day", "start", "stop", "o_orderkey", "1 day")
    order = [F.col("_off").asc(), F.col("_stay").desc(), F.col("o_orderkey").asc()]
    out = joins.waterfall_link(ep, "ep", [held(ep, ["o_custkey", "grp"]), held(ep, ["o_custkey"]), own], order)
    return out.select("ep", "o_orderkey", "pass_no")


PREFIX = """WITH ref AS (SELECT code, min(area) AS area FROM (SELECT replace(p_name, ' ', '') || ' ' || right('000' || (p_partkey % 40), 3) AS code, p_brand AS area
    FROM part WHERE p_size < 6) GROUP BY ALL), bare AS (SELECT trim(code) AS full_key, replace(trim(code), ' ', '') AS b, area FROM ref),
    q AS (SELECT p_partkey, replace(p_name, ' ', '') || CASE WHEN p_partkey % 2 = 0 THEN ' ' ELSE '' END || right('000' || (p_partkey % 60), 3) AS k FROM part),
    f AS (SELECT full_key AS form, min(area) AS area FROM bare GROUP BY 1), b0 AS (SELECT b AS form, min(area) AS area FROM bare GROUP BY 1),
    b7 AS (SELECT left(b, 7) AS form, min(area) AS area FROM bare WHERE len(b) >= 7 GROUP BY 1), b6 AS (SELECT left(b, 6) AS form, min(area) AS area FROM bare WHERE len(b) >= 6 GROUP BY 1),
    b5 AS (SELECT left(b, 5) AS form, min(area) AS area FROM bare WHERE len(b) >= 5 GROUP BY 1), b4 AS (SELECT left(b, 4) AS form, min(area) AS area FROM bare WHERE len(b) >= 4 GROUP BY 1)
    SELECT p_partkey, coalesce(f.area, b0.area, b7.area, b6.area, b5.area, b4.area) AS area FROM q LEFT JOIN f ON f.form = trim(k)
    LEFT JOIN b0 ON b0.form = replace(trim(k), ' ', '') LEFT JOIN b7 ON b7.form = left(replace(k, ' ', ''), 7) LEFT JOIN b6 ON b6.form = left(replace(k, ' ', ''), 6)
    LEFT JOIN b5 ON b5.form = left(replace(k, ' ', ''), 5) LEFT JOIN b4 ON b4.form = left(replace(k, ' ', ''), 4)"""


@query(
    "c12_nearest_in_crowd",
    """WITH spans AS (SELECT o_orderkey, o_orderkey % 5 AS k, o_orderdate::DATE AS a, o_orderdate::DATE + (o_custkey % 400)::INT AS b FROM orders),
    asks AS (SELECT DISTINCT l_suppkey % 5 AS k, l_shipdate::DATE AS d FROM lineitem),
    best AS (SELECT asks.k, d, min(struct_pack(off := abs(d - a), short := a - b, id := o_orderkey)) AS w FROM asks JOIN spans ON asks.k = spans.k AND d BETWEEN a - 1 AND b GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, w.id AS o_orderkey, w.off::INT AS off, (-w.short * 86400)::BIGINT AS stay
    FROM lineitem JOIN best ON l_suppkey % 5 = k AND l_shipdate::DATE = d""",
)
def _(t: Tables) -> DataFrame:
    """Five keys with all orders between them, hundreds of which are open on any day."""
    row = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("row")
    asks = t.lineitem.select(row, (F.col("l_suppkey") % 5).alias("k"), F.to_date("l_shipdate").alias("d"))
    first = F.to_date("o_orderdate")
    spans = t.orders.select("o_orderkey", (F.col("o_orderkey") % 5).alias("k"), first.alias("a"), F.date_add(first, (F.col("o_custkey") % 400).cast("int")).alias("b"))
    out = joins.nearest_in_crowd(asks, "row", spans, ["k"], "d", "a", "b", "o_orderkey", "1 day")
    return out.select("row.*", "o_orderkey", F.col("_off").alias("off"), F.col("_stay").cast("long").alias("stay"))


@query("c13_prefix_lookup", PREFIX)
def _(t: Tables) -> DataFrame:
    name = F.replace(F.col("p_name"), F.lit(" "), F.lit(""))

    def tail(n: int):
        return F.lpad((F.col("p_partkey") % n).cast("string"), 3, "0")

    ref = t.part.filter("p_size < 6").select(F.concat(name, F.lit(" "), tail(40)).alias("code"), F.col("p_brand").alias("area"))
    gap = F.when(F.col("p_partkey") % 2 == 0, " ").otherwise("")
    asked = t.part.select("p_partkey", F.concat(name, gap, tail(60)).alias("k"))
    return joins.prefix_lookup(asked, ref, "k", "code", "area").select("p_partkey", "area")


@query(
    "c14_prefix_to_prefix",
    """SELECT p_partkey, brands FROM part LEFT JOIN (SELECT left(p_name, 4) AS pre, count(DISTINCT p_brand) AS brands FROM part WHERE p_size > 45 GROUP BY 1) ON pre = left(p_name, 4)""",
)
def _(t: Tables) -> DataFrame:
    pre = F.left(F.col("p_name"), F.lit(4)).alias("pre")
    ref = t.part.filter("p_size > 45").groupBy(pre).agg(F.count_distinct("p_brand").alias("brands"))
    return t.part.select("p_partkey", pre).join(keys.shuffled_apart(ref, ["pre"]), "pre", "left").select("p_partkey", "brands")


@query(
    "c15_flatten_hierarchy",
    """WITH RECURSIVE edges AS (SELECT c_custkey AS child, c_custkey // 4 AS parent FROM customer WHERE c_custkey > 0 AND c_custkey % 11 <> 0), up AS (
    SELECT c_custkey AS node, c_custkey AS cur, 1 AS lvl FROM customer UNION ALL SELECT node, parent, lvl + 1 FROM up JOIN edges ON child = cur WHERE lvl < 7)
    SELECT node AS level_1, max(CASE WHEN lvl = 2 THEN cur END) AS level_2, max(CASE WHEN lvl = 3 THEN cur END) AS level_3, max(CASE WHEN lvl = 4 THEN cur END) AS level_4,
    max(CASE WHEN lvl = 5 THEN cur END) AS level_5, max(CASE WHEN lvl = 6 THEN cur END) AS level_6, max(CASE WHEN lvl = 7 THEN cur END) AS level_7 FROM up GROUP BY node""",
)
def _(t: Tables) -> DataFrame:
    valid = t.customer.filter("c_custkey > 0 AND c_custkey % 11 <> 0")
    edges = valid.select(F.col("c_custkey").alias("child"), F.expr("c_custkey div 4").alias("parent"))
    return joins.flatten_hierarchy(t.customer, edges, "c_custkey", "child", "parent", 7)


@query(
    "c15_top_ancestors",
    """WITH RECURSIVE e AS (SELECT c_custkey AS child, CASE c_custkey WHEN 11 THEN 12 WHEN 12 THEN 11 ELSE c_custkey // 2 END AS parent FROM customer WHERE c_custkey % 97 <> 5),
    line(node, top, depth) AS (SELECT child, parent, 1 FROM e UNION ALL SELECT node, parent, depth + 1 FROM line JOIN e ON child = top WHERE depth < 64),
    last AS (SELECT node, max(depth) AS depth, arg_max(top, depth) AS top FROM line GROUP BY node)
    SELECT node, CASE WHEN depth < 64 THEN top END AS top, CASE WHEN depth < 64 THEN depth END::BIGINT AS depth, depth = 64 AS cyclic FROM last""",
)
def _(t: Tables) -> DataFrame:
    """Customers in lines of any depth, two of them each other's parent."""
    key = F.col("c_custkey")
    parent = F.when(key == 11, 12).when(key == 12, 11).otherwise(F.floor(key / 2)).cast(t.customer.schema["c_custkey"].dataType)
    return joins.top_ancestors(t.customer.filter(key % 97 != 5).select(key.alias("child"), parent.alias("parent")), "child", "parent")


@query(
    "c16_latest_reference",
    """SELECT o_orderkey, description FROM orders LEFT JOIN (SELECT p_partkey AS code, p_name AS description FROM part WHERE p_size > 25) ON code = o_orderkey % 2000""",
)
def _(t: Tables) -> DataFrame:
    dictionary = t.part.select(F.col("p_partkey").alias("code"), F.col("p_name").alias("description"), (F.col("p_size") > 25).cast("int").alias("is_latest"))
    ref = keys.latest_ref(dictionary)
    return t.orders.withColumn("code", F.col("o_orderkey") % 2000).join(ref, "code", "left").select("o_orderkey", "description")


@query(
    "c17_validity_period",
    f"""SELECT o_orderkey, o_custkey FROM (SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 <> 0 THEN start END AS start, CASE WHEN o_orderkey % 5 <> 0 THEN stop END AS stop
    FROM ({SPELLS})) WHERE (start IS NULL OR start <= DATE '1998-06-30') AND (stop IS NULL OR stop >= DATE '1998-06-30')""",
)
def _(t: Tables) -> DataFrame:
    s = spells(t).withColumns({"start": F.when(F.col("o_orderkey") % 7 != 0, F.col("start")), "stop": F.when(F.col("o_orderkey") % 5 != 0, F.col("stop"))})
    return joins.effective_at(s, "start", "stop", F.lit("1998-06-30").cast("date")).select("o_orderkey", "o_custkey")


@query(
    "c18_code_redirect",
    """SELECT c_custkey, n_name FROM (SELECT c_custkey, coalesce(new_code, c_nationkey) AS code FROM customer
    LEFT JOIN (SELECT n_nationkey AS old_code, n_nationkey + 1 AS new_code FROM nation WHERE n_nationkey % 5 = 0) ON old_code = c_nationkey) JOIN nation ON n_nationkey = code""",
)
def _(t: Tables) -> DataFrame:
    changes = t.nation.filter("n_nationkey % 5 = 0").select(F.col("n_nationkey").alias("old_code"), (F.col("n_nationkey") + 1).alias("new_code"))
    out = joins.redirect_codes(t.customer, "c_nationkey", changes, "old_code", "new_code", "code")
    return out.join(t.nation, F.col("code") == F.col("n_nationkey")).select("c_custkey", "n_name")


@query(
    "c19_one_row_per_key",
    """SELECT c_custkey, o_orderkey FROM customer LEFT JOIN (SELECT o_custkey, o_orderkey FROM orders
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) = 1) ON o_custkey = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    one = keys.one_per_key(t.orders, ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey").asc()])
    return t.customer.join(one, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query(
    "c20_enrich_from_join",
    """SELECT o_orderkey, coalesce(status, flag) AS status FROM (SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders) LEFT JOIN (SELECT l_orderkey, l_returnflag AS flag
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_returnflag) = 1) ON l_orderkey = o_orderkey""",
)
def _(t: Tables) -> DataFrame:
    base = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    ref = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_returnflag").alias("status"), "l_shipdate")
    return joins.enrich(base, ref, ["o_orderkey"], ["status"], [F.col("l_shipdate").desc(), F.col("status").asc()])


@query(
    "c21_unpivot_slots",
    """SELECT o_orderkey, pos::INT AS pos, value FROM (SELECT o_orderkey, unnest([1, 2, 3]) AS pos, unnest([o_orderpriority, nullif(o_orderstatus, 'P'), o_custkey::VARCHAR]) AS value
    FROM orders) WHERE value IS NOT NULL""",
)
def _(t: Tables) -> DataFrame:
    wide = t.orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("s1"), F.nullif("o_orderstatus", F.lit("P")).alias("s2"), F.col("o_custkey").cast("string").alias("s3")
    )
    return unpivot_slots(wide, ["o_orderkey"], ["s1", "s2", "s3"])


@query(
    "c21_explode_list",
    "SELECT p_partkey, generate_subscripts(parts, 1)::INT AS pos, unnest(parts) AS value FROM (SELECT p_partkey, string_split(p_name, ' ') AS parts FROM part)",
)
def _(t: Tables) -> DataFrame:
    return explode_list(t.part, ["p_partkey"], "p_name", " ")


@query("c22_checked_broadcast", "SELECT s_suppkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey")
def _(t: Tables) -> DataFrame:
    small = joins.checked_broadcast(t.nation)
    return t.supplier.join(small, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name")


@query(
    "c23_exclude_other_feeds",
    """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey AND month(o_orderdate) = month(l_shipdate))""",
)
def _(t: Tables) -> DataFrame:
    other = t.orders.select(F.col("o_orderkey").alias("l_orderkey"), F.month("o_orderdate").alias("month"))
    lines = t.lineitem.withColumn("month", F.month("l_shipdate"))
    return lines.join(other, ["l_orderkey", "month"], "left_anti").select("l_orderkey", "l_linenumber", "l_partkey")


@query(
    "c24_key_reduction",
    """SELECT l_orderkey, round(sum(l_extendedprice), 2) AS total FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderdate >= TIMESTAMP '2001-06-01') GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    cohort = t.orders.filter(F.col("o_orderdate") >= at(2001, 6, 1)).select(F.col("o_orderkey").alias("l_orderkey"))
    return keys.restrict_to_keys(t.lineitem, cohort, ["l_orderkey"]).groupBy("l_orderkey").agg(F.round(F.sum("l_extendedprice"), 2).alias("total"))


@query(
    "c25_value_changes",
    """SELECT c_custkey, 'c_mktsegment' AS attribute, CASE WHEN c_custkey % 5 = 0 THEN 'MOVED' ELSE c_mktsegment END AS current_value, c_mktsegment AS historic_value FROM customer
    WHERE c_custkey % 5 = 0 UNION ALL SELECT c_custkey, 'c_nationkey', (c_nationkey + 1)::VARCHAR, c_nationkey::VARCHAR FROM customer WHERE c_custkey % 7 = 0""",
)
def _(t: Tables) -> DataFrame:
    now = t.customer.withColumns(
        {
            "c_mktsegment": F.when(F.col("c_custkey") % 5 == 0, "MOVED").otherwise(F.col("c_mktsegment")),
            "c_nationkey": F.col("c_nationkey") + (F.col("c_custkey") % 7 == 0).cast("int"),
        }
    )
    return joins.value_changes(now, t.customer, ["c_custkey"], ["c_name", "c_mktsegment", "c_nationkey"])


@query(
    "c26_correlated_scalar",
    "SELECT c_custkey, (SELECT count(*) FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'O') AS open_orders, (SELECT max(o_totalprice) FROM orders WHERE o_custkey = c_custkey) AS top FROM customer",
)
def _(t: Tables) -> DataFrame:
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_orderstatus") == "O").alias("open_orders"), F.max("o_totalprice").alias("top"))
    return t.customer.join(per, "c_custkey", "left").select("c_custkey", F.coalesce("open_orders", F.lit(0)).alias("open_orders"), "top")


@query(
    "c27_constant_condition",
    "SELECT o_orderkey, date_diff('day', o_orderdate::DATE, m::DATE) AS age FROM orders CROSS JOIN (SELECT max(o_orderdate) AS m FROM orders)",
)
def _(t: Tables) -> DataFrame:
    last = t.orders.agg(F.max("o_orderdate")).scalar()
    return t.orders.select("o_orderkey", F.datediff(last, "o_orderdate").alias("age"))


@query(
    "c28_join_by_domain",
    """SELECT event_id, coalesce(c_name, s_name) AS actor FROM events LEFT JOIN customer ON event_type = 'click' AND c_custkey = user_id
    LEFT JOIN supplier ON event_type = 'view' AND s_suppkey = event_id % 100 WHERE event_type IN ('click', 'view')""",
)
def _(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "event_type", "user_id", (F.col("event_id") % 100).alias("s_ref"))
    people = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_name").alias("actor"))
    firms = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("actor"))
    out = joins.union_by_domain(e, "event_type", {"click": (people, "user_id"), "view": (firms, "s_ref")}, "id", ["actor"])
    return out.select("event_id", "actor")


@query(
    "c29_previous_row_self_join",
    """SELECT o_orderkey, lag(o_orderkey) OVER w AS prev_order, lead(o_totalprice) OVER w AS next_price FROM orders WINDOW w AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey)""",
)
def _(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_totalprice")
    span, order = ["o_custkey"], ["o_orderdate", "o_orderkey"]
    out = ordered.scan(o, span, order, before={"prev_order": F.col("o_orderkey")}, after={"next_price": F.col("o_totalprice")})
    return out.select("o_orderkey", "prev_order", "next_price")
