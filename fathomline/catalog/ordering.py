"""Windows, sorts and set operations on the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.aggs import LOGINS, logins
from fathomline.catalog.registry import Tables, query
from fathomline.functions.dates import diff_boundary
from fathomline.functions.text import map_codes
from fathomline.operators import keys, ordered, sessions
from fathomline.sources.tables import merge_layouts

def month() -> Column:
    return F.trunc("o_orderdate", "month")

def day_of() -> Column:
    return F.col("ts").cast("date")

BY_DATE = ["o_orderdate", "o_orderkey"]


def orders(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus", "o_totalprice")


def events(t: Tables) -> DataFrame:
    return t.events.select("event_id", "user_id", "ts", "event_type")


@query("e01_latest_per_key", "SELECT o_custkey, o_orderkey, o_orderdate FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1")
def _(t: Tables) -> DataFrame:
    return keys.latest_per_key(t.orders.select("o_custkey", "o_orderkey", "o_orderdate"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query("e02_sequence_per_key", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS seq FROM orders")
def _(t: Tables) -> DataFrame:
    return ordered.sequence(orders(t), ["o_custkey"], BY_DATE, "seq").select("o_orderkey", "seq")


@query(
    "e03_sequence_of_flagged",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN row_number() OVER (PARTITION BY o_custkey, o_orderstatus = 'F' ORDER BY o_orderdate, o_orderkey) END AS seq FROM orders""",
)
def _(t: Tables) -> DataFrame:
    return ordered.sequence(orders(t), ["o_custkey"], BY_DATE, "seq", where=F.col("o_orderstatus") == "F").select("o_orderkey", "seq")


@query("e04_rank_with_gaps", "SELECT o_orderkey, rank() OVER (PARTITION BY o_custkey ORDER BY date_trunc('month', o_orderdate)) AS rnk FROM orders")
def _(t: Tables) -> DataFrame:
    o = orders(t).withColumn("month", month())
    return ordered.rank_per_key(o, ["o_custkey"], "month", "rnk").select("o_orderkey", "rnk")


@query("e05_dense_rank", "SELECT event_id, dense_rank() OVER (PARTITION BY user_id ORDER BY date_trunc('week', ts) DESC) AS week_no FROM events")
def _(t: Tables) -> DataFrame:
    e = events(t).withColumn("week", F.date_trunc("week", "ts").cast("date"))
    return ordered.dense_rank_per_key(e, ["user_id"], "week", "week_no", descending=True).select("event_id", "week_no")


@query(
    "e06_gap_since_previous",
    "SELECT o_orderkey, date_diff('day', lag(o_orderdate::DATE) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), o_orderdate::DATE) AS gap FROM orders",
)
def _(t: Tables) -> DataFrame:
    return ordered.gap_since_previous(orders(t), ["o_custkey"], BY_DATE, "o_orderdate", "gap").select("o_orderkey", "gap")


@query("e07_next_value", "SELECT event_id, lead(event_type) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS next_type FROM events")
def _(t: Tables) -> DataFrame:
    return ordered.following(events(t), ["user_id"], ["ts", "event_id"], {"next_type": F.col("event_type")}).select("event_id", "next_type")


@query("e08_group_maximum", "SELECT o_orderkey, max(o_totalprice) OVER (PARTITION BY o_custkey) AS top FROM orders")
def _(t: Tables) -> DataFrame:
    return keys.beside(orders(t), ["o_custkey"], {"top": F.max("o_totalprice")}).select("o_orderkey", "top")


@query(
    "e09_order_by_case",
    """SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey
    ORDER BY CASE o_orderstatus WHEN 'P' THEN 1 WHEN 'O' THEN 2 ELSE 3 END, o_orderdate DESC, o_orderkey) = 1""",
)
def _(t: Tables) -> DataFrame:
    place = F.when(F.col("o_orderstatus") == "P", 1).when(F.col("o_orderstatus") == "O", 2).otherwise(3)
    return keys.latest_per_key(orders(t), ["o_custkey"], [place, F.col("o_orderdate").desc(), F.col("o_orderkey")]).select("o_custkey", "o_orderkey")


@query("e10_global_sequence", "SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS seq FROM events")
def _(t: Tables) -> DataFrame:
    return ordered.global_sequence(events(t), ["ts", "event_id"], "seq").select("event_id", "seq")


@query(
    "e11_conditional_sequence",
    """SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN row_number() OVER (PARTITION BY user_id, event_type IN ('click', 'view') ORDER BY ts, event_id) END AS passive_seq,
    CASE WHEN event_type NOT IN ('click', 'view') THEN row_number() OVER (PARTITION BY user_id, event_type IN ('click', 'view') ORDER BY ts, event_id) END AS active_seq FROM events""",
)
def _(t: Tables) -> DataFrame:
    passive = F.col("event_type").isin("click", "view")
    measures = {"passive_seq": ("sum", passive.cast("long")), "active_seq": ("sum", (~passive).cast("long"))}
    out = ordered.running(events(t), ["user_id"], ["ts", "event_id"], measures)
    return out.select("event_id", F.when(passive, F.col("passive_seq")).alias("passive_seq"), F.when(~passive, F.col("active_seq")).alias("active_seq"))


ISLANDS = """SELECT user_id, min(ts) AS start_time, max(ts) AS end_time, count(*) AS events FROM (SELECT user_id, ts, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS isl
    FROM (SELECT user_id, ts, event_id, CASE WHEN date_diff('minute', lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), ts) <= {gap} THEN 0 ELSE 1 END AS brk FROM events)) GROUP BY user_id, isl"""


@query("e12_islands", ISLANDS.format(gap=600))
def _(t: Tables) -> DataFrame:
    out = ordered.islands(events(t), ["user_id"], ["ts", "event_id"], lambda a, b: diff_boundary("minute", a, b) > 600, "ts")
    return out.drop("island")


@query("e12_islands_short_gap", ISLANDS.format(gap=5))
def _(t: Tables) -> DataFrame:
    out = ordered.islands(events(t), ["user_id"], ["ts", "event_id"], lambda a, b: diff_boundary("minute", a, b) > 5, "ts")
    return out.drop("island")


@query(
    "e13_session_merge_full",
    f"""SELECT user_id, min(ts) AS start_time, max(u) AS end_time, count(*) AS rows_merged FROM (SELECT user_id, ts, u, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS ses FROM (
    SELECT user_id, event_id, ts, u, CASE WHEN ts <= max(u) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS brk
    FROM (SELECT *, coalesce(stop, ts) AS u FROM ({LOGINS})))) GROUP BY user_id, ses""",
)
def _(t: Tables) -> DataFrame:
    return sessions.merge_sessions(logins(t), ["user_id"], "ts", "stop", ["ts", "event_id"]).drop("session")


@query(
    "e13_session_merge_pairwise",
    f"""SELECT event_id, absorbed::INT AS absorbed, final_end, CASE WHEN stop IS NOT NULL THEN date_diff('second', ts, final_end) END AS seconds,
    CASE WHEN stop IS NOT NULL THEN date_diff('second', ts, final_end) // 60 END AS minutes FROM (SELECT event_id, ts, stop,
    CASE WHEN lag(stop) OVER w >= ts THEN 1 ELSE 0 END AS absorbed, CASE WHEN lead(ts) OVER w <= stop THEN greatest(stop, lead(stop) OVER w) ELSE coalesce(stop, lead(ts) OVER w) END AS final_end
    FROM ({LOGINS}) WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))""",
)
def _(t: Tables) -> DataFrame:
    out = sessions.merge_sessions(logins(t), ["user_id"], "ts", "stop", ["ts", "event_id"], mode="pairwise")
    return out.select("event_id", "absorbed", "final_end", "seconds", "minutes")


@query(
    "e14_version_flags",
    """SELECT event_id, CASE WHEN event_id = min(event_id) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END::INT AS first_version,
    CASE WHEN event_id = max(event_id) OVER (PARTITION BY user_id) THEN 1 ELSE 0 END::INT AS last_version FROM events""",
)
def _(t: Tables) -> DataFrame:
    return keys.version_flags(events(t), ["user_id"], "event_id").select("event_id", "first_version", "last_version")


@query(
    "e15_action_order",
    """SELECT event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS action_no, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS type_no FROM events""",
)
def _(t: Tables) -> DataFrame:
    order = ["ts", "event_id"]
    out = ordered.sequence(events(t), ["user_id"], order, "action_no")
    return ordered.sequence(out, ["user_id", "event_type"], order, "type_no").select("event_id", "action_no", "type_no")


@query("e16_sequence_per_day", "SELECT event_id, row_number() OVER (PARTITION BY user_id, ts::DATE ORDER BY ts, event_id) AS seq FROM events")
def _(t: Tables) -> DataFrame:
    e = events(t).withColumn("day", day_of())
    return ordered.sequence(e, ["user_id", "day"], ["ts", "event_id"], "seq").select("event_id", "seq")


@query(
    "e17_drop_repeats",
    "SELECT min(event_id) AS event_id, user_id, event_type, ts::DATE::VARCHAR AS day FROM events GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    e = events(t).withColumn("day", day_of())
    return keys.drop_repeats(e, ["user_id", "event_type", "day"], ["event_id"]).select("event_id", "user_id", "event_type", "day")


@query("f01_multi_key_sort", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders ORDER BY o_custkey, o_orderdate DESC, o_orderkey")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_custkey", "o_orderdate", "o_orderkey").orderBy("o_custkey", F.col("o_orderdate").desc(), "o_orderkey")


@query(
    "f02_business_order",
    """SELECT o_orderpriority, count(*) AS n FROM orders GROUP BY 1 ORDER BY CASE o_orderpriority WHEN '5-LOW' THEN 1 WHEN '1-URGENT' THEN 2 ELSE 3 END, o_orderpriority""",
)
def _(t: Tables) -> DataFrame:
    place = map_codes("o_orderpriority", {"5-LOW": 1, "1-URGENT": 2}, 3)
    return t.orders.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n")).orderBy(place, "o_orderpriority")


@query("f03_null_placement", "SELECT o_orderkey, nullif(o_orderstatus, 'P') AS status FROM orders ORDER BY 2 DESC NULLS LAST, 1")
def _(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", F.nullif("o_orderstatus", F.lit("P")).alias("status"))
    return o.orderBy(F.col("status").desc_nulls_last(), "o_orderkey")


@query("f04_top_n", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(20)


@query("f05_top_one_per_group", "SELECT c_custkey, (SELECT o_orderkey FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) AS o_orderkey FROM customer")
def _(t: Tables) -> DataFrame:
    top = keys.top_per_key(orders(t), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    return t.customer.join(top, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", "o_orderkey")


@query("f06_last_id_suffix", "SELECT max(split_part(c_name, '#', 2)::BIGINT) AS last_id FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.agg(F.max(F.substring_index("c_name", "#", -1).cast("long")).alias("last_id"))


@query("g01_union_all", "SELECT o_custkey AS k, o_orderdate AS t FROM orders UNION ALL SELECT user_id, ts FROM events UNION ALL SELECT l_suppkey, l_shipdate FROM lineitem")
def _(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_custkey").alias("k"), F.col("o_orderdate").alias("t"))
    b = t.events.select(F.col("user_id").alias("k"), F.col("ts").alias("t"))
    return a.unionByName(b).unionByName(t.lineitem.select(F.col("l_suppkey").alias("k"), F.col("l_shipdate").alias("t")))


@query("g02_union_distinct", "SELECT o_custkey AS k FROM orders UNION SELECT user_id FROM events UNION SELECT c_custkey FROM customer")
def _(t: Tables) -> DataFrame:
    a, b, c = t.orders.select(F.col("o_custkey").alias("k")), t.events.select(F.col("user_id").alias("k")), t.customer.select(F.col("c_custkey").alias("k"))
    return a.union(b).union(c).distinct()


@query("g03_except_distinct", "SELECT c_custkey AS k FROM customer EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F'")
def _(t: Tables) -> DataFrame:
    return t.customer.select(F.col("c_custkey").alias("k")).subtract(t.orders.filter("o_orderstatus = 'F'").select("o_custkey"))


@query(
    "g04_union_missing_columns",
    "SELECT o_orderkey AS id, o_totalprice AS amount, NULL AS note FROM orders UNION ALL SELECT event_id, NULL, event_type FROM events",
)
def _(t: Tables) -> DataFrame:
    a = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("amount"))
    return a.unionByName(t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("note")), allowMissingColumns=True)


@query(
    "g05_merge_layouts",
    """SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer UNION SELECT s_suppkey, s_name, s_nationkey, NULL FROM supplier
    UNION SELECT c_custkey, c_name, c_nationkey, c_acctbal FROM customer WHERE c_acctbal < 0""",
)
def _(t: Tables) -> DataFrame:
    current = t.customer.select("c_custkey", "c_name", "c_nationkey", "c_acctbal")
    same = {c: c for c in current.columns}
    renamed = {"c_custkey": F.col("s_suppkey").cast("string"), "c_name": "s_name", "c_nationkey": F.col("s_nationkey").cast("string")}
    return merge_layouts(merge_layouts(current, t.supplier, renamed), current.filter("c_acctbal < 0"), same)
