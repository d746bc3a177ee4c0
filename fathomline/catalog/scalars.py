"""Scalar rules and table functions on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.registry import Tables, query
from fathomline.functions import dates, text
from fathomline.functions.rules import explode_list

# A compound id in the form the parsers meet: kind||order|customer|status
def compound_id() -> Column:
    return F.concat(F.lit("Order||"), "o_orderkey", F.lit("|"), "o_custkey", F.lit("|"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(F.lit("")))

COMPOUND_SQL = "'Order||' || o_orderkey || '|' || o_custkey || '|' || CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus ELSE '' END"


@query(
    "h01_trims",
    "SELECT p_partkey, ltrim(x, ' ') AS l, rtrim(x, ' ') AS r, trim(x, ' ') AS b FROM (SELECT p_partkey, '  ' || p_name || '   ' AS x FROM part)",
)
def _(t: Tables) -> DataFrame:
    x = F.concat(F.lit("  "), "p_name", F.lit("   "))
    return t.part.select("p_partkey", F.ltrim(x).alias("l"), F.rtrim(x).alias("r"), F.trim(x).alias("b"))


@query(
    "h02_left_right_length",
    """SELECT doc_id, left(text, 5) AS l, right(text, 7) AS r, substring(text, 3, 4) AS m, length(rtrim(text, ' ')) AS n FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id",
        F.left("text", F.lit(5)).alias("l"),
        F.right("text", F.lit(7)).alias("r"),
        F.substring("text", 3, 4).alias("m"),
        text.text_len("text").cast("long").alias("n"),
    )


@query("h03_position", "SELECT doc_id, strpos(lower(text), 'the') AS pos FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.position_of("THE", "text").cast("long").alias("pos"))


@query(
    "h04_replace",
    "SELECT doc_id, md5(replace(text, ',', ';')) AS literal, md5(regexp_replace(text, '[0-9]+', '#', 'g')) AS pattern FROM documents",
)
def _(t: Tables) -> DataFrame:
    swapped = F.md5(F.replace("text", F.lit(","), F.lit(";")))
    return t.documents.select("doc_id", swapped.alias("literal"), F.md5(F.regexp_replace("text", "[0-9]+", "#")).alias("pattern"))


@query("h05_after_last_separator", "SELECT page_id, list_last(string_split(url, '/')) AS tail FROM pages")
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.after_last("url", "/").alias("tail"))


@query("h06_case", "SELECT c_custkey, upper(c_name) AS u, lower(c_mktsegment) AS l FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.upper("c_name").alias("u"), F.lower("c_mktsegment").alias("l"))


@query("h07_stuff", "SELECT c_custkey, 'X' || chr(45) || substring(c_name, 9) AS code FROM customer")
def _(t: Tables) -> DataFrame:
    return t.customer.select("c_custkey", F.overlay("c_name", F.concat(F.lit("X"), F.chr(F.lit(45))), F.lit(1), F.lit(8)).alias("code"))


@query(
    "h08_null_concatenation",
    "SELECT o_orderkey, 'a' || nullif(o_orderstatus, 'P') AS strict, 'a' || coalesce(nullif(o_orderstatus, 'P'), '') AS guarded FROM orders",
)
def _(t: Tables) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("P"))
    return t.orders.select("o_orderkey", F.concat(F.lit("a"), status).alias("strict"), F.concat(F.lit("a"), F.coalesce(status, F.lit(""))).alias("guarded"))


@query("h09_like", "SELECT doc_id FROM documents WHERE text ILIKE '%ion%the%'")
def _(t: Tables) -> DataFrame:
    return t.documents.filter(F.col("text").ilike("%ION%the%")).select("doc_id")


@query("h10_first_item", "SELECT doc_id, split_part(text, ',', 1) AS first_part FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", text.first_item("text").alias("first_part"))


@query(
    "h11_nth_item",
    f"SELECT o_orderkey, nullif(list_extract(p, 3), '') AS third, nullif(list_extract(p, 5), '') AS fifth, nullif(list_extract(p, 6), '') AS sixth FROM (SELECT o_orderkey, string_split({COMPOUND_SQL}, '|') AS p FROM orders)",
)
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", *[text.nth_item(compound_id(), "|", n).alias(name) for n, name in ((3, "third"), (5, "fifth"), (6, "sixth"))])


@query(
    "h12_compound_id",
    f"SELECT try_cast(p[3] AS BIGINT) AS id, try_cast(p[5] AS BIGINT) AS bad, p[1] AS kind FROM (SELECT string_split({COMPOUND_SQL}, '|') AS p FROM orders)",
)
def _(t: Tables) -> DataFrame:
    return t.orders.select(
        text.number_after(compound_id(), "|", 3).alias("id"), text.number_after(compound_id(), "|", 5).alias("bad"), text.nth_item(compound_id(), "|", 1).alias("kind")
    )


@query("h13_split_to_rows", "SELECT doc_id, unnest(string_split(text, '.')) AS sentence FROM documents")
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.explode(text.split_items("text", ".")).alias("sentence"))


@query(
    "h14_key_comparison",
    """SELECT c_custkey, n_name FROM (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'nation_' ELSE 'NATION_' END || c_nationkey || CASE WHEN c_custkey % 3 = 0 THEN '  ' ELSE '' END AS k FROM customer)
    JOIN nation ON lower(rtrim(k)) = lower(rtrim(n_name))""",
)
def _(t: Tables) -> DataFrame:
    k = F.concat(
        F.when(F.col("c_custkey") % 2 == 0, "nation_").otherwise("NATION_"), F.col("c_nationkey"), F.when(F.col("c_custkey") % 3 == 0, "  ").otherwise("")
    )
    left = t.customer.select("c_custkey", text.normalise_key(k).alias("k"))
    return left.join(t.nation.withColumn("k", text.normalise_key("n_name")), "k").select("c_custkey", "n_name")


@query(
    "h15_conversions",
    """SELECT o_orderkey, strftime(o_orderdate, '%d/%m/%Y') AS british, strftime(o_orderdate, '%Y%m%d') AS compact, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS odbc,
    strptime(strftime(o_orderdate, '%d/%m/%Y'), '%d/%m/%Y')::DATE::VARCHAR AS back, try_cast(o_orderpriority[1] AS INT) AS num FROM orders""",
)
def _(t: Tables) -> DataFrame:
    d = "o_orderdate"
    return t.orders.select(
        "o_orderkey",
        F.date_format(d, "dd/MM/yyyy").alias("british"),
        F.date_format(d, "yyyyMMdd").alias("compact"),
        F.date_format(d, "yyyy-MM-dd HH:mm:ss").alias("odbc"),
        F.to_date(F.date_format(d, "dd/MM/yyyy"), "dd/MM/yyyy").alias("back"),
        F.left("o_orderpriority", F.lit(1)).try_cast("int").alias("num"),
    )


@query(
    "h16_null_functions",
    "SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'none') AS a, nullif(o_custkey, 0) AS b FROM orders",
)
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.coalesce(F.nullif("o_orderstatus", F.lit("P")), F.lit("none")).alias("a"), F.nullif("o_custkey", F.lit(0)).alias("b"))


@query(
    "h17_case_with_null",
    "SELECT o_orderkey, CASE WHEN nullif(o_orderstatus, 'P') = NULL THEN 'never' WHEN nullif(o_orderstatus, 'P') IS NULL THEN 'none' ELSE o_orderstatus END AS c FROM orders",
)
def _(t: Tables) -> DataFrame:
    status = F.nullif("o_orderstatus", F.lit("P"))
    return t.orders.select("o_orderkey", F.when(status == F.lit(None), "never").when(status.isNull(), "none").otherwise(status).alias("c"))


@query("h18_run_date_parameter", "SELECT o_orderkey, date_diff('day', o_orderdate::DATE, DATE '2001-12-31') AS age FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.datediff(F.lit(dt.date(2001, 12, 31)), "o_orderdate").cast("long").alias("age"))


@query(
    "h19_date_add",
    """SELECT event_id, (ts + INTERVAL 3 DAY)::DATE::VARCHAR AS d, (ts::DATE + INTERVAL 1 MONTH)::DATE::VARCHAR AS m, (ts::DATE + INTERVAL 13 MONTH)::DATE::VARCHAR AS y,
    ts + INTERVAL 5 HOUR AS h, ts - INTERVAL 90 SECOND AS s, (ts::DATE + INTERVAL 14 DAY)::DATE::VARCHAR AS w FROM events""",
)
def _(t: Tables) -> DataFrame:
    day = F.col("ts").cast("date")
    return t.events.select(
        "event_id",
        F.date_add(day, 3).alias("d"),
        F.add_months(day, 1).alias("m"),
        F.add_months(day, 13).alias("y"),
        (F.col("ts") + F.expr("interval 5 hours")).alias("h"),
        (F.col("ts") - F.expr("interval 90 seconds")).alias("s"),
        F.date_add(day, 14).alias("w"),
    )


@query("h20_diff_days", "SELECT l_orderkey, l_linenumber, l_partkey, date_diff('day', o_orderdate::DATE, l_shipdate::DATE) AS days FROM lineitem JOIN orders ON o_orderkey = l_orderkey")
def _(t: Tables) -> DataFrame:
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.select("l_orderkey", "l_linenumber", "l_partkey", dates.diff_boundary("day", "o_orderdate", "l_shipdate").cast("long").alias("days"))


@query(
    "h21_diff_boundaries",
    """SELECT event_id, date_diff('month', TIMESTAMP '2023-11-30 12:00:00', ts) AS months, date_diff('year', TIMESTAMP '2022-12-31', ts) AS years,
    date_diff('minute', TIMESTAMP '2024-01-01 00:00:30', ts) AS minutes, date_diff('hour', TIMESTAMP '2024-01-01 00:59:59', ts) AS hours FROM events""",
)
def _(t: Tables) -> DataFrame:
    at, diff = dates.at, dates.diff_boundary
    return t.events.select(
        "event_id",
        diff("month", at(2023, 11, 30, 12), "ts").cast("long").alias("months"),
        diff("year", at(2022, 12, 31), "ts").cast("long").alias("years"),
        diff("minute", at(2024, 1, 1, 0, 0, 30), "ts").alias("minutes"),
        diff("hour", at(2024, 1, 1, 0, 59, 59), "ts").alias("hours"),
    )


@query(
    "h22_seconds_to_minutes",
    "SELECT event_id, date_diff('second', TIMESTAMP '2024-01-01', ts) AS seconds, date_diff('second', TIMESTAMP '2024-01-01', ts) // 60 AS minutes FROM events",
)
def _(t: Tables) -> DataFrame:
    seconds = dates.diff_boundary("second", dates.at(2024, 1, 1), "ts")
    return t.events.select("event_id", seconds.alias("seconds"), dates.whole_minutes(seconds).alias("minutes"))


@query("h23_month_bounds", "SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE::VARCHAR AS first_day, last_day(o_orderdate)::VARCHAR AS final_day FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.month_start("o_orderdate").alias("first_day"), dates.month_end("o_orderdate").alias("final_day"))


@query("h24_previous_month_end", "SELECT o_orderkey, (date_trunc('month', o_orderdate) - INTERVAL 1 DAY)::DATE::VARCHAR AS d FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.previous_month_end("o_orderdate").alias("d"))


@query(
    "h25_week_start",
    "SELECT o_orderkey, date_trunc('week', o_orderdate)::DATE::VARCHAR AS iso, date_trunc('week', o_orderdate + INTERVAL 1 DAY)::DATE::VARCHAR AS moved, (date_trunc('week', o_orderdate) + INTERVAL 6 DAY)::DATE::VARCHAR AS ends FROM orders",
)
def _(t: Tables) -> DataFrame:
    d = "o_orderdate"
    return t.orders.select("o_orderkey", dates.week_start(d).alias("iso"), dates.week_start(d, True).alias("moved"), dates.week_end(d).alias("ends"))


@query("h26_week_numbers", "SELECT o_orderkey, weekofyear(o_orderdate)::INT AS wk, (dayofweek(o_orderdate) + 1)::INT AS dow, (isodow(o_orderdate) - 1)::INT AS wd FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.weekofyear("o_orderdate").alias("wk"), F.dayofweek("o_orderdate").alias("dow"), F.weekday("o_orderdate").alias("wd"))


@query("h27_date_parts", "SELECT event_id, hour(ts)::INT AS h, year(ts)::INT AS y, month(ts)::INT AS m, monthname(ts) AS name, dayname(ts) AS dn FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select(
        "event_id", F.hour("ts").alias("h"), F.year("ts").alias("y"), F.month("ts").alias("m"), F.date_format("ts", "MMMM").alias("name"), F.date_format("ts", "EEEE").alias("dn")
    )


@query("h28_month_end_offset", "SELECT o_orderkey, last_day(o_orderdate::DATE + INTERVAL 3 MONTH)::VARCHAR AS ahead, last_day(o_orderdate::DATE - INTERVAL 2 MONTH)::VARCHAR AS back FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.month_end("o_orderdate", 3).alias("ahead"), dates.month_end("o_orderdate", -2).alias("back"))


@query(
    "h29_date_plus_time",
    "SELECT event_id, CASE WHEN event_type = 'view' THEN date_trunc('day', ts)::TIMESTAMP ELSE date_trunc('second', ts)::TIMESTAMP END AS stamp FROM events",
)
def _(t: Tables) -> DataFrame:
    time = F.when(F.col("event_type") != "view", F.date_format("ts", "HH:mm:ss"))
    return t.events.select("event_id", dates.make_ts("ts", time).alias("stamp"))


@query(
    "h30_fiscal_year",
    """SELECT o_orderkey, make_date(y, 4, 1)::VARCHAR AS starts, y || '/' || right((y + 1)::VARCHAR, 2) AS label FROM (SELECT o_orderkey, year(o_orderdate) - CASE WHEN month(o_orderdate) < 4 THEN 1 ELSE 0 END AS y FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", dates.fiscal_year_start("o_orderdate").alias("starts"), dates.fiscal_year_label("o_orderdate").alias("label"))


@query("h31_time_format", "SELECT event_id, strftime(ts, '%H:%M') AS hm, strftime(ts, '%H:%M:%S') AS hms FROM events")
def _(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.date_format("ts", "HH:mm").alias("hm"), F.date_format("ts", "HH:mm:ss").alias("hms"))


@query("h32_arithmetic", "SELECT l_orderkey, l_linenumber, l_partkey, abs(l_quantity - 25) AS dist, round(l_extendedprice * 2, 1) AS twice FROM lineitem")
def _(t: Tables) -> DataFrame:
    twice = F.round(F.col("l_extendedprice") * 2, 1).alias("twice")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.abs(F.col("l_quantity") - 25).alias("dist"), twice)


@query("h33_plain_aggregates", "SELECT l_returnflag, sum(l_quantity) AS s, min(l_shipdate) AS lo, max(l_shipdate) AS hi, count(*) AS n FROM lineitem GROUP BY 1")
def _(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_returnflag").agg(
        F.sum("l_quantity").alias("s"), F.min("l_shipdate").alias("lo"), F.max("l_shipdate").alias("hi"), F.count(F.lit(1)).alias("n")
    )


@query(
    "h34_arrays",
    """SELECT l_orderkey, l_linenumber, l_partkey, generate_subscripts(a, 1)::INT AS pos, unnest(a) AS v FROM (SELECT l_orderkey, l_linenumber, l_partkey,
    list_sort(list_distinct([l_returnflag, l_linestatus, CASE WHEN l_quantity > 25 THEN 'R' ELSE 'A' END])) AS a FROM lineitem)""",
)
def _(t: Tables) -> DataFrame:
    flags = F.array("l_returnflag", "l_linestatus", F.when(F.col("l_quantity") > 25, "R").otherwise("A"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.posexplode_outer(F.array_sort(F.array_distinct(flags))).alias("p", "v"))
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", (F.col("p") + 1).alias("pos"), "v")


@query("h35_empty_to_null", "SELECT o_orderkey, nullif(trim(CASE WHEN o_orderstatus = 'P' THEN '  ' ELSE ' ' || o_orderstatus END), '') AS s FROM orders")
def _(t: Tables) -> DataFrame:
    raw = F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.concat(F.lit(" "), "o_orderstatus"))
    return t.orders.select("o_orderkey", text.empty_to_null(raw).alias("s"))


@query("h36_new_ids", "SELECT count(*) AS n, count(*) AS ids, 36 AS width FROM customer")
def _(t: Tables) -> DataFrame:
    ids = t.customer.select(F.expr("uuid()").alias("id"))
    return ids.agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("ids"), F.max(F.length("id")).alias("width"))


@query(
    "h37_leap_day_age",
    """SELECT o_orderkey, (1996 + k - 1996 - CASE WHEN (DATE '1996-02-29' + to_years(k))::DATE > make_date(1996 + k, 2, 28) THEN 1 ELSE 0 END)::INT AS age FROM (SELECT o_orderkey, (o_orderkey % 9)::INT AS k FROM orders)""",
)
def _(t: Tables) -> DataFrame:
    at = F.make_date(F.lit(1996) + (F.col("o_orderkey") % 9).cast("int"), F.lit(2), F.lit(28))
    return t.orders.select("o_orderkey", dates.age_years(F.lit(dt.date(1996, 2, 29)), at).alias("age"))


@query(
    "h38_user_agent",
    """SELECT page_id, CASE WHEN lower(html) LIKE '%viewport%' THEN 'mobile' WHEN lower(html) LIKE '%track(1%' THEN 'tablet' ELSE 'desktop' END AS device FROM pages""",
)
def _(t: Tables) -> DataFrame:
    return t.pages.select("page_id", text.classify_contains("html", [("Viewport", "mobile"), ("TRACK(1", "tablet")], "desktop").alias("device"))


@query(
    "j01_proper_case",
    """SELECT doc_id, md5(list_aggregate(list_transform(regexp_extract_all(text, '[ \\t\\r\\n\\x{00a0}]|[^ \\t\\r\\n\\x{00a0}]+'), lambda w: w[1] || lower(w[2:])), 'string_agg', '')) AS digest FROM documents""",
)
def _(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(text.proper_case("text")).alias("digest"))


@query(
    "j02_split_with_offset",
    "SELECT page_id, generate_subscripts(p, 1)::INT AS pos, unnest(p) AS value FROM (SELECT page_id, string_split(url, '/') AS p FROM pages)",
)
def _(t: Tables) -> DataFrame:
    return explode_list(t.pages, ["page_id"], "url", "/")


@query(
    "j03_month_spine",
    """SELECT m::DATE::VARCHAR AS month_start, last_day(m)::VARCHAR AS month_end, (SELECT count(*) FROM orders WHERE date_trunc('month', o_orderdate) = m) AS n
    FROM (SELECT unnest(generate_series(TIMESTAMP '1994-11-01', TIMESTAMP '2002-02-01', INTERVAL 1 MONTH)) AS m)""",
)
def _(t: Tables) -> DataFrame:
    spine = dates.month_spine(t.spark, dt.date(1994, 11, 15), dt.date(2002, 2, 10))
    counts = t.orders.groupBy(F.trunc("o_orderdate", "month").alias("month_start")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(counts, "month_start", "left").select("month_start", "month_end", F.coalesce("n", F.lit(0)).alias("n"))


@query("j04_make_date", "SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1)::VARCHAR AS d FROM orders")
def _(t: Tables) -> DataFrame:
    return t.orders.select("o_orderkey", F.make_date(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).alias("d"))


@query(
    "j05_unpivot",
    """SELECT c_custkey, 'c_name' AS column_name, c_name AS value FROM customer UNION ALL SELECT c_custkey, 'c_mktsegment', c_mktsegment FROM customer
    UNION ALL SELECT c_custkey, 'c_nationkey', c_nationkey::VARCHAR FROM customer""",
)
def _(t: Tables) -> DataFrame:
    wide = t.customer.select("c_custkey", "c_name", "c_mktsegment", F.col("c_nationkey").cast("string").alias("c_nationkey"))
    return wide.unpivot("c_custkey", ["c_name", "c_mktsegment", "c_nationkey"], "column_name", "value")


@query(
    "j06_pivot_two_columns",
    """SELECT o_custkey, """
    + ", ".join(f"max(CASE WHEN o_orderstatus = '{s}' THEN o_totalprice END) AS \"{s}_top\", nullif(count(*) FILTER (o_orderstatus = '{s}'), 0) AS \"{s}_n\"" for s in "FOP")
    + " FROM orders GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    pivoted = t.orders.groupBy("o_custkey").pivot("o_orderstatus", ["F", "O", "P"])
    return pivoted.agg(F.max("o_totalprice").alias("top"), F.count(F.lit(1)).alias("n"))


@query("j07_strip_markup", "SELECT page_id, md5(regexp_replace(html, '<[^>]*>', '', 'g')) AS digest, len(regexp_replace(html, '<[^>]*>', '', 'g')) AS n FROM pages")
def _(t: Tables) -> DataFrame:
    bare = text.strip_markup("html")
    return t.pages.select("page_id", F.md5(bare).alias("digest"), F.length(bare).cast("long").alias("n"))
