"""Sources, sinks and load patterns on the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.registry import Tables, query
from fathomline.functions.dates import at
from fathomline.session import scratch_path
from fathomline.sources import loads, tables


def stored_orders(t: Tables) -> DataFrame:
    """Orders before 1998 play the stored table."""
    return t.orders.filter(F.col("o_orderdate") < at(1998, 1, 1)).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")


def order_batch(t: Tables) -> DataFrame:
    """Orders from the second half of 1997 on, with a changed price, play the batch."""
    return t.orders.filter(F.col("o_orderdate") >= at(1997, 7, 1)).select(
        "o_orderkey", "o_custkey", F.round(F.col("o_totalprice") + 1, 2).alias("o_totalprice"), "o_orderdate"
    )


STORED = "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'"
BATCH = "SELECT o_orderkey, o_custkey, round(o_totalprice + 1, 2) AS o_totalprice, o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1997-07-01'"


def by_day(df: DataFrame) -> DataFrame:
    """A small comparable digest of a table of orders."""
    return df.groupBy(F.year("o_orderdate").alias("y"), F.month("o_orderdate").alias("m")).agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"), F.sum("o_orderkey").alias("keys")
    )


DIGEST = "SELECT year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, count(*) AS n, round(sum(o_totalprice), 2) AS total, sum(o_orderkey)::BIGINT AS keys FROM ({}) GROUP BY ALL"


@query(
    "a01_columnar_scan",
    "SELECT l_orderkey, l_partkey, l_quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01' AND l_returnflag = 'R'",
)
def _(t: Tables) -> DataFrame:
    scan = tables.read_table(t.spark, t.path("lineitem"))
    return scan.filter((F.col("l_shipdate") >= at(1999, 1, 1)) & (F.col("l_returnflag") == "R")).select(
        "l_orderkey", "l_partkey", "l_quantity"
    )


@query("a02_recursive_scan", DIGEST.format("SELECT * FROM orders"))
def _(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "nested")
    orders = t.orders
    for folder, keep in (("a/x", F.col("o_orderstatus") == "F"), ("a/y", F.col("o_orderstatus") == "O"), ("b", F.col("o_orderstatus") == "P")):
        loads.write_overwrite(orders.filter(keep), f"{root}/{folder}")
    return by_day(tables.read_table(t.spark, root, recursive=True, schema=orders.schema))


@query("a03_versioned_scan", DIGEST.format("SELECT * FROM orders"))
def _(t: Tables) -> DataFrame:
    root = scratch_path(t.spark, "versions")
    loads.write_overwrite(stored_orders(t), f"{root}/version=1")
    loads.write_overwrite(t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate"), f"{root}/version=2")
    scan = tables.read_table(t.spark, root)
    return by_day(scan.filter(F.col("version") == 2))


@query(
    "a04_optional_source",
    "SELECT o_orderkey, NULL::VARCHAR AS note FROM orders WHERE o_orderstatus = 'P'",
)
def _(t: Tables) -> DataFrame:
    from pyspark.sql.types import LongType, StringType, StructField, StructType

    schema = StructType([StructField("o_orderkey", LongType()), StructField("note", StringType())])
    notes = tables.read_optional(t.spark, t.path("order_notes"), schema)
    return t.orders.filter("o_orderstatus = 'P'").select("o_orderkey").join(notes, "o_orderkey", "left")


@query(
    "a05_optional_column",
    "SELECT c_custkey, c_mktsegment AS segment, 'none' AS phone FROM customer",
)
def _(t: Tables) -> DataFrame:
    c = t.customer
    return c.select(
        "c_custkey",
        tables.optional_col(c, "segment", "C_MktSegment").alias("segment"),
        tables.optional_col(c, "c_phone", "phone", default="none").alias("phone"),
    )


@query(
    "a06_values_table",
    """SELECT o_orderkey, v.label FROM orders
    LEFT JOIN (VALUES ('F', 'finished'), ('O', 'open')) v(code, label) ON v.code = o_orderstatus""",
)
def _(t: Tables) -> DataFrame:
    labels = tables.values_table(t.spark, [("F", "finished"), ("O", "open")], "code string, label string")
    return t.orders.join(F.broadcast(labels), F.col("o_orderstatus") == F.col("code"), "left").select("o_orderkey", "label")


@query("a07_overwrite", DIGEST.format(BATCH))
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "overwrite")
    loads.write_overwrite(stored_orders(t), path)
    loads.write_overwrite(order_batch(t), path)
    return by_day(tables.read_table(t.spark, path))


@query(
    "a08_append_schema_merge",
    f"""SELECT o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (
    SELECT o_totalprice, NULL AS o_orderstatus FROM ({STORED})
    UNION ALL SELECT o_totalprice, o_orderstatus FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "append")
    loads.write_overwrite(stored_orders(t), path)
    later = t.orders.filter(F.col("o_orderdate") >= at(1998, 1, 1))
    loads.write_append(later.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus"), path)
    both = tables.read_table(t.spark, path, mergeSchema="true")
    return both.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "a09_replace_by_key",
    f"SELECT * FROM ({STORED}) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({BATCH})) UNION ALL {BATCH}",
)
def _(t: Tables) -> DataFrame:
    return loads.replace_by_key(stored_orders(t), order_batch(t), ["o_orderkey"])


@query(
    "a10_replace_by_window",
    f"""SELECT * FROM ({STORED}) WHERE NOT (o_orderdate >= TIMESTAMP '1997-07-01' AND o_orderdate < TIMESTAMP '1997-10-01')
    UNION ALL SELECT * FROM ({BATCH}) WHERE o_orderdate >= TIMESTAMP '1997-07-01' AND o_orderdate < TIMESTAMP '1997-10-01'""",
)
def _(t: Tables) -> DataFrame:
    return loads.replace_by_window(stored_orders(t), order_batch(t), "o_orderdate", dt.datetime(1997, 7, 1), dt.datetime(1997, 10, 1))


@query(
    "a10_replace_partitions",
    DIGEST.format(f"SELECT * FROM ({STORED}) WHERE o_orderdate < TIMESTAMP '1997-07-01' UNION ALL {BATCH}"),
)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "window")
    month = F.date_format("o_orderdate", "yyyy-MM")
    loads.write_window(stored_orders(t).withColumn("month", month), path, ["month"])
    loads.write_window(order_batch(t).withColumn("month", month), path, ["month"])
    return by_day(tables.read_table(t.spark, path))


@query(
    "a10_emptied_month",
    DIGEST.format(
        f"SELECT * FROM ({STORED}) WHERE o_orderdate < TIMESTAMP '1997-07-01' UNION ALL SELECT * FROM ({BATCH}) WHERE month(o_orderdate) <> 9 OR year(o_orderdate) <> 1997"
    ),
)
def _(t: Tables) -> DataFrame:
    """A month of the window for which the batch has no row loses its stored rows."""
    path, month = scratch_path(t.spark, "window"), F.date_format("o_orderdate", "yyyy-MM")
    loads.write_window(stored_orders(t).withColumn("month", month), path, ["month"])
    batch = order_batch(t).withColumn("month", month).filter("month <> '1997-09'")
    loads.write_window(batch, path, ["month"], low="1997-07", high="1998-01")
    return by_day(tables.read_table(t.spark, path))


def window_digest(t: Tables, value: Column, low: object, high: object, emptied: Column) -> DataFrame:
    """Stored orders in partitions by `value`; a batch without the rows of `emptied` replaces the window [low, high), twice."""
    path = scratch_path(t.spark, "window")
    batch = order_batch(t).withColumn("part", value).filter(~emptied)
    for rows in (stored_orders(t).withColumn("part", value), batch, batch):  # the first load finds no table
        loads.write_window(rows, path, ["part"], low=low, high=high)
    return by_day(tables.read_table(t.spark, path))


KEPT = "SELECT * FROM ({}) WHERE NOT coalesce(p >= {} AND p < {}, FALSE) AND coalesce(p, -1) NOT IN (SELECT coalesce(p, -1) FROM b)"


@query(
    "a10_int_window",
    f"""WITH s AS (SELECT *, nullif(month(o_orderdate), 2)::INT AS p FROM ({STORED})), b AS (SELECT *, month(o_orderdate)::INT AS p FROM ({BATCH}) WHERE month(o_orderdate) NOT IN (2, 9, 11))
    {DIGEST.format("SELECT * FROM b UNION ALL " + KEPT.format("SELECT * FROM s", 9, 12))}""",
)
def _(t: Tables) -> DataFrame:
    """Numbers are compared as numbers (9 < 12), and rows without a partition value stay."""
    month = F.month("o_orderdate")
    return window_digest(t, F.when(month != 2, month), 9, 12, month.isin(2, 9, 11))


@query(
    "a10_timestamp_window",
    f"""WITH s AS (SELECT *, date_trunc('month', o_orderdate) + INTERVAL 30 MINUTE AS p FROM ({STORED})), b AS (SELECT *, date_trunc('month', o_orderdate) + INTERVAL 30 MINUTE AS p FROM ({BATCH}) WHERE month(o_orderdate) NOT IN (8, 10))
    {DIGEST.format("SELECT * FROM b UNION ALL SELECT * FROM s WHERE NOT (p >= TIMESTAMP '1997-08-01 00:30:00' AND p < TIMESTAMP '1997-11-01') AND p NOT IN (SELECT p FROM b)")}""",
)
def _(t: Tables) -> DataFrame:
    """Partitions whose folder names are escaped."""
    at_half_past = F.date_trunc("month", "o_orderdate").cast("timestamp_ntz") + F.expr("interval 30 minutes")
    return window_digest(t, at_half_past, dt.datetime(1997, 8, 1, 0, 30), dt.datetime(1997, 11, 1), F.month("o_orderdate").isin(8, 10))


def touched_digest(t: Tables, change: loads.Change, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Stored orders in partitions by year and status; only those that hold a key of the batch are rewritten."""
    path, parts = scratch_path(t.spark, "touched"), ["y", "o_orderstatus"]
    stored = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus").withColumn("y", F.year("o_orderdate"))
    loads.write_overwrite(stored, path, partition_by=parts)
    loads.rewrite_touched(t.spark, path, batch, keys, parts, change)
    return by_day(tables.read_table(t.spark, path))


@query(
    "a09_replace_in_partitions",
    DIGEST.format(
        """SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE NOT (o_custkey % 10 = 3 AND o_orderdate < TIMESTAMP '1994-01-01')
    UNION ALL SELECT o_orderkey, o_totalprice + 1, o_orderdate + INTERVAL 1 YEAR FROM orders WHERE o_custkey % 10 = 3 AND o_orderdate < TIMESTAMP '1994-01-01'"""
    ),
)
def _(t: Tables) -> DataFrame:
    """Replaced rows move to the next year's partition, and leave the old one."""
    moved = (F.col("o_orderdate") + F.expr("interval 1 year")).alias("o_orderdate")
    batch = t.orders.filter((F.col("o_custkey") % 10 == 3) & (F.col("o_orderdate") < at(1994, 1, 1)))
    batch = batch.select("o_orderkey", "o_custkey", (F.col("o_totalprice") + 1).alias("o_totalprice"), moved, "o_orderstatus").withColumn("y", F.year("o_orderdate"))
    return touched_digest(t, lambda rows, b: loads.replace_by_key(rows, b, ["o_orderkey"]), batch, ["o_orderkey"])


@query(
    "a13_merge_in_partitions",
    DIGEST.format(
        """SELECT o_orderkey, o_orderdate, coalesce(a.account, o_totalprice) AS o_totalprice FROM orders LEFT JOIN (SELECT c_custkey, c_acctbal AS account
    FROM customer WHERE c_nationkey = 7) a ON o_custkey = c_custkey AND o_orderdate >= TIMESTAMP '1996-01-01'"""
    ),
)
def _(t: Tables) -> DataFrame:
    """A source without partition columns updates the orders it matches, from 1996 on."""
    source = t.customer.filter("c_nationkey = 7").join(t.orders.filter(F.col("o_orderdate") >= at(1996, 1, 1)), F.col("c_custkey") == F.col("o_custkey"))
    source = source.select("o_orderkey", F.col("c_acctbal").alias("o_totalprice"))
    return touched_digest(t, lambda rows, b: loads.merge_update(rows, b, ["o_orderkey"], ["o_totalprice"], [F.col("o_totalprice")]), source, ["o_orderkey"])


@query(
    "a11_insert_new",
    f"{STORED} UNION ALL SELECT * FROM ({BATCH}) WHERE o_orderkey NOT IN (SELECT o_orderkey FROM ({STORED}))",
)
def _(t: Tables) -> DataFrame:
    return loads.insert_new(stored_orders(t), order_batch(t), ["o_orderkey"])


NEWER_T = "SELECT c_custkey, c_name AS name, (c_custkey % 3)::INT AS version FROM customer WHERE c_mktsegment <> 'HOUSEHOLD'"
NEWER_B = "SELECT c_custkey, upper(c_name) AS name, (c_custkey % 4)::INT AS version FROM customer WHERE c_acctbal > 500"


@query(
    "a12_update_if_newer",
    f"""SELECT coalesce(t.c_custkey, b.c_custkey) AS c_custkey,
    CASE WHEN t.c_custkey IS NULL OR b.version > t.version THEN b.name ELSE t.name END AS name,
    CASE WHEN t.c_custkey IS NULL OR b.version > t.version THEN b.version ELSE t.version END AS version
    FROM ({NEWER_T}) t FULL JOIN ({NEWER_B}) b ON t.c_custkey = b.c_custkey""",
)
def _(t: Tables) -> DataFrame:
    key, name = F.col("c_custkey"), F.col("c_name")
    target = t.customer.filter("c_mktsegment <> 'HOUSEHOLD'").select(key, name.alias("name"), (key % 3).cast("int").alias("version"))
    batch = t.customer.filter("c_acctbal > 500").select(key, F.upper(name).alias("name"), (key % 4).cast("int").alias("version"))
    return loads.upsert_newer(target, batch, ["c_custkey"], "version")


@query(
    "a12_ties_and_repeats",
    f"""WITH t AS ({NEWER_T} UNION ALL SELECT c_custkey, 'again', 1 FROM ({NEWER_T}) WHERE c_custkey % 5 = 0),
    b AS (SELECT c_custkey, max(name) AS name, version FROM ({NEWER_B} UNION ALL SELECT c_custkey, name || '!', version FROM ({NEWER_B})) GROUP BY ALL)
    SELECT c_custkey, CASE WHEN b.version > t.version THEN b.name ELSE t.name END AS name, CASE WHEN b.version > t.version THEN b.version ELSE t.version END AS version
    FROM t LEFT JOIN b USING (c_custkey) UNION ALL SELECT c_custkey, name, version FROM b WHERE c_custkey NOT IN (SELECT c_custkey FROM t)""",
)
def _(t: Tables) -> DataFrame:
    """Keys stored twice keep both rows; batch rows of one version are chosen by their other columns."""
    key, name = F.col("c_custkey"), F.col("c_name")
    target = t.customer.filter("c_mktsegment <> 'HOUSEHOLD'").select(key, name.alias("name"), (key % 3).cast("int").alias("version"))
    target = target.unionByName(target.filter(key % 5 == 0).select(key, F.lit("again").alias("name"), F.lit(1).alias("version")))
    batch = t.customer.filter("c_acctbal > 500").select(key, F.upper(name).alias("name"), (key % 4).cast("int").alias("version"))
    tied = batch.unionByName(batch.withColumn("name", F.concat("name", F.lit("!"))))
    return loads.upsert_newer(target, tied, ["c_custkey"], "version")


@query(
    "a13_merge_update",
    """SELECT c_custkey, c_name, CASE WHEN s.o_custkey IS NULL THEN c_acctbal ELSE s.o_totalprice END AS c_acctbal
    FROM customer LEFT JOIN (SELECT o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'P'
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1) s ON s.o_custkey = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    source = t.orders.filter("o_orderstatus = 'P'").select(
        F.col("o_custkey").alias("c_custkey"), F.col("o_totalprice").alias("c_acctbal"), "o_orderdate", "o_orderkey"
    )
    target = t.customer.select("c_custkey", "c_name", "c_acctbal")
    return loads.merge_update(target, source, ["c_custkey"], ["c_acctbal"], [F.col("o_orderdate").desc(), F.col("o_orderkey").desc()])


@query(
    "a14_align_schema",
    "SELECT o_orderkey::VARCHAR AS o_orderkey, NULL::INT AS stage, o_totalprice FROM orders",
)
def _(t: Tables) -> DataFrame:
    from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType

    wanted = StructType([StructField("o_orderkey", StringType()), StructField("stage", IntegerType()), StructField("o_totalprice", DoubleType())])
    return tables.align_schema(t.orders, wanted)


@query(
    "a15_clean_columns",
    'SELECT p_partkey AS part_key, p_name AS part_name, p_brand AS part_name_2 FROM part',
)
def _(t: Tables) -> DataFrame:
    raw = t.part.select(F.col("p_partkey").alias("part key"), F.col("p_name").alias("part-name"), F.col("p_brand").alias("part.name "))
    return tables.clean_columns(raw)


@query(
    "a16_period_snapshot",
    """SELECT snapshot_month, o_orderstatus, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM (
    SELECT '1997-12' AS snapshot_month, * FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
    UNION ALL SELECT '1998-01', * FROM orders WHERE o_orderdate < TIMESTAMP '1998-02-01') GROUP BY ALL""",
)
def _(t: Tables) -> DataFrame:
    december = t.orders.filter(F.col("o_orderdate") < at(1998, 1, 1)).withColumn("snapshot_month", F.lit("1997-12"))
    january = t.orders.filter(F.col("o_orderdate") < at(1998, 2, 1))
    first = loads.snapshot(december, january, "snapshot_month", "1998-01")
    again = loads.snapshot(first, january, "snapshot_month", "1998-01")
    return again.groupBy("snapshot_month", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


@query(
    "a17_high_water_increment",
    "SELECT event_id, user_id, value FROM events WHERE event_id > (SELECT max(event_id) FROM events WHERE ts < TIMESTAMP '2024-01-20')",
)
def _(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", "value", "ts")
    stored = e.filter(F.col("ts") < at(2024, 1, 20))
    return loads.incremental_by_id(e, stored, "event_id").drop("ts")


@query(
    "a17_stream_available_now",
    "SELECT event_type, count(*) AS n, sum(event_id)::BIGINT AS ids FROM events GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    from fathomline.streaming.incremental import append_new_files

    source, target, marks = (scratch_path(t.spark, n) for n in ("stream-in", "stream-out", "stream-marks"))
    early = F.col("ts") < at(2024, 1, 15)
    loads.write_append(t.events.filter(early), source)
    append_new_files(t.spark, source, t.events.schema, target, marks)
    loads.write_append(t.events.filter(~early), source)
    append_new_files(t.spark, source, t.events.schema, target, marks)
    return t.spark.read.parquet(target).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query(
    "a18_lookback_increment",
    """SELECT event_id, user_id, ts FROM events e WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'error') - INTERVAL 7 DAY
    AND event_id NOT IN (SELECT event_id FROM events WHERE ts < TIMESTAMP '2024-01-20' AND event_type <> 'error')""",
)
def _(t: Tables) -> DataFrame:
    e = t.events.select("event_id", "user_id", "ts")
    # errors arrived late and are not stored yet
    stored = t.events.select("event_id", "user_id", "ts", "event_type").filter((F.col("ts") < at(2024, 1, 20)) & (F.col("event_type") != "error")).drop("event_type")
    return loads.incremental_by_id(e, stored, "ts", lookback=dt.timedelta(days=7), keys=["event_id"])


@query(
    "a19_backfill_plan",
    """WITH stored AS (SELECT DISTINCT ts::DATE AS day FROM events WHERE day(ts) % 6 <> 0 AND ts < TIMESTAMP '2024-01-26'),
    wanted AS (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-28', INTERVAL 1 DAY))::DATE AS day),
    latest AS (SELECT least(max(day), DATE '2024-01-28') AS l FROM stored)
    SELECT day::VARCHAR AS day, CASE WHEN day BETWEEN l - 7 AND l THEN 'refresh' ELSE 'missing' END AS reason FROM wanted, latest
    WHERE day BETWEEN l - 7 AND l OR day NOT IN (SELECT day FROM stored)""",
)
def _(t: Tables) -> DataFrame:
    stored = t.events.filter((F.dayofmonth("ts") % 6 != 0) & (F.col("ts") < at(2024, 1, 26)))
    return loads.plan_dates(t.spark, stored, "ts", dt.date(2024, 1, 1), dt.date(2024, 1, 30))


@query("a20_typed_empty_output", "SELECT event_type, count(*) AS n FROM events WHERE ts < TIMESTAMP '2000-01-01' GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "empty")
    loads.write_overwrite(t.events.filter(F.col("ts") < at(2000, 1, 1)), path)
    return tables.read_table(t.spark, path).groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a21_export_by_label",
    "SELECT strftime(ts, '%Y-%m-%d') AS label, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL",
)
def _(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "export")
    loads.export_partitioned(t.events.withColumn("label", F.date_format("ts", "yyyy-MM-dd")), path, "label")
    back = tables.read_table(t.spark, path).groupBy(F.col("label").cast("string").alias("label"))
    return back.agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 2).alias("total"))


@query(
    "a22_stable_ids",
    """SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'id-' || c_custkey ELSE 'new' END AS id FROM customer""",
)
def _(t: Tables) -> DataFrame:
    stored = t.customer.filter("c_acctbal > 0").select("c_custkey", F.concat(F.lit("id-"), F.col("c_custkey")).alias("id"))
    ids = loads.assign_ids(stored, t.customer, ["c_custkey"], "id")
    return ids.withColumn("id", F.when(F.length("id") == 64, "new").otherwise(F.col("id")))


@query(
    "a23_stamped_rebuild",
    "SELECT s_suppkey, s_name, n_name, TIMESTAMP '2024-02-01 06:00:00' AS snapshot_time FROM supplier JOIN nation ON n_nationkey = s_nationkey",
)
def _(t: Tables) -> DataFrame:
    view = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_name", "n_name")
    path = scratch_path(t.spark, "rebuild")
    loads.write_overwrite(loads.rebuild_snapshot(view, at(2024, 2, 1, 6)), path)
    return tables.read_table(t.spark, path)
