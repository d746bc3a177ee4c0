"""Claim and concern jobs on the given tables: orders play claims, line items payments, events concerns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.aggs import PAYMENTS, payments
from fathomline.catalog.registry import Tables, query
from fathomline.functions.dates import at
from fathomline.plans import claims


def money(c: Column) -> Column:
    return c.cast("decimal(19,4)")


def claim_id() -> Column:
    return F.col("o_orderkey").alias("claim_id")



@query(
    "k45_claim_view",
    f"""WITH p AS (SELECT o_orderkey, coalesce(sum(gross) FILTER (l_returnflag = 'A'), 0) AS pa, coalesce(sum(gross) FILTER (l_returnflag = 'N'), 0) AS pn, coalesce(sum(gross) FILTER (l_returnflag = 'R'), 0) AS pr, max(l_partkey) AS newest FROM ({PAYMENTS}) GROUP BY 1),
    k AS (SELECT l_orderkey, l_partkey AS contact_id FROM lineitem WHERE l_linestatus = 'O' QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_partkey DESC) = 1),
    c AS (SELECT o.o_orderkey AS claim_id, o_orderstatus = 'F' AS shut, coalesce(pa, 0) AS pa, coalesce(pn, 0) AS pn, coalesce(pr, 0) AS pr, o_totalprice * 0.25::DOUBLE + o_totalprice * 0.5::DOUBLE * 0.5::DOUBLE AS reserve,
    CASE WHEN o_orderpriority <> '5-LOW' THEN 60000.0::DOUBLE END AS excess, o_orderpriority = '1-URGENT' AS per, contact_id, greatest(o_custkey, CASE WHEN o_orderpriority <> '3-MEDIUM' THEN o_orderkey END, newest) AS last_change FROM orders o LEFT JOIN p USING (o_orderkey) LEFT JOIN k ON l_orderkey = o.o_orderkey)
    SELECT claim_id, round(pa + pn + pr, 2) AS total_paid, round(reserve, 6) AS total_reserve, round(CASE WHEN shut THEN pa + pn + pr ELSE reserve END, 4) AS total_claim, round(CASE WHEN shut THEN 0 ELSE reserve - pa - pn - pr END, 4) AS outstanding,
    round(least(CASE WHEN shut THEN pa + pn + pr ELSE reserve END, excess), 4) AS excess_applied, round(reserve - excess, 6) AS funded, CASE WHEN (shut AND pa > 0) OR per THEN 'Successful' WHEN shut THEN 'Unsuccessful' ELSE 'Open' END AS outcome, contact_id, last_change FROM c""",
)
def _(t: Tables) -> DataFrame:
    price, priority = F.col("o_totalprice"), F.col("o_orderpriority")
    heads = t.orders.select(
        claim_id(),
        F.when(F.col("o_orderstatus") == "F", 2).otherwise(1).alias("status"),
        F.when(priority != "5-LOW", money(F.lit(60000))).alias("excess"),
        (priority == "1-URGENT").alias("periodical"),
        F.col("o_custkey").alias("changed"),
    )
    reserves = t.orders.select(
        claim_id(),
        money(price * 0.5).alias("reserve_damages"),
        money(price * 0.25).alias("reserve_defence"),
        money(F.lit(None)).alias("reserve_claimant"),
        F.lit(50).cast("decimal(5,2)").alias("share_pct"),
        F.when(priority != "3-MEDIUM", F.col("o_orderkey")).alias("reserve_changed"),
    )
    contacts = t.lineitem.select(
        F.col("l_orderkey").alias("claim_id"), F.col("l_partkey").alias("contact_id"), F.col("l_shipdate").alias("opened"), F.nullif("l_linestatus", F.lit("O")).alias("closed")
    )
    out = claims.claim_view(heads, reserves, payments(t).withColumnRenamed("o_orderkey", "claim_id"), contacts)
    digits = {"total_paid": 2, "total_reserve": 6, "total_claim": 4, "outstanding": 4, "excess_applied": 4, "funded": 6}
    return out.select("claim_id", *[F.round(F.col(c).cast("double"), n).alias(c) for c, n in digits.items()], "outcome", "contact_id", "last_change")


@query(
    "k46_monthly_snapshot",
    """SELECT o_orderkey, o_totalprice, '2000-11' AS snapshot_month FROM orders WHERE o_orderdate < TIMESTAMP '2000-12-01' UNION ALL SELECT o_orderkey, o_totalprice, '2000-12' FROM orders WHERE o_orderdate < TIMESTAMP '2001-01-01'""",
)
def _(t: Tables) -> DataFrame:
    o = t.orders.select("o_orderkey", "o_totalprice", "o_orderdate")
    november = o.filter(F.col("o_orderdate") < at(2000, 12, 1)).drop("o_orderdate")
    december = o.filter(F.col("o_orderdate") < at(2001, 1, 1)).drop("o_orderdate")
    # the first run of December held November's rows; the second run replaces it
    stored = november.withColumn("snapshot_month", F.lit("2000-11")).unionByName(november.withColumn("snapshot_month", F.lit("2000-12")))
    return claims.monthly_snapshot(stored, december, "2000-12")


def concerns(t: Tables) -> DataFrame:
    return t.events.select(
        F.concat(F.col("user_id"), F.lit("/"), F.date_format("ts", "dd")).alias("case_id"),
        F.when(F.col("value") > 30, "major").otherwise("minor").alias("section"),
        F.col("event_type").alias("item"),
        F.struct("ts", "event_id").alias("place"),
    )


CONCERNS = "SELECT user_id || '/' || strftime(ts, '%d') AS case_id, CASE WHEN value > 30 THEN 'major' ELSE 'minor' END AS section, event_type AS item, ts, event_id FROM events"


@query("k47_concern_list", f"SELECT case_id, section, string_agg(item, ', ' ORDER BY ts, event_id) AS items FROM ({CONCERNS}) GROUP BY ALL")
def _(t: Tables) -> DataFrame:
    return claims.concern_list(concerns(t))


@query(
    "k47_concern_summary",
    f"SELECT case_id, string_agg(no || ') ' || item, ' ' ORDER BY no) AS summary FROM (SELECT *, row_number() OVER (PARTITION BY case_id ORDER BY ts, event_id) AS no FROM ({CONCERNS})) GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return claims.concern_summary(concerns(t))


@query(
    "k47_concern_matrix",
    "SELECT case_id, " + ", ".join(f"max(CASE WHEN item = '{k}' THEN 1 END) AS \"{k}\"" for k in ("click", "error", "purchase", "signup", "view")) + f" FROM ({CONCERNS}) GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    return claims.concern_matrix(concerns(t))


@query(
    "k49_symptoms_matrix",
    "SELECT user_id, " + ", ".join(f"max(CASE WHEN dayofweek(ts) = {n} THEN event_type END) AS name_{n}, max(CASE WHEN dayofweek(ts) = {n} THEN value END) AS severity_{n}" for n in range(7)) + " FROM events GROUP BY 1",
)
def _(t: Tables) -> DataFrame:
    rows = t.events.select("user_id", (F.dayofweek("ts") - 1).alias("no"), F.col("event_type").alias("name"), F.col("value").alias("severity"))
    return claims.numbered_matrix(rows, ["user_id"], "no", ["name", "severity"])
