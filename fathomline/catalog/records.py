"""Person-record jobs on the given tables: customers play persons, orders their records."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.registry import Tables, query
from fathomline.functions.dates import age_years, at
from fathomline.functions.rules import band, exclude_matching
from fathomline.functions.text import normalise_names
from fathomline.plans import records
from fathomline.sources.tables import merge_layouts

def key() -> Column:
    return F.col("c_custkey")



@query(
    "k35_draft_contacts",
    """WITH r AS (SELECT user_id, event_id, ts FROM events WHERE event_type IN ('signup', 'click') QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
    p AS (SELECT o_custkey, 'tel' || o_orderkey AS v FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01' AND (o_orderstatus <> 'F' OR o_orderdate::DATE + 400 >= DATE '2000-01-01')
    QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY CASE WHEN o_orderpriority = '1-URGENT' THEN 1 ELSE 0 END DESC, o_orderdate DESC, 'tel' || o_orderkey) = 1)
    SELECT user_id AS person_id, event_id AS request_id, p.v AS phone, lower(c_name) || '@example.org' AS email FROM r LEFT JOIN p ON o_custkey = user_id LEFT JOIN customer ON c_custkey = user_id AND c_acctbal > 1000""",
)
def _(t: Tables) -> DataFrame:
    done = F.when(F.col("event_type").isin("signup", "click"), 0).otherwise(1)
    requests = t.events.select(F.col("user_id").alias("person_id"), F.col("event_id").alias("request_id"), "ts", done.alias("complete"))
    day, none = F.to_date("o_orderdate"), F.lit(None).cast("date")
    phones = t.orders.select(
        F.col("o_custkey").alias("person_id"),
        F.concat(F.lit("tel"), "o_orderkey").alias("value"),
        (F.col("o_orderpriority") == "1-URGENT").cast("int").alias("preferred"),
        day.alias("start"),
        F.when(F.col("o_orderstatus") == "F", F.date_add(day, 400)).alias("end"),
    )
    emails = t.customer.filter("c_acctbal > 1000").select(
        key().alias("person_id"), F.concat(F.lower("c_name"), F.lit("@example.org")).alias("value"), F.lit(1).alias("preferred"), none.alias("start"), none.alias("end")
    )
    return records.draft_contacts(requests, phones, emails, F.lit(dt.date(2000, 1, 1))).select("person_id", "request_id", "phone", "email")


@query(
    "k36_contact_blocks",
    """SELECT o_orderkey AS block_id, row_number() OVER w AS block_no, CASE WHEN lead(o_orderkey) OVER w IS NULL THEN 1 ELSE 0 END::INT AS last_of_kind, concat_ws(', ', nullif(o_orderstatus, 'P'), o_orderpriority) AS block_text
    FROM orders WINDOW w AS (PARTITION BY o_custkey, o_orderkey % 3 ORDER BY o_orderdate, o_orderkey)""",
)
def _(t: Tables) -> DataFrame:
    blocks = t.orders.select(
        F.col("o_custkey").alias("person_id"),
        (F.col("o_orderkey") % 3).alias("kind"),
        F.col("o_orderkey").alias("block_id"),
        F.col("o_orderdate").alias("start"),
        F.nullif("o_orderstatus", F.lit("P")).alias("line_1"),
        F.col("o_orderpriority").alias("line_2"),
    )
    return records.contact_blocks(blocks).select("block_id", "block_no", "last_of_kind", "block_text")


AGES = ([0, 18, 40, 65, 200], ["0-17", "18-39", "40-64", "65+"])


@query(
    "k37_person_summary",
    """WITH a AS (SELECT o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderpriority = '1-URGENT' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    b AS (SELECT o_custkey, o_orderkey FROM orders WHERE o_orderpriority = '2-HIGH' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    c AS (SELECT o_custkey, o_orderdate FROM orders WHERE o_orderstatus = 'P' QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1),
    p AS (SELECT c_custkey, 2001 - (1920 + c_custkey % 75) - CASE WHEN make_date(2001, (c_custkey % 12 + 1)::INT, 15) > DATE '2001-06-30' THEN 1 ELSE 0 END AS age FROM customer)
    SELECT p.c_custkey, a.o_orderstatus AS urgent_o_orderstatus, a.o_totalprice AS urgent_o_totalprice, b.o_orderkey AS high_o_orderkey, c.o_orderdate AS pending_o_orderdate, age::INT AS age,
    CASE WHEN age < 18 THEN '0-17' WHEN age < 40 THEN '18-39' WHEN age < 65 THEN '40-64' ELSE '65+' END AS age_group FROM p LEFT JOIN a ON a.o_custkey = p.c_custkey LEFT JOIN b ON b.o_custkey = p.c_custkey LEFT JOIN c ON c.o_custkey = p.c_custkey""",
)
def _(t: Tables) -> DataFrame:
    o = t.orders.withColumnRenamed("o_custkey", "c_custkey")
    order = ["o_orderdate", "o_orderkey"]
    sections = {
        "urgent": (o.filter("o_orderpriority = '1-URGENT'"), order, ["o_orderstatus", "o_totalprice"]),
        "high": (o.filter("o_orderpriority = '2-HIGH'"), order, ["o_orderkey"]),
        "pending": (o.filter("o_orderstatus = 'P'"), order, ["o_orderdate"]),
    }
    born = F.make_date((F.lit(1920) + key() % 75).cast("int"), (key() % 12 + 1).cast("int"), F.lit(15))
    people = t.customer.select("c_custkey", age_years(born, F.lit(dt.date(2001, 6, 30))).alias("age"))
    return records.latest_sections(people, "c_custkey", sections).withColumn("age_group", band("age", *AGES))


@query(
    "k38_historic_merge",
    """SELECT DISTINCT id, name, area FROM (SELECT c_custkey AS id, trim(c_name) AS name, c_nationkey::VARCHAR AS area FROM customer UNION ALL SELECT s_suppkey, CASE WHEN lower(s_name) = 'supplier#000000007' THEN 'Seven' ELSE s_name END, 'old' FROM supplier)
    WHERE lower(name) NOT LIKE '%00_'""",
)
def _(t: Tables) -> DataFrame:
    current = t.customer.select(key().alias("id"), F.trim("c_name").alias("name"), F.col("c_nationkey").cast("string").alias("area"))
    old = {"id": F.col("s_suppkey").cast("string"), "name": normalise_names("s_name", {"supplier#000000007": "Seven"}), "area": F.lit("old")}
    return exclude_matching(merge_layouts(current, t.supplier, old), "name", ["%00_"])


def base(t: Tables) -> DataFrame:
    """Customers with facts about their orders and documents to test the rules on."""
    per = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("orders"), F.count_if(F.col("o_orderstatus") == "P").alias("pending"), F.max("o_orderdate").alias("last_order"), F.max("o_totalprice").alias("top")
    )
    docs = t.documents.select(F.col("doc_id").alias("c_custkey"), "lang", "n_chars")
    area = t.nation.select(F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("area"))
    return t.customer.join(per, "c_custkey", "left").join(docs, "c_custkey", "left").join(area, "c_nationkey", "left")


# name, Spark condition, SQL condition (the same rule for both sides of the check)
CHECKS = [
    ("No orders", "orders IS NULL"),
    ("Pending order", "pending > 0"),
    ("Many pending", "pending >= 3"),
    ("Negative balance", "c_acctbal < 0"),
    ("High balance", "c_acctbal > 9000"),
    ("Very large order", "top > 450000"),
    ("No document", "lang IS NULL"),
    ("Short document", "n_chars < 200"),
    ("Long document", "n_chars > 20000"),
    ("Foreign document", "lang NOT IN ('en', 'fr')"),
    ("Segment not allowed", "c_mktsegment IN ('HOUSEHOLD', 'MACHINERY') AND c_nationkey > 20"),
    ("Old last order", "year(last_order) < 2001"),
    ("Recent last order", "year(last_order) >= 2001"),
    ("Few orders", "orders < 5"),
    ("Busy and in debt", "orders > 12 AND c_acctbal < 0"),
    ("Empty name", "length(trim(c_name)) = 0"),
    ("Nation missing", "c_nationkey IS NULL"),
    ("Balance missing", "c_acctbal IS NULL"),
]
# rules with one form for everybody
SINGLE_CHECKS = [
    ("Single order", "orders = 1"),
    ("Many orders", "orders > 20"),
    ("All orders pending", "pending = orders"),
    ("Half of the orders pending", "pending * 2 >= orders"),
    ("Zero balance", "c_acctbal = 0"),
    ("Nation out of range", "c_nationkey NOT BETWEEN 0 AND 24"),
    ("Segment missing", "c_mktsegment IS NULL"),
    ("Name without number", "c_name NOT LIKE '%#%'"),
    ("Document without language", "n_chars IS NOT NULL AND lang IS NULL"),
    ("Small orders only", "top < 100000"),
    ("Balance without orders", "orders IS NULL AND c_acctbal > 0"),
    ("Late and large", "year(last_order) >= 1998 AND top > 400000"),
]
# rules for records that are still drafts
DRAFT = "pending > 0"
DRAFT_CHECKS = [
    ("no consent", "c_acctbal < 0"),
    ("deceased", "c_mktsegment = 'BUILDING'"),
    ("no document", "lang IS NULL"),
    ("short document", "n_chars < 500"),
    ("first order", "orders = 1"),
    ("waiting since long", "year(last_order) < 1998"),
]
BASE_SQL = """SELECT c.*, n_name AS area, orders, pending, last_order, top, lang, n_chars FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS orders, count(*) FILTER (o_orderstatus = 'P') AS pending, max(o_orderdate) AS last_order, max(o_totalprice) AS top
    FROM orders GROUP BY 1) ON o_custkey = c_custkey LEFT JOIN documents ON doc_id = c_custkey LEFT JOIN nation ON n_nationkey = c_nationkey"""
DETAIL_SQL = "concat_ws('; ', 'name ' || c_name, 'orders ' || orders, 'language ' || lang)"


@query(
    "k39_exception_report",
    f"WITH b AS ({BASE_SQL}) "
    + " UNION ALL ".join(
        f"SELECT c_custkey, c_name, area, c_mktsegment, '{name}' AS exception, {DETAIL_SQL} AS detail FROM b WHERE {rule}"
        for name, rule in [
            *((f"{name} - living", f"({rule}) AND NOT (c_mktsegment = 'BUILDING')") for name, rule in CHECKS),
            *((f"{name} - deceased", f"({rule}) AND (c_mktsegment = 'BUILDING')") for name, rule in CHECKS),
            *SINGLE_CHECKS,
            *((f"Not published - {name}", f"{DRAFT} AND {rule}") for name, rule in DRAFT_CHECKS),
        ]
    ),
)
def _(t: Tables) -> DataFrame:
    parts: list[tuple[str, Column | str]] = [("name ", "c_name"), ("orders ", "orders"), ("language ", "lang")]
    deceased = F.col("c_mktsegment") == "BUILDING"
    rules = [form for name, rule in CHECKS for form in records.two_forms(records.Rule(name, F.expr(rule), parts), deceased)]
    rules += [records.Rule(name, F.expr(rule), parts) for name, rule in SINGLE_CHECKS]
    rules += records.not_published([records.Rule(name, F.expr(rule), parts) for name, rule in DRAFT_CHECKS], F.expr(DRAFT))
    return records.exception_report(base(t), ["c_custkey"], rules, ["c_name", "area", "c_mktsegment"])


@query(
    "k40_publication_state",
    """SELECT o_orderkey, CASE WHEN o_totalprice < 5000 THEN 'Deleted' WHEN c_mktsegment = 'BUILDING' THEN 'Deceased before publication' WHEN c_acctbal < 0 THEN 'No consent' WHEN o_orderstatus = 'P' THEN 'Draft' ELSE 'Published' END AS state
    FROM orders JOIN customer ON c_custkey = o_custkey""",
)
def _(t: Tables) -> DataFrame:
    joined = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    state = records.publication_state(F.col("o_orderstatus") == "P", F.col("o_totalprice") < 5000, F.col("c_mktsegment") == "BUILDING", F.col("c_acctbal") >= 0)
    return joined.select("o_orderkey", state.alias("state"))


@query(
    "k41_change_texts",
    """WITH n AS (SELECT c_custkey, CASE WHEN c_acctbal < 3000 THEN 'MOVED' ELSE c_mktsegment END AS s2, c_mktsegment AS s1, CASE WHEN c_nationkey > 12 THEN c_nationkey + 1 ELSE c_nationkey END AS n2, c_nationkey AS n1 FROM customer)
    SELECT c_custkey, concat_ws('; ', CASE WHEN s1 <> s2 THEN 'c_mktsegment: ' || s1 || ' -> ' || s2 END, CASE WHEN n1 <> n2 THEN 'c_nationkey: ' || n1 || ' -> ' || n2 END) AS changes FROM n WHERE s1 <> s2 OR n1 <> n2""",
)
def _(t: Tables) -> DataFrame:
    now = t.customer.withColumns(
        {
            "c_mktsegment": F.when(F.col("c_acctbal") < 3000, "MOVED").otherwise(F.col("c_mktsegment")),
            "c_nationkey": F.col("c_nationkey") + (F.col("c_nationkey") > 12).cast("int"),
        }
    )
    return records.change_texts(now, t.customer, "c_custkey", ["c_name", "c_nationkey", "c_mktsegment"])


@query(
    "k50_feed_profile",
    """WITH f AS (SELECT event_id, nullif(event_type, 'error') AS event_type, ts, CASE WHEN value > 20 THEN value END AS value FROM events WHERE ts > TIMESTAMP '2024-01-10')
    SELECT column_name, rows, nulls, round(nulls * 100.0::DOUBLE / rows, 2) AS null_pct FROM (SELECT 'event_id' AS column_name, count(*) AS rows, count(*) - count(event_id) AS nulls FROM f
    UNION ALL SELECT 'event_type', count(*), count(*) - count(event_type) FROM f UNION ALL SELECT 'ts', count(*), count(*) - count(ts) FROM f UNION ALL SELECT 'value', count(*), count(*) - count(value) FROM f)""",
)
def _(t: Tables) -> DataFrame:
    f = t.events.select("event_id", F.nullif("event_type", F.lit("error")).alias("event_type"), "ts", F.when(F.col("value") > 20, F.col("value")).alias("value"))
    return records.feed_profile(f, "ts", at(2024, 1, 10))


@query("k50_newest_sample", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id LIMIT 100")
def _(t: Tables) -> DataFrame:
    return records.newest_sample(t.events.select("event_id", "ts", "event_type"), [F.col("ts").desc(), F.col("event_id")], 100)


@query(
    "k51_decoded_record",
    """SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Built' WHEN 'HOUSEHOLD' THEN 'Home' ELSE 'Unknown' END AS c_mktsegment_text, n_name AS team, date_diff('day', created, closed) AS days_to_closed, date_diff('day', created, died) AS days_to_died,
    md5(regexp_replace(html, '<[^>]*>', '', 'g')) AS digest, CASE WHEN EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P') THEN 1 ELSE 0 END::INT AS has_pending FROM (SELECT *, DATE '2001-01-01' - (c_custkey % 500)::INT AS created,
    CASE WHEN c_acctbal > 0 THEN DATE '2002-01-01' END AS closed, CASE WHEN c_mktsegment = 'BUILDING' THEN DATE '2003-02-01' END AS died FROM customer) LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN pages ON page_id = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    people = t.customer.withColumns(
        {
            "created": F.date_sub(F.lit(dt.date(2001, 1, 1)), (key() % 500).cast("int")),
            "closed": F.when(F.col("c_acctbal") > 0, F.lit(dt.date(2002, 1, 1))),
            "died": F.when(F.col("c_mktsegment") == "BUILDING", F.lit(dt.date(2003, 2, 1))),
        }
    )
    codes = {"c_mktsegment": ({"BUILDING": "Built", "HOUSEHOLD": "Home"}, "Unknown")}
    nations = t.nation.withColumnRenamed("n_nationkey", "c_nationkey")
    texts = t.pages.select(F.col("page_id").alias("c_custkey"), "html")
    pending = t.orders.filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey"))
    out = records.decoded_record(people, codes, {"team": (nations, "c_nationkey", "n_name")}, "created", ["closed", "died"], texts, {"has_pending": pending}, "c_custkey")
    return out.select("c_custkey", "c_mktsegment_text", "team", "days_to_closed", "days_to_died", F.md5("plain_text").alias("digest"), "has_pending")


BLOCKS = ["addresses", "contact_info", "aliases", "alerts", "allergies", "contacts", "diagnoses", "disabilities", "medications", "symptoms"]
SPELT = "coalesce(replace(replace(replace({}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '(N/A)')"
PRACTICE_SQL = " || ".join(
    f"'{label}' || " + SPELT.format(value)
    for label, value in [
        ("Practitioner", "practitioner"),
        ("Title", "staff_title"),
        ("Staff code", "staff_code"),
        ("Practice", "practice"),
        ("Practice code", "practice_code"),
        ("Postcode", "practice_postcode"),
        ("Phone", "practice_phone"),
    ]
)


@query(
    "k51_full_record",
    f"""WITH b AS (SELECT page_id // {len(BLOCKS)} AS k, page_id % {len(BLOCKS)} AS n, html FROM pages),
    w AS (SELECT k, {", ".join(f"md5(max(html) FILTER (n = {i})) AS {b}_raw, md5(regexp_replace(max(html) FILTER (n = {i}), '<[^>]*>', '', 'g')) AS {b}_plain" for i, b in enumerate(BLOCKS))} FROM b GROUP BY k),
    s AS (SELECT n_nationkey AS staff_id, nullif(concat_ws(' ', CASE WHEN n_nationkey % 3 > 0 THEN n_name END, CASE WHEN n_nationkey % 4 > 0 THEN '<' || n_regionkey || '>' END), '') AS practitioner,
      CASE WHEN n_regionkey > 1 THEN 'Dr' END AS staff_title, 'S' || n_nationkey AS staff_code FROM nation),
    p AS (SELECT s_suppkey AS practice_id, s_name AS practice, 'P' || s_suppkey AS practice_code, CASE WHEN s_acctbal > 0 THEN lower(s_name) || '@example.org' END AS practice_email,
      CASE WHEN s_acctbal > 2000 THEN 'tel' || s_suppkey END AS practice_phone, s_nationkey || ' Road & Lane' AS practice_address, 'N' || s_nationkey AS practice_postcode FROM supplier),
    r AS (SELECT c_custkey, CASE c_mktsegment WHEN 'BUILDING' THEN 'Built' WHEN 'HOUSEHOLD' THEN 'Home' END AS c_mktsegment_text, c_nationkey AS staff_id, c_custkey % 120 AS practice_id FROM customer)
    SELECT c_custkey, c_mktsegment_text, practitioner, staff_title, practice, practice_email, practice_address, {PRACTICE_SQL} AS practice_text, {", ".join(f"{b}_raw, {b}_plain" for b in BLOCKS)}
    FROM r LEFT JOIN s USING (staff_id) LEFT JOIN p USING (practice_id) LEFT JOIN w ON k = c_custkey""",
)
def _(t: Tables) -> DataFrame:
    people = t.customer.withColumns({"staff_id": F.col("c_nationkey"), "practice_id": key() % 120, "created": F.lit(dt.date(2001, 1, 1))})
    staff = t.nation.select(
        F.col("n_nationkey").alias("staff_id"),
        F.when(F.col("n_regionkey") > 1, "Dr").alias("staff_title"),
        F.when(F.col("n_nationkey") % 3 > 0, F.col("n_name")).alias("forename"),
        F.when(F.col("n_nationkey") % 4 > 0, F.concat(F.lit("<"), "n_regionkey", F.lit(">"))).alias("surname"),
        F.concat(F.lit("S"), "n_nationkey").alias("staff_code"),
    )
    practices = t.supplier.select(
        F.col("s_suppkey").alias("practice_id"),
        F.col("s_name").alias("practice"),
        F.concat(F.lit("P"), "s_suppkey").alias("practice_code"),
        F.when(F.col("s_acctbal") > 0, F.concat(F.lower("s_name"), F.lit("@example.org"))).alias("practice_email"),
        F.when(F.col("s_acctbal") > 2000, F.concat(F.lit("tel"), "s_suppkey")).alias("practice_phone"),
        F.concat("s_nationkey", F.lit(" Road & Lane")).alias("practice_address"),
        F.concat(F.lit("N"), "s_nationkey").alias("practice_postcode"),
    )
    n = len(BLOCKS)
    of = F.floor(F.col("page_id") / n).alias("c_custkey")
    blocks = {b: t.pages.filter(F.col("page_id") % n == i).select(of, "html") for i, b in enumerate(BLOCKS)}
    none = t.pages.select(F.col("page_id").alias("c_custkey"), "html").filter("false")
    codes = {"c_mktsegment": ({"BUILDING": "Built", "HOUSEHOLD": "Home"}, "Unknown")}
    decoded = records.decoded_record(people, codes, {}, "created", [], none, {}, "c_custkey")
    out = records.full_record(decoded, staff, practices, blocks, "c_custkey", {"c_mktsegment_text": "Unknown"})
    kept = ["c_custkey", "c_mktsegment_text", "practitioner", "staff_title", "practice", "practice_email", "practice_address", "practice_text"]
    return out.select(*kept, *[c for b in BLOCKS for c in (F.md5(f"{b}_html").alias(f"{b}_raw"), F.md5(b).alias(f"{b}_plain"))])
