"""Reference jobs on the given tables: suppliers play practices and sites, customers staff and persons."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.catalog.registry import Tables, query
from fathomline.plans import organisation

def area_code() -> Column:
    return F.concat(F.substring("n_name", 1, 3), F.lpad(F.col("n_nationkey").cast("string"), 2, "0"), F.lit(" "), F.lpad((F.col("n_nationkey") * 3).cast("string"), 2, "0"))

AREA_SQL = "substring(n_name, 1, 3) || lpad(n_nationkey::VARCHAR, 2, '0') || ' ' || lpad((n_nationkey * 3)::VARCHAR, 2, '0')"


def postcode(n: Column) -> Column:
    return F.concat(F.lit("NAT"), F.lpad(n.cast("string"), 2, "0"), F.lit(" "), F.lpad((n * 3 + n % 2).cast("string"), 2, "0"))


def postcode_sql(n: str) -> str:
    return f"('NAT' || lpad(({n})::VARCHAR, 2, '0') || ' ' || lpad((({n}) * 3 + ({n}) % 2)::VARCHAR, 2, '0'))"


@query(
    "k13_practice_reference",
    f"""WITH rel AS (SELECT s_suppkey AS p, o_custkey % 40 AS net FROM orders JOIN supplier ON s_suppkey = o_orderkey % (SELECT count(*) FROM supplier)
    QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 2 END, o_orderdate DESC, o_custkey % 40) = 1),
    dom AS (SELECT net, area FROM (SELECT c_custkey % 40 AS net, c_mktsegment AS area, count(*) AS n FROM customer GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY net ORDER BY n DESC, area) = 1),
    ref AS (SELECT {AREA_SQL} AS code, n_name AS a FROM nation), s AS (SELECT s_suppkey, {postcode_sql('s_nationkey')} AS pc FROM supplier)
    SELECT s_suppkey AS practice_id, net AS network_id, dom.area AS network_area, coalesce((SELECT min(a) FROM ref WHERE code = pc), (SELECT min(a) FROM ref WHERE replace(code, ' ', '') = replace(pc, ' ', '')),
    (SELECT min(a) FROM ref WHERE left(replace(code, ' ', ''), 7) = left(replace(pc, ' ', ''), 7)), (SELECT min(a) FROM ref WHERE left(replace(code, ' ', ''), 6) = left(replace(pc, ' ', ''), 6)),
    (SELECT min(a) FROM ref WHERE left(replace(code, ' ', ''), 5) = left(replace(pc, ' ', ''), 5)), (SELECT min(a) FROM ref WHERE left(replace(code, ' ', ''), 4) = left(replace(pc, ' ', ''), 4))) AS authority
    FROM s LEFT JOIN rel ON p = s_suppkey LEFT JOIN dom USING (net)""",
)
def _(t: Tables) -> DataFrame:
    size = t.supplier.agg(F.count(F.lit(1))).scalar()
    relations = t.orders.select(
        (F.col("o_orderkey") % size).alias("practice_id"),
        (F.col("o_custkey") % 40).alias("network_id"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(2).alias("kind_rank"),
        F.col("o_orderdate").alias("started"),
    )
    practices = t.supplier.select(F.col("s_suppkey").alias("practice_id"), F.col("s_name").alias("name"), postcode(F.col("s_nationkey")).alias("postcode"))
    members = t.customer.select((F.col("c_custkey") % 40).alias("network_id"), F.col("c_mktsegment").alias("area"))
    postcodes = t.nation.select(area_code().alias("postcode"), F.col("n_name").alias("authority"))
    return organisation.practice_reference(practices, relations, members, postcodes).select("practice_id", "network_id", "network_area", "authority")


@query(
    "k14_site_reference",
    """SELECT s_suppkey AS site_id, sn.n_name AS site_area, c_name AS parent_name, cn.n_name AS parent_area, CASE WHEN c_name = 'Customer#000000003' THEN 'C3' ELSE 'Other' END AS abbreviation
    FROM supplier JOIN nation sn ON sn.n_nationkey = s_nationkey LEFT JOIN customer ON c_custkey = s_suppkey % 7 LEFT JOIN nation cn ON cn.n_nationkey = c_nationkey""",
)
def _(t: Tables) -> DataFrame:
    sites = t.supplier.select(F.col("s_suppkey").alias("site_id"), (F.col("s_suppkey") % 7).alias("parent_id"), F.col("s_nationkey").alias("postcode"))
    parents = t.customer.select(F.col("c_custkey").alias("parent_id"), F.col("c_name").alias("parent_name"), F.col("c_nationkey").alias("parent_postcode"))
    grid = t.nation.select(F.col("n_nationkey").alias("postcode"), F.col("n_name").alias("area"))
    out = organisation.site_reference(sites, parents, grid, {"Customer#000000003": "C3"})
    return out.select("site_id", "site_area", "parent_name", "parent_area", "abbreviation")


@query(
    "k18_organisation_base",
    """WITH s AS (SELECT 'N' || c_nationkey AS code, c_name AS name, 'portal' AS source, c_mktsegment AS type FROM customer UNION ALL SELECT 'N' || s_nationkey, s_name, 'registry', 'SUPPLIER' FROM supplier),
    m AS (SELECT CASE WHEN n_nationkey IS NOT NULL THEN 'N' || (n_nationkey + 1) ELSE code END AS cur, *, CASE source WHEN 'registry' THEN 1 ELSE 2 END AS rnk FROM s LEFT JOIN nation ON code = 'N' || n_nationkey AND n_regionkey = 2 WHERE lower(name) NOT LIKE '%#00000000_')
    SELECT cur AS current_code, min_by(name, (rnk, name)) AS name, min_by(source, (rnk, name)) AS source, min(type) AS type, count(*) AS source_rows FROM m GROUP BY 1""",
)
def _(t: Tables) -> DataFrame:
    c = t.customer.select(F.concat(F.lit("N"), "c_nationkey").alias("code"), F.col("c_name").alias("name"), F.lit("portal").alias("source"), F.col("c_mktsegment").alias("type"))
    s = t.supplier.select(F.concat(F.lit("N"), "s_nationkey").alias("code"), F.col("s_name").alias("name"), F.lit("registry").alias("source"), F.lit("SUPPLIER").alias("type"))
    moves = t.nation.filter("n_regionkey = 2").select(
        F.concat(F.lit("N"), "n_nationkey").alias("old_code"), F.concat(F.lit("N"), F.col("n_nationkey") + 1).alias("new_code")
    )
    return organisation.organisation_base(c.unionByName(s), ["registry", "portal"], moves, ["%#00000000_"])


@query(
    "k19_organisation_hierarchy",
    """WITH e AS (SELECT c_custkey AS child, c_custkey // 5 AS parent, CASE WHEN c_acctbal > 0 THEN DATE '2000-01-01' + (c_custkey % 900)::INT END AS s, CASE WHEN c_nationkey > 3 THEN DATE '2003-01-01' - (c_custkey % 700)::INT END AS f FROM customer WHERE c_custkey > 0
    UNION ALL SELECT c_custkey, c_custkey // 3, NULL, NULL FROM customer WHERE c_mktsegment = 'MACHINERY' AND c_custkey > 0),
    v AS (SELECT child, min(parent) AS parent FROM e WHERE (s IS NULL OR s <= DATE '2001-12-01') AND (f IS NULL OR f >= DATE '2001-12-01') GROUP BY 1)
    SELECT c_custkey AS level_1, b.parent AS level_2, c.parent AS level_3, d.parent AS level_4, x.parent AS level_5, y.parent AS level_6, z.parent AS level_7 FROM customer LEFT JOIN v b ON b.child = c_custkey
    LEFT JOIN v c ON c.child = b.parent LEFT JOIN v d ON d.child = c.parent LEFT JOIN v x ON x.child = d.parent LEFT JOIN v y ON y.child = x.parent LEFT JOIN v z ON z.child = y.parent""",
)
def _(t: Tables) -> DataFrame:
    key = F.col("c_custkey")
    people = t.customer.filter("c_custkey > 0")
    a = people.select(
        key.alias("child"),
        F.expr("c_custkey div 5").alias("parent"),
        F.when(F.col("c_acctbal") > 0, F.date_add(F.lit(dt.date(2000, 1, 1)), (key % 900).cast("int"))).alias("start"),
        F.when(F.col("c_nationkey") > 3, F.date_sub(F.lit(dt.date(2003, 1, 1)), (key % 700).cast("int"))).alias("end"),
    )
    open_ended = F.lit(None).cast("date")
    b = people.filter("c_mktsegment = 'MACHINERY'").select(key.alias("child"), F.expr("c_custkey div 3").alias("parent"), open_ended.alias("start"), open_ended.alias("end"))
    return organisation.hierarchy(t.customer, a.unionByName(b), "c_custkey", F.lit(dt.date(2001, 12, 1)))


@query(
    "k20_staff_links",
    """WITH l AS (SELECT o_orderkey AS link_id, o_custkey AS staff_id, o_orderkey % 4 AS org_id, CASE o_orderstatus WHEN 'F' THEN o_orderdate::DATE - 10 WHEN 'O' THEN DATE '1900-01-01' END AS s, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderdate::DATE + (o_orderkey % 300)::INT END AS f, o_orderdate AS created FROM orders),
    r AS (SELECT *, CASE WHEN s IS NULL OR s = DATE '1900-01-01' THEN created::DATE ELSE s END AS start FROM l)
    SELECT staff_id, org_id, link_id, start::VARCHAR AS start, f::VARCHAR AS "end" FROM r QUALIFY row_number() OVER (PARTITION BY staff_id, org_id ORDER BY f DESC NULLS FIRST, start DESC, created DESC, link_id DESC) = 1""",
)
def _(t: Tables) -> DataFrame:
    key, day, status = F.col("o_orderkey"), F.to_date("o_orderdate"), F.col("o_orderstatus")
    links = t.orders.select(
        key.alias("link_id"),
        F.col("o_custkey").alias("staff_id"),
        (key % 4).alias("org_id"),
        F.when(status == "F", F.date_sub(day, 10)).when(status == "O", F.lit(dt.date(1900, 1, 1))).alias("start"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.date_add(day, (key % 300).cast("int"))).alias("end"),
        F.col("o_orderdate").alias("created"),
    )
    return organisation.staff_links(links).select("staff_id", "org_id", "link_id", "start", "end")


@query(
    "k44_registered_practice",
    """WITH r AS (SELECT o_custkey AS person, o_orderkey % (SELECT count(*) FROM supplier) AS practice, o_orderdate::DATE AS s, CASE WHEN o_orderstatus = 'F' THEN o_orderdate::DATE + 365 END AS f FROM orders),
    c AS (SELECT * FROM r WHERE s <= DATE '1999-01-01' AND (f IS NULL OR f >= DATE '1999-01-01') QUALIFY row_number() OVER (PARTITION BY person ORDER BY s DESC, practice) = 1)
    SELECT c_custkey AS person_id, practice AS practice_id, s_name AS practice_name FROM customer LEFT JOIN c ON person = c_custkey LEFT JOIN supplier ON s_suppkey = practice""",
)
def _(t: Tables) -> DataFrame:
    size, day = t.supplier.agg(F.count(F.lit(1))).scalar(), F.to_date("o_orderdate")
    registrations = t.orders.select(
        F.col("o_custkey").alias("person_id"), (F.col("o_orderkey") % size).alias("practice_id"), day.alias("start"), F.when(F.col("o_orderstatus") == "F", F.date_add(day, 365)).alias("end")
    )
    practices = t.supplier.select(F.col("s_suppkey").alias("practice_id"), F.col("s_name").alias("practice_name"))
    people = t.customer.select(F.col("c_custkey").alias("person_id"))
    return organisation.registered_practice(people, registrations, practices, F.lit(dt.date(1999, 1, 1)))


@query(
    "k52_resolved_roles",
    """WITH one AS (SELECT * FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey) = 1), st AS (SELECT c_custkey AS ref, 'O' || c_custkey AS o, 'L' || (c_custkey // 2) AS l FROM customer WHERE c_acctbal > -500)
    SELECT l_orderkey AS record_id, a.o AS author_original_id, a.l AS author_latest_id, b.o AS editor_original_id, b.l AS editor_latest_id, c.o AS approver_original_id, c.l AS approver_latest_id, d.o AS owner_original_id, d.l AS owner_latest_id
    FROM one LEFT JOIN st a ON a.ref = l_suppkey LEFT JOIN st b ON b.ref = l_partkey LEFT JOIN st c ON c.ref = l_suppkey + l_linenumber LEFT JOIN st d ON d.ref = l_partkey % 97""",
)
def _(t: Tables) -> DataFrame:
    records = t.lineitem.select(
        F.col("l_orderkey").alias("record_id"),
        F.col("l_suppkey").alias("author"),
        F.col("l_partkey").alias("editor"),
        (F.col("l_suppkey") + F.col("l_linenumber")).alias("approver"),
        (F.col("l_partkey") % 97).alias("owner"),
        "l_shipdate", "l_linenumber", "l_partkey", "l_suppkey",
    )
    staff = t.customer.filter("c_acctbal > -500").select(
        F.col("c_custkey").alias("ref"), F.concat(F.lit("O"), "c_custkey").alias("original_id"), F.concat(F.lit("L"), F.expr("c_custkey div 2")).alias("latest_id")
    )
    order = [F.col("l_shipdate").desc(), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")]
    return organisation.resolve_roles(records, ["author", "editor", "approver", "owner"], staff, order)
