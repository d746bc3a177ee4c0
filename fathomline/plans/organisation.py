"""Organisation, practice and staff reference jobs."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.rules import exclude_matching
from fathomline.functions.text import map_codes
from fathomline.operators.aggs import mode_per_key
from fathomline.operators.joins import effective_at, flatten_hierarchy, prefix_lookup, redirect_codes
from fathomline.operators.keys import latest_per_key

# Fixed value: the date that stands for an unknown start
UNKNOWN_START = dt.date(1900, 1, 1)


def practice_reference(practices: DataFrame, relations: DataFrame, members: DataFrame, postcodes: DataFrame) -> DataFrame:
    """Practices with their latest network, the dominant area of that network, and the area of their postcode.

    practices: practice_id, name, postcode; relations: practice_id, network_id, kind_rank, started;
    members: network_id, area; postcodes: postcode, authority
    """
    newest = [F.col("kind_rank").asc(), F.col("started").desc_nulls_last(), F.col("network_id").asc()]
    network = latest_per_key(relations, ["practice_id"], newest).select("practice_id", "network_id")
    area = mode_per_key(members, ["network_id"], "area").select("network_id", F.col("area").alias("network_area"))
    out = practices.join(network, "practice_id", "left").join(area, "network_id", "left")
    return prefix_lookup(out, postcodes, "postcode", "postcode", "authority")


def site_reference(sites: DataFrame, parents: DataFrame, grid: DataFrame, abbreviations: dict[str, str]) -> DataFrame:
    """Sites with their parent and both postcode areas. sites: site_id, parent_id, postcode; parents: parent_id, parent_name,
    parent_postcode; grid: postcode, area (unique)"""
    own = grid.select(F.col("postcode"), F.col("area").alias("site_area"))
    theirs = grid.select(F.col("postcode").alias("parent_postcode"), F.col("area").alias("parent_area"))
    out = sites.join(own, "postcode", "left").join(parents, "parent_id", "left").join(theirs, "parent_postcode", "left")
    return out.withColumn("abbreviation", map_codes("parent_name", abbreviations, "Other"))


def organisation_base(sources: DataFrame, precedence: Sequence[str], redirects: DataFrame, test_patterns: Sequence[str]) -> DataFrame:
    """One row per organisation code: redirected codes, the best source, a single type, no test rows.

    sources: code, name, source, type; redirects: old_code, new_code
    """
    moved = redirect_codes(sources, "code", redirects, "old_code", "new_code", "current_code")
    real = exclude_matching(moved, "name", test_patterns)
    rank = F.array_position(F.array(*[F.lit(s) for s in precedence]), F.col("source"))
    known = real.filter(rank > 0)
    best = known.groupBy("current_code").agg(
        F.min(F.struct(rank.alias("_rank"), F.col("name"), F.col("source"))).alias("_best"), F.min("type").alias("type"), F.count(F.lit(1)).alias("source_rows")
    )
    return best.select("current_code", F.col("_best.name").alias("name"), F.col("_best.source").alias("source"), "type", "source_rows")


def hierarchy(nodes: DataFrame, edges: DataFrame, node: str, at: Column, depth: int = 7) -> DataFrame:
    """Ancestors of each node over the edges in force at a date; the lowest parent counts where a child has several.

    edges: child, parent, start, end
    """
    current = effective_at(edges, "start", "end", at).groupBy("child").agg(F.min("parent").alias("parent"))
    return flatten_hierarchy(nodes, current, node, "child", "parent", depth)


def staff_links(links: DataFrame) -> DataFrame:
    """Latest span of each member of staff and organisation; an unknown or missing start becomes the creation date.

    links: staff_id, org_id, start, end, created
    """
    unknown = F.col("start").isNull() | (F.col("start") == F.lit(UNKNOWN_START))
    repaired = links.withColumn("start", F.when(unknown, F.to_date("created")).otherwise(F.col("start")))
    newest = [F.col("end").isNull().desc(), F.col("end").desc(), F.col("start").desc(), F.col("created").desc(), F.col("link_id").desc()]
    return latest_per_key(repaired, ["staff_id", "org_id"], newest)


def registered_practice(people: DataFrame, registrations: DataFrame, practices: DataFrame, at: Column) -> DataFrame:
    """The practice each person is registered with at a date. registrations: person_id, practice_id, start, end"""
    valid = effective_at(registrations, "start", "end", at)
    newest = [F.col("start").desc_nulls_last(), F.col("practice_id").asc()]
    current = latest_per_key(valid, ["person_id"], newest).select("person_id", "practice_id")
    return people.join(current, "person_id", "left").join(practices, "practice_id", "left")


def resolve_roles(records: DataFrame, roles: Sequence[str], staff: DataFrame, order: Sequence[Column]) -> DataFrame:
    """Original and latest ids for several roles of a record, one row per record.

    records carry one column per role with a staff reference and are ordered to choose the row; staff: ref, original_id, latest_id.
    The role columns are looked up in one join: roles to rows, one lookup, back to columns.
    """
    one = latest_per_key(records, ["record_id"], order)
    long = one.select("record_id", F.inline(F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("ref")) for r in roles])))
    found = long.join(staff, "ref", "left")
    wide = [F.max(F.when(F.col("role") == r, F.col(c))).alias(f"{r}_{c}") for r in roles for c in ("original_id", "latest_id")]
    return found.groupBy("record_id").agg(*wide)
