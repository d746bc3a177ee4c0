"""Claim and case-concern jobs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fathomline.functions.rules import claim_measures, claim_outcome, row_max
from fathomline.operators.aggs import column_values, concat_numbered, concat_ordered, dynamic_pivot, payment_heads
from fathomline.operators.keys import latest_per_key
from fathomline.sources.loads import snapshot


def claim_view(claims: DataFrame, reserves: DataFrame, payments: DataFrame, contacts: DataFrame) -> DataFrame:
    """Claims with money measures, outcome, newest change and the latest open contact.

    claims: claim_id, status, excess, periodical, changed; reserves: claim_id, reserve_<head>, share_pct, reserve_changed;
    payments: see payment_heads, keyed by claim_id; contacts: claim_id, contact_id, opened, closed
    """
    paid = payment_heads(payments, ["claim_id"])
    open_contacts = contacts.filter(F.col("closed").isNull())
    last = latest_per_key(open_contacts, ["claim_id"], [F.col("opened").desc(), F.col("contact_id").desc()]).select("claim_id", "contact_id")
    joined = claims.join(reserves, "claim_id", "left").join(paid, "claim_id", "left").join(last, "claim_id", "left")
    out = claim_measures(joined)
    return out.withColumns(
        {
            "outcome": claim_outcome(F.col("status"), F.col("paid_damages"), F.col("periodical")),
            "last_change": row_max("changed", "reserve_changed", "last_paid"),
        }
    )


def monthly_snapshot(stored: DataFrame, current: DataFrame, month: str) -> DataFrame:
    """The stored snapshots with this month's replaced."""
    return snapshot(stored, current, "snapshot_month", month)


def concern_list(concerns: DataFrame) -> DataFrame:
    """Concerns of a case as one text per section. concerns: case_id, section, group_name, item, place (unique in a case)"""
    return concat_ordered(concerns, ["case_id", "section"], "item", ["place"], ", ", "items", split=True)


def concern_summary(concerns: DataFrame) -> DataFrame:
    """Numbered concerns of a case: '1) a 2) b'."""
    return concat_numbered(concerns, ["case_id"], "item", ["place"], " ", "summary")


def concern_matrix(concerns: DataFrame) -> DataFrame:
    """Cases by main concern: one column per concern found in the data, 1 where present."""
    return dynamic_pivot(concerns, ["case_id"], "item", F.max(F.lit(1)))


def numbered_matrix(rows: DataFrame, keys: Sequence[str], number: str, values: Sequence[str]) -> DataFrame:
    """Several columns per number found in the data, such as name_1, severity_1, name_2 ..."""
    columns = [F.max(F.when(F.col(number) == n, F.col(v))).alias(f"{v}_{n}") for n in column_values(rows, number) for v in values]
    return rows.groupBy(*keys).agg(*columns)
