"""Derived columns and predicates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def band(c: Column | str, edges: Sequence[float], labels: Sequence[str], other: str | None = None, closed: bool = False, null_label: str | None = None) -> Column:
    """Label of the band a number falls in.

    Band i holds edges[i] <= value < edges[i+1], or <= on both ends with `closed` (first match wins).
    NULL gets `null_label` if given, else `other`.
    """
    if len(labels) != len(edges) - 1:
        raise ValueError("need one label per pair of edges")
    value = _col(c)
    result = F.when(value.isNull(), F.lit(null_label if null_label is not None else other))
    for low, high, label in zip(edges, edges[1:], labels):
        upper = value <= high if closed else value < high
        result = result.when((value >= low) & upper, label)
    return result.otherwise(F.lit(other))


def flag(condition: Column, otherwise: object = 0) -> Column:
    """1 where the condition is true, else `otherwise`; an unknown condition counts as false."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(otherwise))


def flag_in(c: Column | str, codes: Sequence[object], otherwise: object = 0) -> Column:
    return flag(_col(c).isin(list(codes)), otherwise)


def flag_any(conditions: Sequence[Column], otherwise: object = 0) -> Column:
    return flag(reduce(lambda a, b: a | b, conditions), otherwise)


def not_in_or_null(c: Column | str, codes: Sequence[object]) -> Column:
    """Exclusion that keeps NULL."""
    return _col(c).isNull() | ~_col(c).isin(list(codes))


def breach(c: Column | str, limit: float) -> tuple[Column, Column]:
    """Flag for values above the limit, and the excess."""
    value = _col(c)
    return flag(value > limit), F.when(value.isNotNull(), F.greatest(value - F.lit(limit), F.lit(0)))


def or_default(c: Column | str, label: object) -> Column:
    return F.coalesce(_col(c), F.lit(label))


def safe_ratio(num: Column | str | float, den: Column | str, scale: float = 100000.0) -> Column:
    """num / den * scale, NULL where den is 0 or NULL."""
    top = F.lit(num) if isinstance(num, (int, float)) else _col(num)
    return top / F.nullif(_col(den), F.lit(0)) * F.lit(scale)


def stale_flag(closed: Column | str, last_report: Column | str, as_of: object, months: int = 6) -> Column:
    """1 for an open record without a report in the last `months` months."""
    return flag(_col(closed).isNull() & (F.add_months(_col(last_report), months) < F.lit(as_of)))


def record_status(end: Column | str, period: Column | str, last_period: Column) -> Column:
    """Closed with an end; open if still reported in the last period; else inactive."""
    return F.when(_col(end).isNotNull(), "Closed").when(_col(period) == last_period, "Open").otherwise("Inactive")


def length_of_stay(start: Column | str, end: Column | str, as_of: object = None, inclusive: bool = False) -> Column:
    """Days from start to end; open records run to `as_of` if given. Inclusive counts both ends."""
    until = _col(end) if as_of is None else F.coalesce(_col(end), as_of if isinstance(as_of, Column) else F.lit(as_of))
    return F.datediff(until, _col(start)) + F.lit(1 if inclusive else 0)


def row_max(*cols: Column | str) -> Column:
    """Largest non-NULL value of a row."""
    return F.greatest(*[_col(c) for c in cols])


def exclude_matching(df: DataFrame, c: str, patterns: Sequence[str]) -> DataFrame:
    """Rows whose text is like none of the patterns (case ignored); NULL text stays."""
    hit = reduce(lambda a, b: a | b, [F.col(c).ilike(p) for p in patterns])
    return df.filter(F.col(c).isNull() | ~hit)


def unpivot_slots(df: DataFrame, keys: Sequence[str], slots: Sequence[str], pos: str = "pos", value: str = "value") -> DataFrame:
    """Numbered slot columns to one row per filled slot, keeping the slot number."""
    items = F.array(*[F.struct(F.lit(i).alias(pos), F.col(s).alias(value)) for i, s in enumerate(slots, 1)])
    rows = df.select(*keys, F.inline(items))
    return rows.filter(F.col(value).isNotNull())


def explode_list(df: DataFrame, keys: Sequence[str], c: str, sep: str = ",", pos: str = "pos", value: str = "value") -> DataFrame:
    """A delimited list to one row per item, with its position from 1."""
    return df.select(*keys, F.posexplode(F.split(F.col(c), "\\Q" + sep + "\\E")).alias("_p", value)).select(
        *keys, (F.col("_p") + 1).alias(pos), value
    )


HEADS = ("damages", "defence", "claimant")


def claim_measures(df: DataFrame) -> DataFrame:
    """Money measures of a claim; absent amounts count as 0, an absent excess never caps. The type of the amounts is kept:
    decimals stay decimals (share_pct then is one too).

    Reads: status (2 is closed), share_pct, reserve_<head> and paid_<head> per head, excess.
    """
    closed = F.col("status") == 2
    share = F.col("share_pct") / 100
    paid = {h: F.coalesce(F.col(f"paid_{h}"), F.lit(0)) for h in HEADS}
    reserve = {h: F.coalesce(F.col(f"reserve_{h}") * (F.lit(1) if h == "defence" else share), F.lit(0)) for h in HEADS}
    total_paid = reduce(lambda a, b: a + b, paid.values())
    total_reserve = reduce(lambda a, b: a + b, reserve.values())
    out = df.withColumns({"total_paid": total_paid, "total_reserve": total_reserve})
    out = out.withColumns(
        {
            "total_claim": F.when(closed, F.col("total_paid")).otherwise(F.col("total_reserve")),
            "outstanding": F.when(closed, F.lit(0)).otherwise(F.col("total_reserve") - F.col("total_paid")),
            **{f"outstanding_{h}": F.when(closed, F.lit(0)).otherwise(reserve[h] - paid[h]) for h in HEADS},
        }
    )
    return out.withColumns({"excess_applied": F.least("total_claim", "excess"), "funded": F.col("total_reserve") - F.col("excess")})


def claim_outcome(status: Column, damages_paid: Column, periodical: Column) -> Column:
    """Successful, Unsuccessful or Open; `periodical` marks claims settled by periodical payments."""
    paid = F.coalesce(damages_paid, F.lit(0))
    won = ((status == 2) & (paid > 0)) | periodical
    return F.when(won, "Successful").when((status == 2) & (paid <= 0), "Unsuccessful").otherwise("Open")
