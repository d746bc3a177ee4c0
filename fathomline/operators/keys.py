"""One-row-per-key choices. `row_number() = 1` is planned as a group limit before the shuffle, so a
map task sends at most one row per key and a hot key never travels whole."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_safe(left: str, right: str, keys: Sequence[str]) -> Column:
    """Equality of the key columns of two aliased inputs, where NULL equals NULL."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in keys])


def shuffled_apart(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """df, small and already partitioned by its keys (an aggregate, a one-row-per-key choice), made ready to be joined by them.

    Spark splits a skewed partition of the big side only where a shuffle of their own stands under both sides of the join.
    A side that comes out of a grouping by the join key has none, so a hot key would be joined in one task. Placing it by
    a hash of the keys instead makes the join shuffle it again, which costs the small side once more.
    """
    return df.repartition(F.xxhash64(*keys))


def top_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int = 1, rank_col: str | None = None) -> DataFrame:
    """The first n rows of each key in the given order, which must end in a unique column."""
    ranked = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter(F.col("_rn") <= n)
    return ranked.withColumnRenamed("_rn", rank_col) if rank_col else ranked.drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The first row of each key in the given order."""
    return top_per_key(df, keys, order, 1)


one_per_key = latest_per_key
drop_repeats = latest_per_key


def beside(df: DataFrame, keys: Sequence[str], aggregates: dict[str, Column]) -> DataFrame:
    """Group aggregates beside each row: aggregate first (combined before the shuffle), then join back,
    where a hot key can be split by the adaptive skew join. A plain window would hold it in one task."""
    grouped = df.groupBy(*keys).agg(*[c.alias(name) for name, c in aggregates.items()]).alias("g")
    joined = df.alias("d").join(grouped, null_safe("d", "g", keys), "inner")
    return joined.select("d.*", *[F.col(f"g.{name}") for name in aggregates])


def flag_extreme(df: DataFrame, keys: Sequence[str], column: str, out: str, last: bool = True) -> DataFrame:
    """1 on the rows holding the largest (or smallest) value of their key, else 0."""
    extreme = F.max(column) if last else F.min(column)
    return (
        beside(df, keys, {"_extreme": extreme})
        .withColumn(out, F.coalesce((F.col(column) == F.col("_extreme")).cast("int"), F.lit(0)))
        .drop("_extreme")
    )


def version_flags(df: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """first_version and last_version flags per key."""
    both = beside(df, keys, {"_lo": F.min(version), "_hi": F.max(version)})
    return (
        both.withColumn("first_version", F.coalesce((F.col(version) == F.col("_lo")).cast("int"), F.lit(0)))
        .withColumn("last_version", F.coalesce((F.col(version) == F.col("_hi")).cast("int"), F.lit(0)))
        .drop("_lo", "_hi")
    )


def filter_groups(df: DataFrame, keys: Sequence[str], condition: Column) -> DataFrame:
    """Rows of the groups whose aggregate condition holds."""
    good = df.groupBy(*keys).agg(condition.alias("_ok")).filter("_ok").alias("g")
    return df.alias("d").join(good, null_safe("d", "g", keys), "left_semi")


def single_row_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur in exactly one row."""
    return df.groupBy(*keys).count().filter(F.col("count") == 1).select(*keys)


def restrict_to_keys(df: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is in keys_df: cuts the wide side before a join."""
    wanted = shuffled_apart(keys_df.select(*keys).distinct(), keys)
    return df.join(wanted, list(keys), "left_semi")


def exists_flag(df: DataFrame, other: DataFrame, keys: Sequence[str], out: str) -> DataFrame:
    """1 where the one-to-many side has any row of the key, else 0."""
    present = shuffled_apart(other.select(*keys).distinct(), keys).withColumn("_has", F.lit(1))
    return df.join(present, list(keys), "left").withColumn(out, F.coalesce("_has", F.lit(0))).drop("_has")


def latest_ref(df: DataFrame, flag: str = "is_latest", value: object = 1) -> DataFrame:
    """The current version of a reference table."""
    return df.filter(F.col(flag) == F.lit(value)).drop(flag)
