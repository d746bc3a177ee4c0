"""Load patterns. Each takes the stored rows and a batch and gives the new stored rows, lazily.

The batch is used twice by most of them (its keys, then its rows): pass one that is already written
(`session.materialise`) where it is expensive to compute.

Writers never change a path in place while it is read: callers write the result to a new path, or
use partitions with `write_window`, which touches the partitions of the window only, or with `rewrite_touched`, which applies a
pattern to the partitions that hold a key of the batch and leaves the files of all others.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from fathomline.operators.keys import latest_per_key, null_safe
from fathomline.session import Stages, path_exists, remove_path
from fathomline.sources.tables import align_schema


def write_overwrite(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = (), files: int | None = None) -> None:
    """Replace everything at `path`. An empty df still leaves a readable, typed table."""
    out = df.coalesce(files) if files else df
    out.write.format(fmt).mode("overwrite").partitionBy(*partition_by).save(path)


def write_append(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> None:
    """Append. Readers of a table that gained columns pass mergeSchema=true."""
    df.write.format(fmt).mode("append").partitionBy(*partition_by).save(path)


def partition_folders(spark: SparkSession, path: str, partition_by: Sequence[StructField], fmt: str = "parquet") -> DataFrame:
    """(partition columns, folder, file) of a stored table: each partition's folder as the file system names it, and one of its files. Values have the types of the fields given, whatever text the folders spell them with; no column is read."""
    stored = spark.read.format(fmt).schema(StructType(list(partition_by))).load(path)
    file = F.col("_metadata.file_path")
    names = [F.col(f"`{f.name}`") for f in partition_by]
    files = stored.select(*names, F.regexp_replace(file, "/[^/]*$", "").alias("folder"), file.alias("file"))
    return files.groupBy(*names, "folder").agg(F.min("file").alias("file"))


def _replace_partitions(df: DataFrame, path: str, partition_by: Sequence[str], fmt: str, before: dict[str, str]) -> None:
    """Dynamic partition overwrite, and then the folders of `before` (with one of their files) that df had no row for go: a folder
    that was overwritten has other files."""
    df.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).save(path)
    if before:
        spark, fields = df.sparkSession, [df.schema[c] for c in partition_by]
        after = partition_folders(spark, path, fields, fmt).select("folder", "file").collect()
        for folder, file in after:
            if before.get(folder) == file and not remove_path(spark, folder, encoded=True):
                raise OSError(f"could not remove {folder}")


def write_window(
    df: DataFrame, path: str, partition_by: Sequence[str], fmt: str = "parquet", low: object | None = None, high: object | None = None
) -> None:
    """Replace partitions, so a rerun is idempotent: those present in df (dynamic partition overwrite) and, where bounds are
    given, also those (of all levels) with low <= first partition column < high that df has no row for, whose rows are stale.

    Bounds are compared in the type of the column; a NULL partition is in no window. An absent path is a first load. df is read once. New
    partitions are written before stale ones go: after a failure between the two a rerun completes the work. One row per partition
    folder of the window passes through the driver."""
    spark, before = df.sparkSession, {}
    if low is not None and path_exists(spark, path):
        first = df.schema[partition_by[0]]
        column = F.col(f"`{first.name}`")
        inside = (column >= F.lit(low).cast(first.dataType)) & (column < F.lit(high).cast(first.dataType))
        folders = partition_folders(spark, path, [df.schema[c] for c in partition_by], fmt)
        before = {r["folder"]: r["file"] for r in folders.filter(inside).collect()}
    _replace_partitions(df, path, partition_by, fmt, before)


Change = Callable[[DataFrame, DataFrame], DataFrame]


def rewrite_touched(spark: SparkSession, path: str, batch: DataFrame, keys: Sequence[str], partition_by: Sequence[str], change: Change, fmt: str = "parquet") -> int:
    """Apply a load pattern to a stored table of partitions and rewrite only the partitions that it can change; returns how many.

    Touched are the partitions that hold a key of the batch and, if the batch has the partition columns, those of its rows. Only these
    are read in full and replaced; of the others the keys alone are read and the files stay. `change` takes
    the touched rows and the batch, such as replace_by_key, upsert_newer or merge_update with their keys filled in; it must leave
    rows alone whose key is not in the batch. A row that moves to another partition leaves the old one, and a partition left
    without rows goes. NULL keys and NULL partitions match each other. The new rows are written beside the table first, so a lost
    executor or a rerun finds the old ones whole until they are replaced."""
    with Stages(spark) as stages:
        batch = stages.write(batch, "batch")
        stored = spark.read.format(fmt).load(path)
        fields = [stored.schema[c] for c in partition_by]
        names = [F.col(f"`{c}`") for c in partition_by]
        fresh = batch.select(*keys).distinct().alias("b")
        held = stored.select(*dict.fromkeys([*keys, *partition_by])).alias("t").join(fresh, null_safe("t", "b", keys), "left_semi").select(*names)
        if set(partition_by) <= set(batch.columns):
            held = held.union(batch.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in fields]))
        touched = stages.write(held.distinct(), "touched")
        # the first partition column as literals, so that other folders are not listed for reading; then the exact partitions
        values = [r[0] for r in touched.select(names[0]).distinct().collect()]  # partition folders, not rows
        pruned = stored.filter(names[0].isin([v for v in values if v is not None]) | (names[0].isNull() if None in values else F.lit(False)))
        rows = pruned.alias("s").join(touched.alias("p"), null_safe("s", "p", partition_by), "left_semi")
        after = stages.write(change(rows, batch).select(*stored.columns), "rewritten")
        folders = partition_folders(spark, path, fields, fmt).alias("s").join(touched.alias("p"), null_safe("s", "p", partition_by), "left_semi")
        before = {r["folder"]: r["file"] for r in folders.collect()}
        _replace_partitions(after, path, partition_by, fmt, before)
        return len(before)


def rebuild_snapshot(df: DataFrame, as_of: Column, column: str = "snapshot_time") -> DataFrame:
    """A full rebuild stamped with its snapshot time."""
    return df.withColumn(column, as_of)


def replace_by_key(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Stored rows whose key is in the batch go; all batch rows come in. NULL keys match each other."""
    fresh = batch.select(*keys).distinct().alias("b")
    kept = target.alias("t").join(fresh, null_safe("t", "b", keys), "left_anti")
    return kept.unionByName(align_schema(batch, target.schema))


def replace_by_window(target: DataFrame, batch: DataFrame, column: str, low: object, high: object) -> DataFrame:
    """Stored rows with low <= column < high go; batch rows of that window come in."""
    dtype = target.schema[column].dataType
    inside = (F.col(column) >= F.lit(low).cast(dtype)) & (F.col(column) < F.lit(high).cast(dtype))
    kept = target.filter(~F.coalesce(inside, F.lit(False)))
    return kept.unionByName(align_schema(batch.filter(inside), target.schema))


def snapshot(target: DataFrame, current: DataFrame, period_col: str, value: object) -> DataFrame:
    """Replace the snapshot of one period by the current rows stamped with it."""
    stamped = current.withColumn(period_col, F.lit(value).cast(target.schema[period_col].dataType))
    kept = target.filter(~F.coalesce(F.col(period_col) == F.lit(value), F.lit(False)))
    return kept.unionByName(align_schema(stamped, target.schema))


def insert_new(target: DataFrame, batch: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the batch rows whose key is not stored yet; stored rows stay as they are."""
    stored = target.select(*keys).distinct().alias("t")
    added = batch.alias("b").join(stored, null_safe("b", "t", keys), "left_anti")
    return target.unionByName(align_schema(added, target.schema))


def upsert_newer(target: DataFrame, batch: DataFrame, keys: Sequence[str], version: str) -> DataFrame:
    """Insert new keys, then replace the stored rows of a key where the batch holds a higher version of it.

    Of several batch rows of a key the highest version counts, and among equal versions the greatest row by its other
    columns. Every stored row stays or is replaced; none is lost where a key is stored twice."""
    rows, others = align_schema(batch, target.schema), [c for c in target.columns if c not in (*keys, version)]
    one = latest_per_key(rows, keys, [F.col(version).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in others]])
    fresh = one.select(*keys, F.struct(*target.columns).alias("_new")).alias("b")
    joined = target.alias("t").join(fresh, null_safe("t", "b", keys), "left")
    newer = F.col(f"_new.{version}") > F.col(f"t.{version}")
    kept = joined.select(*[F.when(newer, F.col(f"_new.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in target.columns])
    stored = target.select(*keys).distinct().alias("t")
    return kept.unionByName(one.alias("b").join(stored, null_safe("b", "t", keys), "left_anti"))


def merge_update(target: DataFrame, source: DataFrame, keys: Sequence[str], cols: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Update `cols` of the stored rows that have a match; nothing is inserted. One source row per key is enforced first."""
    one = latest_per_key(source, keys, order).select(*keys, F.struct(*cols).alias("_new")).alias("s")
    joined = target.alias("t").join(one, null_safe("t", "s", keys), "left")
    picked = [
        F.when(F.col("_new").isNotNull(), F.col(f"_new.{c}")).otherwise(F.col(f"t.{c}")).alias(c) if c in cols else F.col(f"t.{c}")
        for c in target.columns
    ]
    return joined.select(*picked)


def high_water(target: DataFrame, column: str) -> Column:
    """The stored maximum as a scalar subquery: it never passes through the driver program."""
    return target.agg(F.max(column)).scalar()


def incremental_by_id(source: DataFrame, target: DataFrame, column: str, lookback: object | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """Source rows above the stored maximum (everything if nothing is stored).

    With `lookback` the window reopens that far below the maximum and rows already stored by `keys` are left out.
    """
    mark = high_water(target, column)
    low = mark - F.lit(lookback) if lookback is not None else mark
    fresh = source.filter(mark.isNull() | (F.col(column) > low))
    if lookback is None:
        return fresh
    stored = target.filter(F.col(column) > low).select(*keys).distinct().alias("t")
    return fresh.alias("s").join(stored, null_safe("s", "t", keys), "left_anti")


def plan_dates(
    spark: SparkSession, existing: DataFrame, column: str, start: dt.date, today: dt.date, lag_days: int = 2, refresh_days: int = 8
) -> DataFrame:
    """Days to build: (a) wanted but missing, (b) the refresh window ending at the latest complete day.

    Columns: day, reason ('refresh' or 'missing').
    """
    last = today - dt.timedelta(days=lag_days)
    wanted = spark.range(1).select(F.explode(F.sequence(F.lit(start), F.lit(last))).alias("day"))
    stored = existing.select(F.col(column).cast("date").alias("day")).filter(F.col("day").isNotNull()).distinct()
    latest = F.least(stored.agg(F.max("day")).scalar(), F.lit(last))
    flagged = wanted.withColumn("_refresh", F.coalesce(F.col("day").between(F.date_sub(latest, refresh_days - 1), latest), F.lit(False)))
    missing = flagged.filter(~F.col("_refresh")).join(stored, "day", "left_anti").select("day", F.lit("missing").alias("reason"))
    refresh = flagged.filter("_refresh").select("day", F.lit("refresh").alias("reason"))
    return missing.unionByName(refresh)


def export_partitioned(df: DataFrame, path: str, column: str, fmt: str = "parquet") -> None:
    """One folder per period label. Rows spread over tasks by label and AQE splits labels that are too big."""
    df.hint("rebalance", column).write.format(fmt).mode("overwrite").partitionBy(column).save(path)


def assign_ids(target: DataFrame, batch: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Keep stored ids; give a new one to each key that has none. The id is a digest of the key, so
    a recomputed task gives the same id again (a random id would not)."""
    stored = target.select(*keys).distinct().alias("t")
    fresh = batch.select(*keys).distinct().alias("b").join(stored, null_safe("b", "t", keys), "left_anti")
    digest = F.sha2(F.to_json(F.struct(*keys)), 256)
    return target.select(*keys, id_col).unionByName(fresh.select(*keys, digest.alias(id_col)))
