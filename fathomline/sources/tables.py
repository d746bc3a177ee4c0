"""Readers and schema helpers."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def read_table(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    recursive: bool = False,
    schema: StructType | None = None,
    **options: str,
) -> DataFrame:
    """Scan one table. `fmt` may be any installed source; `recursive` walks nested folders."""
    reader = spark.read.format(fmt).options(**options)
    if recursive:
        reader = reader.option("recursiveFileLookup", "true")
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def empty_table(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows, with the given types."""
    return spark.createDataFrame([], schema)


def read_optional(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    """Scan a table that may be missing. Only a missing path gives the empty result; other errors surface."""
    try:
        return align_schema(read_table(spark, path, fmt), schema)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" not in str(error.getCondition()):
            raise
        return empty_table(spark, schema)


def optional_col(df: DataFrame, *names: str, default: object = None, dtype: str | None = None) -> Column:
    """The first of `names` that df has (case is ignored), else a literal default."""
    present = {c.lower(): c for c in df.columns}
    for name in names:
        if name.lower() in present:
            column = F.col(f"`{present[name.lower()]}`")
            break
    else:
        column = F.lit(default)
    return column.cast(dtype) if dtype else column


def values_table(spark: SparkSession, rows: Sequence[tuple], schema: str | StructType) -> DataFrame:
    """A small constant table written in the job itself."""
    return spark.createDataFrame(list(rows), schema)


def align_schema(df: DataFrame, schema: StructType, keep_extra: bool = False) -> DataFrame:
    """df with the columns of `schema`, in that order and type; missing ones are typed NULL."""
    present = {c.lower(): c for c in df.columns}
    columns = []
    for field in schema.fields:
        source = present.pop(field.name.lower(), None)
        value = F.col(f"`{source}`") if source is not None else F.lit(None)
        columns.append(value.cast(field.dataType).alias(field.name))
    if keep_extra:
        columns += [F.col(f"`{c}`") for c in present.values()]
    return df.select(*columns)


def clean_names(names: Iterable[str]) -> list[str]:
    """Letters, digits and underscores only; repeats get a numeric suffix."""
    taken: set[str] = set()
    result = []
    for name in names:
        base = re.sub(r"[^0-9A-Za-z]+", "_", name.strip()).strip("_") or "col"
        candidate, n = base, 1
        while candidate.lower() in taken:
            n += 1
            candidate = f"{base}_{n}"
        taken.add(candidate.lower())
        result.append(candidate)
    return result


def clean_columns(df: DataFrame) -> DataFrame:
    """df with safe, unambiguous column names."""
    return df.toDF(*clean_names(df.columns))


def merge_layouts(current: DataFrame, historic: DataFrame, mapping: dict[str, Column | str]) -> DataFrame:
    """Current rows united (distinct) with rows of an older layout, renamed and retyped through `mapping`.

    `mapping` gives, per current column, the expression over the historic table; absent ones become NULL.
    """
    picked = []
    for field in current.schema.fields:
        source = mapping.get(field.name)
        value = F.lit(None) if source is None else (F.col(source) if isinstance(source, str) else source)
        picked.append(value.cast(field.dataType).alias(field.name))
    return current.unionByName(historic.select(*picked)).distinct()
