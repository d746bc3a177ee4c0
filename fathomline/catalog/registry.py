"""How a query is registered."""

from __future__ import annotations

import os
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampType


class Tables:
    """The input tables of one folder; `t.orders` scans orders.parquet."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        # split a skewed join side even where that costs one more shuffle after the join
        spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")

    def path(self, name: str) -> str:
        return os.path.join(self.folder, f"{name}.parquet")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(self.path(name))


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return portable(self.build(Tables(spark, folder)))


REGISTRY: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a query under `name`, with the SQL it must agree with."""

    def add(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if name in REGISTRY:
            raise ValueError(f"{name} is registered twice")
        REGISTRY[name] = Query(name, build, sql)
        return build

    return add


def portable(df: DataFrame) -> DataFrame:
    """Dates as yyyy-MM-dd text and timestamps without zone, so that results compare across engines."""
    columns = []
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if isinstance(field.dataType, DateType):
            value = value.cast("string")
        elif isinstance(field.dataType, TimestampType):
            value = value.cast("timestamp_ntz")
        columns.append(value.alias(field.name))
    return df.select(*columns)
