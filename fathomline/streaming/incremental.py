"""The high-water load as a stream: each run takes the files that arrived since the last one and stops."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def new_files(spark: SparkSession, source: str, schema: StructType, fmt: str = "parquet") -> DataFrame:
    return spark.readStream.format(fmt).schema(schema).load(source)


def append_new_files(spark: SparkSession, source: str, schema: StructType, target: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Append the unseen files of `source` to `target` exactly once; `checkpoint` remembers what was seen."""
    run = (
        new_files(spark, source, schema, fmt)
        .writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    run.awaitTermination()
