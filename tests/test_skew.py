"""A hot key is split where a big side meets an aggregate or a one-row-per-key choice."""

import pytest
from pyspark.sql import functions as F

from fathomline.operators import joins, keys
from fathomline.plans import attendance, audit

# nothing is broadcast, and a few kilobytes already count as a large partition
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
}


@pytest.fixture
def low(spark):
    old = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def big(spark, tmp_path_factory):
    """60,000 rows, 70 % of them with one key."""
    n = F.col("id")
    hot = F.when(n % 10 < 7, F.lit(0).cast("long")).otherwise(n % 500)
    rows = spark.range(0, 60_000, numPartitions=8).select(n.alias("item_id"), hot.alias("k"), F.sha2(n.cast("string"), 256).alias("pay"))
    path = str(tmp_path_factory.mktemp("skew") / "rows")
    rows.write.parquet(path)
    return path


def other(df):
    return df.filter("item_id % 3 = 0").select("k", F.col("pay").alias("v"), F.col("item_id").alias("o"))


def log(df):
    day = F.timestamp_seconds(F.col("item_id") * 60)
    return df.select("item_id", F.col("k").alias("record_id"), day.alias("ts"), (F.col("item_id") % 40).alias("staff_id"),
                     (F.col("item_id") % 9).alias("team_id"), F.lit("view").alias("action"), "pay")


def grouped(df, key, *aggs):
    return df.groupBy(key).agg(*aggs)


def team_audit(df):
    rows = log(df)
    staff = grouped(rows, "staff_id", F.max("pay").alias("staff_name"))
    return audit.team_audit(rows, staff, grouped(rows, "team_id", F.max("pay").alias("team_name")), "view")


CASES = {
    "exists_flag": lambda df: keys.exists_flag(df, other(df), ["k"], "has"),
    "restrict_to_keys": lambda df: keys.restrict_to_keys(df, other(df), ["k"]),
    "enrich": lambda df: joins.enrich(df.withColumn("v", F.lit(None).cast("string")), other(df), ["k"], ["v"], [F.col("o").desc()]),
    "prefix_lookup": lambda df: joins.prefix_lookup(
        df.withColumn("code", F.format_string("%08d", "k")), other(df).withColumn("ref", F.format_string("%08d", "k")), "code", "ref", "v"
    ),
    "team_audit": team_audit,
    "beside": lambda df: keys.beside(df, ["k"], {"most": F.max("pay")}),
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_hot_key_is_split(low, big, name):
    out = CASES[name](low.read.parquet(big))
    sums = out.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*out.columns)))
    split = sums.collect()[0]
    text = sums._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in text, text
    low.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    try:
        whole = CASES[name](low.read.parquet(big))
        assert whole.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64(*whole.columns))).collect()[0] == split
    finally:
        low.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")


def test_a_hot_code_meets_the_dictionary_once_per_group(low, big):
    """Decoding joins no row by its code: 42,000 rows with one code come as one per group of neighbours."""
    rows = low.read.parquet(big).withColumn("_group", F.shiftright(F.monotonically_increasing_id(), attendance.GROUP_BITS))
    groups = rows.select("_group").distinct().count()
    codes = attendance.group_codes(rows, ["k"])
    assert codes.filter("code = '0'").count() == groups <= 60_000 // 2**attendance.GROUP_BITS + 8
    known = low.range(0, 500, 2).select(F.col("id").cast("string").alias("code"), F.concat(F.lit("text "), "id").alias("description"))
    out = attendance.decode(low.read.parquet(big), known, {"k": "text"})
    want = F.when(F.col("k") % 2 == 0, F.concat(F.lit("text "), F.col("k")))
    assert out.count() == 60_000 and out.filter(~F.col("text").eqNullSafe(want)).count() == 0
