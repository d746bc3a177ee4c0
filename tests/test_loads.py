"""Load patterns on small tables in a temporary folder."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from fathomline.sources import loads, tables
from fathomline.streaming.incremental import append_new_files

SCHEMA = "k string, v int, d date"


def day(n):
    return dt.date(2024, 1, n)


@pytest.fixture()
def stored(spark):
    return spark.createDataFrame([("a", 1, day(1)), ("b", 2, day(2)), (None, 3, day(3)), ("c", 4, None)], SCHEMA)


@pytest.fixture()
def batch(spark):
    return spark.createDataFrame([("a", 9, day(4)), (None, 8, day(5)), ("d", 7, day(6))], SCHEMA)


def values(df):
    return sorted((r.k or "", r.v) for r in df.collect())


def test_replace_by_key_twice_equals_once(stored, batch):
    once = loads.replace_by_key(stored, batch, ["k"])
    assert values(once) == [("", 8), ("a", 9), ("b", 2), ("c", 4), ("d", 7)]
    assert values(loads.replace_by_key(once, batch, ["k"])) == values(once)


def test_empty_batch_and_empty_target(spark, stored, batch):
    none = spark.createDataFrame([], SCHEMA)
    for load in (loads.replace_by_key, loads.insert_new):
        assert values(load(stored, none, ["k"])) == values(stored)
        assert values(load(none, batch, ["k"])) == values(batch)
    assert values(loads.upsert_newer(none, batch, ["k"], "v")) == values(batch)


def test_replace_by_window_keeps_null_dates(stored, batch):
    out = loads.replace_by_window(stored, batch, "d", day(2), day(5))
    assert values(out) == [("a", 1), ("a", 9), ("c", 4)]


def test_insert_new(stored, batch):
    assert values(loads.insert_new(stored, batch, ["k"])) == [("", 3), ("a", 1), ("b", 2), ("c", 4), ("d", 7)]


def test_upsert_newer_only_replaces_with_higher_versions(spark):
    target = spark.createDataFrame([("a", 5, "old"), ("b", 5, "old"), ("c", None, "old")], "k string, version int, note string")
    batch = spark.createDataFrame([("a", 6, "new"), ("b", 5, "new"), ("c", 1, "new"), ("d", 1, "new")], "k string, version int, note string")
    got = {r.k: r.note for r in loads.upsert_newer(target, batch, ["k"], "version").collect()}
    assert got == {"a": "new", "b": "old", "c": "old", "d": "new"}


def test_merge_update_sets_null_and_takes_one_row_per_key(spark):
    target = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    source = spark.createDataFrame([("a", None, 2), ("a", 7, 1), ("z", 9, 1)], "k string, v int, n int")
    got = {r.k: r.v for r in loads.merge_update(target, source, ["k"], ["v"], [F.col("n").desc()]).collect()}
    assert got == {"a": None, "b": 2}


def test_snapshot_is_idempotent(spark):
    target = spark.createDataFrame([("a", 1, "2024-01")], "k string, v int, m string")
    now = spark.createDataFrame([("a", 2), ("b", 3)], "k string, v int")
    once = loads.snapshot(target, now, "m", "2024-02")
    twice = loads.snapshot(once, now, "m", "2024-02")
    assert sorted(map(tuple, twice.collect())) == [("a", 1, "2024-01"), ("a", 2, "2024-02"), ("b", 3, "2024-02")]


def test_increments_over_slices_equal_one_run(spark):
    source = spark.range(100).select(F.col("id"), (F.col("id") * 2).alias("x"))
    target = source.filter("id < 0")
    for high in (10, 10, 57, 100):
        seen = source.filter(F.col("id") < high)
        target = target.unionByName(loads.incremental_by_id(seen, target, "id"))
    assert sorted(r.id for r in target.collect()) == list(range(100))


def test_lookback_brings_late_rows_once(spark):
    source = spark.range(50).withColumnRenamed("id", "n")
    stored = source.filter("n < 40 AND n <> 35 AND n <> 3")
    out = loads.incremental_by_id(source, stored, "n", lookback=10, keys=["n"])
    assert sorted(r.n for r in out.collect()) == [35, *range(40, 50)]


def test_date_plan_of_an_empty_table(spark):
    none = spark.createDataFrame([], "d date")
    plan = loads.plan_dates(spark, none, "d", day(1), day(10))
    got = sorted((r.day, r.reason) for r in plan.collect())
    assert [d for d, _ in got] == [day(n) for n in range(1, 9)]


def test_ids_stay(spark):
    stored = spark.createDataFrame([("a", "x1")], "k string, id string")
    batch = spark.createDataFrame([("a",), ("b",), ("b",), (None,)], "k string")
    first = {r.k: r.id for r in loads.assign_ids(stored, batch, ["k"], "id").collect()}
    again = {r.k: r.id for r in loads.assign_ids(stored, batch, ["k"], "id").collect()}
    assert first == again and first["a"] == "x1" and len(set(first.values())) == 3


def test_writers(spark, tmp_path, stored, batch):
    path = str(tmp_path / "t")
    loads.write_overwrite(stored, path)
    loads.write_append(batch.withColumn("extra", F.lit(1)), path)
    both = tables.read_table(spark, path, mergeSchema="true")
    assert both.count() == 7 and "extra" in both.columns
    parts = str(tmp_path / "p")
    loads.write_window(stored.filter("d IS NOT NULL"), parts, ["d"])
    loads.write_window(stored.filter("d = '2024-01-02'").withColumn("v", F.lit(99)), parts, ["d"])
    assert values(spark.read.parquet(parts)) == [("", 3), ("a", 1), ("b", 99)]
    empty = str(tmp_path / "e")
    loads.write_overwrite(stored.filter("v > 100"), empty)
    assert tables.read_table(spark, empty).schema["v"].dataType.simpleString() == "int"


def test_optional_source_and_columns(spark, tmp_path):
    schema = StructType([StructField("k", StringType()), StructField("n", LongType())])
    missing = tables.read_optional(spark, str(tmp_path / "none"), schema)
    assert missing.count() == 0 and missing.schema == schema
    df = spark.createDataFrame([("x", 1)], "Name string, b int")
    out = df.select(tables.optional_col(df, "full_name", "name").alias("n"), tables.optional_col(df, "zz", default=5, dtype="long").alias("z"))
    assert tuple(out.first()) == ("x", 5)


def test_clean_names():
    assert tables.clean_names(["a b", "a-b", "A.b ", "%%", ""]) == ["a_b", "a_b_2", "A_b_3", "col", "col_2"]


def test_stream_takes_each_file_once(spark, tmp_path, stored):
    source, target, marks = (str(tmp_path / n) for n in ("in", "out", "marks"))
    for part in (stored, stored.limit(1)):
        loads.write_append(part, source)
        append_new_files(spark, source, stored.schema, target, marks)
    append_new_files(spark, source, stored.schema, target, marks)
    assert spark.read.parquet(target).count() == 5


def files_of(path):
    return {os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


@pytest.mark.parametrize(
    "kind, value, low, high",
    [("int", lambda n: n, 9, 13), ("date", day, day(9), day(13)), ("timestamp", lambda n: dt.datetime(2024, 1, n, 10, 30), dt.datetime(2024, 1, 9), dt.datetime(2024, 1, 13))],
)
def test_window_replaces_stale_partitions_of_any_type(spark, tmp_path, kind, value, low, high):
    path, schema = str(tmp_path / "t"), f"v int, p {kind}"
    make = lambda days, v: spark.createDataFrame([(v, value(n) if n else None) for n in days], schema)
    loads.write_window(make([1, 8, 9, 10, 11, 12, 13, 20, None], 0), path, ["p"], low=low, high=high)  # an absent path is a first load
    before = files_of(path)
    for _ in range(2):
        loads.write_window(make([12], 5), path, ["p"], low=low, high=high)
        got = sorted((r.v, r.p is None, r.p or 0) for r in spark.read.schema(schema).parquet(path).collect() if r.p is not None)
        assert got == sorted([(0, False, value(n)) for n in (1, 8, 13, 20)] + [(5, False, value(12))])
        assert spark.read.schema(schema).parquet(path).filter("p IS NULL").count() == 1
    assert len(files_of(path) & before) == 5


def test_window_of_two_levels(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda rows: spark.createDataFrame(rows, "v int, d date, s string")
    loads.write_window(make([(1, day(1), "a"), (2, day(2), "a"), (3, day(2), "b/c"), (4, day(3), "a")]), path, ["d", "s"])
    loads.write_window(make([(9, day(3), "z z")]), path, ["d", "s"], low=day(2), high=day(4))
    assert sorted(r.v for r in spark.read.parquet(path).collect()) == [1, 9]


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    path, schema = str(tmp_path / "t"), "k int, v int, version int, p int, q string"
    rows = [(k, 0, 1, k % 5, "x" if k % 2 else None) for k in range(40)] + [(99, 0, 1, 7, "lonely"), (None, 0, 1, 8, "n")]
    spark.createDataFrame(rows, schema).write.partitionBy("p", "q").parquet(path)
    before = files_of(path)
    batch = spark.createDataFrame([(3, 5, 2, 3, "x"), (99, 5, 2, 3, "x"), (None, 5, 2, 8, "n"), (500, 5, 2, 9, None)], schema)
    n = loads.rewrite_touched(spark, path, batch, ["k"], ["p", "q"], lambda old, new: loads.replace_by_key(old, new, ["k"]))
    got = sorted((-1 if r.k is None else r.k, r.v, r.p, r.q or "") for r in spark.read.schema(schema).parquet(path).collect())
    want = [(k, 0, k % 5, "x" if k % 2 else "") for k in range(40) if k != 3] + [(3, 5, 3, "x"), (99, 5, 3, "x"), (-1, 5, 8, "n"), (500, 5, 9, "")]
    assert got == sorted(want) and n == 3
    kept = files_of(path) & before
    assert {f for f in before if "p=7/" not in f and "p=8/" not in f and not ("p=3/" in f and "q=x" in f)} == kept
    assert not any("p=7" in f for f in files_of(path))
    # a source without the partition columns, and one that holds no stored key
    loads.rewrite_touched(spark, path, batch.select("k", F.lit(77).alias("v")).filter("k = 500"), ["k"], ["p", "q"], lambda old, new: loads.merge_update(old, new, ["k"], ["v"], [F.col("v")]))
    assert spark.read.parquet(path).filter("v = 77").count() == 1 and spark.read.parquet(path).count() == 43
    now = files_of(path)
    none = batch.filter("k = -5").select("k", "v")
    assert loads.rewrite_touched(spark, path, none, ["k"], ["p", "q"], lambda old, new: loads.merge_update(old, new, ["k"], ["v"], [F.col("v")])) == 0 and files_of(path) == now
    newer = spark.createDataFrame([(4, 8, 3, 4, None), (6, 8, 0, 1, None)], schema)
    loads.rewrite_touched(spark, path, newer, ["k"], ["p", "q"], lambda old, new: loads.upsert_newer(old, new, ["k"], "version"))
    assert {r.k: r.v for r in spark.read.parquet(path).filter("k IN (4, 6)").collect()} == {4: 8, 6: 0}
