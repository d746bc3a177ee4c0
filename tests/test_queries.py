"""Every registered query against its SQL at sf0.01, and shape checks on the plans."""

import os
import subprocess
import sys

import pytest

from fathomline.catalog import all_queries
from fathomline.catalog.compare import compare, connect

FOLDER = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
QUERIES = all_queries()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    ok, note = compare(QUERIES[name], spark, duck, FOLDER)
    assert ok, note


SPLIT = "c09 c10 c11 c29 d12 d13 e02 e03 e04 e05 e06 e07 e10 e11 e12 e13 e15 e16 k01 k03 k04 k06 k07 k17 k21 k22 k24 k25 k28 k29 k36 k43 k47 k48"
ORDERED = [n for n in sorted(QUERIES) if n[:3] in SPLIT.split()]


@pytest.mark.parametrize("name", ORDERED)
def test_matches_sql_with_hot_keys_split(spark, duck, monkeypatch, name):
    """The same answers when nearly every key counts as hot."""
    monkeypatch.setattr("fathomline.operators.ordered.HOT_ROWS", 30)
    ok, note = compare(QUERIES[name], spark, duck, FOLDER)
    assert ok, note


def test_every_query_has_sql():
    assert [n for n, q in QUERIES.items() if q.sql is None] == []


def test_queries_and_sql_need_no_session():
    """The driver may ask for the SQL where no Spark is running."""
    code = "import __spark_entry__ as e; q = set(e.all_queries()); assert q <= set(e.queries()) and q <= set(e.oracle_sql())"
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    subprocess.run([sys.executable, "-c", code], cwd=root, check=True, timeout=120)


def plan(df, capsys, mode=None):
    df.explain(mode=mode)
    return capsys.readouterr().out


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_products_and_no_python(spark, capsys, name):
    """No query forms a product of two tables or leaves the JVM."""
    text = plan(QUERIES[name](spark, "/root/testdata/sf0.001"), capsys)
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "ArrowEvalPython", "BatchEvalPython", "FlatMapGroups"):
        assert bad not in text, text


def test_filters_and_columns_reach_the_scan(spark, capsys):
    text = plan(QUERIES["a01_columnar_scan"](spark, FOLDER), capsys, "formatted")
    assert "GreaterThanOrEqual(l_shipdate" in text and "EqualTo(l_returnflag,R)" in text
    assert "l_comment" not in text and "l_extendedprice" not in text


@pytest.mark.parametrize("name", ["e01_latest_per_key", "e09_order_by_case", "e17_drop_repeats", "c19_one_row_per_key", "d19_dominant_category"])
def test_groups_are_limited_before_the_shuffle(spark, capsys, name):
    text = plan(QUERIES[name](spark, FOLDER), capsys)
    assert text.count("WindowGroupLimit") >= 2, text
    assert "Partial" in text


@pytest.mark.parametrize("name", ["e02_sequence_per_key", "e06_gap_since_previous", "e10_global_sequence", "e12_islands", "e13_session_merge_full"])
def test_rows_are_windowed_by_key_and_split(spark, capsys, name):
    """Windows over rows are partitioned by the (key, split) span; only summaries are windowed by key."""
    text = plan(QUERIES[name](spark, FOLDER), capsys)
    rows = [line for line in text.splitlines() if "Window [" in line and "_span" in line]
    assert rows
    exchanges = [line for line in text.splitlines() if "Exchange hashpartitioning(_hash" in line and "_span" in line]
    assert exchanges
    assert "Exchange SinglePartition" not in text
