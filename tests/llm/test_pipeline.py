"""The pipeline on awkward and empty tables, stage by stage, and on the given one."""

import os

import pytest

import corpus_pipeline
from test_edges import TABLES

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "row", "id", "digest", "key", "label", "comp"]


@pytest.fixture(scope="module", params=["awkward", "empty"])
def stages(request, spark, tmp_path_factory):
    top = str(tmp_path_factory.mktemp(request.param))
    for name in ("documents", "benchmark"):
        schema, rows = TABLES[name]
        if name == "documents":
            schema += ", _lost string, _corpus_row long, lines string"  # names that a stage might use itself
            rows = [(*r, "l", 1, "x") for r in rows]
        spark.createDataFrame(rows if request.param == "awkward" else [], schema).coalesce(2).write.parquet(os.path.join(top, f"{name}.parquet"))
    docs, out = spark.read.parquet(os.path.join(top, "documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        path = os.path.join(top, f"out-{name}")
        stage(spark, docs, top).write.parquet(path)
        docs = spark.read.parquet(path)
        out[name] = docs
    return request.param, out


def test_stages_keep_the_columns_and_only_remove_rows(stages):
    kind, out = stages
    before = None
    for name in ("quality", "lines", "similar", "benchmark"):
        assert out[name].columns == [*COLUMNS, "_lost", "_corpus_row", "lines"]
        rows = out[name].count()
        assert rows == 0 if kind == "empty" else before is None or rows <= before
        before = rows
    assert out["mix"].columns[:5] == ["doc_id", "size", "source_size", "target", "taken"]
    assert out["mix"].count() == before


def test_nulls_and_short_texts_go_first(stages):
    kind, out = stages
    assert not {r.doc_id for r in out["quality"].select("doc_id").collect()} & {3, 4, 5, 6, 8, 9, 10, 11}


def test_given_table(spark):
    rows = {r.doc_id: r for r in corpus_pipeline.run(spark, "/root/testdata/sf0.01").collect()}
    assert 500 < len(rows) < 1000 and all(0 <= r.taken <= 3 * r.size for r in rows.values())
