"""The pipeline on odd rows, and what it leaves in the shared folder."""

import os

import corpus_pipeline
import plain
import pytest

from setwise.llm import common
from setwise.session import shared_dir

STAGES = dict(corpus_pipeline.STAGES)


def folders(spark):
    place = shared_dir(spark)
    return set(os.listdir(place))


@pytest.fixture()
def tables(spark, docs, tmp_path):
    """The odd documents, with columns whose names clash, as a folder of tables."""
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(100, 1, 0), (101, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    return str(tmp_path)


def test_odd_rows_go_through_all_stages(spark, docs, messy, tables):
    before = folders(spark)
    out = corpus_pipeline.run(spark, tables)
    assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    lettered = {k for k, t in messy if t and any(c.isalpha() for c in t)}
    got = out.collect()
    assert got and {r["doc_id"] for r in got} <= lettered
    left = {f.rsplit("-", 1)[0] for f in folders(spark) - before}
    assert left == {name.replace(" ", "_") for name in STAGES}


def test_stages_keep_the_columns(spark, docs, tables):
    for name, stage in list(STAGES.items())[:-1]:
        assert stage(spark, docs, tables).columns == docs.columns, name


def test_an_empty_table(spark, nothing, tables, tmp_path):
    nothing.write.parquet(str(tmp_path / "none" / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "none" / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path / "none")).isEmpty()


def test_scratch_removes_what_it_held(spark):
    before = folders(spark)
    with common.scratch(spark):
        a = common.store(spark.range(5), "inner")
        b = common.store(a.where("id > 2"), "outer", keep=True)
    assert b.count() == 2
    assert {f.rsplit("-", 1)[0] for f in folders(spark) - before} == {"outer"}
    assert plain.ordered(b.collect()) == [(3,), (4,)]
