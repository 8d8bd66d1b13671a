import os

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from skeinwork.llm import decontaminate, queries
from tests.oracle import connect, rows

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the driver's tables")


def test_every_operator_is_registered():
    names = entry.queries()
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names


@pytest.mark.parametrize("limit", [queries.SHARD_LIMIT, 20_000])
def test_sharding_equals_its_sql(spark, monkeypatch, limit):
    sql = queries.ORACLES["op5_sharding"].replace(str(queries.SHARD_LIMIT), str(limit))
    monkeypatch.setattr(queries, "SHARD_LIMIT", limit)
    got = queries.op5_sharding(spark, SF).toPandas()
    assert rows(got) == rows(connect(SF).sql(sql).df())


def test_the_pipeline_stage_by_stage(spark):
    """Each stage against what a plain reading of its input says."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, before, SF).cache()
        kept[name] = docs.count()
        assert docs.columns[: len(columns)] == columns
        if name == "near_duplicates":
            texts = [r["text"] for r in docs.select("text").collect()]
            assert len(texts) == len(set(texts))
        if name == "decontamination":
            assert decontaminate.find_leaks(docs, spark.read.parquet(f"{SF}/benchmark.parquet")).count() == 0
    assert docs.filter("NOT intact").count() == 0
    assert kept["language_id"] >= kept["near_duplicates"] >= kept["decontamination"] == kept["byte_bpe"] > 0
    run = corpus_pipeline.run(spark, SF)
    assert sorted(r["doc_id"] for r in run.select("doc_id").collect()) == sorted(r["doc_id"] for r in docs.select("doc_id").collect())


def test_the_pipeline_takes_odd_rows(spark, tmp_path):
    rows_ = [(1, None, None, "s", 0), (2, "", "en", "s", 0), (None, "the house and the people of the town", "en", "s", 9), (3, "der Hund und die Katze sind nicht im Haus", "de", None, 9), (3, "der Hund und die Katze sind nicht im Haus", "de", None, 9)]
    spark.createDataFrame(rows_, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] or 0) for r in got) == [0, 3]
    assert corpus_pipeline.run(spark, str(tmp_path)).columns[:5] == ["doc_id", "text", "lang", "source", "n_chars"]
