"""The queries of the subpackage against their SQL twins, and the pipeline stage by stage."""

from __future__ import annotations

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from gridlake.llm.common import stored
from gridlake.llm.queries import ORACLES, QUERIES
from tests.conftest import SF_DIR
from workload.check import differences


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_its_twin(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "labels", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')")
    # Arrow keeps types and nulls of both sides; a nullable number has another pandas type in each of them.
    assert not differences(QUERIES[name](spark, SF_DIR).toArrow(), con.sql(ORACLES[name]).to_arrow_table())


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stored(stage(spark, left, SF_DIR), name)
        assert after.columns == docs.columns
        if name in ("quality", "near_dedup"):
            assert 0.5 * left.count() < after.count() <= left.count()
            assert after.exceptAll(left).isEmpty()
        if name == "pii":
            assert after.count() == left.count()
        left = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, left, SF_DIR).toPandas()
    assert set(pieces["doc_id"]) == {r["doc_id"] for r in left.select("doc_id").distinct().collect()}
    assert (pieces.groupby("sequence_id")["length"].sum() == 2048).sum() >= pieces["sequence_id"].nunique() - 1


def test_stages_keep_columns_that_look_like_their_own(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60).withColumns(
        {c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in ("_score", "class_key", "_n_replaced", "mix", "mix_shard", "mix_place", "_part")}
    )
    docs = stored(docs, "odd-names")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for table in (docs, docs.where("false")):
            after = stage(spark, table, SF_DIR).drop("text", "n_chars")
            assert after.columns == [c for c in docs.columns if c not in ("text", "n_chars")], name
            assert after.exceptAll(docs.select(*after.columns).unionAll(docs.select(*after.columns))).isEmpty(), name


def test_quality_hands_few_texts_to_python_at_once(spark, monkeypatch):
    """Rows come with the number of rows that reached Python with them, in a task with 1,000."""

    def counted(docs, network, score):
        schema = docs.withColumn(score, F.lit(1.0)).schema
        return docs.mapInPandas(lambda frames: (f.assign(n_chars=len(f), **{score: 1.0}) for f in frames), schema)

    monkeypatch.setattr(corpus_pipeline.quality, "fitted", lambda docs, labels: 1.0)
    monkeypatch.setattr(corpus_pipeline.quality, "scored", counted)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").crossJoin(spark.range(5)).drop("id").coalesce(1)
    after = corpus_pipeline.quality_filter(spark, docs, SF_DIR)
    assert after.count() == docs.count() == 1000 and after.agg(F.max("n_chars")).first()[0] <= 500


def test_packing_hands_few_rows_to_python_at_once(spark, monkeypatch):
    """As above; and the workers are told how many words to remember."""

    def counted(docs, *args, remembered, **kwargs):
        assert remembered == corpus_pipeline.WORDS < 450_000
        return docs.mapInPandas(lambda frames: (f.assign(n_chars=len(f)) for f in frames), docs.schema)

    monkeypatch.setattr(corpus_pipeline.packing, "pack", counted)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").crossJoin(spark.range(5)).drop("id").coalesce(1)
    after = corpus_pipeline.sequences(spark, docs, SF_DIR)
    assert after.count() == docs.count() == 1000 and after.agg(F.max("n_chars")).first()[0] <= 500


def test_a_run_goes_on_behind_its_last_whole_stage(spark, monkeypatch):
    calls = []

    def stage(name, kept):
        return name, lambda spark, docs, sf_dir: calls.append(name) or docs.where(kept)

    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage("one", "doc_id % 2 = 0"), stage("two", "doc_id % 3 = 0"), stage("last", "true")])
    first = corpus_pipeline.run(spark, SF_DIR, "again").count()
    assert calls == ["one", "two", "last"] and corpus_pipeline.run(spark, SF_DIR, "again").count() == first
    assert calls == ["one", "two", "last", "last"]
