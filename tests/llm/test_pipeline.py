"""The stages of the pipeline, each against a plain version of its own decision."""

import brute
import pytest
from conftest import SF

import corpus_pipeline
from rosterflow.llm import language_id, source_mixing


@pytest.fixture(scope="module")
def stages(spark, documents, tmp_path_factory):
    """Input and output of every stage, written and read again as the pipeline does."""
    folder, docs, out = tmp_path_factory.mktemp("stages"), documents, []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{folder}/{i}")
        result = spark.read.parquet(f"{folder}/{i}")
        out.append((name, docs, result))
        docs = result
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages, documents):
    assert all(out.columns == documents.columns for _, _, out in stages[:-1])


def test_language_stage(stages):
    _, docs, out = stages[0]
    scores = language_id.identify(docs, language_id.fit(docs)).collect()
    assert {i for i, _ in rows(out)} == {r["doc_id"] for r in scores if r["lang_pred"] != "und" and r["score"] >= corpus_pipeline.LEAST_SCORE}
    assert out.count() >= 0.99 * docs.count()


def test_line_stage(stages):
    _, docs, out = stages[1]
    want = brute.line_dedup(rows(docs))
    assert dict(rows(out)) == {i: t for i, (n, lost, t) in want.items() if lost < n or not n}
    assert all(r["n_chars"] == len(r["text"]) for r in out.collect() if want[r["doc_id"]][1])


def test_document_stage(stages):
    _, docs, out = stages[2]
    assert {i for i, _ in rows(out)} == {i for i, (_, c) in brute.near_duplicates(rows(docs), 5).items() if i == c}


def test_mixing_stage(stages):
    _, docs, out = stages[3]
    assert {i for i, _ in rows(out)} == {r["doc_id"] for r in source_mixing.mix(docs).collect() if r["kept"]}


def test_run_is_the_stages_in_turn(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1][2].collect()))


def test_stages_take_edge_rows(spark, edge, tmp_path):
    docs = edge
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
    assert docs.count() > 0


def test_stages_take_empty_tables(spark, nothing):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, nothing, SF).collect() == []
