"""The pipeline on a small table: each stage against what it is to do with its own input."""

import numpy as np
import pytest

import corpus_pipeline
from concordat.llm import quality, simhash

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def outputs(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found = {"input": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.stored(stage(spark, docs, "/root/testdata/sf0.001"))
        found[name] = docs
    return found


def test_stages(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == list(outputs)[1:]
    for name in list(outputs)[:-1]:
        assert outputs[name].columns == COLUMNS


def test_quality_keeps_what_passes(outputs):
    want = {r.doc_id for r in quality.judge_documents(outputs["input"]).where("kept").collect()}
    assert {r.doc_id for r in outputs["quality_rules"].collect()} == want


def test_lines_only_go(outputs):
    before = {r.doc_id: r for r in outputs["quality_rules"].collect()}
    for r in outputs["line_dedup"].collect():
        assert set(r.text.split("\n")) <= {*before[r.doc_id].text.split("\n"), ""}
        assert r.n_chars == len(r.text) or r.n_chars == before[r.doc_id].n_chars


def test_one_document_of_each_group(outputs):
    rows = simhash.simhash_components(outputs["line_dedup"], 5, similarity=0.8).collect()
    assert sorted(r.doc_id for r in outputs["near_dedup"].collect()) == sorted({r.component_id for r in rows})


def test_mixture_repeats_whole_rows(outputs):
    assert {tuple(r) for r in outputs["mix_sources"].collect()} <= {tuple(r) for r in outputs["near_dedup"].collect()}


def test_windows_hold_all_tokens(outputs):
    rows = outputs["pack_windows"].toPandas()
    assert (rows.groupby("sequence_id").length.sum() <= 1024).all()
    assert len(rows[rows.start == 0]) == outputs["mix_sources"].count()
    assert (rows.ids.map(len) == 4 * rows.length).all() and np.isfinite(rows.offset).all()
