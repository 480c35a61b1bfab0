"""The stages one after the other, each held against what it got."""

import corpus_pipeline
import numpy as np
import pytest
from conftest import SF

from souk.llm import bpe, simhash
from souk.llm.frames import stage


@pytest.fixture(scope="module")
def stages(spark):
    found = [spark.read.parquet(f"{SF}/documents.parquet")]
    for _, function in corpus_pipeline.STAGES:
        found.append(stage(function(spark, found[-1], SF)))
    return found


def test_stages_are_the_agreed_ones(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "line_dedup", "simhash_near_dedup", "source_mixing", "bpe_encoding"]
    assert all(s.columns == stages[0].columns for s in stages[1:-1])


def test_quality_keeps_the_good(spark, stages):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    lost = stages[0].join(stages[1].select("doc_id"), "doc_id", "left_anti").join(labels, "doc_id")
    good = labels.filter("quality = 1").count()
    assert lost.filter("quality = 1").count() <= 0.05 * good


def test_line_dedup_keeps_each_line(stages):
    lines = lambda df: {x for r in df.collect() for x in (r.text or "").split("\n")}
    assert lines(stages[1]) - {""} == lines(stages[2]) - {""}
    assert all(r.n_chars == len(r.text) for r in stages[2].collect())


def test_one_of_each_group_stays(stages):
    before = {r.id: r.group for r in simhash.simhash_groups(stages[2]).collect()}
    assert sorted(r.doc_id for r in stages[3].collect()) == sorted(set(before.values()))
    prints = np.array([simhash.fingerprint(r.text) for r in stages[3].collect()], dtype=np.uint64)
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    assert near.sum() == len(prints)


def test_mixing_only_repeats(stages):
    assert {tuple(r) for r in stages[4].collect()} <= {tuple(r) for r in stages[3].collect()}


def test_encoding_is_that_of_the_library(stages):
    library = bpe.codec(bpe.default_vocabulary()).tokenizer
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert len(rows) == stages[4].count()
    assert all(list(r.ids) == library.encode(texts[r.doc_id], add_special_tokens=False).ids for r in rows)


def test_run_gives_the_rows_of_the_last_stage(spark, stages):
    key = lambda df: sorted((r.doc_id, r.n_tokens) for r in df.collect())
    assert key(corpus_pipeline.run(spark, SF)) == key(stages[-1])
