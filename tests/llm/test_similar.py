"""Similar shingle sets against plain sets, in large groups of near copies too, and what the pipeline leaves behind."""

import os
import random

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from souk.llm import similar, simhash
from souk.llm.frames import scope, stage
from souk.operators.staging import shared_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def copies(n, words=100, changed=2, seed=1):
    """Copies of one text with some words changed: many in one band, few as similar as 0.8."""
    draw = random.Random(seed)
    base = [f"w{draw.randrange(10**6)}" for _ in range(words)]
    out = []
    for i in range(n):
        own = list(base)
        for at in draw.sample(range(words), changed):
            own[at] = f"x{draw.randrange(10**6)}"
        out.append((i, " ".join(own)))
    return out


def groups_of(rows, similarity=0.8):
    """The least id that each text reaches over fingerprints or sets, by looking at all pairs."""
    sets = [set(similar.shingle_set(t or "").tolist()) for _, t in rows]
    prints = np.array([simhash.fingerprint(t or "") for _, t in rows], np.uint64)
    label = list(range(len(rows)))

    def root(i):
        while label[i] != i:
            label[i] = label[label[i]]
            i = label[i]
        return i

    for i in range(len(rows)):
        near = np.bitwise_count(prints[i] ^ prints) <= 3
        for j in range(i):
            shared = len(sets[i] & sets[j])
            if near[j] or (shared and shared / (len(sets[i]) + len(sets[j]) - shared) >= similarity):
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {rows[i][0]: rows[root(i)][0] for i in range(len(rows))}


def test_shared_counts_are_those_of_plain_sets():
    draw = np.random.default_rng(4)
    for often in (1, 5, 200):
        sets = [np.unique(draw.zipf(1.3, draw.integers(0, 60)) % often) for _ in range(70)]
        wanted = [[len(set(a.tolist()) & set(b.tolist())) if i != j else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
        found = similar.shared_counts(sets)
        np.fill_diagonal(found, 0)
        assert found.tolist() == wanted
    assert similar.shared_counts([]).shape == (0, 0)


@pytest.mark.parametrize("chunk", [similar.CHUNK, 16])
def test_groups_of_near_copies_are_those_of_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(similar, "CHUNK", chunk)
    rows = copies(150) + [(1000 + i, t) for i, t in copies(60, 40, 1, seed=2)] + [(2000, None), (2001, ""), (2002, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.id: r.group for r in simhash.simhash_groups(docs).collect()}
    assert found == groups_of(rows)


def bytes_of(folder):
    return sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(folder) for f in names)


def test_many_near_copies(spark):
    rows = copies(2000)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    found = {r.id: r.group for r in simhash.simhash_groups(docs).collect()}
    # A fixed point of the links: all pairs of 1,200 of them, which is enough to see a lost one.
    few = groups_of(rows[:1200])
    assert all(found[i] == found[r] for i, r in few.items())


def test_the_groups_leave_one_table(spark):
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in copies(300)], DOCS)
    kept = simhash.first_of_each_group(docs)
    assert len([f for f in set(os.listdir(folder)) - before if f.startswith("souk-")]) == 1
    assert 0 < kept.count() < 300


def test_long_sets_are_chunks_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(similar, "CHUNK_SHINGLES", 100)
    rows = copies(30, 300, 1)
    found = simhash.simhash_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r.id: r.group for r in found} == groups_of(rows)


ODD = [
    (1, None, "en", "a", 0),
    (2, "", "en", "a", 0),
    (3, " \n\t ", None, None, 4),
    (4, "lorem ipsum dolor " * 9000, "en", "b", None),
    (4, "lorem ipsum dolor " * 9000, "en", "b", None),
    (None, "no id here", None, None, 10),
    (None, "no id here", None, None, 10),
    (6, "one two", "en", "c", 7),
    (7, "one two", "en", "c", 7),
    (8, "ünï </s><|endoftext|> 漢字 İ ß", "de", "c", 30),
]


@pytest.mark.parametrize("rows", [ODD, []])
def test_whole_pipeline_on_odd_rows(spark, tmp_path, rows):
    root = str(tmp_path)
    wide = spark.createDataFrame(rows, DOCS).withColumns({"id": F.lit(1), "version": F.lit("x"), "score": F.lit(0.1)})
    wide.write.parquet(f"{root}/documents.parquet")
    labels = [(6, 1, 0), (4, 1, 0), (None, 0, 0), (99, 0, 1), (2, None, None)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    folder = shared_folder(spark)
    before = set(os.listdir(folder))
    with scope(spark):
        result = corpus_pipeline.run(spark, root).collect()
        left = [f for f in set(os.listdir(folder)) - before if f.startswith("souk-")]
        assert len(left) == 1
    assert {r.doc_id for r in result} <= {r[0] for r in rows}
    assert set(os.listdir(folder)) == before


def test_every_stage_takes_empty_labels(spark, tmp_path):
    root = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    docs = spark.createDataFrame(ODD, DOCS)
    for name, function in corpus_pipeline.STAGES:
        with scope(spark, keep_last=True):
            docs = stage(function(spark, docs, root))
        assert docs.columns == ([f.split()[0] for f in DOCS.split(", ")] if name != "bpe_encoding" else ["doc_id", "n_tokens", "ids"])
