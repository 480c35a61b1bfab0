"""Multiple-instance toxicity: the gradient against differences, held-out labels, and the sentences it points at."""

import os

import numpy as np
import pytest
from conftest import SF

from souk.llm import queries, toxicity

DOCS = "doc_id long, text string, id int, score int, ones int, zeros int, offending string, held_out string"
LABELS = "doc_id long, toxic int, text string, ones int"
CLEAN = "the cat sat here. a dog ran there\nbirds sing in trees"
BAD = "the cat sat here. You grumblefink of a dog!\nbirds sing"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, "x", "y") for i, t in rows], DOCS)


def labels_of(spark, rows):
    return spark.createDataFrame([(i, y, "z", 9) for i, y in rows], LABELS)


def log_likelihood(ones, zeros, n, sizes, lengths, features, weights, bias):
    total = at = inside = 0
    for d in range(len(n)):
        clean = (1 - 1 / (1 + np.exp(-bias))) ** (n[d] - sizes[d])
        for _ in range(sizes[d]):
            own = features[inside : inside + lengths[at]]
            clean *= 1 - 1 / (1 + np.exp(-(weights[own].sum() + bias)))
            inside, at = inside + lengths[at], at + 1
        total += (ones[d] * np.log(1 - clean) if ones[d] else 0) + (zeros[d] * np.log(clean) if zeros[d] else 0)
    return total


def test_gradient_is_the_slope_of_the_likelihood():
    draw = np.random.default_rng(3)
    n, sizes = np.array([3, 1, 4, 0, 2]), np.array([2, 1, 0, 0, 2])
    lengths = np.array([2, 1, 3, 1, 2])
    features = draw.integers(0, 6, lengths.sum())
    ones, zeros = np.array([1, 0, 1, 0, 2]), np.array([0, 1, 0, 1, 1])
    weights, bias = draw.normal(size=6), -0.7
    found = toxicity.gradient(ones, zeros, n, sizes, lengths, features, weights, bias)
    for i in range(7):
        step = np.zeros(7)
        step[i] = 1e-6
        up, down = (
            log_likelihood(ones, zeros, n, sizes, lengths, features, weights + s[:-1], bias + s[-1]) for s in (step, -step)
        )
        assert found[i] == pytest.approx((up - down) / 2e-6, rel=1e-5, abs=1e-6)


def test_score_is_noisy_or_of_the_sentences():
    model = toxicity.Model({"=grumblefink": 0, "=dog": 1}, np.array([5.0, 1.0]), -3.0)
    score, found, n = model.score(BAD)
    p = lambda x: 1 / (1 + np.exp(-x))
    places = toxicity.sentences(BAD)
    assert n == len(places) == 3 and [i for i, _ in found] == [1]
    assert BAD[slice(*places[1])].strip() == "You grumblefink of a dog" and found[0][1] == pytest.approx(p(3.0))
    assert score == pytest.approx(1 - (1 - p(3.0)) * (1 - p(-3.0)) ** 2)
    assert model.score("") == (0.0, [], 0) and model.score(" 12 .. \n")[0] == 0.0
    assert [i for i, _ in model.score(" 1. İ!? .\nGRUMBLEFINK\ndog x.. grumblefink")[1]] == [1, 2, 3]
    assert [i for i, _ in model.score("x\n\n dog")[1]] == [1]


def test_held_out_labels_are_predicted(spark):
    root = os.path.join(os.path.dirname(SF), "sf0.1")
    scored = queries.op12_toxicity(spark, root)
    rows = scored.join(spark.read.parquet(f"{root}/labels.parquet"), "doc_id").filter("toxic is not null").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.predicted == r.toxic for r in held) >= 0.97 * len(held)
    assert sum(r.predicted for r in held if r.toxic == 0) <= 0.01 * len(held)
    assert scored.count() == spark.read.parquet(f"{root}/documents.parquet").count()


def test_the_offending_sentence_is_found(spark):
    rows = [(i, BAD if i % 4 == 0 else CLEAN) for i in range(200)]
    docs, labels = docs_of(spark, rows), labels_of(spark, [(i, int(i % 4 == 0)) for i in range(200)])
    for r in toxicity.toxicity(docs, labels).collect():
        assert r.predicted == int(r.id % 4 == 0)
        assert [s.sentence.strip() for s in r.offending] == (["You grumblefink of a dog"] if r.id % 4 == 0 else [])
        assert all(BAD[s.start : s.end] == s.sentence for s in r.offending)


def test_labels_are_learnt_from_the_other_folds_only(spark):
    rows = [(i, BAD if i % 4 == 0 else CLEAN) for i in range(200)]
    held = {r.id for r in spark.range(200).filter(toxicity.held_out("id")).collect()}
    true = [(i, int(i % 4 == 0)) for i in range(200)]
    lies = [(i, 1 - y if i in held else y) for i, y in true]
    scores = [
        sorted((r.id, r.score) for r in toxicity.toxicity(docs_of(spark, rows), labels_of(spark, x)).collect())
        for x in (true, lies)
    ]
    assert scores[0] == scores[1]


def test_odd_rows(spark):
    odd = [(1, None), (2, ""), (3, " \n\t "), (4, "the grumblefink " * 40_000), (4, "the grumblefink " * 40_000)]
    odd += [(None, BAD), (5, "x" * 100_000), (6, "ünï </s> 漢字 İ ß")]
    train = [(i, BAD if i % 4 == 0 else CLEAN) for i in range(100, 200)]
    labels = [(i, int(i % 4 == 0)) for i in range(100, 200)] + [(101, None), (102, 7), (None, 1), (104, 1), (1, 0)]
    found = toxicity.toxicity(docs_of(spark, odd + train), labels_of(spark, labels)).collect()
    assert len(found) == len(odd) + len(train)
    by_id = {r.id: r for r in found}
    assert by_id[1].score == by_id[2].score == by_id[3].score == 0 and by_id[1].predicted == 0
    assert by_id[4].predicted == 1 and by_id[None].predicted == 1 and by_id[None].held_out is False
    assert sum(r.id == 4 for r in found) == 2
    assert toxicity.toxicity(docs_of(spark, []), labels_of(spark, labels)).count() == 0


@pytest.mark.parametrize(("labels", "score"), [([], 0.5), ([(101, 1), (102, 1)], 1.0), ([(101, 0)], 0.0)])
def test_labels_of_one_kind(spark, labels, score):
    docs = docs_of(spark, [(101, CLEAN), (102, BAD), (103, "")])
    assert {r.score for r in toxicity.toxicity(docs, labels_of(spark, labels)).collect()} == {score}


def test_counted_features(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame([("aaaa bbb", 1, 0), ("aaaa aaaa", 0, 1), ("bbb", 2, 1)], "text string, ones long, zeros long")
    counted = docs.mapInArrow(toxicity._count_features, "feature string, ones long, zeros long")
    rows = counted.groupBy("feature").agg(F.sum("ones"), F.sum("zeros")).collect()
    assert sorted(map(tuple, rows)) == [("=aaaa", 1, 1), ("=bbb", 3, 1), ("aaa", 1, 1), ("aaaa", 1, 1), ("bbb", 3, 1)]
