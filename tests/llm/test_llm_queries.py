"""Registered queries against SQL, and on whole tables against brute force where SQL has no say."""

import hashlib
import os

import duckdb
import numpy as np
import pytest
from compare import differences
from conftest import SF

from souk.llm import bpe, queries, simhash, token_counts

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_agrees_with_sql(spark, duck, name):
    assert differences(queries.QUERIES[name](spark, SF), duck, queries.SQL[name]) == []


def test_there_is_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in queries.QUERIES
    assert set(queries.SQL) <= set(queries.QUERIES)


def test_token_counts_are_those_of_the_library(spark, duck):
    library = token_counts._pieces(token_counts.default_model())
    wanted = {}
    for doc_id, text in duck.execute("select doc_id, text from documents").fetchall():
        n = len(library.encode(text or ""))
        wanted[doc_id] = (len((text or "").encode()), n, n > 4096)
    found = {r.doc_id: (r.n_bytes, r.n_tokens, r.over_limit) for r in queries.op2_token_counts(spark, SF).collect()}
    assert found == wanted


def test_encoding_is_that_of_the_library(spark, duck):
    library = bpe.codec(bpe.default_vocabulary()).tokenizer
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = {}
    for doc_id, text in duck.execute("select doc_id, text from documents").fetchall():
        ids = library.encode(text or "", add_special_tokens=False).ids
        wanted[doc_id] = (len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False)))
    found = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op6_bpe(spark, SF).collect()}
    assert found == wanted


def test_simhash_components_are_those_of_all_pairs(spark, duck):
    rows = duck.execute("select doc_id, text from documents order by doc_id").fetchall()
    ids = [i for i, _ in rows]
    prints = np.array([simhash.fingerprint(t or "") for _, t in rows], dtype=np.uint64)
    label = list(range(len(ids)))
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    while True:  # the least label of all neighbours, until nothing changes
        new = [min(label[j] for j in np.flatnonzero(near[i])) for i in range(len(ids))]
        if new == label:
            break
        label = new
    wanted = {ids[i]: (f"{int(prints[i]):016x}", ids[label[i]]) for i in range(len(ids))}
    found = {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op4_simhash(spark, SF).collect()}
    assert found == wanted


def test_nearest_recall_is_at_least_nine_tenths(spark, duck):
    rows = duck.execute("select vec_id, embedding from embeddings order by vec_id").fetchall()
    ids = np.array([i for i, _ in rows])
    unit = np.array([v for _, v in rows], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    found: dict[int, list] = {}
    for r in queries.op5_nearest(spark, SF).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(found) == [i for i in ids if i % 50 == 0]
    hits = 0
    for q, got in found.items():
        cosines = unit @ unit[list(ids).index(q)]
        cosines[list(ids).index(q)] = -2
        hits += len({v for v, _ in got} & set(ids[np.argsort(-cosines)[:5]].tolist()))
        for v, score in got:
            assert score == pytest.approx(cosines[list(ids).index(v)], abs=1e-12)
    assert hits >= 0.9 * 5 * len(found)


def test_held_out_labels_are_predicted(spark):
    root = os.path.join(os.path.dirname(SF), "sf0.01")
    scored = queries.op8_quality(spark, root).join(spark.read.parquet(f"{root}/labels.parquet"), "doc_id")
    rows = scored.filter("held_out and quality is not null").collect()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert sum(r.predicted == r.quality for r in rows) >= 0.95 * len(rows)
