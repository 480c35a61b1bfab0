"""Cross-tokenizer alignment against whole texts given to both libraries, and pair counts against plain counting."""

import hashlib
from collections import Counter, defaultdict

import duckdb
import pytest
from conftest import SF
from hypothesis import given, settings
from hypothesis import strategies as st

from souk.llm import alignment, queries

DOCS = "doc_id long, text string, id int, text_digest string, n_a string, pairs int, copies int, best int, a int"
ODD = [
    (1, None),
    (2, ""),
    (3, " \n\t "),
    (4, "lorem ipsum dolor " * 3000),
    (4, "lorem ipsum dolor " * 3000),
    (5, "x" * 20_000),
    (None, "no id  here "),
    (6, "one two\n\nthree  four"),
    (7, "one two\n\nthree  four"),
    (8, "ünï </s><|endoftext|> <0x41> 漢字 İ ß 😀 it's"),
    (9, "a ▁ b"),
    (10, "a\x00b \r\n c"),
]


@pytest.fixture(scope="module")
def own():
    return alignment.aligner(*alignment.default_paths())


def tokens(own, text):
    """Ids and bytes of the tokens of a whole text, by both libraries."""
    a, b = (own.a.encode(" " + text, add_special_tokens=False).ids, own.b.encode(text)) if text else ([], [])
    return a, b, [own.bytes_a[i] for i in a], [own.bytes_b[i] for i in b]


def brute_force(own, texts):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, digest) of each text, all from whole texts and byte ranges."""
    laid, counts = [], Counter()
    for text in texts:
        text = text or ""
        a, b, bytes_a, bytes_b = tokens(own, text)
        whole = (" " + text).encode()
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            laid.append(None)
            continue
        ranges = []
        for ids, parts in ((a, bytes_a), (b, bytes_b)):
            at, found = 0, []
            for i, p in zip(ids, parts, strict=True):
                found.append((i, at, at + len(p)))
                at += len(p)
            ranges.append(found)
        ends = sorted({e for *_, e in ranges[0]} & {e for *_, e in ranges[1]})
        by_end = [defaultdict(list), defaultdict(list)]
        for side, found in enumerate(ranges):
            for i, _, e in found:
                by_end[side][next(x for x in ends if x >= e)].append(str(i))
        links, j = [], 0
        for i, s, e in ranges[0]:
            j = max(0, j - 1)
            while ranges[1][j][2] <= s:
                j += 1
            k = j
            while k < len(ranges[1]) and ranges[1][k][1] < e:
                links.append((i, ranges[1][k][0]))
                k += 1
        counts.update(links)
        groups = ";".join(f"{','.join(by_end[0][e])}|{','.join(by_end[1][e])}" for e in ends)
        laid.append((len(a), len(b), len(ends), links, groups))
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    out = []
    for x in laid:
        if x is None:
            out.append((0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, n, links, groups = x
        best = sum(counts[p] == highest[p[1]] for p in links)
        total = sum(counts[p] for p in links)
        out.append((n_a, n_b, n, len(links), best, total, hashlib.sha256(groups.encode()).hexdigest()))
    return out, counts


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def test_query_agrees_with_brute_force(spark, own):
    rows = duckdb.sql(f"select doc_id, text from '{SF}/documents.parquet' order by doc_id").fetchall()
    # Groups are found by a scan of all ends, so the longest texts are compared by the other test below.
    wanted, _ = brute_force(own, [t for _, t in rows])
    found = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in queries.op11_alignment(spark, SF).collect()}
    assert found == {i: w for (i, _), w in zip(rows, wanted, strict=True)}


@pytest.mark.parametrize("most", [alignment.BROADCAST_PAIRS, 0])
def test_odd_rows_by_either_way(spark, own, most):
    docs = spark.createDataFrame([(i, t, 1, "x", "y", 2, 3, 4, 5) for i, t in ODD], DOCS)
    measures, pairs = alignment.align_corpus(docs, broadcast_pairs=most)
    wanted, counts = brute_force(own, [t for _, t in ODD])
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    found = sorted(((r["id"], *(r[c] for c in COLUMNS)) for r in measures.collect()), key=key)
    assert found == sorted(((i, *w) for (i, _), w in zip(ODD, wanted, strict=True)), key=key)
    assert {(r.a, r.b): r.n for r in pairs.collect()} == dict(counts)
    highest = Counter()
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    assert all(r.best == (r.n == highest[r.b]) for r in pairs.collect())


def test_no_rows_and_no_texts(spark):
    for rows in ([], [(1, None, 1, "x", "y", 2, 3, 4, 5)]):
        measures, pairs = alignment.align_corpus(spark.createDataFrame(rows, DOCS))
        assert [tuple(r) for r in measures.collect()] == [(1, 0, 0, 0, 0, 0, 0, "")] * len(rows)
        assert pairs.count() == 0


def test_the_alignment_itself(spark, own):
    docs = spark.createDataFrame([(i, t, 1, "x", "y", 2, 3, 4, 5) for i, t in ODD], DOCS)
    found = {r.id: r.groups for r in alignment.alignments(docs).collect()}
    a, b, *_ = tokens(own, ODD[7][1])
    sides = [g.split("|") for g in found[6].split(";")]
    assert [int(i) for left, _ in sides for i in left.split(",")] == a
    assert [int(i) for _, right in sides for i in right.split(",")] == b
    assert found[1] == found[2] == found[9] == ""


@settings(max_examples=400, deadline=None)
@given(st.lists(st.text("ab 'sé\n\t▁1.漢 ", min_size=1, max_size=60), min_size=1, max_size=6))
def test_words_have_the_alignment_of_the_whole(texts):
    fresh = alignment.aligner(*alignment.default_paths())
    fresh.known.clear()
    for text, found in zip(texts, fresh.texts(texts), strict=True):
        assert found == fresh.align(text)
        assert " ".join(alignment.words(text)) == text and all(alignment.words(text))


def test_a_small_memory_gives_the_same(monkeypatch, own):
    texts = [t for _, t in ODD if t] + ["one three two", "here lorem"]
    wanted = [own.align(t) for t in texts]
    monkeypatch.setattr(alignment, "WORDS", 3)
    own.known.clear()
    assert [own.texts([t])[0] for t in texts] == wanted and own.texts(texts) == wanted


def test_documents_share_a_hot_text(spark):
    docs = spark.range(900).selectExpr("id as doc_id", "if(id % 3 = 0, 'the same text', concat('text ', id)) as text")
    measures, pairs = alignment.align_corpus(docs)
    rows = {r.id: r for r in measures.collect()}
    assert len(rows) == 900 and len({rows[i].count_sum for i in range(0, 900, 3)}) == 1
    assert sum(r.n for r in pairs.collect()) == sum(r.n_links for r in rows.values())
