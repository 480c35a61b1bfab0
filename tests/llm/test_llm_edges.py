"""Nulls, empty and very long texts, ties, repeated rows, empty tables and columns with clashing names."""

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from souk.llm import (
    ann,
    bpe,
    chat,
    components,
    exact_topk,
    line_runs,
    mixing,
    quality,
    simhash,
    token_counts,
    url_lists,
)

DOCS = (
    "doc_id long, text string, source string, rank int, score double, n_tokens int, copy int, ids string, "
    "_n int, _v int, _d int, _cdf int, _salt int, id int, fp int, doc int"
)
LONG = "lorem ipsum dolor " * 9000


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, s, 1, 0.5, 2, 3, "x", *range(8)) for i, t, s in rows], DOCS)


ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", None),
    (4, LONG, "b"),
    (4, LONG, "b"),
    (5, "x" * 150_000, "b"),
    (None, "no id here", None),
    (6, "one two", "c"),
    (7, "one two", "c"),
    (8, "ünï </s><|endoftext|> 漢字 İ ß", "c"),
]


@pytest.fixture(scope="module")
def odd(spark):
    return docs_of(spark, ODD).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


def key(row):
    return tuple((v is None, str(v)) for v in row)


def test_token_counts(spark, odd, none):
    library = token_counts._pieces(token_counts.default_model())
    wanted = []
    for i, t, _ in ODD:
        n = len(library.encode(t or ""))
        wanted.append((i, len((t or "").encode()), n, n > 4096))
    assert sorted(map(tuple, token_counts.token_counts(odd).collect()), key=key) == sorted(wanted, key=key)
    assert token_counts.token_counts(none).count() == 0


def test_token_counts_by_the_other_library(spark, odd):
    path = bpe.default_vocabulary()
    library = bpe.codec(path).tokenizer
    found = token_counts.token_counts(odd, model_path=path).select("id", "n_tokens").collect()
    wanted = [(i, len(library.encode(t or "", add_special_tokens=False).ids)) for i, t, _ in ODD]
    assert sorted(map(tuple, found), key=key) == sorted(wanted, key=key)


@settings(max_examples=200, deadline=None)
@given(st.text("ab  \n▁é<", max_size=200), st.integers(1, 20))
def test_parts_have_the_counts_of_the_whole(text, size):
    path = token_counts.default_model()
    assert token_counts.splits_at_spaces(path)
    assert sum(token_counts.lengths(path, token_counts.parts(text, size))) == token_counts.lengths(path, [text])[0]


def test_encode_and_decode(spark, odd, none):
    library = bpe.codec(bpe.default_vocabulary()).tokenizer
    wanted = []
    for i, t, _ in ODD:
        ids = library.encode(t or "", add_special_tokens=False).ids
        wanted.append((i, ids, library.decode(ids, skip_special_tokens=False)))
    assert sorted(map(tuple, bpe.decode(bpe.encode(odd)).collect()), key=key) == sorted(wanted, key=key)
    assert bpe.decode(bpe.encode(none)).count() == 0


@pytest.mark.parametrize("letters", ["abc", "aB'sé1 2!\n", "日本語テキ'!s", "İΣσς é '!st", "😀👍a ", "ßüÄ'll're "])
def test_tree_of_halves_is_the_encoding_of_the_whole(letters):
    own, draw = bpe.codec(bpe.default_vocabulary()), random.Random(letters)
    for _ in range(25):
        text = "".join(draw.choice(letters) for _ in range(draw.choice([1, 5, 100, 2000])))
        if draw.random() < 0.3:
            text = text[: len(text) // 2] + "<|endoftext|>" + text[len(text) // 2 :]
        wanted = own.tokenizer.encode(text, add_special_tokens=False).ids
        assert list(np.frombuffer(own.encode([text])[0], np.int32)) == wanted
        ids = []
        for special, section in own.sections(text):
            if special:
                ids.append(own.tokenizer.token_to_id(section))
                continue
            encoded, at = [], 0
            for a, b in bpe.halves(0, len(section), draw.choice([7, 50, 500])):
                size = len(section[a:b].encode())
                encoded.append((at, at + size, own.spans(section[a:b], at)))
                at += size
            ids += own.tree(section.encode(), encoded).ids
        assert ids == wanted
        pieces = bpe.chunks(text, draw.choice([5, 40]))
        assert "".join(pieces) == text
        assert [i for p in pieces for i in own.tokenizer.encode(p, add_special_tokens=False).ids] == wanted


def test_simhash(spark, odd, none):
    found = {(r.id, r.group) for r in simhash.simhash_groups(odd).collect()}
    assert (1, 1) in found and (2, 1) in found and (3, 1) in found  # no words: fingerprint zero
    assert (6, 6) in found and (7, 6) in found
    assert simhash.simhash_groups(odd).count() == len(ODD)
    assert simhash.simhash_groups(none).count() == 0
    kept = simhash.first_of_each_group(odd)
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 1, 4, 5, 6, 8]
    assert kept.columns == odd.columns
    assert simhash.first_of_each_group(none).count() == 0


def test_one_row_of_each_group_stays_whatever_its_id(spark):
    texts = {None: ["one two", "alone here", "alone here"], 6: ["one two"], 9: ["a first text", "some quite different words"]}
    docs = docs_of(spark, [(i, t, "a") for i, found in texts.items() for t in found])
    kept = sorted((str(r.doc_id), r.text) for r in simhash.first_of_each_group(docs).collect())
    assert kept == [("6", "one two"), ("9", "a first text"), ("9", "some quite different words"), ("None", "alone here")]


def test_texts_with_similar_five_word_shingles_are_one_group(spark):
    """Edited copies, compared pair by pair; most are more than three bits apart."""
    draw = random.Random(5)
    texts = []
    for g in range(12):
        words = [f"w{draw.randrange(400)}" for _ in range(draw.choice([60, 150, 400]))]
        for _ in range(6):
            copy = list(words)
            for at in draw.sample(range(len(copy)), round(len(copy) * draw.choice([0, 0.01, 0.02, 0.04]))):
                copy[at] = f"edit{draw.random()}"
            texts.append(" ".join(copy))
    sets = [{tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in map(str.split, texts)]
    prints = [simhash.fingerprint(t) for t in texts]
    label, far = list(range(len(texts))), 0
    for i in range(len(texts)):
        for j in range(i):
            alike = len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8
            near = (prints[i] ^ prints[j]).bit_count() <= 3
            far += alike and not near
            if alike or near:
                label = [label[j] if x == label[i] else x for x in label]
    least = {x: label.index(x) for x in label}
    docs = docs_of(spark, [(i, t, "a") for i, t in enumerate(texts)])
    found = {r.id: r.group for r in simhash.simhash_groups(docs).collect()}
    assert far > 10 and found == {i: least[x] for i, x in enumerate(label)}
    assert len(set(found.values())) < simhash.simhash_groups(docs, similarity=None).select("group").distinct().count()


@pytest.mark.parametrize("chunk", [8, 2048])
def test_links_join_what_all_pairs_join(spark, monkeypatch, chunk):
    """A large group of near fingerprints, dealt out in many chunks."""
    monkeypatch.setattr(simhash, "CHUNK", chunk)
    draw = np.random.default_rng(chunk)
    centre = draw.integers(0, 2**63, 6, dtype=np.uint64)
    prints = set(draw.integers(0, 2**63, 300, dtype=np.uint64).tolist())
    for c in centre.tolist():
        for _ in range(60):
            prints.add(c ^ sum(1 << int(b) for b in set(draw.integers(0, 64, 2).tolist())))
    prints = np.array(sorted(prints), dtype=np.uint64)
    df = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    found = {r.node: r.root for r in components.components(simhash.links(df)).collect()}
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= 3
    label = np.arange(len(prints))
    while True:
        new = np.array([label[row].min() for row in near])
        if (new == label).all():
            break
        label = new
    ours = [found.get(int(p), int(p)) for p in prints.view(np.int64)]
    classes = lambda labels: {tuple(np.flatnonzero(np.array(labels) == x)) for x in set(labels)}
    assert classes(ours) == classes(label.tolist())


def test_components_of_a_long_chain_and_of_nothing(spark):
    chain = spark.range(1, 200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = components.components(chain.unionByName(chain.limit(5)))
    assert {(r.node, r.root) for r in found.collect()} == {(i, 1) for i in range(1, 201)}
    assert components.components(chain.limit(0)).count() == 0


def brute_runs(docs, least):
    """Lines left of each text, with every window of lines of ``least`` words compared with every earlier one."""
    lines = {i: t.split("\n") for i, t in sorted(docs.items())}
    gone = {i: set() for i in lines}
    first: dict[tuple, tuple] = {}
    for i, own in lines.items():
        for a in range(len(own)):
            words, b = 0, a
            while b < len(own) and words < least:
                words += len(own[b].split())
                b += 1
            if words < least:
                continue
            window = tuple(own[a:b])
            if window not in first:
                first[window] = (i, a)
                continue
            j, c = first[window]
            gone[i] |= set(range(max(a, c + b - a) if i == j else a, b))
    return {i: "\n".join(x for n, x in enumerate(own) if n not in gone[i]) for i, own in lines.items()}


@pytest.mark.parametrize("seed", range(4))
def test_repeated_runs_are_those_of_brute_force(spark, seed):
    draw = random.Random(seed)
    line = ["", "a", "b b", "c c c", "d", "e e"][: 3 + seed]
    docs = {i: "\n".join(draw.choice(line) for _ in range(draw.randrange(0, 14))) for i in range(40)}
    rows = [(i, t, "s") for i, t in docs.items()]
    found = line_runs.drop_repeated_runs(docs_of(spark, rows), min_words=5)
    assert {r.doc_id: r.text for r in found.collect()} == brute_runs(docs, 5)


def test_repeated_runs_on_odd_rows(spark, odd, none):
    found = line_runs.drop_repeated_runs(odd, min_words=2)
    texts = sorted(((r.doc_id or -1), r.text) for r in found.filter("text is not null").collect())
    wanted = [((i or -1), t) for i, t, _ in ODD if t is not None]
    wanted[wanted.index((7, "one two"))] = (7, "")  # a later copy; the equal rows of 4 are one document
    assert texts == sorted(wanted)
    assert found.columns == [*odd.columns, "n_lines", "n_removed"]
    assert line_runs.drop_repeated_runs(none).count() == 0


def test_documents_without_id_take_part_in_repeated_runs(spark):
    shared, other = ("\n".join(f"{w} line {i} of a long run" for i in range(12)) for w in ("shared", "other"))
    texts = [(7, f"numbered\n{shared}"), (None, f"first\n{shared}\nend"), (None, f"second\n{shared}")]
    texts += [(None, f"third\n{other}"), (None, f"fourth\n{other}")]
    found = line_runs.drop_repeated_runs(docs_of(spark, [(i, t, "s") for i, t in texts]))
    kept = {r.text.split("\n")[0]: r.text for r in found.collect()}
    assert kept["numbered"] == texts[0][1] and kept["first"] == "first\nend" and kept["second"] == "second"
    assert sorted(len(kept[x].split("\n")) for x in ("third", "fourth")) == [1, 13]


def test_mixing(spark, odd, none, monkeypatch):
    mixed = mixing.mix(odd, epochs=3.0)
    assert mixed.columns == [*odd.columns, "copy_", "mix_key"]
    rows = sorted(((r.doc_id or -1), r.copy_, r.mix_key) for r in mixed.collect())
    monkeypatch.setattr(mixing, "BROADCAST_NUMBERS", 0)
    assert sorted(((r.doc_id or -1), r.copy_, r.mix_key) for r in mixing.mix(odd, epochs=3.0).collect()) == rows
    assert mixing.mix(none).count() == 0


def test_mixing_reaches_the_target_weights(spark):
    docs = docs_of(spark, [(i, "w" * 100, "big" if i % 10 else "small") for i in range(4000)])
    weights = spark.createDataFrame([("big", 1.0), ("small", 1.0)], "source string, weight double")
    counts = {r.source: r["count"] for r in mixing.mix(docs, weights=weights).groupBy("source").count().collect()}
    assert counts["big"] == pytest.approx(2000, rel=0.1) and counts["small"] == pytest.approx(2000, rel=0.1)
    only = spark.createDataFrame([("small", 2.0)], "source string, weight double")
    assert {r.source for r in mixing.mix(docs, weights=only).select("source").distinct().collect()} == {"small"}


def test_documents_without_id_are_drawn_apart(spark):
    docs = docs_of(spark, [(None, f"text {i:04}", "big") for i in range(2000)] + [(1, "w" * 18_000, "small")])
    weights = spark.createDataFrame([("big", 0.15), ("small", 0.85)], "source string, weight double")
    rows = mixing.mix(docs, weights=weights).filter("source = 'big'").collect()  # 36,000 bytes: a rate of 0.3
    assert len(rows) == pytest.approx(600, rel=0.15)
    assert len({r.mix_key for r in rows}) == len(rows) > len({r.text for r in rows}) > 400


def test_poisson_distribution():
    from math import exp, factorial

    for rate in (0.0, 0.3, 4.0):
        first, cdf = mixing.poisson_cdf(rate)
        assert first == 0
        for k, value in enumerate(cdf[:12]):
            assert value == pytest.approx(sum(exp(-rate) * rate**j / factorial(j) for j in range(k + 1)), abs=1e-12)


@pytest.mark.parametrize("rate", [5e3, 1e6, 1e9])
def test_poisson_distribution_of_a_high_rate_is_short_and_right(rate):
    first, cdf = mixing.poisson_cdf(rate)
    k, p = first + np.arange(len(cdf)), np.diff(cdf, prepend=0.0)
    assert len(cdf) < 20 * rate**0.5 + 64 and cdf[-1] == 1 and cdf[0] < 1e-16
    assert (p * k).sum() == pytest.approx(rate, rel=1e-9)
    assert (p * (k - rate) ** 2).sum() == pytest.approx(rate, rel=1e-6)


def test_mixing_repeats_a_rare_source_very_often(spark):
    docs = docs_of(spark, [(i, "w" * 1000, "big") for i in range(300)] + [(900, "w", "rare")])
    counts = {r.source: r["count"] for r in mixing.mix(docs).groupBy("source").count().collect()}
    rate = (300_001 / (300_000**0.5 + 1)) / 1
    assert abs(counts["rare"] - rate) < 6 * rate**0.5


VECTORS = [
    (0, [1.0, 0.5]),
    (100, [1.0, 0.5]),
    (100, [1.0, 0.5]),
    (1, [1.0, 0.5]),
    (2, [-1.0, 2.0, 3.0]),
    (3, None),
    (4, [1.0, None]),
    (5, [float("nan"), 1.0]),
    (6, [float("inf"), 1.0]),
    (7, [0.0, 0.0]),
    (8, []),
    (9, [3e30, -2e30]),
    (None, [1.0, 1.0]),
    (200, [-0.25, 1e-9]),
]


@pytest.fixture(scope="module")
def vectors(spark):
    rows = [(i, v, 1, 2.0) for i, v in VECTORS]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank int, score double").cache()


def finite(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def test_exact_top_k(spark, vectors):
    own = {i: [int(np.floor(1024 * x)) for x in v] for i, v in VECTORS if i is not None and finite(v)}
    wanted = []
    for q in (i for i in own if i % 100 == 0):
        scores = []
        for i, v in own.items():
            if i != q:
                s = sum(a * b for a, b in zip(own[q], v, strict=False))
                scores.append((-min(max(s, -(2**63)), 2**63 - 1), i))
        wanted += [(q, n, i, -s) for n, (s, i) in enumerate(sorted(scores)[:4], 1)]
    found = exact_topk.top_k(vectors, F.col("id") % 100 == 0, k=4)
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert exact_topk.top_k(vectors.limit(0), F.col("id") % 100 == 0).count() == 0


def test_exact_top_k_over_many_blocks(spark, monkeypatch):
    for name, size in (("BLOCK", 7), ("SLOT", 3), ("BATCH", 5)):
        monkeypatch.setattr(exact_topk, name, size)
    draw = np.random.default_rng(5)
    data = np.round(draw.normal(size=(300, 6)), 1)
    data[::3] = data[0]  # one vector with a third of the rows
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    whole = np.floor(1024 * data).astype(np.int64)
    wanted = set()
    for q in range(0, 300, 10):
        order = sorted((-(int(whole[q] @ whole[i])), i) for i in range(300) if i != q)[:10]
        wanted |= {(q, n, i, -s) for n, (s, i) in enumerate(order, 1)}
    assert set(map(tuple, exact_topk.top_k(df, F.col("id") % 10 == 0).collect())) == wanted


def test_nearest(spark, vectors):
    found = ann.nearest(vectors, F.col("id") % 100 == 0, k=5).collect()
    by_query = {q: [(r.vec_id, r.score) for r in found if r.query_id == q] for q in (0, 100, 200)}
    assert [v for v, _ in by_query[0][:2]] == [1, 100]  # ties go to the smaller id
    assert [v for v, _ in by_query[100][:2]] == [0, 1]
    assert all(len(v) == 5 for v in by_query.values())
    assert not {3, 4, 5, 6, 7, 8} & {r.vec_id for r in found}
    assert ann.nearest(vectors.limit(0), F.col("id") % 100 == 0).count() == 0


def test_nearest_over_many_shards_and_batches(spark, monkeypatch):
    """Tied and repeated vectors in shards of some ten rows, queries in batches of four."""
    draw = np.random.default_rng(8)
    data = draw.normal(size=(240, 6))
    data[::3] = data[0]  # one vector with a third of the rows
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(data)], "vec_id long, embedding array<double>")
    monkeypatch.setattr(ann, "SHARD_BYTES", 10 * 48)
    monkeypatch.setattr(ann, "BATCH_BYTES", 4 * 48)
    found: dict[int, list] = {}
    for r in ann.nearest(df, F.col("id") % 8 == 0, k=5).orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append(r.vec_id)
    unit = data / np.linalg.norm(data, axis=1)[:, None]
    hits = 0
    for q in range(0, 240, 8):
        others = [i for i in range(240) if i != q]
        wanted = sorted(others, key=lambda i: (-round(float(unit[q] @ unit[i]), 12), i))[:5]
        hits += len(set(wanted) & set(found[q]))
        if q % 3 == 0:
            assert found[q] == wanted
    assert sorted(found) == list(range(0, 240, 8)) and hits >= 0.9 * 5 * len(found)


def test_multi_index_finds_every_code_within_the_radius():
    draw = np.random.default_rng(1)
    data = draw.normal(size=(400, 16))
    shard = ann.Shard(data, [[i] for i in range(400)], ann.learn_rotations(data, 16))
    for radius in (10, 31, 70, 110):
        differ = np.bitwise_count(shard.words ^ shard.words[7]).sum(1)
        assert shard.within(shard.codes[7], radius).tolist() == np.flatnonzero(differ <= radius).tolist()


def test_quality_without_usable_labels(spark, odd, none):
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 5)], "doc_id long, quality int")
    rows = quality.quality_scores(odd, labels).collect()
    assert len(rows) == len(ODD) and {r.score for r in rows} == {0.5}
    assert quality.quality_scores(none, labels).count() == 0
    assert quality.keep_good(odd, labels).count() == len(ODD)


def test_isotonic_fit_is_the_best_nondecreasing_one():
    level = np.arange(6.0)
    _, fitted = quality.isotonic(level, np.array([0.1, 0.4, 0.2, 0.6, 0.5, 0.9]), np.array([1, 1, 3, 2, 2, 1.0]))
    assert (np.diff(fitted) >= 0).all()
    assert fitted[0] == pytest.approx(0.1) and fitted[-1] == pytest.approx(0.9)
    assert 0.25 in np.round(fitted, 12) and 0.55 in np.round(fitted, 12)


def test_url_lists(spark):
    day = "2024-01-{:02d}".format
    entries = spark.createDataFrame(
        [
            ("l", "domain", "bad.org", True, day(5)),
            ("l", "domain", "bad.org", False, day(10)),
            ("l", "domain", "bad.org", True, day(20)),
            ("m", "host", "www.ok.net", True, day(1)),
            ("m", "host", "www.ok.net", True, day(1)),
            ("p", "prefix", "ok.net/a/b", True, day(1)),
            ("p", "prefix", None, True, day(1)),
        ],
        "list string, kind string, value string, listed boolean, at string",
    )
    pages = [
        (1, "http://x.BAD.org:80/q", day(4), []),
        (2, "http://x.bad.org/q", day(5), ["l"]),
        (3, "https://u@bad.org", day(9), ["l"]),
        (4, "https://bad.org", day(10), []),
        (5, "https://notbad.org", day(25), []),
        (6, "http://www.ok.net/A//b/c?x#y", day(2), ["m"]),
        (7, "http://ok.net/A//b/c?x#y", day(2), ["p"]),
        (7, "http://ok.net/A//b/c?x#y", day(2), ["p"]),
        (8, "http://ok.net/a/bc", day(2), []),
        (9, None, day(2), []),
        (10, "", day(2), []),
        (11, "no url", None, []),
        (None, "http://bad.org/" + "d/" * 5000, day(30), ["l"]),
    ]
    table = spark.createDataFrame([p[:3] + ("z",) for p in pages], "page_id long, url string, fetched string, lists string")
    found = url_lists.filter_captures(table, entries)
    got = sorted(((r.id or -1), r.blocked, r.matches, r.lists) for r in found.collect())
    assert got == sorted(((i or -1), bool(w), len(w), w) for i, _, _, w in pages)
    assert url_lists.filter_captures(table.limit(0), entries).count() == 0
    assert url_lists.filter_captures(table, entries.limit(0)).filter("blocked").count() == 0


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.text("</s>[INST] \\x", max_size=12), st.text("<s>[/INST]\\ok\n", max_size=40)), max_size=5))
def test_turns_survive_their_format(turns):
    formatted = "".join(chat.format_turn(*t)[0] for t in turns)
    assert [(r, t) for r, t, _, _ in chat.read_turns(formatted)] == turns
    for role, text in turns:
        whole, a, b = chat.format_turn(role, text)
        assert not any(c in whole[a:b] for c in ("<s>", "</s>", "[INST]", "[/INST]"))


def test_prefix_tree(spark):
    shared = [(0, "user", "hi"), (1, "assistant", "<s>")]
    rows = [(c, *t, 0) for c in range(30) for t in shared]
    rows += [(c, 2, "user", f"more {c % 3}", 0) for c in range(20)]
    rows += [(50, None, None, None, 0), (50, 1, "user", "x", 0), (50, 1, "user", "x", 0), (None, 0, "user", "lost", 0)]
    table = spark.createDataFrame(rows, "conv_id long, turn int, role string, text string, start int")
    packed = chat.pack(table)
    nodes = {bytes(n.node): n for n in packed.nodes.collect()}
    assert len(nodes) == 2 + 3 + 3 + 1
    by_start = sorted(nodes.values(), key=lambda n: n.start)
    assert [n.start for n in by_start] == [0, *np.cumsum([len(n.text) for n in by_start]).tolist()[:-1]]
    stream = "".join(n.text for n in by_start)
    paths: dict = {}
    for p in packed.paths.collect():
        paths.setdefault(p.conv_id, []).append((p.depth, bytes(p.node)))
    for path in paths.values():
        before = ""
        for _, name in sorted(path):
            node = nodes[name]
            assert node.position == len(before)
            assert "".join(stream[a.start : a.end] for a in node.attends) == before
            before += node.text
    counts = sorted(n.conversations for n in nodes.values())
    assert counts[-2:] == [30, 30]
    back = {r.conv_id: r for r in chat.read_back(packed).collect()}
    assert back[0].n_turns == 3 and back[25].n_turns == 2 and back[50].n_turns == 3 and back[None].n_turns == 1
    assert back[0].loss_chars == 3 and back[50].loss_chars == 0
    assert chat.read_back(chat.pack(table.limit(0))).count() == 0
