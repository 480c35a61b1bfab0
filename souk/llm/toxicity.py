"""Toxicity by multiple-instance learning: only documents carry labels, yet the model scores sentences.

A sentence is toxic with the probability of a logistic model over its words and their beginnings, and a document is toxic
if any of its sentences is (noisy-or): P = 1 - prod(1 - p). Training passes over the labelled documents give each
sentence its share p / P of a toxic document's label, and sum the gradient by partition, so what reaches the driver
has the size of the model. The model then says which sentences make a document toxic.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from souk.llm.frames import batches_by_bytes, keyed, scope, stage
from souk.llm.quality import held_out

#: Labelled documents that the model is fitted on at most (about), taken by a hash of their id. All rows are scored.
MAX_LABELLED = 50_000
#: Features of the model at most: those that go best with the labels.
VOCABULARY = 2048
#: A feature must be in so many labelled documents, and its likelihood ratio (G squared) must reach this.
MIN_DOCUMENTS, MIN_RATIO = 3, 10.83
#: Beginnings of words that are features, in characters, besides the whole word.
BEGINNINGS = (3, 4, 5, 6)
#: Passes over the labelled documents, step of the first one, and ridge.
PASSES, STEP, RIDGE = 24, 1.0, 0.1
SUM_PARTITIONS = 16
#: Bytes of text whose features are counted at a time, and words whose features a worker remembers.
BATCH_BYTES = 1 << 23
WORDS = 200_000
SCORED_BYTES = 1 << 20
#: Longest word kept as a feature or remembered, in characters; a longer one counts with its beginnings only.
LONGEST = 40

SENTENCE = re.compile(r"[^.!?\n]+")
WORD = re.compile(r"[^\W\d_]+")
TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]")
ENDS = frozenset(".!?\n")


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the stretches between full stops, other end marks and line ends that hold a word."""
    return [m.span() for m in SENTENCE.finditer(text) if WORD.search(m[0])]


def features_of(word: str) -> list[str]:
    """The features of a lower-case word: its beginnings, and the whole word behind a mark."""
    found = [word[:n] for n in BEGINNINGS if len(word) >= n]
    if len(word) <= LONGEST:
        found.append(f"={word}")
    return found


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray
    bias: float
    #: The score of every document where the labels taught nothing.
    constant: float | None = None
    known: dict[str, tuple[int, ...]] = field(default_factory=dict, repr=False, compare=False)

    def __post_init__(self) -> None:
        self.listed = self.weights.tolist()
        self.openings = frozenset(f.removeprefix("=")[:3] for f in self.vocabulary)

    def __getstate__(self) -> dict:
        return self.__dict__ | {"known": {}}

    def _word(self, word: str) -> tuple[int, ...]:
        """Numbers of the features of a word, remembered by each worker."""
        found: tuple[int, ...] = ()
        if word[:3] in self.openings:
            found = tuple(i for f in features_of(word) if (i := self.vocabulary.get(f)) is not None)
        if len(word) <= LONGEST:
            if len(self.known) >= WORDS:
                self.known.clear()
            self.known[word] = found
        return found

    def active(self, text: str) -> tuple[int, list[tuple[int, list[int]]]]:
        """Number of sentences, and (number, features) of those that hold any feature. A feature counts once."""
        n, spoken, own = 0, False, set()
        found, known = [], self.known.get
        for token in TOKEN.findall(text.lower()):
            features = known(token)
            if features:
                spoken = True
                own.update(features)
            elif features is not None:
                spoken = True
            elif token in ENDS:
                if spoken:
                    if own:
                        found.append((n, sorted(own)))
                        own = set()
                    n, spoken = n + 1, False
            else:
                spoken = True
                own.update(self._word(token))
        if own:
            found.append((n, sorted(own)))
        return n + spoken, found

    def score(self, text: str) -> tuple[float, list[tuple[int, float]], int]:
        """The document's probability, (number, probability) of its sentences with features, and how many
        sentences there are. A text without words has probability 0."""
        n, found = self.active(text)
        if self.constant is not None:
            return self.constant, [], n
        plain = 1 / (1 + math.exp(-self.bias))
        clean, scored, weights = (n - len(found)) * math.log1p(-plain), [], self.listed
        for i, own in found:
            p = 1 / (1 + math.exp(-max(-60.0, min(60.0, sum([weights[f] for f in own]) + self.bias))))
            clean += math.log1p(-min(p, 1 - 1e-12))
            scored.append((i, p))
        return -math.expm1(clean), scored, n


def learnable(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """(id, ones, zeros): how often each id that may be learnt has either label; about ``MAX_LABELLED`` ids at most."""
    known = (
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .filter("id is not null and label in (0, 1)")
        .filter(~held_out("id"))
        .groupBy("id")
        .agg(F.count_if(F.col("label") == 1).alias("ones"), F.count_if(F.col("label") == 0).alias("zeros"))
    )
    known = stage(known)
    rows = known.count()
    if rows > MAX_LABELLED:
        known = known.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(int(MAX_LABELLED / rows * (1 << 20))))
    return known


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, ones, zeros): in how many labelled documents of each kind a feature is, by batch."""
    for batch in batches_by_bytes(batches, "text", BATCH_BYTES):
        ones: Counter[str] = Counter()
        zeros: Counter[str] = Counter()
        parts: dict[str, list[str]] = {}
        for text, o, z in zip(*(batch.column(c).to_pylist() for c in ("text", "ones", "zeros")), strict=True):
            own: set[str] = set()
            for w in set(words_of(text)):
                if w not in parts:
                    parts[w] = features_of(w)
                own.update(parts[w])
            for counts, times in ((ones, o), (zeros, z)):
                if times == 1:
                    counts.update(own)
                elif times:
                    for f in own:
                        counts[f] += times
        names = list(ones.keys() | zeros.keys())
        columns = [names, [ones[f] for f in names], [zeros[f] for f in names]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int64()), strict=True)],
            ["feature", "ones", "zeros"],
        )


def _ratio(ones: int, zeros: int):
    """G squared of a feature in ``a`` toxic and ``b`` clean documents of so many, as an expression."""
    a, b = F.col("a"), F.col("b")
    n = ones + zeros

    def term(seen, rows, total):
        expected = rows * total / F.lit(float(n))
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    held, free = a + b, F.lit(float(n)) - a - b
    return 2 * (
        term(a, held, ones) + term(b, held, zeros) + term(ones - a, free, ones) + term(zeros - b, free, zeros)
    )


def _choose(texts: DataFrame, ones: int, zeros: int) -> dict[str, int]:
    """The features that go best with the labels, in order of their names."""
    counted = texts.mapInArrow(_count_features, "feature string, ones long, zeros long")
    summed = counted.groupBy("feature").agg(F.sum("ones").cast("double").alias("a"), F.sum("zeros").cast("double").alias("b"))
    rated = summed.filter(F.col("a") + F.col("b") >= MIN_DOCUMENTS).select("feature", _ratio(ones, zeros).alias("g"))
    best = rated.filter(F.col("g") >= MIN_RATIO).orderBy(F.desc("g"), "feature").limit(VOCABULARY)
    return {f: i for i, f in enumerate(sorted(r["feature"] for r in best.collect()))}


EXAMPLES = "ones long, zeros long, n long, lengths array<int>, features array<int>"


def _examples(model: Model):
    """Per labelled document its number of sentences, and the features of those that have any, one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text", BATCH_BYTES):
            found = [model.active(t) for t in batch.column("text").to_pylist()]
            columns = [
                batch.column("ones"),
                batch.column("zeros"),
                pa.array([n for n, _ in found], pa.int64()),
                pa.array([[len(own) for _, own in s] for _, s in found], pa.list_(pa.int32())),
                pa.array([[i for _, own in s for i in own] for _, s in found], pa.list_(pa.int32())),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["ones", "zeros", "n", "lengths", "features"])

    return run


def gradient(
    ones: np.ndarray,
    zeros: np.ndarray,
    n: np.ndarray,
    sizes: np.ndarray,
    lengths: np.ndarray,
    features: np.ndarray,
    weights: np.ndarray,
    bias: float,
) -> np.ndarray:
    """Gradient of the log-likelihood by the weights and, last, the bias.

    Document d has ``n[d]`` sentences; ``sizes[d]`` of them hold features, ``lengths`` says how many each.
    """
    sentence = np.repeat(np.arange(len(lengths)), lengths)
    owner = np.repeat(np.arange(len(n)), sizes)
    p = _sigmoid(np.bincount(sentence, weights[features], len(lengths)) + bias)
    plain = float(_sigmoid(np.float64(bias)))
    rest = n - sizes
    clean = np.bincount(owner, np.log1p(-np.minimum(p, 1 - 1e-12)), len(n)) + rest * math.log1p(-plain)
    toxic = -np.expm1(clean)
    # The slope of log P in a sentence's logit is its share p / P of the label, less p; that of log(1 - P) is -p.
    pull = ones / np.maximum(toxic, 1e-300)
    slope = p * (pull[owner] - (ones + zeros)[owner])
    by_weight = np.bincount(features, slope[sentence], len(weights))
    by_bias = slope.sum() + (plain * rest * (np.where(rest > 0, pull, 0.0) - ones - zeros)).sum()
    return np.append(by_weight, by_bias)


def _sum_gradient(weights: np.ndarray, bias: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(weights) + 1)
        for batch in batches:
            if not batch.num_rows:
                continue
            ones, zeros, n = (batch.column(c).to_numpy() for c in ("ones", "zeros", "n"))
            lengths, features = batch.column("lengths"), batch.column("features")
            sizes = np.diff(lengths.offsets.to_numpy())
            total += gradient(
                ones, zeros, n, sizes, lengths.flatten().to_numpy(), features.flatten().to_numpy(), weights, bias
            )
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["i", "g"])

    return run


def _passes(examples: DataFrame, width: int, bias: float) -> tuple[np.ndarray, float]:
    """Weights and bias after ``PASSES`` adaptive steps up the summed gradient."""
    at, seen = np.append(np.zeros(width), bias), np.full(width + 1, 1e-12)
    few = examples.coalesce(SUM_PARTITIONS)
    for _ in range(PASSES):
        parts = few.mapInArrow(_sum_gradient(at[:-1], at[-1]), "i int, g double").groupBy("i")
        # Partial sums are added in one order, so that every run gives the same model.
        summed = parts.agg(F.aggregate(F.array_sort(F.collect_list("g")), F.lit(0.0), lambda s, x: s + x).alias("g"))
        slope = np.zeros(width + 1)
        for row in summed.collect():
            slope[row["i"]] = row["g"]
        slope[:-1] -= RIDGE * at[:-1]
        seen += slope**2
        at = at + STEP * slope / np.sqrt(seen)
    return at[:-1], float(at[-1])


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
) -> Model:
    """A sentence model from documents and their labels 0 and 1.

    Held-out ids are left out, and about ``MAX_LABELLED`` labelled documents are used at most. Without labels of both
    kinds, every score is the share of ones (0.5 without labels).
    """
    with scope(docs.sparkSession):
        known = learnable(labels, id_col, label_col)
        # Bounded by MAX_LABELLED rows of three numbers.
        texts = stage(keyed(docs, id_col, text_col).join(F.broadcast(known), "id").select("text", "ones", "zeros"))
        totals = texts.agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros"), F.count(F.lit(1)).alias("n")).first()
        ones, zeros = int(totals["ones"] or 0), int(totals["zeros"] or 0)
        if not ones or not zeros:
            return Model({}, np.zeros(0), 0.0, ones / (ones + zeros) if ones + zeros else 0.5)
        vocabulary = _choose(texts, ones, zeros)
        blank = Model(vocabulary, np.zeros(len(vocabulary)), 0.0)
        examples = stage(texts.mapInArrow(_examples(blank), EXAMPLES))
        spoken = examples.agg(F.sum("n").alias("n")).first()["n"] or 1
        share = ones / (ones + zeros) * totals["n"] / spoken
        bias = math.log(min(share, 0.5) / (1 - min(share, 0.5)))
        return Model(vocabulary, *_passes(examples, len(vocabulary), bias))


SCORED = (
    "id long, score double, n_sentences int, "
    "offending array<struct<start: int, end: int, score: double, sentence: string>>"
)
_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("sentence", pa.string())])


def scored_texts(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5
) -> DataFrame:
    """(id, score, n_sentences, offending): every row of ``docs`` with its score and the sentences whose own
    probability reaches ``threshold``, with their places in the text (in characters) in order of appearance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches_by_bytes(batches, "text", SCORED_BYTES):
            scores, counts, spans = [], [], []
            for text in batch.column("text").to_pylist():
                score, found, n = model.score(text)
                scores.append(score)
                counts.append(n)
                offending = [(i, p) for i, p in found if p >= threshold]
                places = sentences(text) if offending else []
                spans.append(
                    [
                        {"start": a, "end": b, "score": p, "sentence": text[a:b]}
                        for (a, b), p in ((places[i], p) for i, p in offending)
                    ]
                )
            columns = [batch.column("id"), pa.array(scores, pa.float64()), pa.array(counts, pa.int32())]
            columns.append(pa.array(spans, pa.list_(_SPAN)))
            yield pa.RecordBatch.from_arrays(columns, ["id", "score", "n_sentences", "offending"])

    return keyed(docs, id_col, text_col).mapInArrow(run, SCORED)


def toxicity(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    threshold: float = 0.5,
) -> DataFrame:
    """(id, held_out, score, predicted, n_sentences, offending): one row per row of ``docs``.

    ``score`` is the probability that label 1 holds, ``predicted`` whether it reaches ``threshold``, ``offending`` the
    sentences that reach it by themselves. Only the text is looked at. Null texts count as empty; texts without words
    have score 0. Null ids are scored and not held out. Labels that are null or neither 0 nor 1 are ignored; an id with
    several labels counts with each. Repeated rows stay. An empty table gives an empty result. Other columns are
    ignored.
    """
    model = fit(docs, labels, id_col, text_col, label_col)
    return scored_texts(docs, model, id_col, text_col, threshold).select(
        "id",
        held_out("id").alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
        "n_sentences",
        "offending",
    )
