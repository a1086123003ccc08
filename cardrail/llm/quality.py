"""Quality classifier: supervised subword embeddings.

A text is a bag of tokens: its words, the character n-grams of each word between marks, and a token of its own for each
word that equals the one before it. Every token has a learned vector, found by hashing; the vectors of a text are
averaged, and a softmax over two classes gives the score. Vectors and softmax weights are learned by stochastic gradient
descent in numpy, in ``steps`` steps over at most ``sample_rows`` labelled texts taken in the order of a hash of
``doc_id``.

For scoring, the difference of the two classes' weights is multiplied into the vectors once: a token then has one
number, a word has the sum of its tokens', and a text costs a look-up for each word. The broadcast model has
``buckets`` numbers, whatever the input.

Defined results: a null text counts as empty, and an empty text is scored by the start token alone; rows with a null
``doc_id`` are scored and not held out; labels with a null id or a quality other than 0 and 1 are not learned from;
without any label every score is 0.5; other columns are left out by ``score`` and kept by ``keep_good``.
"""

from __future__ import annotations

import zlib
from collections import Counter
from dataclasses import dataclass
from itertools import islice

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from cardrail.llm.common import bounded_sample, held_in_worker, small

AGAIN, START = "\x02again", "\x02start"
REMEMBERED_WORDS = 300_000


@dataclass(frozen=True)
class Settings:
    sample_rows: int = 2_000
    buckets: int = 1 << 18
    dimensions: int = 16
    shortest: int = 3
    longest: int = 5
    steps: int = 8_000
    rate: float = 0.3
    seed: int = 7


def tokens_of(word: str, s: Settings) -> list[int]:
    """The buckets of a word: its own, and those of the n-grams of the word between marks."""
    raw = f"<{word}>".encode()
    grams = (raw[i : i + n] for n in range(s.shortest, s.longest + 1) for i in range(len(raw) - n + 1))
    return [zlib.crc32(raw, 1) % s.buckets, *(zlib.crc32(g) % s.buckets for g in grams)]


def words_of(text: str) -> list[str]:
    """The words of a text, with a token of its own for each word that repeats the one before."""
    words = text.split()
    again = sum(a == b for a, b in zip(words, words[1:]))
    return [START, *words, *([AGAIN] * again)]


@dataclass
class Model:
    """Token vectors, and a softmax weight vector for each class."""

    settings: Settings
    vectors: np.ndarray
    weights: np.ndarray

    def flat(self) -> np.ndarray:
        """One number for each bucket: its vector against the difference of the classes."""
        return self.vectors @ (self.weights[1] - self.weights[0])


def _bag(text: str, s: Settings, known: dict[str, list[int]]) -> tuple[np.ndarray, np.ndarray]:
    found: Counter = Counter()
    for word, times in Counter(words_of(text)).items():
        if word not in known:
            known[word] = tokens_of(word, s)
        for bucket in known[word]:
            found[bucket] += times
    share = np.fromiter(found.values(), "f4", len(found))
    return np.fromiter(found, "i4", len(found)), share / share.sum()


def fit(texts: list[str], labels: list[int], s: Settings | None = None) -> Model:
    s = s or Settings()
    draw = np.random.default_rng(s.seed)
    vectors = draw.uniform(-1 / s.dimensions, 1 / s.dimensions, (s.buckets, s.dimensions)).astype("f4")
    weights = np.zeros((2, s.dimensions), "f4")
    known: dict[str, list[int]] = {}
    bags = [_bag(t, s, known) for t in texts]
    order = (i for _ in range(-(-s.steps // max(1, len(bags)))) for i in draw.permutation(len(bags)))
    for step, i in enumerate(islice(order, s.steps)):
        buckets, share = bags[i]
        hidden = share @ vectors[buckets]
        odds = np.exp(weights @ hidden - np.max(weights @ hidden))
        error = np.eye(2, dtype="f4")[labels[i]] - odds / odds.sum()
        rate = s.rate * (1 - step / s.steps)
        moved = error @ weights
        weights += rate * np.outer(error, hidden)
        # a token's gradient is its share of the text, which is tiny: it moves in proportion to the largest share
        vectors[buckets] += rate * np.outer(share / share.max(), moved)
    return Model(s, vectors, weights)


class Scorer:
    """Scores texts by the flattened model."""

    def __init__(self, flat: np.ndarray, s: Settings):
        self.flat, self.settings = flat, s
        self.known: dict[str, tuple[float, int]] = {}

    def score(self, text: str | None) -> float:
        if len(self.known) > REMEMBERED_WORDS:
            self.known = {}
        total = count = 0
        known = self.known
        for word in words_of(text or ""):
            found = known.get(word)
            if found is None:
                buckets = tokens_of(word, self.settings)
                known[word] = found = (float(self.flat[buckets].sum()), len(buckets))
            total += found[0]
            count += found[1]
        return float(1 / (1 + np.exp(-np.clip(total / count, -60, 60))))


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a row is kept from learning: crc32 of its id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def learn(docs: DataFrame, labels: DataFrame, s: Settings | None = None) -> Model:
    """Fits a model on a bounded sample of the labelled rows that are not held out."""
    s = s or Settings()
    marks = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marks = marks.filter("doc_id is not null and quality in (0, 1)").filter(~held_out())
    marks = bounded_sample(marks, s.sample_rows, "doc_id", "quality")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(marks), "doc_id")
    texts = texts.orderBy(F.xxhash64("doc_id"), "doc_id", "quality", "text").limit(s.sample_rows)
    rows = texts.select(F.coalesce("text", F.lit("")).alias("text"), "quality").collect()
    return fit([r.text for r in rows], [r.quality for r in rows], s)


def _scorer(flat: np.ndarray, s: Settings) -> Scorer:
    """The scorer of a model, one in each Python worker, so that known words last from task to task."""
    return held_in_worker(("scorer", zlib.crc32(flat.tobytes())), lambda: Scorer(flat, s))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id``, ``held_out`` and ``score`` of every row, from its whole text. A narrow pass."""
    shared = docs.sparkSession.sparkContext.broadcast((model.flat(), model.settings))

    def run(batches):
        import pyarrow as pa

        scorer = _scorer(*shared.value)
        for batch in small(batches):
            scores = pa.array([scorer.score(t) for t in batch.column("text").to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), scores], ["doc_id", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")
    return rows.select("doc_id", held_out().alias("held_out"), "score")


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that score at least ``threshold``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast((model.flat(), model.settings))

    def run(batches):
        import pyarrow as pa

        scorer = _scorer(*shared.value)
        for batch in small(batches):
            yield batch.filter(pa.array([scorer.score(t) >= threshold for t in batch.column("text").to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
