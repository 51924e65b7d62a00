"""Toxicity by multiple-instance learning.

A document is a bag of sentences. Each sentence has a logistic score from its words (and
their beginnings); a noisy-or combines them: a document is toxic unless no sentence is.
The sentence weights are trained from document labels alone, through the noisy-or; then
the sentences themselves can be scored, which locates the offending ones.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconframe.llm.labelled import held_out, sample
from beaconframe.llm.naming import carried, unused
from beaconframe.session import ship, table

_TOKEN = re.compile(r"[^\W_]+|[.!?\n]")
_ENDS = frozenset(".!?\n")
#: Lengths of the word beginnings that are features besides the word itself.
PREFIXES = (4, 5, 6)
#: A feature is trained if it occurs in so many sampled documents and its share differs between the classes by so many standard errors.
MIN_DOCS, MIN_Z = 3, 3.0
STEPS, RATE, DECAY, START = 200, 0.2, 1e-4, -6.0
CACHE_WORDS = 300_000


def word_features(word: str) -> list[str]:
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n)]


@dataclass
class Model:
    """Weights of word features and the sentences' bias."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = START

    def word_weight(self, word: str) -> float:
        get = self.weights.get
        return sum(get(f, 0.0) for f in word_features(word))


class _Weights(dict):
    def __init__(self, model: Model) -> None:
        super().__init__()
        self.model = model

    def __missing__(self, word: str) -> float:
        if len(self) > CACHE_WORDS:
            self.clear()
        w = self[word] = np.nan if word in _ENDS else self.model.word_weight(word)
        return w


def sentence_logits(text: str, weights: _Weights, bias: float) -> np.ndarray:
    """Of each sentence with a word, in order."""
    tokens = _TOKEN.findall(text.lower())
    w = np.fromiter(map(weights.__getitem__, tokens), np.float64, len(tokens))
    ends = np.isnan(w)
    at = np.cumsum(ends)
    n = int(at[-1]) + 1 if len(at) else 0
    if not n:
        return np.zeros(0)
    words = np.bincount(at, ~ends, n) > 0
    return np.bincount(at, np.where(ends, 0.0, w), n)[words] + bias


def noisy_or(logits: np.ndarray) -> float:
    """1 - prod(1 - sigmoid(z)); 0 without a sentence."""
    return float(-np.expm1(-np.logaddexp(0, logits).sum()))


def fit(rows: list[tuple[str, int]]) -> Model:
    """Full-batch Adam on the log loss of the noisy-or. One class or no rows at all: a model that scores next to 0."""
    y = np.array([r[1] for r in rows], float)
    if len(rows) == 0 or y.min() == y.max():
        return Model()
    vocabulary: dict[str, int] = {}
    features: dict[str, int] = {}
    of_word: list[tuple[int, ...]] = []
    counts: list[list[int]] = [[], []]
    bags = []  # word numbers, and -1 where a sentence ends
    for text, label in rows:
        bag = []
        for word in _TOKEN.findall(text.lower()):
            if word in _ENDS:
                bag.append(-1)
                continue
            k = vocabulary.setdefault(word, len(of_word))
            if k == len(of_word):
                of_word.append(tuple(features.setdefault(f, len(features)) for f in word_features(word)))
            bag.append(k)
        bags.append(np.array(bag, np.int32))
        for c in counts:
            c.extend([0] * (len(features) - len(c)))
        for f in {f for k in set(bag) if k >= 0 for f in of_word[k]}:
            counts[label][f] += 1
    c0, c1 = (np.array(c, float) for c in counts)
    n1 = y.sum()
    n0 = len(y) - n1
    p = (c0 + c1) / len(y)
    chosen = (c0 + c1 >= MIN_DOCS) & (abs(c1 / n1 - c0 / n0) >= MIN_Z * np.sqrt(p * (1 - p) * (1 / n1 + 1 / n0)))
    number = np.cumsum(chosen) - 1
    index = {f: int(number[i]) for f, i in features.items() if chosen[i]}
    selected = [[int(number[f]) for f in fs if chosen[f]] for fs in of_word]
    width = np.array([len(fs) for fs in selected], int)
    flat, first = np.array([i for fs in selected for i in fs], int), np.cumsum(width) - width
    parts, sentences = [[], [], []], 0
    for d, bag in enumerate(bags):
        words = bag >= 0
        kept, at = np.unique(np.cumsum(~words)[words], return_inverse=True)
        k = bag[words]
        many = width[k]
        ends_ = np.cumsum(many)
        parts[0].append(flat[np.repeat(first[k] - (ends_ - many), many) + np.arange(ends_[-1] if len(ends_) else 0)])
        parts[1].append(np.repeat(at + sentences, many))
        parts[2].append(np.full(len(kept), d))
        sentences += len(kept)
    feature, sentence, of = (np.concatenate(p).astype(int) for p in parts)
    w, bias = np.zeros(len(index)), START
    m, v = np.zeros(len(index) + 1), np.zeros(len(index) + 1)
    for step in range(1, STEPS + 1):
        z = np.bincount(sentence, w[feature], len(of)) + bias
        off = np.bincount(of, np.logaddexp(0, z), len(y))  # -log(1 - P)
        # dLoss/dz: p where the label is 0, and -p (1 - P) / P where it is 1
        scale = np.where(y > 0, -1 / np.expm1(np.clip(off, 1e-12, 700)), 1.0)
        g = scale[of] * np.exp(-np.logaddexp(0, -z)) / len(y)
        grad = np.append(np.bincount(feature, g[sentence], len(index)) + DECAY * w, g.sum())
        m += 0.1 * (grad - m)
        v += 0.001 * (grad * grad - v)
        move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-10)
        w -= move[:-1]
        bias -= move[-1]
    return Model({f: float(w[i]) for f, i in index.items() if w[i]}, float(bias))


def offending(text: str, model: Model, threshold: float = 0.5) -> list[tuple[int, int, float]]:
    """start, end and score of each sentence whose own score reaches the threshold (code points of the text)."""
    out = []
    for m in re.finditer(r"[^.!?\n]+[.!?\n]?", text):
        words = [t for t in _TOKEN.findall(m[0].lower()) if t not in _ENDS]
        if words and (p := 1 / (1 + np.exp(-(sum(map(model.word_weight, words)) + model.bias)))) >= threshold:
            out.append((m.start(), m.end(), float(p)))
    return out


def _scored(batches: Iterator[pa.RecordBatch], model: Model, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    weights = _Weights(model)
    span = schema.field("offending").type
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).to_pylist()
        scores = [noisy_or(sentence_logits(t or "", weights, model.bias)) for t in texts]
        spans = [[dict(zip(("start", "end", "score"), s, strict=True)) for s in offending(t or "", model)] if p >= 0.5 else [] for t, p in zip(texts, scores, strict=True)]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64()), pa.array(spans, span)], schema=pa.schema([*list(batch.schema)[:-1], schema.field("score"), schema.field("offending")]))


def score(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """The columns `carry`, score (0 to 1) and offending (array of start, end, score; empty below 0.5).

    A null text counts as empty; a text without words scores 0. Rows are kept as they are,
    repeated ones too; carried columns named like the two made ones give way. No rows give no rows.
    """
    ship(docs.sparkSession)
    kept = carried(carry, ("score", "offending"))
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(unused(kept, "text")))
    added = "score double, offending array<struct<start: bigint, end: bigint, score: double>>"
    schema = pa.schema([("score", pa.float64()), ("offending", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))])
    declared = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in kept)
    return rows.mapInArrow(lambda it: _scored(it, model, schema), declared + added)


def _kept(batches: Iterator[pa.RecordBatch], model: Model, at: int, threshold: float) -> Iterator[pa.RecordBatch]:
    weights = _Weights(model)
    for batch in batches:
        yield batch.filter(pa.array([noisy_or(sentence_logits(t or "", weights, model.bias)) < threshold for t in batch.column(at).to_pylist()], pa.bool_()))


def reject_toxic(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """The rows of docs, with all their columns, whose score is below the threshold.

    Null and empty texts score 0 and stay; repeated rows stay or go together. No rows give no rows.
    """
    ship(docs.sparkSession)
    at = docs.columns.index(text)
    return docs.mapInArrow(lambda it: _kept(it, model, at, threshold), docs.schema)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(sample(docs, labels, "toxic"))


def query(spark, sf_dir: str) -> DataFrame:
    """op1: toxicity scores of `documents`, whole table and whole texts, by a model of the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), F.size("offending").alias("n_offending"))
