"""Quality by naive Bayes support vectors.

Indicators of n-grams are scaled by their log-count ratio between the classes; a linear
hinge-loss model is fitted on them by dual coordinate descent. The n-grams are those of
words, of word shapes, and marks of repetition within the text; margins become
probabilities by a logistic fit on rows that the descent did not see.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from beaconframe.llm.labelled import held_out, sample
from beaconframe.llm.naming import carried, unused
from beaconframe.session import ship, table

HASH_BITS = 20
#: Documents in which an n-gram must occur; smoothing of the counts; cost, passes and share of rows for the logistic fit.
MIN_DOCS, SMOOTH, COST, PASSES, CALIBRATE = 5, 1.0, 1.0, 12, 5
THRESHOLD = 0.3
CACHE_WORDS = 300_000
_MASK = (1 << HASH_BITS) - 1
_LOWER, _UPPER, _DIGIT, _SAME = re.compile(r"[a-zß-öø-ÿ]+"), re.compile(r"[A-ZÀ-ÖØ-Þ]+"), re.compile(r"[0-9]+"), re.compile(r"([^a-zA-Z0-9])\1+")


def shape(word: str) -> str:
    """Runs of lower-case letters as x, of upper-case ones as X, of digits as 9, of equal marks as one."""
    return _SAME.sub(r"\1", _DIGIT.sub("9", _UPPER.sub("X", _LOWER.sub("x", word))))


class _Hashes(dict):
    """Word to its hash and its shape's, packed in 64 bits."""

    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        h = self[word] = zlib.crc32(word.lower().encode("utf-8", "replace")) << 32 | zlib.crc32(shape(word).encode("utf-8", "replace"))
        return h


def _mixed(x: np.ndarray, salt: int) -> np.ndarray:
    x = (x ^ np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
    return ((x ^ (x >> np.uint64(29))) >> np.uint64(17)).astype(np.int64) & _MASK


def _share(count: float, of: int, salt: int, steps: int = 8) -> np.ndarray:
    """An indicator for each eighth that the share reaches."""
    return _mixed(np.arange(1, int(steps * count / max(1, of)) + 1, dtype=np.uint64), salt)


def indicators(text: str, hashes: _Hashes) -> np.ndarray:
    """Distinct hashed n-grams of the whole text."""
    words = text.split()
    n = len(words)
    both = np.fromiter(map(hashes.__getitem__, words), np.uint64, n)
    w, s = both >> np.uint64(32), both & np.uint64(0xFFFFFFFF)
    pair = lambda x, k: x[:-1] * np.uint64(k) + x[1:]
    parts = [_mixed(w, 1), _mixed(s, 3), _mixed(np.array([min(n, 16)], np.uint64), 9)]
    if n > 1:
        w2, s2 = pair(w, 1000003), pair(s, 1000003)
        parts += [_mixed(w2, 2), _mixed(s2, 4), _share((w[1:] == w[:-1]).sum(), n - 1, 5), _share(n - len(np.unique(w)), n, 6)]
        if n > 2:
            w3 = pair(w2, 1000033)
            parts += [_mixed(pair(s2, 1000033), 7), _share(len(w3) - len(np.unique(w3)), len(w3), 8)]
        top = np.unique(s, return_counts=True)
        parts += [_share(c, n, int(v) & 0xFFFF | 1 << 20) for v, c in zip(*top, strict=True) if 8 * c >= n]
    return np.unique(np.concatenate(parts))


@dataclass
class Model:
    """weights: of each hashed n-gram, its log-count ratio multiplied in."""

    weights: np.ndarray
    bias: float = 0.0
    slope: float = 1.0
    shift: float = 0.0

    def probability(self, features: np.ndarray) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.slope * (self.weights[features].sum() + self.bias) + self.shift, -30, 30))))


def log_count_ratio(x: list[np.ndarray], y: np.ndarray) -> np.ndarray:
    count = [np.bincount(np.concatenate([f for f, t in zip(x, y, strict=True) if (t > 0) == side] or [np.zeros(0, int)]), minlength=_MASK + 1) for side in (True, False)]
    p, q = (c + SMOOTH for c in count)
    return np.where(count[0] + count[1] >= MIN_DOCS, np.log(p / p.sum()) - np.log(q / q.sum()), 0.0)


def descend(x: list[np.ndarray], r: np.ndarray, y: np.ndarray, cost: float = COST, passes: int = PASSES) -> tuple[np.ndarray, float]:
    """Weights and bias of the hinge-loss model over r * x, by dual coordinate descent in a fixed random order."""
    w, bias, alpha, rng = np.zeros(len(r)), 0.0, np.zeros(len(y)), np.random.default_rng(7)
    values = [r[f] for f in x]
    square = np.array([v @ v for v in values]) + 1.0
    for _ in range(passes):
        for i in rng.permutation(len(y)):
            g = y[i] * (w[x[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - g / square[i], 0.0), cost)
            if new != alpha[i]:
                move = (new - alpha[i]) * y[i]
                w[x[i]] += move * values[i]
                bias += move
                alpha[i] = new
    return w * r, bias


def fit(rows: list[tuple[str, int]]) -> Model:
    """One class or no rows at all: a model that finds everything good."""
    y = np.array([2 * t - 1 for _, t in rows], float)
    if len(rows) == 0 or y.min() == y.max():
        return Model(np.zeros(_MASK + 1), shift=5.0)
    hashes = _Hashes()
    x = [indicators(t, hashes) for t, _ in rows]
    seen = np.arange(len(y)) % CALIBRATE != 0
    if len(set(y[seen])) < 2:
        seen[:] = True
    xs = [f for f, s in zip(x, seen, strict=True) if s]
    r = log_count_ratio(xs, y[seen])
    r /= max(np.sqrt(np.mean([(r[f] ** 2).sum() for f in xs])), 1e-9)
    w, bias = descend(xs, r, y[seen])
    model = Model(w, bias)
    check = ~seen if (~seen).any() else seen
    z = np.array([w[f].sum() + bias for f, c in zip(x, check, strict=True) if c])
    t = (y[check] > 0) * (1 - 2 / (len(z) + 2)) + 1 / (len(z) + 2)
    a, b = 1.0, 0.0
    for _ in range(50):  # Newton's method
        p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
        g, h = np.array([((p - t) * z).sum(), (p - t).sum()]), p * (1 - p)
        step = np.linalg.solve([[(h * z * z).sum() + 1e-3, (h * z).sum()], [(h * z).sum(), h.sum() + 1e-3]], g + 1e-3 * np.array([a, b]))
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -1, 1)
    model.slope, model.shift = float(a), float(b)
    return model


def _scored(batches: Iterator[pa.RecordBatch], level) -> Iterator[pa.RecordBatch]:
    model, hashes = level.value, _Hashes()
    for batch in batches:
        scores = [model.probability(indicators(t or "", hashes)) for t in batch.column(batch.num_columns - 1).to_pylist()]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], names=[*batch.schema.names[:-1], "score"])


def score(docs: DataFrame, model: Model, carry: list[str], text: str = "text") -> DataFrame:
    """The columns `carry` and score: the probability of good quality.

    A null text counts as empty, which scores like any other text. Rows are kept as they
    are, repeated ones too; a carried column named score gives way to it. No rows give no rows.
    """
    spark = docs.sparkSession
    ship(spark)
    level = spark.sparkContext.broadcast(model)  # 8 MiB
    kept = carried(carry, ["score"])
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias(unused(kept, "text")))
    declared = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in kept)
    return rows.mapInArrow(lambda it: _scored(it, level), f"{declared}score double")


def _kept(batches: Iterator[pa.RecordBatch], level, at: int, threshold: float) -> Iterator[pa.RecordBatch]:
    model, hashes = level.value, _Hashes()
    for batch in batches:
        yield batch.filter(pa.array([model.probability(indicators(t or "", hashes)) >= threshold for t in batch.column(at).to_pylist()], pa.bool_()))


def keep_good(docs: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, with all their columns, whose score reaches the threshold.

    A null text counts as empty; repeated rows stay or go together. No rows give no rows.
    """
    ship(docs.sparkSession)
    level = docs.sparkSession.sparkContext.broadcast(model)  # 8 MiB
    at = docs.columns.index(text)
    return docs.mapInArrow(lambda it: _kept(it, level, at, threshold), docs.schema)


def train(docs: DataFrame, labels: DataFrame) -> Model:
    return fit(sample(docs, labels, "quality"))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: quality scores of `documents`, whole table and whole texts, by a model of the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
