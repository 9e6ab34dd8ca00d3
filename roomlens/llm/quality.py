"""Quality classifier learnt from trusted positives and unlabelled text."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

THRESHOLD = 0.7
SAMPLE_ROWS = 12_000  # bound on the positives, and on the unlabelled rows, a model is fitted on
STEPS = 600
_FOLDS, _HELD_OUT = 4, 2

# Byte classes: what a text looks like, not what it says.
_CLASSES = 14


def _byte_classes() -> np.ndarray:
    table = np.full(256, 10, dtype=np.uint8)  # other ASCII symbols
    table[:32] = 11  # control
    for chars, number in (("abcdefghijklmnopqrstuvwxyz", 0), ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", 1), ("0123456789", 2),
                          (" ", 3), ("\n", 4), (".", 5), (",;:", 6), ("!?", 7), ("'\"-()", 8), ("@/\\_=+", 9)):
        table[list(chars.encode())] = number
    table[128:192] = 12  # continuation bytes
    table[192:] = 13  # first bytes of non-ASCII characters
    return table


_CLASS = _byte_classes()
FEATURES = _CLASSES * _CLASSES + 8
_PIECE = 1 << 20  # bytes of a text looked at together
_SPACE, _LINE_END = re.compile(rb"[ \t-\r]"), re.compile(rb"\n")


def _pieces(data: bytes, cut: re.Pattern) -> Iterator[bytes]:
    """``data`` in pieces of about ``_PIECE`` bytes that end with a ``cut``, or the rest."""
    start = 0
    while start < len(data):
        found = cut.search(data, start + _PIECE)
        end = found.end() if found else len(data)
        yield data[start:end]
        start = end


def features(text: str | None) -> np.ndarray:
    """Numbers that describe a whole text: shares of byte-class pairs, lengths, repetition.

    A long text is counted in pieces; only its distinct words and lines are held beside it.
    """
    data = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(FEATURES)
    if not data:
        return out
    view, pairs = np.frombuffer(data, dtype=np.uint8), np.zeros(_CLASSES * _CLASSES, dtype=np.int64)
    for start in range(0, len(data) - 1, _PIECE):
        kinds = _CLASS[view[start : start + _PIECE + 1]]  # pair numbers fit a byte
        pairs += np.bincount(kinds[:-1] * np.uint8(_CLASSES) + kinds[1:], minlength=len(pairs))
    out[: _CLASSES * _CLASSES] = np.sqrt(pairs / max(1, len(data) - 1))
    n_words, words, n_lines, lines = 0, set(), 0, set()
    for piece in _pieces(data, _SPACE):
        found = piece.split()
        n_words += len(found)
        words.update(found)
    for piece in _pieces(data, _LINE_END):
        found = [line for line in piece.split(b"\n") if line.strip()]
        n_lines += len(found)
        lines.update(found)
    distinct, spaced = len(words), max(1, n_words)
    out[-8:] = (
        np.log1p(len(data)), np.log1p(n_words), distinct / spaced,
        np.log1p(spaced / max(1, distinct)), len(lines) / max(1, n_lines),
        len(data) / spaced / 10, np.log1p(len(data) / max(1, n_lines)), 1.0,
    )
    return out


@dataclass(frozen=True)
class Model:
    """A logistic model over standardised features; without weights every score is ``prior``."""

    prior: float
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        z = np.clip((rows - self.mean) / self.scale, -8, 8) @ self.weights + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _descend(gradient, size: int, steps: int = STEPS, rate: float = 0.05) -> np.ndarray:
    """Adam from zero; deterministic."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for step in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def estimate_prior(positive: np.ndarray, unlabelled: np.ndarray, decay: float = 1e-3) -> float:
    """Share of positives in the unlabelled rows, from the density ratio of the two samples.

    A logistic model tells positives from unlabelled rows; its odds are the density ratio
    p(x | positive) / p(x), which is 1 / prior wherever no negatives are. The median over the
    positives is taken.
    """
    rows = np.vstack([positive, unlabelled])
    target = np.r_[np.ones(len(positive)), np.zeros(len(unlabelled))]
    weight = np.where(target > 0, 0.5 / len(positive), 0.5 / len(unlabelled))

    def gradient(w: np.ndarray) -> np.ndarray:
        return rows.T @ (weight * (_sigmoid(rows @ w) - target)) + decay * w

    odds = np.exp(np.clip(positive @ _descend(gradient, rows.shape[1]), -20, 20))
    return float(np.clip(1 / np.median(odds), 0.05, 0.99))


def fit(positive: np.ndarray, unlabelled: np.ndarray, decay: float = 1e-4) -> Model:
    """Minimise the non-negative unbiased risk with the logistic loss.

    risk = prior * loss(positives as 1) + max(0, loss(unlabelled as 0) - prior * loss(positives as
    0)). Where the second part falls below zero, its gradient is followed upwards instead.
    """
    if not len(positive) or not len(unlabelled):
        size = FEATURES
        return Model(0.5, np.zeros(size), np.ones(size), np.zeros(size), 0.0)
    both = np.vstack([positive, unlabelled])
    mean, scale = both.mean(axis=0), both.std(axis=0)
    scale = np.where(scale < 1e-4, 1.0, scale)

    def prepared(rows: np.ndarray) -> np.ndarray:
        return np.c_[np.clip((rows - mean) / scale, -8, 8), np.ones(len(rows))]

    p, u = prepared(positive), prepared(unlabelled)
    prior = estimate_prior(p, u)

    def gradient(w: np.ndarray) -> np.ndarray:
        zp, zu = p @ w, u @ w
        gain = prior * (p.T @ (_sigmoid(zp) - 1)) / len(p)
        negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        rest = (u.T @ _sigmoid(zu)) / len(u) - prior * (p.T @ _sigmoid(zp)) / len(p)
        return (gain + rest if negative >= 0 else -rest) + decay * np.r_[w[:-1], 0]

    w = _descend(gradient, p.shape[1])
    return Model(prior, mean, scale, w[:-1], float(w[-1]))


def held_out(doc_id: Column) -> Column:
    """Whether the document belongs to the fold whose labels are never learnt from."""
    digits = F.coalesce(doc_id.cast("string"), F.lit(""))
    return F.crc32(digits.cast("binary")) % _FOLDS == _HELD_OUT


def _feature_rows(docs: DataFrame) -> np.ndarray:
    """Features of a bounded sample, in order of doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [features(t.as_py()) for t in batch["text"]]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(values, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )

    found = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, x array<double>").toArrow()
    rows = found["x"].combine_chunks().flatten().to_numpy().reshape(-1, FEATURES)
    ids = np.array([-1 if i is None else i for i in found["doc_id"].to_pylist()], dtype=np.int64)
    return rows[np.lexsort((*rows.T[::-1], ids))]


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """A model from documents outside the held-out fold.

    Trusted positives are documents labelled 1; unlabelled text is any document, labelled or not.
    Of both, the ``sample_rows`` with the smallest hash of their id are used: a documented bound on
    what is fitted, read from all rows. Labels of 0 and of the held-out fold are never looked at.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).where(~held_out(F.col("doc_id")))
    ids = rows.select("doc_id")
    trusted = labels.where("quality = 1").select(F.col("doc_id").cast("long")).distinct()

    def sample(of: DataFrame, seed: int) -> DataFrame:
        picked = of.distinct().orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample_rows)
        bounded = spark.createDataFrame([(r[0],) for r in picked.collect()], "doc_id long")
        return rows.join(F.broadcast(bounded), "doc_id", "left_semi")

    positive = sample(ids.join(trusted, "doc_id", "left_semi"), 1)
    return fit(_feature_rows(positive), _feature_rows(sample(ids, 2)))


def classify(docs: DataFrame, model: Model, threshold: float = THRESHOLD, keep: list[str] | None = None,
             names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """Columns ``keep`` of ``docs`` (all by default) with score and predicted, or other ``names``.

    The score (0 to 1, higher: good text likelier) comes from the whole text alone; predicted is 1
    from ``threshold`` on. Null counts as empty; an empty text gets a score, too; repeated rows come
    back as often; columns of the input with these names are replaced. No rows give no rows. The features of a
    text are counted over the whole of it, in memory of some 20 bytes for each of its own.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in names]
    last = len([c for c in kept if c != "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(last)
            parts = [
                model.score(np.array([features(t.as_py()) for t in texts.slice(at, 256)]))
                for at in range(0, batch.num_rows, 256)
            ]
            scores = np.concatenate(parts) if parts else np.zeros(0)
            others = iter(batch.columns[:last])
            yield pa.RecordBatch.from_arrays(
                [
                    *(texts if c == "text" else next(others) for c in kept),
                    pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32)),
                ],
                names=[*kept, *names],
            )

    types = {f.name: f.dataType.simpleString() for f in docs.schema} | {"text": "string"}
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in kept), f"`{names[0]}` double", f"`{names[1]}` int"])
    text = F.col("text").cast("string")
    return docs.select(*(F.col(f"`{c}`") for c in kept if c != "text"), text).mapInArrow(run, schema)
