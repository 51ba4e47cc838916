"""Quality by supervised subword embeddings.

Each word has a learned vector, as have its hashed character n-grams and its shape; a document is the average of all
of them, and a softmax layer on the average gives the classes. Vectors and layer are learned together by numpy
stochastic gradient descent. As the layer is linear in the average, tasks only need one number per vector.

Words are runs without white space, with case and punctuation. A word that repeats the one before has a mark of its own. The
sample is bounded (see ``labelled``); scores cover every row, over whole texts. Null and empty texts score the class
counts; rows that repeat repeat their scores.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c
from grantlake.llm import labelled

BUCKETS = 1 << 17
WIDTH = 16
GRAMS = (3, 4, 5)
#: Rounds over the sample; a small sample takes more, up to so many gradient steps.
EPOCHS, LEAST_STEPS = 5, 1000
RATE = 0.5
#: How much faster vectors learn than the layer, and the layer's greatest norm.
PULL, LAYER_NORM = 4.0, 4.0
#: Documents of a gradient step.
STEP_ROWS = 16
_RAW = np.arange(256, dtype=np.uint8)
CLASSES = np.where(np.isin(_RAW, list(b"\x20\x09\x0a\x0b\x0c\x0d\x00")), 0, _RAW).astype(np.uint8)
_SHAPES = _RAW.copy()
_SHAPES[ord("a") : ord("z") + 1] = ord("x")
_SHAPES[ord("A") : ord("Z") + 1] = ord("X")
_SHAPES[ord("0") : ord("9") + 1] = ord("9")
_SHAPES[128:] = ord("x")
_REPEAT = 0
_OPEN, _CLOSE = 1, 2


def word_buckets(marks: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (word, bucket) of all parts of the words: itself, its n-grams with marked ends, its shape."""
    sizes = ends - begins + 2
    to = np.cumsum(sizes)
    at = to - sizes
    inner = np.arange(to[-1] if len(to) else 0) - np.repeat(at, sizes)
    flat = np.full(len(inner), _OPEN, np.uint8)
    flat[to - 1] = _CLOSE
    body = (inner > 0) & (inner < np.repeat(sizes, sizes) - 1)
    flat[body] = marks[np.repeat(begins, sizes)[body] + inner[body] - 1]
    of = np.repeat(np.arange(len(sizes)), sizes)
    word, bucket = [np.arange(len(sizes))], [c.span_hashes(flat, at, to)]
    for n in GRAMS:
        start = np.flatnonzero(inner + n <= np.repeat(sizes, sizes))
        word.append(of[start])
        bucket.append(c.span_hashes(flat, start, start + n) + np.uint64(n))
    shape = _SHAPES[flat]
    keep = np.ones(len(flat), bool)
    keep[1:] = (shape[1:] != shape[:-1]) | (inner[1:] == 0)  # runs count once
    kept = np.append(0, np.cumsum(keep))
    word.append(np.arange(len(sizes)))
    bucket.append(c.span_hashes(shape[keep], kept[at], kept[to]) + np.uint64(99))
    return np.concatenate(word), np.concatenate(bucket) % np.uint64(BUCKETS - 1) + np.uint64(1)


def parsed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words' (word, bucket) pairs; for each word of the texts its distinct word, its row, and if it repeats."""
    data, offsets = c.utf8(texts)
    marks, begins, ends, rows = c.word_spans(data, offsets, CLASSES)
    hashes = c.span_hashes(marks, begins, ends)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    word, bucket = word_buckets(marks, begins[first], ends[first])
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    again = np.zeros(len(which), bool)
    again[1:] = (which[1:] == which[:-1]) & (row[1:] == row[:-1])
    return word, bucket.astype(np.int64), which, row, again


@dataclass
class Model:
    """``pull``: for each bucket, how far its vector moves the log odds of label 1."""

    pull: np.ndarray
    bias: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        word, bucket, which, row, again = parsed(texts)
        n = which.max() + 1 if len(which) else 0
        total, count = np.bincount(word, self.pull[bucket], minlength=n), np.bincount(word, minlength=n)
        moved = np.bincount(row, total[which] + again * self.pull[_REPEAT], minlength=len(texts)) if len(which) else np.zeros(len(texts))
        parts = np.bincount(row, count[which] + again, minlength=len(texts)) if len(which) else np.zeros(len(texts))
        return self.bias + moved / np.maximum(parts, 1)


def _counts(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each row's buckets with the share of its parts that they are, and where each row begins and the last ends."""
    sizes, buckets, shares = np.zeros(len(texts) + 1, np.int64), [], []
    for begin in range(0, len(texts), 64):
        part = pa.array(texts[begin : begin + 64], pa.string())
        word, bucket, which, row, again = parsed(part)
        pairs, times = np.unique(row * (which.max() + 1 if len(which) else 1) + which, return_counts=True)
        n = which.max() + 1 if len(which) else 1
        cut = np.searchsorted(np.sort(word, kind="stable"), np.arange(n + 1))
        bucket = bucket[np.argsort(word, kind="stable")]
        size = np.diff(cut)[pairs % n]
        at = np.repeat(cut[pairs % n] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        key = np.concatenate([np.repeat(pairs // n, size) * BUCKETS + bucket[at], row[again] * BUCKETS + _REPEAT])
        weight = np.concatenate([np.repeat(times, size), np.ones(again.sum())])
        key, back = np.unique(key, return_inverse=True)
        weight = np.bincount(back, weight, minlength=len(key))
        own = key // BUCKETS
        sizes[begin + 1 : begin + 1 + len(part)] = np.bincount(own, minlength=len(part))
        buckets.append((key % BUCKETS).astype(np.int32))
        shares.append((weight / np.bincount(own, weight, minlength=len(part))[own]).astype(np.float32))
    return np.cumsum(sizes), np.concatenate(buckets), np.concatenate(shares)


def fitted(texts: list[str], labels: np.ndarray, odds: float, seed: int = 7) -> Model:
    """Vectors and layer from the sample, classes weighted alike; ``odds`` puts the bias right."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS, np.float32), odds)
    cut, col, share = _counts(texts)
    # From here on buckets are numbered among those in use; eight bytes for each bucket of a row is all that is held.
    number = np.zeros(BUCKETS, np.int32)
    for begin in range(0, len(col), BUCKETS):
        number[col[begin : begin + BUCKETS]] = 1
    used = np.flatnonzero(number)
    number[used] = np.arange(len(used))
    for begin in range(0, len(col), BUCKETS):
        col[begin : begin + BUCKETS] = number[col[begin : begin + BUCKETS]]
    random = np.random.default_rng(seed)
    vectors = random.uniform(-1 / WIDTH, 1 / WIDTH, (len(used), WIDTH)).astype(np.float32)
    layer, bias = np.zeros((WIDTH, 2), np.float32), np.zeros(2, np.float32)
    weight = np.where(labels == 1, len(labels) / (2 * (labels == 1).sum()), len(labels) / (2 * (labels == 0).sum()))
    target = np.eye(2, dtype=np.float32)[labels]
    in_round = -(-len(texts) // STEP_ROWS)
    rounds = max(EPOCHS, -(-LEAST_STEPS // in_round))
    steps, done = rounds * in_round, 0
    for _ in range(rounds):
        order = random.permutation(len(texts))
        for begin in range(0, len(texts), STEP_ROWS):
            some = order[begin : begin + STEP_ROWS]
            rate = RATE * (1 - done / steps)
            done += 1
            mean = np.stack([share[cut[i] : cut[i + 1]] @ vectors[col[cut[i] : cut[i + 1]]] for i in some])
            z = mean @ layer + bias
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            error = (p - target[some]) * weight[some, None].astype(np.float32)
            back = error @ layer.T
            layer -= rate * mean.T @ error
            layer *= min(1.0, LAYER_NORM / max(1e-9, float(np.linalg.norm(layer))))  # keeps steps from overshooting
            bias -= rate * error.sum(axis=0) / len(some)
            for i, step in zip(some, back, strict=True):
                own = slice(cut[i], cut[i + 1])
                vectors[col[own]] -= rate * PULL * share[own, None] * step
    pull = np.zeros(BUCKETS, np.float32)
    pull[used] = vectors @ (layer[:, 1] - layer[:, 0])
    return Model(pull, float(bias[1] - bias[0]) + odds)


def scores(documents: DataFrame, labels: DataFrame, held: int = 0, parts: int = 5) -> DataFrame:
    """doc_id, held_out and score of every row; labels of rows that are held out are not read."""
    texts, ys, odds = labelled.sampled(documents, labels, "quality", labelled.bucket(parts) != held)
    sent = documents.sparkSession.sparkContext.broadcast(fitted(texts, ys, odds))  # half a megabyte
    found = labelled.scored(documents, lambda texts: sent.value.logits(texts))
    return found.withColumn("held_out", F.coalesce(labelled.bucket(parts) == held, F.lit(False)))
