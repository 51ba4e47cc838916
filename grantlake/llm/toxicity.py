"""Toxicity by a counterfactually regularised classifier.

Logistic regression on the distinct words, and beginnings of words, of a text. Sentences of labelled texts that name a group are copied with
the group exchanged for each of a few others, and the squared change of the score enters the loss, so a group's name
by itself moves no score; a sparse penalty keeps words without evidence at zero.

The sample is bounded (see ``labelled``); scores cover every row. Null and empty texts score the bias. Rows that
repeat repeat their scores. Without labels of both classes the score is that of the class counts.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c
from grantlake.llm import labelled

#: Names of groups, exchanged within a line.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys"), ("woman", "man", "girl", "boy"), ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"), ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "african", "european"), ("immigrants", "refugees", "natives"), ("old", "young"),
    ("femmes", "hommes"), ("musulmans", "chrétiens", "juifs"), ("frauen", "männer"), ("muslime", "christen", "juden"),
    ("mujeres", "hombres"), ("musulmanes", "cristianos", "judíos"),
)
BUCKETS = 1 << 18
#: Beginnings of words, in bytes, that are features beside whole words.
PREFIXES = (4, 5)
SWAP_PENALTY = 10.0
CHOICE_PENALTY = 4e-3
SPARSE_PENALTY = 2e-5
STEPS = 300
SWAPS_PER_TEXT = 4
CLASSES = c.byte_table(bytes(range(0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (row, bucket) of the distinct words and beginnings of each text."""
    data, offsets = c.utf8(texts)
    marks, begins, ends, rows = c.word_spans(data, offsets, CLASSES)
    words = c.span_hashes(marks, begins, ends)
    row = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    found = [row * BUCKETS + (words % np.uint64(BUCKETS)).astype(np.int64)]
    for n in PREFIXES:
        long = ends - begins > n
        start = c.span_hashes(marks, begins[long], begins[long] + n) + np.uint64(n)
        found.append(row[long] * BUCKETS + (start % np.uint64(BUCKETS)).astype(np.int64))
    keys = np.unique(np.concatenate(found))
    return keys // BUCKETS, keys % BUCKETS


def _word(word: str) -> tuple[int, set[int]]:
    """The bucket of a word itself, and those of the word and its beginnings."""
    data, offsets = c.utf8(pa.array([word]))
    marks, begins, ends, _ = c.word_spans(data, offsets, CLASSES)
    return int(c.span_hashes(marks, begins, ends)[0] % np.uint64(BUCKETS)), set(features(pa.array([word]))[1].tolist())


@dataclass
class Model:
    weights: np.ndarray
    bias: float

    def logits(self, texts: pa.Array) -> np.ndarray:
        row, bucket = features(texts)
        return self.bias + np.bincount(row, self.weights[bucket], minlength=len(texts))


def swapped(rows: np.ndarray, buckets: np.ndarray, groups: Sequence[Sequence[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For texts that name a group: number of the exchange, buckets, and +1 for words that go, -1 for those that come."""
    number, out = 0, ([], [], [])
    for group in groups:
        own = [_word(w) for w in group]
        for k, (whole, parts) in enumerate(own):
            others = [x for _, x in own[k + 1 :] + own[:k] if x != parts][:SWAPS_PER_TEXT]
            for _ in rows[buckets == whole]:
                for other in others:
                    for sign, some in ((1.0, parts - other), (-1.0, other - parts)):
                        out[0].extend([number] * len(some))
                        out[1].extend(some)
                        out[2].extend([sign] * len(some))
                    number += 1
    return np.array(out[0], np.int64), np.array(out[1], np.int64), np.array(out[2])


def fitted(texts: list[str], labels: np.ndarray, odds: float, groups: Sequence[Sequence[str]] = IDENTITY_TERMS) -> Model:
    """Accelerated proximal gradient steps on the sample; ``odds`` puts the bias right for unequal classes."""
    if not len(labels) or labels.min() == labels.max():
        return Model(np.zeros(BUCKETS, np.float32), odds)
    rows, buckets = [], []
    for begin in range(0, len(texts), 256):
        r, b = features(pa.array(texts[begin : begin + 256], pa.string()))
        rows.append(r + begin)
        buckets.append(b)
    rows, buckets = np.concatenate(rows), np.concatenate(buckets)
    swap, swap_bucket, sign = swapped(rows, buckets, groups)
    share = np.where(labels == 1, 0.5 / (labels == 1).sum(), 0.5 / (labels == 0).sum())
    weights = np.zeros(BUCKETS)
    bias = 0.0
    # A heavy penalty finds the words with evidence, a light one then gives them their weights.
    for penalty in (CHOICE_PENALTY, SPARSE_PENALTY):
        if penalty == SPARSE_PENALTY:
            keep, keep_swap = weights[buckets] != 0, weights[swap_bucket] != 0
            rows, buckets, swap, swap_bucket, sign = rows[keep], buckets[keep], swap[keep_swap], swap_bucket[keep_swap], sign[keep_swap]
        used, at = np.unique(np.concatenate([buckets, swap_bucket]), return_inverse=True)
        w, bias = _descended(rows, at[: len(buckets)], swap, at[len(buckets) :], sign, len(used), labels, share, penalty)
        weights[:] = 0
        weights[used] = w
    return Model(weights.astype(np.float32), bias + odds)


def _descended(rows, col, swap, swap_col, sign, n_used, labels, share, penalty) -> tuple[np.ndarray, float]:
    """Weights of ``n_used`` words and the bias after STEPS accelerated proximal steps."""
    n_swaps = int(swap.max()) + 1 if len(swap) else 1
    w = ahead = np.zeros(n_used)
    bias = bias_ahead = 0.0
    # The curvature is at most a quarter of the mean squared length, and twice the penalty on each exchange.
    size = np.bincount(rows, minlength=len(labels))
    per_swap = SWAP_PENALTY / n_swaps
    touched = np.bincount(swap_col, minlength=n_used).max() if len(swap) else 0
    rate = 1 / (0.25 * (share * (size + 1)).sum() + 4 * per_swap * touched)
    t = 1.0
    for _ in range(STEPS):
        z = bias_ahead + np.bincount(rows, ahead[col], minlength=len(labels))
        error = share * (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels)
        slope = np.bincount(col, error[rows], minlength=n_used)
        if len(swap):
            change = np.bincount(swap, sign * ahead[swap_col], minlength=n_swaps)
            slope += 2 * per_swap * np.bincount(swap_col, sign * change[swap], minlength=n_used)
        new = ahead - rate * slope
        new = np.sign(new) * np.maximum(np.abs(new) - rate * penalty, 0)
        new_bias = bias_ahead - rate * error.sum()
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        ahead, bias_ahead = new + (before - 1) / t * (new - w), new_bias + (before - 1) / t * (new_bias - bias)
        w, bias = new, new_bias
    return w, bias


def kept(documents: DataFrame, labels: DataFrame, least: float = 0.3, held: int = 2, parts: int = 4) -> DataFrame:
    """The rows of ``documents`` that score below ``least``, with all their columns."""
    texts, ys, odds = labelled.sampled(documents, labels, "toxic", labelled.bucket(parts) != held)
    sent = documents.sparkSession.sparkContext.broadcast(fitted(texts, ys, odds))  # a megabyte
    bound = float(np.log(least / (1 - least)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            yield batch.filter(pa.array(sent.value.logits(batch.column("text")) < bound))

    return documents.mapInArrow(run, documents.schema)


def scores(documents: DataFrame, labels: DataFrame, held: int = 2, parts: int = 4) -> DataFrame:
    """doc_id, held_out and score of every row; labels of rows that are held out are not read."""
    texts, ys, odds = labelled.sampled(documents, labels, "toxic", labelled.bucket(parts) != held)
    sent = documents.sparkSession.sparkContext.broadcast(fitted(texts, ys, odds))  # a megabyte
    found = labelled.scored(documents, lambda texts: sent.value.logits(texts))
    return found.withColumn("held_out", F.coalesce(labelled.bucket(parts) == held, F.lit(False)))
