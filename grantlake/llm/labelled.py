"""Bounded samples of labelled texts for fitting, and the class counts of all labels."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

#: Labelled rows of each class that a model is fitted on at most: those with the smallest hashes of doc_id.
FIT_ROWS = 2000


def bucket(parts: int) -> Column:
    """crc32 of doc_id as text, modulo ``parts``; a row without doc_id is in none."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def sampled(documents: DataFrame, labels: DataFrame, label: str, usable: Column, rows: int = FIT_ROWS) -> tuple[list[str], np.ndarray, float]:
    """Texts and 0/1 labels to fit on, and the log odds of label 1 among all usable rows of ``labels``.

    A document whose rows disagree on the label is left out, as are rows whose label or doc_id is null.
    """
    own = labels.filter(usable & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("z")).filter("y = z")
    own = c.staged(own.select(F.col("doc_id").cast("long"), F.col("y").cast("int")), "labels")
    counts = {r["y"]: r["count"] for r in own.groupBy("y").count().collect()}
    odds = float(np.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5)))
    picked = None
    for y in (0, 1):
        part = c.hashed_sample(own.filter(F.col("y") == y), "doc_id", rows)
        picked = part if picked is None else picked.unionByName(part)
    # Two ids per fitted row of sixteen bytes: a fixed bound.
    found = documents.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(picked), "doc_id")
    found = found.groupBy("doc_id", "y").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    texts, ys = [], []
    for r in found.toLocalIterator():
        texts.append(r["text"])
        ys.append(r["y"])
    order = np.argsort(np.array([hash_of(t) for t in texts], np.uint64), kind="stable")
    return [texts[i] for i in order], np.array(ys, np.int64)[order], odds


def hash_of(text: str) -> int:
    return int.from_bytes(text.encode("utf-8", "replace")[:64].ljust(8, b" ")[-8:], "little") ^ len(text)


def scored(documents: DataFrame, logits: Callable[[pa.Array], np.ndarray]) -> DataFrame:
    """doc_id and score of every row; ``logits`` maps a text column to one value per row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            z = np.clip(logits(batch.column("text")), -30, 30)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-z)), pa.float64())], ["doc_id", "score"])

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id long, score double")
