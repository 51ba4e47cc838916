"""Approximate nearest neighbours by learned partitions.

On a bounded sample the nearest-neighbour graph is cut into parts of equal size that keep neighbours together. A small
classifier learns from a vector the parts of its neighbours. It puts every row into its most probable part, and sends
a query to several most probable ones, where exact inner products in double precision rank all rows. Held-out rows of
the sample tell how many parts to ask: few where vectors cluster, most where they lie alike in all directions.

Parts are dealt in blocks of rows and of queries, so a part may hold any share of the table. A query asks more parts while
those it has hold fewer rows than it wants. Rows whose vector is null, zero, of another length than most, or holds null or
non-finite values take no part, nor do rows without vec_id. Rows that share a vec_id are one candidate and one query with several
vectors: the largest product of any two counts. A product that overflows is infinite, one without a value the smallest.
Equal scores are ranked by vec_id. Other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

#: Rows fitted on at most (smallest hashes of vec_id), of these held out to tell how many parts to ask; parts; neighbours in the graph.
FIT_ROWS, HELD_ROWS, PARTS, NEIGHBOURS = 4096, 512, 32, 10
#: Share of the true neighbours that held-out rows have to find in the sample.
TARGET = 0.95
#: Rows and queries that meet in one task at a time.
BLOCK_ROWS, BLOCK_QUERIES = 20_000, 4_000
HIDDEN, EPOCHS = 96, 40


def balanced_parts(vectors: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """The part of each vector, parts being equal in size up to one, and the neighbour graph (row by row)."""
    n = len(vectors)
    near = vectors @ vectors.T
    np.fill_diagonal(near, -np.inf)
    graph = np.argsort(-near, axis=1, kind="stable")[:, : min(NEIGHBOURS, n - 1)]
    # Start: halve along the widest direction until there are enough parts.
    groups = [np.arange(n)]
    while len(groups) < parts:
        groups.sort(key=len)
        rows = groups.pop()
        centred = vectors[rows] - vectors[rows].mean(axis=0)
        along = centred @ np.linalg.svd(centred.T @ centred)[0][:, 0]
        order = np.argsort(along, kind="stable")
        groups += [rows[order[: len(rows) // 2]], rows[order[len(rows) // 2 :]]]
    part = np.zeros(n, np.int64)
    for k, rows in enumerate(groups):
        part[rows] = k
    room = -(-n // parts)
    for _ in range(6):
        # Each vector wants the part that holds most of its neighbours; the surest choose first, while there is room.
        votes = np.zeros((n, parts))
        np.add.at(votes, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1)
        np.add.at(votes, (graph.ravel(), np.repeat(part, graph.shape[1])), 1)
        votes[np.arange(n), part] += 0.5
        wish = np.argsort(-votes, axis=1, kind="stable")
        space = np.full(parts, room)
        for i in np.argsort(-votes.max(axis=1), kind="stable"):
            k = next(k for k in wish[i] if space[k])
            part[i] = k
            space[k] -= 1
    return part, graph


@dataclass
class Router:
    """A classifier with one hidden layer."""

    layers: list[np.ndarray]
    width: int

    def logits(self, vectors: np.ndarray) -> np.ndarray:
        a, b, d, e = self.layers
        return np.maximum(vectors @ a + b, 0) @ d + e


def fitted(vectors: np.ndarray, seed: int = 5) -> Router:
    """A router for the sample; targets are the parts of a vector and its neighbours."""
    n, width = vectors.shape
    parts = max(1, min(PARTS, n // 16))
    part, graph = balanced_parts(vectors, parts)
    target = np.zeros((n, parts))
    np.add.at(target, (np.repeat(np.arange(n), graph.shape[1]), part[graph].ravel()), 1)
    target[np.arange(n), part] += 1
    target /= target.sum(axis=1, keepdims=True)
    random = np.random.default_rng(seed)
    layers = [random.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN), random.normal(0, (1 / HIDDEN) ** 0.5, (HIDDEN, parts)), np.zeros(parts)]
    scale = np.sqrt((vectors**2).mean()) or 1.0
    x = vectors / scale
    means, squares, step = [np.zeros_like(p) for p in layers], [np.zeros_like(p) for p in layers], 0
    for _ in range(EPOCHS):
        order = random.permutation(n)
        for begin in range(0, n, 128):
            some = order[begin : begin + 128]
            hidden = np.maximum(x[some] @ layers[0] + layers[1], 0)
            z = hidden @ layers[2] + layers[3]
            p = np.exp(z - z.max(axis=1, keepdims=True))
            error = (p / p.sum(axis=1, keepdims=True) - target[some]) / len(some)
            back = (error @ layers[2].T) * (hidden > 0)
            step += 1
            for k, slope in enumerate((x[some].T @ back, back.sum(axis=0), hidden.T @ error, error.sum(axis=0))):
                means[k] = 0.9 * means[k] + 0.1 * slope
                squares[k] = 0.999 * squares[k] + 0.001 * slope**2
                layers[k] = layers[k] - 3e-3 * (means[k] / (1 - 0.9**step)) / (np.sqrt(squares[k] / (1 - 0.999**step)) + 1e-8)
    layers[0] = layers[0] / scale
    return Router(layers, width)


def parts_to_ask(router: Router, held: np.ndarray, others: np.ndarray, top: int) -> int:
    """The fewest parts in which ``held`` find TARGET of their nearest among ``others``."""
    truth = np.argsort(-(held @ others.T), axis=1, kind="stable")[:, :top]
    place = np.argsort(np.argsort(-router.logits(held), axis=1, kind="stable"), axis=1)
    own = router.logits(others).argmax(axis=1)
    needed = np.sort(np.take_along_axis(place, own[truth], axis=1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(TARGET * len(needed))) - 1)]) + 1 if len(needed) else 1


def _valid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id and the vector's doubles as bytes."""
    for batch in batches:
        ids, out = [], []
        for i, v in zip(batch.column("vec_id").to_pylist(), batch.column("embedding"), strict=True):
            if i is None or not v.is_valid or v.values.null_count or not len(v.values):
                continue
            x = v.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(x).all() and x.any():
                ids.append(i)
                out.append(x.tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(out, pa.binary())], ["vec_id", "vector"])


def _stacked(column: pa.Array, width: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float64).reshape(-1, width)


def _best(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, rows: np.ndarray, top: int) -> pd.DataFrame:
    """The ``top`` best rows of each query but itself."""
    out = []
    # Where rows share a vec_id, more rows than ``top`` are needed for as many of them.
    last = max(0, len(ids) - top - (len(ids) - len(np.unique(ids))))
    for begin in range(0, len(q), 128):
        # A product may overflow; where infinities cancel out, it counts as the smallest.
        with np.errstate(over="ignore", invalid="ignore"):
            near = np.nan_to_num(q[begin : begin + 128] @ rows.T, nan=-np.inf, posinf=np.inf, neginf=-np.inf)
        own = q_ids[begin : begin + 128, None] == ids
        near[own] = -np.inf
        least = np.partition(near, last, axis=1)[:, last]
        for k, line in enumerate(near):
            # A little below the last, so that rounding of the product decides no tie.
            bound = least[k] - 1e-9 * (abs(least[k]) + 1) if np.isfinite(least[k]) else least[k]
            at = np.flatnonzero((line >= bound) & ~own[k])
            with np.errstate(over="ignore", invalid="ignore"):
                score = np.nan_to_num((rows[at] * q[begin + k]).sum(axis=1), nan=-np.inf, posinf=np.inf, neginf=-np.inf)
            order = np.lexsort((ids[at], -score))
            # Of several vectors of one vec_id the nearest counts.
            _, once = np.unique(ids[at][order], return_index=True)
            order = order[np.sort(once)][:top]
            out.append((np.full(len(order), q_ids[begin + k]), ids[at][order], score[order]))
    columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [[], [], []]
    return pd.DataFrame({"query_id": columns[0], "vec_id": columns[1], "score": columns[2]})


def neighbours(embeddings: DataFrame, every: int = 20, top: int = 20, asked: int | None = None) -> DataFrame:
    """For each row whose vec_id is divisible by ``every``: query_id, rank, vec_id, score of the ``top`` nearest found.

    ``asked`` parts are searched for each query; None takes as many as held-out rows of the sample need.
    """
    spark = embeddings.sparkSession
    rows = embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>")).mapInArrow(_valid, "vec_id long, vector binary")
    rows = c.staged(rows.distinct(), "vectors")
    sample = [bytes(r["vector"]) for r in c.hashed_sample(rows, "vec_id", FIT_ROWS).select("vector").toLocalIterator()]
    if not sample:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    size = Counter(map(len, sample)).most_common(1)[0][0]
    sample = np.unique(np.stack([np.frombuffer(v, np.float64) for v in sample if len(v) == size]), axis=0)
    sample = sample[np.random.default_rng(1).permutation(len(sample))]
    held = sample[: min(HELD_ROWS, len(sample) // 4)]
    router = fitted(sample[len(held) :])
    asked = asked or parts_to_ask(router, held, sample[len(held) :], top)
    width, parts = router.width, len(router.layers[3])
    rows = rows.filter(F.octet_length("vector") == size)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            part = router.logits(_stacked(batch.column("vector"), width)).argmax(axis=1) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part.astype(np.int64))], ["vec_id", "vector", "part"])

    index = c.staged(rows.mapInArrow(placed, "vec_id long, vector binary, part long"), "parts")
    sizes = np.zeros(parts, np.int64)
    for r in index.groupBy("part").count().collect():  # one row per part
        sizes[r["part"]] = r["count"]

    def routed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            order = np.argsort(-router.logits(_stacked(batch.column("vector"), width)), axis=1, kind="stable")
            held = np.cumsum(sizes[order], axis=1)
            # The asked parts, and further ones until there are enough rows beside the query.
            ask = (np.arange(parts) < asked) | (held - sizes[order] < top + 1)
            line, at = np.nonzero(ask)
            yield pa.RecordBatch.from_arrays([*(x.take(pa.array(line)) for x in batch.columns), pa.array(order[line, at])], ["vec_id", "vector", "part"])

    queries = index.filter(F.col("vec_id") % every == 0).select("vec_id", "vector")
    queries = c.staged(queries.mapInArrow(routed, "vec_id long, vector binary, part long"), "queries")
    wanted = np.zeros(parts, np.int64)
    for r in queries.groupBy("part").count().collect():
        wanted[r["part"]] = r["count"]
    blocks = F.array(*[F.lit(max(1, -(-int(n) // BLOCK_ROWS))) for n in sizes])
    chunks = F.array(*[F.lit(max(1, -(-int(n) // BLOCK_QUERIES))) for n in wanted])
    at = F.col("part").cast("int")
    own = F.xxhash64("vec_id")
    left = index.withColumn("block", F.pmod(own, F.get(blocks, at))).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.get(chunks, at) - 1)))
    right = queries.withColumn("chunk", F.pmod(own, F.get(chunks, at)).cast("int")).withColumn("block", F.explode(F.sequence(F.lit(0), F.get(blocks, at) - 1)))
    place = ["part", "block", "chunk"]

    def ranked(some: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        if not len(some) or not len(asking):
            return pd.DataFrame({"query_id": [], "vec_id": [], "score": []})
        vectors = [np.frombuffer(b"".join(x["vector"]), np.float64).reshape(-1, width) for x in (asking, some)]
        return _best(asking["vec_id"].to_numpy(), vectors[0], some["vec_id"].to_numpy(), vectors[1], top)

    left = left.withColumn("block", F.col("block").cast("int")).groupBy(*place)
    found = left.cogroup(right.groupBy(*place)).applyInPandas(ranked, "query_id long, vec_id long, score double")
    # A query has top rows for each part and block it asked; of several vectors of a vec_id the nearest counts.
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return found.selectExpr(
        "query_id", "cast(row_number() over (partition by query_id order by score desc, vec_id) as int) as rank", "vec_id", "score"
    ).filter(F.col("rank") <= top)
