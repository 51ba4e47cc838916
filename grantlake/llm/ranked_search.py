"""Ranked lexical search without random access (NRA) over impact-sorted lists.

``build`` cuts documents into segments of whole documents and writes, for each segment and term, the documents that
hold the term, largest impact first. ``search`` reads the lists of an item's terms from the top, deeper in each round, and
keeps an interval for the score of each document of the segment: the lower end is what the read entries add up to, the
upper end adds, for each list in which the document hasn't been met, the last impact read there. It reads on until
every document that may still be among the best k, ties included, has an interval of one point, so that membership,
order and scores are final. The best k of all segments hold the best k of all documents.

Segments are independent: no term, document or source is gathered in one task. A segment holds SEGMENT_WORDS words, or
one longer document. Terms are known by 64-bit hashes.

Null and empty texts have no terms and are never found, nor do they count as documents. Repeated rows are separate
documents. A null doc_id ranks after all others of its score. Rows of one item_id (null is one, too) are one item with the
terms of all. Other columns are ignored. An empty table of documents or items gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantlake.llm import common as c
from grantlake.llm.positional_index import CLASSES, terms_of

SEGMENT_WORDS = 1 << 20
#: Pairs of item and term that are sent to the tasks at once; more are searched in further passes over the index.
PASS_TERMS = 1_000_000
#: Entries that the first round reads of each list; each further round doubles the depth.
FIRST_DEPTH = 32

_ROWS = pa.schema([
    ("kind", pa.string()), ("segment", pa.int64()), ("term", pa.int64()), ("n", pa.int64()),
    ("docs", pa.binary()), ("impacts", pa.binary()), ("doc_ids", pa.list_(pa.int64())),
])
_DDL = "kind string, segment long, term long, n long, docs binary, impacts binary, doc_ids array<long>"


@dataclass
class Index:
    """``lists``: segment, term, n, docs and impacts (int32, largest impact first). ``documents``: segment, doc_ids. ``size``: documents with a term."""

    lists: DataFrame
    documents: DataFrame
    size: int


def _segment(number: int, doc_ids: pa.Array, lengths: np.ndarray, terms: np.ndarray, size: int, words: int) -> Iterator[pa.RecordBatch]:
    documents = np.repeat(np.arange(len(lengths)), lengths)
    order = np.argsort(terms, kind="stable")
    terms, documents = terms[order], documents[order]
    head = np.flatnonzero(np.concatenate([[True], (terms[1:] != terms[:-1]) | (documents[1:] != documents[:-1])])) if len(terms) else np.zeros(0, np.int64)
    tf = np.diff(np.append(head, len(terms)))
    terms, documents = terms[head], documents[head]
    m = 10 + 90 * lengths.astype(np.int64) * size // max(words, 1)
    impacts = 1_000_000_000 * tf // (1000 * tf + 8 * m[documents])
    order = np.lexsort((documents, -impacts, terms))
    terms, documents, impacts = terms[order], documents[order].astype(np.int32), impacts[order].astype(np.int32)
    firsts = np.flatnonzero(np.concatenate([[True], terms[1:] != terms[:-1]])) if len(terms) else head
    ends = np.append(firsts[1:], len(terms)) if len(terms) else head

    def rows(kind: str, count: int, **columns: pa.Array) -> pa.RecordBatch:
        columns |= {"kind": pa.array([kind] * count, pa.string()), "segment": pa.array(np.full(count, number))}
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(count, f.type)) for f in _ROWS], schema=_ROWS)

    yield rows("documents", 1, doc_ids=pa.ListArray.from_arrays(pa.array([0, len(doc_ids)], pa.int32()), doc_ids))
    for begin in range(0, len(firsts), 1 << 14):
        f, e = firsts[begin : begin + (1 << 14)], ends[begin : begin + (1 << 14)]
        cut = (np.concatenate([f, e[-1:]]) - f[0]).astype(np.int32) * 4
        docs, strong = (
            pa.Array.from_buffers(pa.binary(), len(f), [None, pa.py_buffer(cut), pa.py_buffer(x[f[0] : e[-1]].copy())]) for x in (documents, impacts)
        )
        yield rows("lists", len(f), term=pa.array(terms[f]), n=pa.array((e - f).astype(np.int64)), docs=docs, impacts=strong)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in c.slices(batches):
        data, offsets = c.utf8(batch.column("text"))
        lengths = np.diff(c.word_spans(data, offsets, CLASSES)[3])
        yield pa.RecordBatch.from_arrays([pa.array([int((lengths > 0).sum())]), pa.array([int(lengths.sum())])], ["size", "words"])


def build(documents: DataFrame) -> Index:
    """Indexes ``doc_id`` (integers) and ``text`` of every row; the index is written to the shared folder."""
    rows = documents.select(F.col("doc_id").cast("long"), "text")
    counts = rows.select("text").mapInArrow(_counted, "size long, words long").agg(F.sum("size").alias("size"), F.sum("words").alias("words")).head()
    size, words = counts["size"] or 0, counts["words"] or 0

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held, total = [], 0

        def written() -> Iterator[pa.RecordBatch]:
            ids, lengths, terms = zip(*held, strict=True)
            return _segment(number, pa.concat_arrays(ids), np.concatenate(lengths), np.concatenate(terms), size, words)

        for batch in c.slices(batches):
            terms, cuts = terms_of(batch.column("text"))
            held.append((batch.column("doc_id"), np.diff(cuts), terms))
            total += len(terms)
            if total >= SEGMENT_WORDS:
                yield from written()
                number, held, total = number + 1, [], 0
        if held:
            yield from written()

    written = c.staged(rows.mapInArrow(segments, _DDL), "impacts", "kind")
    return Index(
        written.filter("kind = 'lists'").select("segment", "term", "n", "docs", "impacts"),
        written.filter("kind = 'documents'").select("segment", "doc_ids"),
        size,
    )


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in c.slices(batches):
        terms, cuts = terms_of(batch.column("text"))
        ids = batch.column("item_id").take(pa.array(np.repeat(np.arange(batch.num_rows), np.diff(cuts))))
        yield pa.RecordBatch.from_arrays([ids, pa.array(terms)], ["item_id", "term"])


def best(lists: list[tuple[np.ndarray, np.ndarray]], n: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents 0 to ``n`` - 1 with a score above 0 that may be among the best ``k``, ties included, and their scores.

    ``lists``: for each term its documents and what it adds to their scores, largest first.
    """
    sizes = np.array([len(d) for d, _ in lists], np.int64)
    low = np.zeros(n, np.int64)
    met_docs, met_lists = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    depth, before = FIRST_DEPTH, 0
    while True:
        for x in np.flatnonzero(sizes > before):
            docs, adds = lists[x][0][before:depth], lists[x][1][before:depth]
            low[docs] += adds  # a list names a document once
            met_docs.append(docs)
            met_lists.append(np.full(len(docs), x))
        met_docs, met_lists = [np.concatenate(met_docs)], [np.concatenate(met_lists)]
        # What a document can still get from a list is at most the last value read, and nothing once the list has ended.
        last = np.array([adds[depth - 1] if len(adds) > depth else 0 for _, adds in lists], np.int64)
        high = low + last.sum()
        np.subtract.at(high, met_docs[0], last[met_lists[0]])
        bar = max(int(np.partition(low, n - k)[n - k]) if n > k else 0, 1)
        able = np.flatnonzero(high >= bar)
        if (high[able] == low[able]).all():
            return able, low[able]
        before, depth = depth, 2 * depth


@dataclass
class _Pass:
    """Items of one pass by number, as pairs of item and term in the order of items."""

    ids: pa.Array
    items: np.ndarray
    terms: np.ndarray
    weights: np.ndarray


def _in_segment(table: pa.Table, sought: _Pass, k: int) -> pa.Table:
    """The best ``k`` of one segment for each item."""
    kinds = np.array(table["kind"].to_pylist())
    ids = table["doc_ids"].combine_chunks().take(pa.array(np.flatnonzero(kinds == "documents"))).flatten()
    table = table.take(pa.array(np.flatnonzero(kinds == "lists"))).sort_by("term").combine_chunks()
    terms = table["term"].to_numpy()
    docs, impacts = ([np.frombuffer(x, np.int32) for x in table[name].to_pylist()] for name in ("docs", "impacts"))
    # Among equal scores smaller ids come first, rows without an id last.
    order = np.lexsort((ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False)))
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    slot = np.searchsorted(terms, sought.terms)
    slot[slot == len(terms)] = 0
    here = np.flatnonzero(terms[slot] == sought.terms) if len(terms) else np.zeros(0, np.int64)
    cuts = np.flatnonzero(np.diff(sought.items[here], prepend=-1))
    none = np.zeros(0, np.int64)
    parts = [(none, none, none)]
    for pairs in np.split(here, cuts[1:]) if len(here) else ():
        lists = [(docs[s], impacts[s] * w) for s, w in zip(slot[pairs], sought.weights[pairs], strict=True)]
        found, scores = best(lists, len(ids), k)
        top = np.lexsort((place[found], -scores))[:k]
        parts.append((np.full(len(top), sought.items[pairs[0]]), found[top], scores[top]))
    item, doc, score = (np.concatenate(x) for x in zip(*parts, strict=True))
    return pa.table([sought.ids.take(pa.array(item)), ids.take(pa.array(doc)), pa.array(score)], ["item_id", "doc_id", "score"])


def _searched(sought: Broadcast, k: int) -> Callable[[pa.Table], pa.Table]:
    return lambda table: _in_segment(table, sought.value, k)


def search(index: Index, items: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` documents of highest score for each item (``item_id``, ``text``): item_id, rank, doc_id, score."""
    spark = index.lists.sparkSession
    terms = items.select(F.col("item_id").cast("long"), "text").mapInArrow(_item_terms, "item_id long, term long").distinct()
    terms = c.staged(terms, "item_terms")
    df = index.lists.join(terms.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * index.size + 2) / (2 * F.col("df") + 1).cast("double")))
    weighed = c.staged(terms.join(df, "term").select("item_id", "term", weight.alias("w")).filter("w > 0"), "weights")
    passes = max(1, -(-weighed.count() // PASS_TERMS))
    documents = index.documents.select("segment", F.lit("documents").alias("kind"), "doc_ids")
    found = None
    for number in range(passes):
        # Items are dealt over passes by hash: about PASS_TERMS pairs of 24 bytes, and the lists of those terms only.
        part = weighed.filter(F.pmod(F.xxhash64("item_id"), F.lit(passes)) == number)
        pairs = part.orderBy("item_id", "term").toArrow().combine_chunks()
        ids = pc.dictionary_encode(pairs["item_id"].combine_chunks(), null_encoding="encode")
        numbers = ids.indices.to_numpy().astype(np.int64)
        sought = spark.sparkContext.broadcast(_Pass(ids.dictionary, numbers, pairs["term"].to_numpy(), pairs["w"].to_numpy()))
        lists = index.lists.join(F.broadcast(part.select("term").distinct()), "term", "left_semi")
        rows = lists.select("segment", F.lit("lists").alias("kind"), "term", "docs", "impacts").unionByName(documents, allowMissingColumns=True)
        tops = rows.groupBy("segment").applyInArrow(_searched(sought, k), "item_id long, doc_id long, score long")
        found = tops if found is None else found.unionByName(tops)
    # Each task keeps its best k of an item before they meet.
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.select("item_id", F.row_number().over(order).alias("rank"), "doc_id", "score").filter(F.col("rank") <= k)
