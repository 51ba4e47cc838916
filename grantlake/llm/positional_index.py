"""Benchmark decontamination with a distributed positional inverted index.

``build`` cuts documents into segments of whole documents and writes, for each segment and term, the sorted
list of the term's positions. ``phrases`` intersects, in each segment, the lists of a phrase's terms, each
shifted by its offset in the phrase, beginning with the term that is rarest in the whole corpus. ``near``
returns stretches that hold all of some terms. Segments are independent, so no term, document or source is ever
gathered in one task; a segment holds SEGMENT_WORDS words, or one longer document.

Null and empty texts have no words; their documents are in the index with length 0. Repeated rows are separate
documents. Other columns of the input, whatever their names, are ignored. An empty table gives an empty index.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

SEGMENT_WORDS = 1 << 20
#: Phrase words sent to the tasks at once; more phrases are looked up in further passes over the index.
PASS_WORDS = 2_000_000
WINDOW = 13
_GAP = 64
#: Words of the contamination rule: digits, lower-case letters and all that is not ASCII.
CLASSES = c.byte_table(bytes(range(0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x80)))

_ROWS = pa.schema([
    ("kind", pa.string()), ("segment", pa.int64()), ("term", pa.int64()), ("n", pa.int64()),
    ("places", pa.binary()), ("doc_id", pa.int64()), ("start", pa.int64()),
])


@dataclass
class Index:
    """``postings``: segment, term, n, places (int32 positions in the segment). ``documents``: segment, start, doc_id, n."""

    postings: DataFrame
    documents: DataFrame


def terms_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The term numbers (word hashes) of all texts, and where each text's begin."""
    data, offsets = c.utf8(texts)
    marks, begins, ends, rows = c.word_spans(data, offsets, CLASSES)
    return c.span_hashes(marks, begins, ends).view(np.int64), rows


def _segment(number: int, docs: list, lengths: list, terms: list) -> Iterator[pa.RecordBatch]:
    doc_ids = pa.concat_arrays(docs)
    n = np.concatenate(lengths)
    starts = np.concatenate([[0], np.cumsum(n + _GAP)])[:-1]
    words = np.concatenate(terms)
    # A gap between documents that no phrase or stretch is allowed to bridge; see ``_hits``.
    places = (np.arange(len(words)) + np.repeat(starts - (np.cumsum(n) - n), n)).astype(np.int32)
    order = np.argsort(words, kind="stable")
    words, places = words[order], places[order]
    firsts = np.flatnonzero(np.concatenate([[True], words[1:] != words[:-1]])) if len(words) else np.zeros(0, np.int64)
    ends = np.concatenate([firsts[1:], [len(words)]]) if len(words) else firsts

    def rows(kind: str, count: int, **columns: pa.Array) -> pa.RecordBatch:
        columns |= {"kind": pa.array([kind] * count, pa.string()), "segment": pa.array(np.full(count, number))}
        return pa.RecordBatch.from_arrays([columns.get(f.name, pa.nulls(count, f.type)) for f in _ROWS], schema=_ROWS)

    yield rows("documents", len(doc_ids), doc_id=doc_ids, n=pa.array(n.astype(np.int64)), start=pa.array(starts.astype(np.int64)))
    for begin in range(0, len(firsts), 1 << 14):
        f, e = firsts[begin : begin + (1 << 14)], ends[begin : begin + (1 << 14)]
        cut = (np.concatenate([f, e[-1:]]) - f[0]).astype(np.int32) * 4
        lists = pa.Array.from_buffers(pa.binary(), len(f), [None, pa.py_buffer(cut), pa.py_buffer(places[f[0] : e[-1]].copy())])
        yield rows("postings", len(f), term=pa.array(words[f]), n=pa.array((e - f).astype(np.int64)), places=lists)


def _segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    docs, lengths, terms, size = [], [], [], 0
    for batch in c.slices(batches):
        words, rows = terms_of(batch.column("text"))
        docs.append(batch.column("doc_id"))
        lengths.append(np.diff(rows))
        terms.append(words)
        size += len(words) + _GAP * batch.num_rows
        if size >= SEGMENT_WORDS:
            yield from _segment(number, docs, lengths, terms)
            number, docs, lengths, terms, size = number + 1, [], [], [], 0
    if docs:
        yield from _segment(number, docs, lengths, terms)


def build(documents: DataFrame) -> Index:
    """Indexes ``doc_id`` (integers) and ``text`` of every row; the index is written to the shared folder."""
    rows = documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        _segments, "kind string, segment long, term long, n long, places binary, doc_id long, start long"
    )
    rows = c.staged(rows, "index", "kind")
    return Index(
        rows.filter("kind = 'postings'").select("segment", "term", "n", "places"),
        rows.filter("kind = 'documents'").select("segment", "start", "doc_id", "n"),
    )


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """Each ``size`` consecutive words of each item (``item_id``, ``text``), or all words of a shorter one: item_id, terms."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            words, rows = terms_of(batch.column("text"))
            ids = batch.column("item_id").to_pylist()
            for i, (a, b) in enumerate(zip(rows[:-1], rows[1:], strict=True)):
                found = [words[k : min(k + size, b)] for k in range(a, max(a, b - size) + 1)] if b > a else []
                for at in range(0, len(found), 10_000):
                    part = found[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[i]] * len(part), pa.int64()), pa.array(part, pa.list_(pa.int64()))], ["item_id", "terms"]
                    )

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(cut, "item_id long, terms array<long>")


class _Phrases:
    """Phrases of one pass in the order in which their terms are looked up: rarest of the corpus first."""

    def __init__(self, items: list, phrases: list[np.ndarray], counts: dict[int, int]):
        self.items = pd.array(items, dtype="Int64")
        self.lengths = np.array([len(p) for p in phrases], np.int64)
        self.steps = max(self.lengths, default=0)
        self.terms = np.zeros((len(phrases), self.steps), np.int64)
        self.shifts = np.zeros((len(phrases), self.steps), np.int64)
        for k, p in enumerate(phrases):
            order = np.argsort([counts[int(t)] for t in p], kind="stable")
            self.terms[k, : len(p)], self.shifts[k, : len(p)] = p[order], order


def _joined(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The terms of a segment in order, where the positions of each begin, and the positions."""
    group = group.sort_values("term")
    ends = np.concatenate([[0], group["n"].to_numpy().cumsum()])
    return group["term"].to_numpy(), ends, np.frombuffer(b"".join(group["places"]), np.int32).astype(np.int64)


def _hits(group: pd.DataFrame, sought: _Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Where in the segment which phrase occurs."""
    terms, ends, places = _joined(group)
    slot = np.searchsorted(terms, sought.terms)
    slot[slot == len(terms)] = 0
    used = np.arange(sought.steps) < sought.lengths[:, None]
    alive = np.flatnonzero(((terms[slot] == sought.terms) | ~used).all(axis=1))
    slot = slot[alive]
    # One sorted array of (term, position) serves all lists.
    width = int(places.max()) + _GAP + sought.steps + 1
    keys = np.repeat(np.arange(len(terms)), np.diff(ends)) * width + places
    first = slot[:, 0]
    count = ends[first + 1] - ends[first]
    phrase = np.repeat(np.arange(len(alive)), count)
    begin = places[np.repeat(ends[first] - (count.cumsum() - count), count) + np.arange(count.sum())]
    begin = begin - sought.shifts[alive[phrase], 0]
    for step in range(1, sought.steps):
        more = sought.lengths[alive[phrase]] > step
        at = begin + sought.shifts[alive[phrase], step]
        wanted = slot[phrase, step] * width + at
        found = np.searchsorted(keys, wanted)
        found[found == len(keys)] = 0
        keep = ~more | ((keys[found] == wanted) & (at >= 0))
        phrase, begin = phrase[keep], begin[keep]
    keep = begin >= 0
    return alive[phrase[keep]], begin[keep]


def phrases(index: Index, wanted: DataFrame) -> DataFrame:
    """Each exact occurrence of ``wanted`` (item_id, terms): item_id, segment, begin, end, with touching ones of an item as one.

    Phrases of up to PASS_WORDS words are looked up in one pass; a larger table takes several.
    """
    spark = index.postings.sparkSession
    wanted = c.staged(wanted.filter(F.size("terms") > 0).distinct(), "phrases")
    total = wanted.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).head()[0]
    passes = max(1, -(-total // PASS_WORDS))
    out = None
    for k in range(passes):
        part = wanted.filter(F.pmod(F.xxhash64("item_id", "terms"), F.lit(passes)) == k)
        vocabulary = part.select(F.explode("terms").alias("term")).distinct()
        # A pass has at most about PASS_WORDS terms of eight bytes, so this side has a fixed bound.
        postings = index.postings.join(F.broadcast(vocabulary), "term", "left_semi")
        counts = {r["term"]: r["n"] for r in postings.groupBy("term").agg(F.sum("n").alias("n")).toLocalIterator()}
        rows = [(r["item_id"], np.array(r["terms"], np.int64)) for r in part.toLocalIterator()]
        rows = [r for r in rows if all(int(t) in counts for t in r[1])]
        sought = spark.sparkContext.broadcast(_Phrases([r[0] for r in rows], [r[1] for r in rows], counts))
        found = postings.groupBy("segment").applyInPandas(_search(sought), "segment long, item_id long, begin long, end long")
        out = found if out is None else out.unionByName(found)
    return out


def _search(sought: Broadcast) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda group: _occurrences(group, sought.value)


def _occurrences(group: pd.DataFrame, sought: _Phrases) -> pd.DataFrame:
    which, begin = _hits(group, sought) if len(sought.lengths) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    rows = pd.DataFrame({"item_id": sought.items[which], "begin": begin, "end": begin + sought.lengths[which]})
    rows = rows.sort_values(["item_id", "begin"], ignore_index=True)
    far = rows["end"].groupby(rows["item_id"], dropna=False).cummax()
    new = (rows["item_id"].fillna(-1).diff() != 0) | (rows["item_id"].isna() != rows["item_id"].isna().shift()) | (rows["begin"] > far.shift())
    rows = rows.groupby(new.cumsum().to_numpy()).agg({"item_id": "first", "begin": "min", "end": "max"})
    rows.insert(0, "segment", group["segment"].iloc[0])
    return rows


def near(index: Index, words: list[str], width: int) -> DataFrame:
    """Stretches of at most ``width`` words that hold all of ``words``: segment, begin, end (shortest from each begin).

    ``width`` may be up to the gap between documents, so that a stretch stays inside one document.
    """
    if not 0 < width <= _GAP:
        raise ValueError(f"width must be from 1 to {_GAP}")
    terms = np.unique(terms_of(pa.array([" ".join(words)]))[0])

    def search(group: pd.DataFrame) -> pd.DataFrame:
        _, ends, places = _joined(group)
        lists = [places[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]
        empty = np.zeros(0, np.int64)
        begin = stop = empty
        if len(lists) == len(terms):
            rarest = min(lists, key=len)
            begin = np.unique(places)
            after = np.searchsorted(rarest, begin)
            begin = begin[(after < len(rarest)) & (rarest[np.minimum(after, len(rarest) - 1)] - begin < width)]
            stop = begin
            for x in lists:
                after = np.searchsorted(x, begin)
                stop = np.maximum(stop, np.where(after < len(x), x[np.minimum(after, len(x) - 1)], np.iinfo(np.int64).max - 1))
            keep = stop - begin < width
            begin, stop = begin[keep], stop[keep] + 1
        return pd.DataFrame({"segment": group["segment"].iloc[0], "begin": begin, "end": stop})

    postings = index.postings.filter(F.col("term").isin([int(t) for t in terms]))
    return postings.groupBy("segment").applyInPandas(search, "segment long, begin long, end long")


def in_documents(index: Index, found: DataFrame) -> DataFrame:
    """``found`` (segment, begin, end, ...) with doc_id, the document's place in the index, and word numbers in the document."""
    docs = index.documents.groupBy("segment").agg(F.array_sort(F.collect_list(F.struct("start", "doc_id", "n"))).alias("docs"))
    last = F.element_at(F.filter("docs", lambda d: d["start"] <= F.col("begin")), -1)
    return found.join(docs, "segment").withColumn("d", last).select(
        "segment", F.col("d.start").alias("start"), F.col("d.doc_id").alias("doc_id"), F.col("d.n").alias("n_words"),
        *[x for x in found.columns if x not in ("segment", "begin", "end")],
        (F.col("begin") - F.col("d.start")).alias("begin"), (F.col("end") - F.col("d.start")).alias("end"),
    )


def contamination(documents: DataFrame, items: DataFrame) -> DataFrame:
    """Per document: n_words, n_hit (words inside an occurrence of a window), the sorted ids of items with occurring windows.

    ``contaminated`` if at least a twentieth of its words are hit. Items without an id count for n_hit but are
    not listed. Rows that repeat give repeated results; documents without words have zeros.
    """
    index = build(documents)
    return judged(index, phrases(index, windows(items)))


def judged(index: Index, found: DataFrame) -> DataFrame:
    spans = in_documents(index, c.staged(found, "hits"))
    covered = F.aggregate(
        F.array_sort(F.collect_list(F.struct("begin", "end"))),
        F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("end")),
        lambda a, s: F.struct(
            (a["n"] + F.greatest(s["end"] - F.greatest(s["begin"], a["end"]), F.lit(0).cast("long"))).alias("n"),
            F.greatest(a["end"], s["end"]).alias("end"),
        ),
        lambda a: a["n"],
    )
    # The spans of one document and item are merged already, so these lists are short.
    hits = spans.groupBy("segment", "start").agg(
        covered.alias("n_hit"), F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items")
    )
    docs = index.documents.join(hits, ["segment", "start"], "left")
    return docs.select(
        "doc_id", F.col("n").alias("n_words"), F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    ).withColumn("contaminated", F.expr("n_hit > 0 and 20 * n_hit >= n_words"))


def decontaminated(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``documents`` without contaminated ones, all columns kept; each row is judged by itself, known by a hash of doc_id and text."""
    key = c.fresh(documents, "own_hash")
    keyed = documents.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), "text"))
    with c.scratch() as keep:
        found = contamination(keyed.select(F.col(key).alias("doc_id"), "text"), items).filter("contaminated")
        found = keep(c.staged(found.select(F.col("doc_id").alias(key)).distinct(), "contaminated"))
    return keyed.join(found, key, "left_anti").select(*documents.columns)
