"""Near duplicates by one-permutation hashing with optimal densification, banded buckets and star-shaped candidates.

A document's set are its distinct five-word shingles. One hash per shingle gives the whole signature: the hash
range is cut into BANDS * ROWS bins and each bin keeps its smallest hash; an empty bin takes the value of the first
bin that is not empty in an order fixed for it. Documents that agree on all rows of a band share a bucket.

Documents with equal sets are one class from the start. In each bucket classes are paired with the smallest one only,
and pairs are confirmed on the full sets: first each class with one of its smallest classes, then, in buckets whose
classes are still in several components, with that bucket's. Classes of buckets that are still in several
components go through an exact prefix filter: whatever order shingles have, two sets that are linked share one of the
first quarter of theirs. With common shingles last, a passage that many documents share pairs nobody. So a smallest
class that resembles only some of the others hides no link. At a similarity of 0.75 a pair shares no bucket with a probability of 4e-6.

Null and empty texts have no shingles and are linked with nothing. Each row is a document; several may share a doc_id. A
row without doc_id is compared, and links run through it, but it names no component: the component is null if none of its
rows has an id, and they are kept then. Other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

SHINGLE = 5
BANDS, ROWS = 64, 6
#: Linked if 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Shingles known as common at most.
COMMON = 1 << 16
#: Classes of a group that are paired, and classes of a larger group compared with each other in one step.
SMALL, BLOCK = 64, 256
CLASSES = c.byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")

_BINS = BANDS * ROWS
_EDGES = np.array([(k << 64) // _BINS for k in range(_BINS)], np.uint64)
#: For each bin the order in which an empty one asks the others.
_ASKS = np.stack([np.argsort(c.mixed(np.arange(k * _BINS + 1, (k + 1) * _BINS + 1, dtype=np.uint64)), kind="stable") for k in range(_BINS)])
_MIX = c.mixed(np.arange(1, _BINS + 1, dtype=np.uint64)).reshape(BANDS, ROWS) | np.uint64(1)
_SALT = c.mixed(np.arange(1001, 1001 + BANDS, dtype=np.uint64))


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes in order."""
    data, offsets = c.utf8(texts)
    marks, begins, ends, rows = c.word_spans(data, offsets, CLASSES)
    words = c.span_hashes(marks, begins, ends)
    runs = c.run_hashes(words, SHINGLE)
    for a, b in zip(rows[:-1], rows[1:], strict=True):
        if b - a >= SHINGLE:
            yield np.unique(runs[a : b - SHINGLE + 1])
        else:
            yield c.run_hashes(words[a:b], b - a) if b > a else np.zeros(0, np.uint64)


def bands_of(shingles: np.ndarray) -> np.ndarray:
    """The bucket of each band for a sorted set that is not empty."""
    first = np.searchsorted(shingles, _EDGES)
    filled = np.append(first[1:], len(shingles)) > first
    values = shingles[np.minimum(first, len(shingles) - 1)]
    empty = np.flatnonzero(~filled)
    if len(empty):
        asks = _ASKS[empty]
        values[empty] = values[asks[np.arange(len(empty)), filled[asks].argmax(axis=1)]]
    return c.mixed((values.reshape(BANDS, ROWS) * _MIX).sum(axis=1) + _SALT).view(np.int64)


def digest(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that two sets share if and only if they are equal, but for chance."""
    a = c.mixed(shingles + np.uint64(0x51)).sum(dtype=np.uint64)
    b = c.mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    return int(a.view(np.int64)), int(b.view(np.int64))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in c.slices(batches):
        sizes, first, second, buckets = [], [], [], []
        for shingles in shingle_sets(batch.column("text")):
            a, b = digest(shingles)
            sizes.append(len(shingles))
            first.append(a)
            second.append(b)
            buckets.append(bands_of(shingles) if len(shingles) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text_hash"), *(pa.array(x, pa.int64()) for x in (sizes, first, second)), pa.array(buckets, pa.list_(pa.int64()))],
            ["doc_id", "text_hash", "n", "d1", "d2", "buckets"],
        )


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in c.slices(batches):
        found = list(shingle_sets(batch.column("text")))
        pairs = [digest(x) for x in found]
        yield pa.RecordBatch.from_arrays(
            [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64()), pa.array([x.tobytes() for x in found], pa.binary())],
            ["d1", "d2", "shingles"],
        )


def _confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            a, b = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            if len(a) > len(b):
                a, b = b, a
            at = np.searchsorted(b, a)
            at[at == len(b)] = 0
            common = int((b[at] == a).sum())
            keep.append(100 * common >= PERCENT * (len(a) + len(b) - common))
        yield batch.filter(pa.array(keep, pa.bool_())).select(["a", "b"])


def confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) of class representatives that are linked on their full sets (rep, shingles)."""
    left = sets.select(F.col("rep").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("rep").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(_confirm, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """For each vertex of ``edges`` (a, b) the smallest vertex it can reach: v, component.

    Alternates two steps until nothing changes: each vertex's larger neighbours move to its smallest neighbour, then its
    smaller ones do. Vertices with many neighbours cost one row each; only counts come to the driver.
    """
    edges = c.staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u > v").distinct(), "edges")
    seen = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = c.staged(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u > v").distinct()
        large = c.staged(large, "large")
        c.released(least)
        least = c.staged(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        small = large.join(least, "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        before, edges = edges, c.staged(small.filter("u > v").distinct(), "edges")
        c.released(before, large, least)
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).head()
        if now == seen:
            return edges.select(F.col("u").alias("v"), F.col("v").alias("component")).unionByName(
                edges.select("v", F.col("v").alias("component")).distinct()
            )
        seen = now


def _open(shared: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows of buckets that hold classes of several components, with the component of each."""
    label = shared.join(joined.withColumnRenamed("v", "rep"), "rep", "left")
    label = c.staged(label.select("bucket", "a", "an", "rep", "n", F.coalesce("component", "rep").alias("component")), "labels")
    mixed = label.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high")
    mixed = c.staged(label.join(mixed.select("bucket"), "bucket"), "open")
    c.released(label)
    return mixed


def _among_rare(classes: DataFrame, tested: DataFrame) -> DataFrame:
    """Linked pairs (a, b) of different components, among classes whose first quarters of shingles, common ones last, meet.

    Groups of up to SMALL classes give pairs, so there are SMALL pairs per row at most; larger ones are compared in blocks.

    ``classes``: rep, n, component, shingles. Which shingles are common is read from a part of the classes, and COMMON of
    them are kept. This only sets the order; any order gives every linked pair.
    """

    def exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("shingles")]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(own))], ["shingle"])

    part = classes.filter(F.pmod(F.xxhash64("rep"), F.lit(8)) == 0).select("shingles").mapInArrow(exploded, "shingle long")
    counts = part.groupBy("shingle").count().filter("count > 2").orderBy(F.desc("count"), "shingle").limit(COMMON).toPandas()
    common = np.sort(counts["shingle"].to_numpy(np.int64).view(np.uint64))
    often = counts["count"].to_numpy(np.int64)[np.argsort(counts["shingle"].to_numpy(np.int64).view(np.uint64))]

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            firsts, sizes = [], []
            for x in batch.column("shingles"):
                own = np.frombuffer(x.as_buffer(), np.uint64)
                sizes.append(len(own))
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    own = own[np.argsort(np.where(common[at] == own, often[at], 0), kind="stable")]
                firsts.append(own[: len(own) - -(-PERCENT * len(own) // 100) + 1].view(np.int64))
            of = pa.array(np.repeat(np.arange(len(firsts)), [len(x) for x in firsts]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(firsts)), batch.column("rep").take(of), pa.array(sizes, pa.int64()).take(of), batch.column("component").take(of)],
                ["shingle", "rep", "n", "component"],
            )

    every = c.staged(classes.mapInArrow(prefixes, "shingle long, rep long, n long, component long"), "prefixes")
    several = every.groupBy("shingle").agg(F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("size"))
    rows = c.staged(every.join(several.filter("low < high").select("shingle", "size"), "shingle"), "prefixes")
    c.released(every)

    few = rows.filter(F.col("size") <= SMALL)
    other = few.select("shingle", F.col("rep").alias("b"), F.col("n").alias("bn"), F.col("component").alias("bc"))
    pairs = few.join(other, "shingle").filter("rep < b and component <> bc and 100 * least(n, bn) >= %d * greatest(n, bn)" % PERCENT)
    pairs = pairs.select(F.col("rep").alias("a"), "b").distinct().join(tested, ["a", "b"], "left_anti")
    links = confirmed(c.staged(pairs, "pairs"), classes.select("rep", "shingles"))

    # A larger group is cut into blocks; each pair of blocks meets in one place, where only links leave the task.
    # Blocks of the group's main component come first and never meet each other, as all in them are linked already.
    many = rows.filter(F.col("size") > SMALL)
    main = many.groupBy("shingle", "component").count().groupBy("shingle")
    main = main.agg(F.max_by("component", F.struct("count", "component")).alias("main"), F.max("count").alias("mains"))
    many = many.join(main, "shingle").withColumns({
        "inside": F.col("component") == F.col("main"),
        "begin": F.ceil(F.col("mains") / BLOCK).cast("long"),
        "rest": F.ceil((F.col("size") - F.col("mains")) / BLOCK).cast("long"),
    })
    spread = F.xxhash64("rep")
    own = F.when(F.col("inside"), F.pmod(spread, F.col("begin"))).otherwise(F.col("begin") + F.pmod(spread, F.col("rest")))
    first = F.when(F.col("inside"), F.col("begin")).otherwise(F.lit(0).cast("long"))
    others = F.sequence(first, F.col("begin") + F.col("rest") - 1)
    many = many.withColumn("own", own).withColumn("other", F.explode(others))
    many = many.select("shingle", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "component")
    many = many.join(classes.select("rep", "shingles"), "rep")
    place = ["shingle", "i", "j"]
    many = many.repartition(c.shuffle_partitions(rows.sparkSession), *place).sortWithinPartitions(*place)
    return links.unionByName(many.mapInArrow(_linked, "a long, b long").distinct())


def _linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The linked pairs of different components among consecutive rows with equal (shingle, i, j)."""
    place, held = None, []
    for batch in batches:
        keys = np.stack([batch.column(k).to_numpy() for k in ("shingle", "i", "j")])
        cuts = np.flatnonzero(np.concatenate([[True], (keys[:, 1:] != keys[:, :-1]).any(axis=0)])) if batch.num_rows else []
        found = []
        for a, b in zip(cuts, [*cuts[1:], batch.num_rows], strict=True):
            if held and (keys[:, a] != place).any():
                found.append(_pairs(held))
                held = []
            place = keys[:, a]
            held.append(batch.slice(a, b - a))
        if found:
            yield from found
        # What is held must not keep the batch alive.
        held = [pa.RecordBatch.from_arrays([pa.concat_arrays([x]).take(pa.array(np.arange(len(x)))) for x in h.columns], schema=h.schema) for h in held]
    if held:
        yield _pairs(held)


def _pairs(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    rows = pa.Table.from_batches(held)
    rep, component = rows["rep"].to_numpy(), rows["component"].to_numpy()
    sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in rows["shingles"]]
    sizes = np.array([len(x) for x in sets])
    every = np.concatenate(sets)
    _, at, count = np.unique(every, return_inverse=True, return_counts=True)
    shared = count > 1
    slot = (np.cumsum(shared) - 1)[at]
    inside = shared[at]
    row, slot = np.repeat(np.arange(len(sets)), sizes)[inside], slot[inside]
    common = np.zeros((len(sets), len(sets)), np.float32)
    for begin in range(0, int(shared.sum()), 4096):
        part = (slot >= begin) & (slot < begin + 4096)
        marks = np.zeros((len(sets), 4096), np.float32)
        marks[row[part], slot[part] - begin] = 1
        common += marks @ marks.T
    linked = 100 * common >= PERCENT * (sizes[:, None] + sizes - common)
    a, b = np.nonzero(linked & (rep[:, None] < rep) & (component[:, None] != component))
    return pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b])], ["a", "b"])


def near_duplicates(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, n_shingles, class_id (smallest doc_id with the same set), component_id, kept."""
    out = _grouped(documents)
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("class_id")).otherwise(F.col("doc_id")).alias("class_id"),
        component.alias("component_id"), F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
    )


def _grouped(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, text_hash, n, and of rows with shingles class_id, component_id and component, a number that is never null."""
    rows = documents.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), "text")
    with c.scratch() as keep:
        sketches = c.staged(rows.mapInArrow(_sketch, "doc_id long, text_hash long, n long, d1 long, d2 long, buckets array<long>"), "sketches")
        # Classes have numbers of their own, as a class may have no doc_id, and one doc_id several texts.
        classes = sketches.filter("n > 0").groupBy("d1", "d2").agg(
            F.min("doc_id").alias("class_id"), F.min(_row()).alias("row"), F.first("n").alias("n"), F.first("buckets").alias("buckets")
        )
        classes = c.staged(classes.withColumn("rep", F.monotonically_increasing_id()), "classes")
        read = keep(c.staged(sketches.drop("buckets"), "read"))
        c.released(sketches)
        names = keep(c.staged(classes.drop("buckets", "n"), "names"))
        member = classes.select("rep", "n", F.explode("buckets").alias("bucket"))
        stars = member.groupBy("bucket").agg(F.min_by(F.struct("rep", "n"), "rep").alias("least"), F.count("*").alias("size")).filter("size > 1")
        stars = c.staged(stars.select("bucket", F.col("least.rep").alias("a"), F.col("least.n").alias("an")), "stars")
        shared = c.staged(member.join(stars, "bucket"), "shared")
        c.released(classes, stars)
        joined = keep(c.staged(_joined(rows, shared, names), "components"))
    # A component is named by its smallest doc_id.
    labels = names.join(joined.withColumnRenamed("v", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    least = labels.groupBy("component").agg(F.min("class_id").alias("component_id"))
    ids = labels.join(least, "component").select("d1", "d2", "class_id", "component", "component_id")
    return read.join(ids, ["d1", "d2"], "left")


def _row(id: str = "doc_id", text_hash: str = "text_hash") -> Column:
    """Tells rows apart, but for repeats and for chance."""
    return F.xxhash64(id, text_hash)


def _joined(rows: DataFrame, shared: DataFrame, names: DataFrame) -> DataFrame:
    """For each class that is linked with another its component: v, component, both numbers of classes."""
    close = 100 * F.least("an", "n") >= PERCENT * F.greatest("an", "n")
    stars = shared.filter((F.col("a") != F.col("rep")) & close).select("a", F.col("rep").alias("b"))
    first = c.staged(stars.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "pairs")
    wanted = c.staged(shared.select("rep").distinct().join(names.select("rep", "d1", "d2", "row"), "rep"), "wanted")
    # Most texts have no part in this; they are left out before the join, which deals the others.
    some = c.possible(rows.withColumn("row", _row()), F.col("row"), wanted.select("row"), "some").filter("some")
    sets = some.join(wanted.select("row"), "row", "left_semi").select("text").mapInArrow(_sets, "d1 long, d2 long, shingles binary")
    sets = sets.groupBy("d1", "d2").agg(F.first("shingles").alias("shingles"))
    sets = c.staged(sets.join(wanted, ["d1", "d2"]).select("rep", "shingles"), "sets")
    edges = c.staged(confirmed(first, sets), "links")
    joined = components(edges)

    # Other smallest classes of buckets that are still in several components.
    label = _open(shared, joined)
    second = label.join(label.select("bucket", F.col("rep").alias("ra"), F.col("component").alias("ac")), ["bucket"]).filter(
        "ra = a and rep <> a and component <> ac"
    )
    second = second.filter(close).select("a", F.col("rep").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    second = c.staged(second, "pairs")
    c.released(label)
    more = c.staged(confirmed(second, sets), "links")
    c.released(second)
    if more.limit(1).count():
        edges = edges.unionByName(more)
        joined = components(edges)

    label = _open(shared, joined)
    left = c.staged(label.select("rep", "n", "component").distinct().join(sets, "rep"), "open")
    c.released(label, shared, sets)
    more = c.staged(_among_rare(left, first), "links")
    return components(edges.unionByName(more)) if more.limit(1).count() else joined


def deduplicated(documents: DataFrame) -> DataFrame:
    """``documents`` with one row of each component, all columns kept: that of the smallest doc_id, one without an id last.

    Rows are known by doc_id and a hash of their text, so other rows of that doc_id are judged by themselves. Of rows that repeat
    both, one stays. Rows without shingles all stay.
    """
    with c.scratch() as keep:
        rows = c.staged(_grouped(documents).select("doc_id", "text_hash", "n", "component"), "judged")
        first = F.min(F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")).alias("first")
        stay = rows.filter("n > 0").groupBy("component").agg(first)
        other = ~(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("text_hash") == F.col("first.text_hash")))
        gone = keep(c.staged(rows.filter("n > 0").join(stay, "component").filter(other).select("doc_id", "text_hash"), "gone"))
        again = rows.filter("n > 0").groupBy("doc_id", "text_hash").count().filter("count > 1")
        again = keep(c.staged(again.select("doc_id", "text_hash"), "repeated"))
    id, hash = c.fresh(documents, "own_id"), c.fresh(documents, "own_hash")
    keyed = documents.withColumns({id: F.col("doc_id").cast("long"), hash: F.xxhash64("text")})

    def among(other: DataFrame) -> Column:
        return F.col(id).eqNullSafe(other["doc_id"]) & (F.col(hash) == other["text_hash"])

    # Rows that are surely not gone are not dealt for the join.
    maybe = c.fresh(keyed, "own_maybe")
    marked = c.possible(keyed, _row(id, hash), gone.select(_row()), maybe)
    kept = marked.filter(~F.col(maybe)).drop(maybe).unionByName(marked.filter(maybe).drop(maybe).join(gone, among(gone), "left_anti"))
    if not again.isEmpty():
        once = kept.join(again, among(again), "left_semi").dropDuplicates([id, hash])
        kept = kept.join(again, among(again), "left_anti").unionByName(once)
    return kept.select(*documents.columns)
