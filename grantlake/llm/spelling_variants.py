"""Groups of spelling variants by dense prefix-suffix tiling.

Two words are near if one inserted, deleted or replaced code point leads from one to the other, that is, if their
common prefix and suffix together reach the length of the longer less one. ``near_words`` compares words by tiles:
blocks of words as matrices of code points, one aligned left and one aligned right, both padded with zero, block
against block at once.

So that only blocks that can hold near words meet, each word is dealt under what surrounds a region of it. For words of
L and L + 1 code points the L positions are cut into regions; words under one key agree before and after a region,
and every near pair meets under the one region that holds its first difference, so it is found once. Keys are
hashes; the tiles compare the words themselves. A key that more than MOST words share goes into another round with
its region cut finer. Regions end at one position, where the alphabet allows no more than 64 + 26 words of length L
and their square of length L + 1 under a key.

Words are made of A-Z, a-z and U+00C0 to U+00FF. Null and empty texts have no words; a null doc_id counts as empty text
in the hash that damages runs. Repeated rows count again. An empty table gives no words. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

LEAST_LENGTH = 7
LEAST_COUNT = 2
#: A near word is the form of a word if it occurs this many times as often.
OUTWEIGHS = 10
#: Words under one key that are compared at once; more are dealt anew under finer regions.
MOST = 2048
#: Bytes of text in which words are counted at once before they leave a task.
_SLICE = 1 << 22
_REGIONS = 8
_BLOCK = 16
_CELLS = 1 << 20
_LETTERS = np.zeros(256, bool)
_LETTERS[np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz", np.uint8)] = True
_LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
#: All code points from U+00C0 to U+00FF, and no others, begin with this byte.
_LATIN = 0xC3
_ROUND_BYTES = 64


def _crc_table() -> np.ndarray:
    out = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        out = np.where(out & 1, (out >> 1) ^ np.uint32(0xEDB88320), out >> 1)
    return out


_CRC = _crc_table()


def _crc32(data: np.ndarray, begins: np.ndarray, ends: np.ndarray, so_far: np.ndarray) -> np.ndarray:
    """crc32 of each span, carried on from ``so_far``; byte by byte over all spans, long ones by themselves."""
    sizes = ends - begins
    order = np.argsort(-sizes, kind="stable")
    long = int((sizes > _ROUND_BYTES).sum())
    state, at = so_far[order] ^ np.uint32(0xFFFFFFFF), begins[order]
    left = np.searchsorted(-sizes[order], -np.arange(_ROUND_BYTES), side="left")
    for j in range(_ROUND_BYTES):
        if left[j] <= long:
            break
        now = slice(long, left[j])
        state[now] = _CRC[(state[now] ^ data[at[now] + j]) & np.uint32(0xFF)] ^ (state[now] >> np.uint32(8))
    out = np.empty(len(sizes), np.uint32)
    out[order] = state ^ np.uint32(0xFFFFFFFF)
    for i in order[:long]:
        out[i] = zlib.crc32(data[begins[i] : ends[i]].tobytes(), int(so_far[i]))
    return out


def _runs(batch: pa.RecordBatch, damage: int | None) -> pa.Array:
    """All words of the rows with repeats, lower-cased and damaged."""
    raw, offsets = c.utf8(batch.column("text"))
    latin = raw == _LATIN
    inside = _LETTERS[raw] | latin
    inside[1:] |= latin[:-1]
    begins, ends = c.stretches(inside, offsets)
    data = _LOWER[raw]
    # Code points before each byte: all bytes but the second ones of two.
    points = np.zeros(len(data) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=points[1:])
    lengths = points[ends] - points[begins]
    begins, ends, lengths = (x[lengths >= LEAST_LENGTH] for x in (begins, ends, lengths))
    if damage is None:
        return c.gathered(data, begins, ends)
    heads = [b":" if d is None else f"{d}:".encode() for d in batch.column("doc_id").to_pylist()]
    heads = np.array([zlib.crc32(h) for h in heads], np.uint32)
    hashes = _crc32(data, begins, ends, heads[np.searchsorted(offsets, begins, side="right") - 1])
    hit = hashes % np.uint32(damage) == 0
    cut = []
    for b, e, n, h in zip(begins[hit], ends[hit], lengths[hit], hashes[hit], strict=True):
        if n > LEAST_LENGTH:
            word = data[b:e].tobytes().decode()
            k = int(h) % int(n)
            cut.append(word[:k] + word[k + 1 :])
    return pa.chunked_array([c.gathered(data, begins[~hit], ends[~hit]), pa.array(cut, pa.large_string())])


def words_of(documents: DataFrame, damage: int | None = None) -> DataFrame:
    """word and n (occurrences) of all words of at least LEAST_LENGTH code points and LEAST_COUNT occurrences.

    ``damage``: a run whose crc32 of ``<doc_id>:<run>`` it divides loses the code point numbered by the hash, so that texts
    without misspellings have some.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches, most=_SLICE):
            found = pc.value_counts(_runs(batch, damage))
            found = found.combine_chunks() if isinstance(found, pa.ChunkedArray) else found
            yield pa.RecordBatch.from_arrays([found.field(0).cast(pa.string()), found.field(1)], ["word", "n"])

    counts = documents.select("doc_id", "text").mapInArrow(count, "word string, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= LEAST_COUNT)


_DEALT = pa.schema([
    ("key", pa.int64()), ("size", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("word", pa.string()), ("n", pa.int64()),
])
_DEALT_DDL = "key long, size int, start int, stop int, word string, n long"


def _points(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The code points of all words, none above U+00FF, and where each word's begin."""
    data, offsets = c.utf8(words)
    lead = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=lead[1:])
    return np.frombuffer(data.tobytes().decode().encode("latin-1"), np.uint8), lead[offsets]


def _keyed(batch: pa.RecordBatch, which: np.ndarray, size: np.ndarray, start: np.ndarray, stop: np.ndarray) -> pa.RecordBatch:
    """Rows ``which`` of the batch under the keys of regions ``start`` to ``stop`` of ``size`` positions."""
    points, offsets = _points(batch.column("word"))
    begin, end = offsets[which], offsets[which + 1]
    keys = c.span_hashes(points, begin, begin + start) * np.uint64(3) + c.span_hashes(points, end - (size - stop), end)
    keys = c.mixed(keys + (size << 20).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + start.astype(np.uint64))
    rows = pa.array(which)
    return pa.RecordBatch.from_arrays(
        [pa.array(keys.view(np.int64)), *(pa.array(x.astype(np.int32)) for x in (size, start, stop)),
         batch.column("word").take(rows), batch.column("n").take(rows)], schema=_DEALT,
    )


def _cut(size: np.ndarray, start: np.ndarray, stop: np.ndarray, least: int) -> tuple[np.ndarray, ...]:
    """Each region cut into _REGIONS at most, of ``least`` positions at least: numbers of the rows, starts, stops."""
    width = np.maximum(least, -(-(stop - start) // _REGIONS))
    parts = -(-(stop - start) // width)
    which = np.repeat(np.arange(len(size)), parts)
    k = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = start[which] + k * width[which]
    return which, begin, np.minimum(begin + width[which], stop[which])


def _dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every word under the keys of its own length, and of the length one less as the longer of a pair."""
    for batch in batches:
        lengths = np.diff(_points(batch.column("word"))[1])
        for own in (0, 1):
            word = np.flatnonzero(lengths - own >= LEAST_LENGTH)
            size = lengths[word] - own
            which, start, stop = _cut(size, np.zeros(len(size), np.int64), size, 2)
            yield _keyed(batch, word[which], size[which], start, stop)


def _finer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        size, start, stop = (batch.column(x).to_numpy().astype(np.int64) for x in ("size", "start", "stop"))
        which, start, stop = _cut(size, start, stop, 1)
        yield _keyed(batch, which, size[which], start, stop)


_FOUND = pa.schema([
    ("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string()),
    ("size", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()),
])
_FOUND_DDL = "word string, n long, n_near long, best_n long, best string, size int, start int, stop int"


def _open(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Rows for another round: they name a region and no near word."""
    columns = [table[f.name] if f.name in table.column_names else pa.nulls(len(table), f.type) for f in _FOUND]
    yield from pa.Table.from_arrays(columns, schema=_FOUND).to_batches()


def _tiles(same: np.ndarray, points: np.ndarray, offsets: np.ndarray, size: int, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of near rows among the words of ``size`` and ``size`` + 1 code points, sorted by their group ``same``."""
    n, width = len(same), size + 1
    lengths = np.diff(offsets)
    left = np.zeros((-(-n // _BLOCK) * _BLOCK, width), np.uint8)
    column = np.arange(width)
    rows, cols = np.nonzero(column < lengths[:, None])
    left[rows, cols] = points[offsets[0] : offsets[-1]]
    right = np.zeros_like(left)
    right[rows, cols + (width - lengths)[rows]] = points[offsets[0] : offsets[-1]]
    # The rows that fill up the last block belong to no group.
    fill = len(left) - n
    group = np.concatenate([same, np.full(fill, -1)]).reshape(-1, _BLOCK)
    longer = np.concatenate([lengths > size, np.ones(fill, bool)]).reshape(-1, _BLOCK)
    left, right = left.reshape(-1, _BLOCK, width), right.reshape(-1, _BLOCK, width)
    blocks = np.arange(len(group))
    firsts, seconds = [], []
    step = max(1, _CELLS // (_BLOCK * _BLOCK))
    apart = 0
    tails = np.append(same, -1)[np.minimum(blocks * _BLOCK + _BLOCK - 1, n - 1)]
    while True:
        here = blocks[: len(blocks) - apart]
        if apart:
            here = here[tails[here] == group[here + apart, 0]]
        if not len(here):
            break
        for at in range(0, len(here), step):
            a = here[at : at + step]
            b = a + apart
            fits = (group[a][:, :, None] == group[b][:, None, :]) & ~(longer[a][:, :, None] & longer[b][:, None, :])
            if not apart:
                fits &= np.triu(np.ones((_BLOCK, _BLOCK), bool), 1)
            prefix, suffix = np.zeros(fits.shape, np.int32), np.zeros(fits.shape, np.int32)
            alive, back = fits.copy(), fits.copy()
            for k in range(size):
                alive &= left[a][:, :, None, k] == left[b][:, None, :, k]
                prefix += alive
                back &= right[a][:, :, None, size - k] == right[b][:, None, :, size - k]
                suffix += back
            long = (longer[a][:, :, None] | longer[b][:, None, :]) + np.int32(size)
            t, i, j = np.nonzero(fits & (prefix + suffix >= long - 1))
            first = a[t] * _BLOCK + i
            place = np.minimum(prefix[t, i, j], size - 1)
            # The region of the first difference counts the pair, no other.
            own = (start[first] <= place) & (place < stop[first])
            firsts.append(first[own])
            seconds.append((b[t] * _BLOCK + j)[own])
        apart += 1
    return np.concatenate(firsts) if firsts else np.zeros(0, np.int64), np.concatenate(seconds) if seconds else np.zeros(0, np.int64)


def _compared(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Near words of whole groups, sorted by size and key."""
    if not len(table):
        return
    table = table.combine_chunks()
    key, size = table["key"].to_numpy(), table["size"].to_numpy()
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (size[1:] != size[:-1])])
    group = np.cumsum(new) - 1
    many = np.bincount(group)
    wide = table["stop"].to_numpy() - table["start"].to_numpy() > 1
    later = (many[group] > MOST) & wide
    if later.any():
        yield from _open(table.filter(pa.array(later)))
    now = np.flatnonzero((many[group] > 1) & ~later)
    if not len(now):
        return
    table, group, size = table.take(pa.array(now)).combine_chunks(), group[now], size[now]
    words = table["word"].combine_chunks() if isinstance(table["word"], pa.ChunkedArray) else table["word"]
    points, offsets = _points(words)
    start, stop, n = (table[x].to_numpy() for x in ("start", "stop", "n"))
    cuts = np.concatenate([[0], np.flatnonzero(size[1:] != size[:-1]) + 1, [len(size)]])
    pairs = []
    for b, e in zip(cuts[:-1], cuts[1:], strict=True):
        i, j = _tiles(group[b:e], points, offsets[b : e + 1], int(size[b]), start[b:e], stop[b:e])
        pairs += [(i + b, j + b), (j + b, i + b)]
    rows, others = (np.concatenate([p[k] for p in pairs]) for k in (0, 1))
    if not len(rows):
        return
    rank = pc.rank(words, tiebreaker="dense").to_numpy()
    order = np.lexsort((rank[others], -n[others], rows))
    rows, others = rows[order], others[order]
    head = np.flatnonzero(np.concatenate([[True], rows[1:] != rows[:-1]]))
    own, best = pa.array(rows[head]), pa.array(others[head])
    found = {
        "word": words.take(own), "n": table["n"].take(own), "n_near": pa.array(np.diff(np.append(head, len(rows)))),
        "best_n": table["n"].take(best), "best": words.take(best),
    }
    columns = [found.get(f.name, pa.nulls(len(head), f.type)) for f in _FOUND]
    yield from pa.Table.from_arrays(columns, schema=_FOUND).to_batches()


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hands on groups that are whole; of one that is far too large, no more than a batch is held."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        key = batch.column("key").to_numpy()
        if key[0] == key[-1] and sum(b.num_rows for b in held) <= MOST:
            continue
        table = pa.Table.from_batches(held)
        keys = table["key"].to_numpy()
        size, wide = table["size"].to_numpy(), table["stop"][-1].as_py() - table["start"][-1].as_py() > 1
        same = (keys != keys[-1]) | (size != size[-1])
        begin = int(np.flatnonzero(same)[-1]) + 1 if same.any() else 0
        yield from _compared(table.slice(0, begin))
        rest = table.slice(begin)
        if wide and len(rest) > MOST:
            # What stays is too much for one comparison as well, so the whole group goes into another round.
            yield from _open(rest.slice(0, len(rest) - MOST - 1))
            rest = rest.slice(len(rest) - MOST - 1)
        held = rest.to_batches()
    if held:
        yield from _compared(pa.Table.from_batches(held))


def near_words(words: DataFrame) -> DataFrame:
    """Of words with a near word: word, n, n_near, best_n and best, the near word of largest n (ties: smallest).

    ``words``: word and n, each word once. A word may have several rows here; their n_near add up.
    """
    spark = words.sparkSession
    dealt, found = words.mapInArrow(_dealt, _DEALT_DDL), None
    while True:
        spread = dealt.repartition(c.shuffle_partitions(spark), "key").sortWithinPartitions("size", "key")
        rows = c.staged(spread.mapInArrow(_grouped, _FOUND_DDL), "near")
        part = rows.filter("best is not null").select("word", "n", "n_near", "best_n", "best")
        found = part if found is None else found.unionByName(part)
        wide = rows.filter("best is null")
        if wide.isEmpty():
            return found
        dealt = wide.select("word", "n", "size", "start", "stop").mapInArrow(_finer, _DEALT_DDL)


def variants(words: DataFrame) -> DataFrame:
    """word, n, n_near, form, form_n and root of each word; ``words`` has word and n, each word once.

    The form is the near word of largest n (ties: the smallest in code-point order) if that is OUTWEIGHS times the
    word's, else null. The root is where the forms of forms end; their n grow tenfold each step, so few rounds of joins find it.
    """
    words = c.staged(words.select("word", "n"), "words")
    near = near_words(words)
    each = words.select("word", "n", F.lit(0).cast("long").alias("n_near"), F.lit(None).cast("long").alias("best_n"), F.lit(None).cast("string").alias("best"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    each = each.unionByName(near).groupBy("word").agg(F.max("n").alias("n"), F.sum("n_near").alias("n_near"), best.alias("b"))
    outweighs = -F.col("b.less") >= OUTWEIGHS * F.col("n")
    each = c.staged(each.select(
        "word", "n", "n_near", F.when(outweighs, F.col("b.best")).alias("form"), F.when(outweighs, -F.col("b.less")).alias("form_n")
    ), "forms")
    roots = each.filter("form is not null").select("word", F.col("form").alias("root"), F.lit(True).alias("moved"))
    while True:
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = roots.join(further, "root", "left")
        moved = c.staged(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        roots = moved
        if moved.filter("moved").isEmpty():
            break
    return each.join(roots.select("word", "root"), "word", "left").withColumn("root", F.coalesce("root", "word"))
