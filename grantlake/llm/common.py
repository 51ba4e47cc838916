"""What the operators share: scratch tables, running sums, and words of Arrow text columns as numpy arrays.

Words are cut on UTF-8 bytes. All separators are ASCII and no byte of a multi-byte character is, so cutting
bytes and cutting characters give the same words.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from grantlake.session import remove_path, scratch_path

#: Bytes of text handled at once in a task; a longer text is handled alone.
SLICE_BYTES = 1 << 19
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_scopes: list[dict[int, tuple[DataFrame, str]]] = [{}]


def staged(df: DataFrame, name: str, *by: str) -> DataFrame:
    """The rows, written to the shared folder and read back: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*by) if by else writer).parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    if len(_scopes) > 1:
        _scopes[-1][id(out)] = (out, path)
    return out


def released(*frames: DataFrame) -> None:
    """Deletes the files of tables staged in this scope that nothing reads any more."""
    for df in frames:
        _, path = _scopes[-1].pop(id(df), (None, None))
        if path:
            remove_path(df.sparkSession, path)


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A scope whose staged tables go when it is left, but for those given to the function it yields, which the scope around takes on."""
    kept: set[int] = set()

    def keep(df: DataFrame) -> DataFrame:
        kept.add(id(df))
        return df

    _scopes.append({})
    try:
        yield keep
    finally:
        released(*[df for df, _ in list(_scopes[-1].values()) if id(df) not in kept])
        left = _scopes.pop()
        if len(_scopes) > 1:
            _scopes[-1].update(left)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hashed_sample(df: DataFrame, key: str, rows: int) -> DataFrame:
    """The ``rows`` rows with the smallest hashes of ``key`` (all, if fewer).

    Rows whose hash is beyond a share of the range go before the sort, so that what meets in one task is bounded by ``rows``.
    """
    total = df.count()
    spread = F.pmod(F.xxhash64(key), F.lit(1 << 32))
    if total > 2 * rows:
        df = df.filter(spread < int(1.5 * rows / total * (1 << 32)))
    return df.orderBy(spread, key).limit(rows)


#: Bits of a filter for each member, bits of one of its rows, and bits at most.
_SPARSE, _MAP_BITS, MOST_BITS = 16, 1 << 15, 1 << 28


def possible(df: DataFrame, hash: Column, members: DataFrame, name: str) -> DataFrame:
    """``df`` with a boolean ``name``: false only where ``hash`` is surely not among the hashes in the one column of ``members``.

    A bitmap of the members' hashes goes to all tasks, so that wide rows that a join would drop need not be dealt for it.
    Beyond ``MOST_BITS`` it is no larger and lets more pass; an exact join has to follow.
    """
    bits = min(MOST_BITS, max(_MAP_BITS, 1 << (_SPARSE * members.count()).bit_length()))
    number, bit, maps = (fresh(df, n) for n in ("map_number", "map_bit", "map_bits"))

    def place(value: Column) -> list[Column]:
        at = F.pmod(value, F.lit(bits).cast("long"))
        return [F.floor(at / _MAP_BITS).alias(number), (at % _MAP_BITS).alias(bit)]

    filled = members.select(*place(F.col(members.columns[0]))).repartition(number).groupBy(number).agg(F.bitmap_construct_agg(bit).alias(maps))
    placed = df.select("*", *place(hash)).join(F.broadcast(filled), number, "left")
    byte = F.conv(F.hex(F.substring(maps, (F.floor(F.col(bit) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = F.coalesce(byte.bitwiseAND(F.expr(f"shiftleft(1, cast({bit} % 8 as int))")) != 0, F.lit(False))
    return placed.withColumn(name, found).select(*df.columns, name)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = f"_{name}"
    return name


def with_running(df: DataFrame, group: Sequence[str], order: Sequence[str], sums: dict[str, Column], name: str) -> DataFrame:
    """``df`` with running sums (this row included) of ``sums`` in each group, in the order of ``order``.

    No group has to fit into a task: rows are dealt by range over group and order, each range is summed by
    itself, and the totals of earlier ranges are added. There is one total per group and range, so a group has
    as many totals as there are ranges at most. Rows with equal order values get their sums in any order.
    """
    spark = df.sparkSession
    keys = [F.col(c).asc_nulls_first() for c in (*group, *order)]
    values = df.select("*", *[v.cast("long").alias(f"_v_{k}") for k, v in sums.items()])
    dealt = values.repartitionByRange(shuffle_partitions(spark), *keys).withColumn("_range", F.spark_partition_id())
    dealt = staged(dealt, name)
    own = Window.partitionBy("_range", *group).orderBy(*[F.col(c).asc_nulls_first() for c in order])
    totals = dealt.groupBy("_range", *group).agg(*[F.sum(f"_v_{k}").alias(f"_t_{k}") for k in sums])
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select(
        F.col("_range").alias("_r"),
        *[F.col(c).alias(f"_g_{c}") for c in group],
        *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in sums],
    )
    running = dealt.select("*", *[F.sum(f"_v_{k}").over(own.rowsBetween(Window.unboundedPreceding, 0)).alias(f"_s_{k}") for k in sums])
    match = F.col("_range") == F.col("_r")
    for c in group:
        match = match & F.col(c).eqNullSafe(F.col(f"_g_{c}"))
    return running.join(totals, match).select(
        *df.columns, *[(F.col(f"_s_{k}") + F.col(f"_b_{k}")).alias(k) for k in sums]
    )


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column and where each row begins and the last ends; a null is empty."""
    column = pc.fill_null(column, "").cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of ``batches`` in order, in pieces of ``most`` bytes of text; a longer text comes alone."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        begin = total = 0
        for i, size in enumerate(sizes):
            if i > begin and total + size > most:
                yield batch.slice(begin, i - begin)
                begin, total = i, 0
            total += int(size)
        if begin < batch.num_rows:
            yield batch.slice(begin)


def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """For each byte 0 if it separates words, else the byte, with A-Z in lower case if ``lower``.

    A NUL that is part of words is told apart from separators as 255, which UTF-8 never uses.
    """
    out = np.frombuffer(bytes(range(256)).lower() if lower else bytes(range(256)), np.uint8).copy()
    out[0] = 255
    out[np.frombuffer(separators, np.uint8)] = 0
    return out


def word_spans(data: np.ndarray, offsets: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The bytes as ``classes`` has them, begin and end of each word, and how many words come before each row."""
    marks = classes[data]
    begins, ends = stretches(marks != 0, offsets)
    return marks, begins, ends, np.searchsorted(begins, offsets)


def stretches(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of each longest stretch of bytes that are ``inside`` one row."""
    first = np.zeros(len(inside) + 1, bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    return np.flatnonzero(begins), np.flatnonzero(ends) + 1


def gathered(marks: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The spans of bytes as a text column."""
    cut = np.zeros(len(begins) + 1, np.int64)
    np.cumsum(ends - begins, out=cut[1:])
    data = marks[np.repeat(begins - cut[:-1], ends - begins) + np.arange(cut[-1])]
    return pa.Array.from_buffers(pa.large_string(), len(begins), [None, pa.py_buffer(cut), pa.py_buffer(data.astype(np.uint8))])


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * _STEP)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) < n:
        for k, base in enumerate((_STEP, _BACK)):
            _POWERS[k] = np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, base)]), dtype=np.uint64)
    return _POWERS[0], _POWERS[1]


def span_hashes(marks: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes, by differences of one running sum."""
    up, down = _powers(len(marks) + 1)
    sums = np.zeros(len(marks) + 1, np.uint64)
    np.cumsum(_BYTES[marks] * up[: len(marks)], out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * down[begins] + (ends - begins).astype(np.uint64))


def run_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A 64-bit hash of each run of ``n`` words."""
    count = max(0, len(words) - n + 1)
    out = np.zeros(count, np.uint64)
    for k in range(n):
        out = out * _STEP + words[k : k + count]
    return mixed(out)


def reduced(sums: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of the stretches between ``offsets`` of a value array."""
    running = np.zeros(len(sums) + 1, sums.dtype if sums.dtype.kind == "f" else np.int64)
    np.cumsum(sums, out=running[1:])
    return running[offsets[1:]] - running[offsets[:-1]]
