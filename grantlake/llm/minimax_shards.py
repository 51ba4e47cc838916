"""Sharding by minimax contiguous partition, with DataFrame functions only.

Rows with equal texts are an atomic group; groups stand in the order of the SHA-256 of their text. The smallest capacity for
which greedy cutting needs no more than the wanted shards is found by a search that halves the range many times in each
round: all capacities of a round are cut greedily together, one shard per job, by looking up the last group end within reach.
The corpus is then cut there. No shard could be smaller at its largest without splitting a group or changing the order.
Where that capacity is the size of one group, the group is a shard of its own, and the stretches around it are cut again in
the same way, together, with the shards that are left; shards still left then halve the largest ones that hold several groups.

A null text has size 1 and forms a group with other null texts. Rows that repeat are separate rows with slots of their own.
A shard stays empty only if there are fewer groups. Other columns of the input are ignored.
"""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

#: Capacities tried in one round.
TRIED = 24


def measured(documents: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and the group of each row."""
    text = F.coalesce("text", F.lit(""))
    return documents.select(
        F.col("doc_id").cast("long"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        F.unhex(F.coalesce(F.sha2(F.encode("text", "UTF-8"), 256), F.lit(""))).alias("group"),
    )


def _inside(stretches: list[tuple[int, int]]) -> Column:
    return functools.reduce(operator.or_, [(F.col("end") > a) & (F.col("end") <= b) for a, b in stretches])


def _least(ends: DataFrame, stretches: list[tuple[int, int]], low: int, high: int, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity in a range, whose upper end suffices, for cutting ``stretches`` in order, and where shards end."""
    final, following = stretches[-1][1], dict(zip([b for _, b in stretches], [a for a, _ in stretches[1:]], strict=False))
    while True:
        span = high - low
        tried = sorted({low + span * k // TRIED for k in range(TRIED + 1)})
        at, trail = [stretches[0][0]] * len(tried), [[] for _ in tried]
        for _ in range(shards):
            # A capacity is at least the largest group, so there always is an end within reach.
            limits = [next((b for _, b in stretches if b > a), final) for a in at]
            reach = [min(limit, a + capacity) for limit, a, capacity in zip(limits, at, tried, strict=True)]
            within = ends.filter((F.col("end") > min(at)) & (F.col("end") <= max(reach)))
            row = within.agg(*[F.max(F.when(F.col("end") <= r, F.col("end"))).alias(f"c{k}") for k, r in enumerate(reach)]).head()
            stops = [max(a, row[k] or 0) for k, a in enumerate(at)]
            for steps, a, stop in zip(trail, at, stops, strict=True):
                steps += [stop] if stop > a else []
            at = [following.get(stop, stop) for stop in stops]
            if min(at) == final:
                break
        best = next(k for k, a in enumerate(at) if a == final)
        if best == 0 or tried[best] - tried[best - 1] <= 1:
            return tried[best], trail[best]
        low, high = tried[best - 1] + 1, tried[best]


def cuts(ends: DataFrame, total: int, largest: int, shards: int) -> list[int]:
    """Where each shard that holds rows ends; ``ends`` holds the running size after each group, and its size."""
    stretches, left, stops = [(0, total)], shards, set()
    high = -(-total // shards) + largest
    while stretches:
        size, end = ends.filter(_inside(stretches)).agg(F.max(F.struct("size", "end")).alias("m")).head()["m"]
        low = max(size, -(-sum(b - a for a, b in stretches) // left))
        high, found = _least(ends, stretches, low, high, left)
        if high > size:
            stops.update(found)
            break
        # No shard with this group has room for another one.
        stops.update({end - size, end})
        left -= 1
        parts = [p for a, b in stretches for p in ([(a, end - size), (end, b)] if a < end <= b else [(a, b)])]
        stretches = [(a, b) for a, b in parts if a < b]
        stops.update(b for _, b in stretches)
    stops = sorted(stops - {0})
    whole = set()
    while len(stops) < shards:
        parts = [(a, b) for a, b in zip([0, *stops], stops, strict=False) if b not in whole]
        if not parts:
            break
        a, b = max(parts, key=lambda p: p[1] - p[0])
        groups, size = ends.filter(_inside([(a, b)])).agg(F.count("*"), F.max("size")).head()
        if groups == 1:
            whole.add(b)
            continue
        _, found = _least(ends, [(a, b)], max(size, -(-(b - a) // 2)), -(-(b - a) // 2) + size, 2)
        stops = sorted({*stops, *found})
    return stops


def sharded(documents: DataFrame, shards: int = 8) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless in each shard, in the order of group and doc_id)."""
    rows = measured(documents)
    rows = c.with_running(rows, [], ["group", "doc_id"], {"end": F.col("size"), "number": F.lit(1)}, "ordered")
    rows = c.staged(rows, "running")
    ends = c.staged(rows.groupBy("group").agg(F.max("end").alias("end"), F.sum("size").alias("size")).select("end", "size"), "ends")
    totals = ends.agg(F.max("end"), F.max("size")).head()
    if totals[0] is None:
        return rows.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.col("number").alias("slot"))
    stops = cuts(ends, totals[0], totals[1], shards)
    counts = rows.agg(*[F.count_if(F.col("end") <= stop).alias(f"c{k}") for k, stop in enumerate(stops)]).head()
    before = [0, *counts][: len(stops)]
    shard = sum((F.col("end") > stop).cast("int") for stop in stops[:-1]) if len(stops) > 1 else F.lit(0)
    return rows.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", "shard",
        (F.col("number") - 1 - F.element_at(F.array(*[F.lit(b).cast("long") for b in before]), F.col("shard") + 1)).alias("slot"),
    )
