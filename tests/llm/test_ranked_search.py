"""Ranked search against a plain version and the query's SQL."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np

from grantlake.llm import queries, ranked_search
from tests.test_catalog import TABLES


def terms(text):
    lower = "".join(ch.lower() if ch.isascii() else ch for ch in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)


def brute(rows, items, k):
    docs = [(d, Counter(t)) for d, t in ((d, terms(text)) for d, text in rows) if t]
    n, words = len(docs), sum(sum(c.values()) for _, c in docs)
    df = Counter(t for _, c in docs for t in c)
    sought = defaultdict(set)
    for i, text in items:
        sought[i] |= set(terms(text))
    out = []
    for i, ts in sought.items():
        scores = []
        for d, c in docs:
            m = 100 - 90 + (90 * sum(c.values()) * n) // words
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in ts if t in c)
            scores.append((-score, d is None, d or 0, d))
        out += [(i, rank + 1, s[3], -s[0]) for rank, s in enumerate(sorted(scores)[:k]) if s[0]]
    return Counter(out)


def found(index, items, k=10):
    return Counter(tuple(r) for r in ranked_search.search(index, items, k).select("item_id", "rank", "doc_id", "score").collect())


def test_query_equals_sql_and_brute_force(spark, sf_dir):
    got = Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in queries.QUERIES["op12_ranked_search"](spark, sf_dir).collect())
    duck = duckdb.connect()
    for name in TABLES:
        duck.sql(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    sql = duck.sql(queries.SQL["op12_ranked_search"])
    assert sql.columns == ["item_id", "rank", "doc_id", "score"]
    assert got == Counter(sql.fetchall())
    texts = [duck.sql(f"select {key}, text from {name}").fetchall() for name, key in (("documents", "doc_id"), ("benchmark", "item_id"))]
    assert got == brute(*texts, 10)


def test_ties_nulls_and_long_texts(spark, monkeypatch):
    """Small segments, repeated rows and ids, equal scores over the edge of the list, a text of many megabytes, clashing columns."""
    monkeypatch.setattr(ranked_search, "FIRST_DEPTH", 1)
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(40)] + ["É", "日本", "x9"]
    weights = 1 / np.arange(1, len(vocabulary) + 1)
    rows = [(int(d), " ".join(rng.choice(vocabulary, rng.integers(1, 30), p=weights / weights.sum()))) for d in range(300)]
    rows += [(d, "tie Tie\x00w3") for d in range(400, 430)] + [(400, "tie tie w3"), (None, "tie tie w3"), (None, None), (7, ""), (8, "?!")]
    rows += [(9, "w1 w2 w3 é " * 500_000)]
    items = [(1, "W1 w2, w3 tie"), (2, "tie"), (2, "日本 x9 w39"), (3, None), (4, ""), (None, "É w0 w0"), (5, "nowhere"), (6, " ".join(vocabulary))]
    docs = spark.createDataFrame([(d, t, 0, "x") for d, t in rows], "doc_id long, text string, n int, segment string").repartition(5)
    sought = spark.createDataFrame([(i, t, 1.0) for i, t in items], "item_id long, text string, df double")
    for words in (50, 1 << 20):
        monkeypatch.setattr(ranked_search, "SEGMENT_WORDS", words)
        index = ranked_search.build(docs)
        for k in (1, 10, 31):
            assert found(index, sought, k) == brute(rows, items, k)
    monkeypatch.setattr(ranked_search, "PASS_TERMS", 8)
    assert found(index, sought) == brute(rows, items, 10)


def test_reads_no_deeper_than_needed():
    """A list with one strong entry decides; the rest of a long list of weak ones stays unread."""

    class Watched(np.ndarray):
        deepest = 0

        def __getitem__(self, key):
            if isinstance(key, slice):
                Watched.deepest = max(Watched.deepest, key.stop or 0)
            return np.asarray(super().__getitem__(key))

    n = 100_000
    adds = np.sort(np.random.default_rng(1).integers(1, 1000, n))[::-1].astype(np.int64)
    adds[:3] = 1_000_000, 900_000, 800_000
    docs, scores = ranked_search.best([(np.arange(n).view(Watched), adds)], n, 2)
    assert sorted(zip(docs[np.argsort(-scores)][:2], np.sort(scores)[::-1][:2], strict=True)) == [(0, 1_000_000), (1, 900_000)]
    assert Watched.deepest <= ranked_search.FIRST_DEPTH


def test_empty(spark):
    none, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert not found(ranked_search.build(none), items)
    assert not found(ranked_search.build(spark.createDataFrame([(1, "a")], "doc_id long, text string")), items.limit(0))
