"""Spelling variants against a plain version."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import Row

from grantlake.llm import queries, spelling_variants


def counted(rows, damage=None):
    found = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(ch.lower() if ch.isascii() else ch for ch in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if damage and h % damage == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def is_near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def brute(words):
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in words:
        for size in (len(w), len(w) + 1):
            for v in by_length.get(size, []):
                if is_near(w, v):
                    near[w].append(v)
                    if size != len(w):
                        near[v].append(w)
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * words[w] else None

    def root(w):
        return w if form[w] is None else root(form[w])

    return {(w, form[w], root(w), words[w], len(near[w]), words.get(form[w])) for w in words}


def rows_of(found):
    return {(r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in found.collect()}


def test_query_equals_brute_force(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    words = counted([(r.doc_id, r.text) for r in documents.collect()], 31)
    found = queries.QUERIES["op13_spelling_variants"](spark, sf_dir)
    assert found.count() == len(words) > 1000
    assert rows_of(found) == brute(words)


def test_words_of_odd_texts(spark):
    long = "ä" * 300 + "x" * 5000
    rows = [
        (1, "Straßen STRASSEN strassen straßen ×÷Àÿabc Āabcdefg"), (1, None), (2, ""), (3, "0123 4567 !?"),
        (None, f"{long} {long.upper()} {long}"), (4, "abcdefgh " * 500), (4, "abcdefgh\x00abcdefgi " * 40), (4, "abcdef " * 9),
        (5, "中abcdefg中 abcdefg ÀBCDEFGH Àbcdefgh àbcdefgh"),
    ]
    df = spark.createDataFrame([Row(doc_id=d, text=t, Word="x", n=0) for d, t in rows], "doc_id long, text string, Word string, n int")
    for damage in (None, 1, 2, 31):
        found = {(r.word, r.n) for r in spelling_variants.words_of(df, damage).collect()}
        assert found == set(counted(rows, damage).items()), damage


def test_variants_of_crowded_keys(spark, monkeypatch):
    """Words that agree but for a region, so that keys are cut finer over two rounds; chains of forms; equal counts."""
    monkeypatch.setattr(spelling_variants, "MOST", 8)
    rng = np.random.default_rng(5)
    letters = list("abcdxyzéß")
    words = {}
    for size in (7, 8, 9, 20, 40, 41):
        base = list(rng.choice(letters, size))
        for _ in range(120):
            w = base.copy()
            for _ in range(rng.integers(1, 4)):
                k, what = rng.integers(len(w)), rng.integers(3)
                w[k : k + 1] = [[rng.choice(letters)], [w[k], rng.choice(letters)], []][what]
            if len(w) >= 7:
                words["".join(w)] = int(10 ** rng.integers(1, 6))
    df = spark.createDataFrame(list(words.items()), "word string, n long").repartition(3)
    assert rows_of(spelling_variants.variants(df)) == brute(words)


def test_empty(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling_variants.variants(spelling_variants.words_of(none)).count() == 0
