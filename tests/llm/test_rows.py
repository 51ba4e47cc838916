"""Rows are judged by themselves; the registered queries and the pipeline's stages against plain versions."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grantlake.llm import common, learned_partitions, near_duplicates, positional_index, queries

LOWER = {c: c + 32 for c in range(65, 91)}


def words5(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def shingles(text):
    w = words5(text)
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def grouped(rows):
    """Per row of (doc_id, text) the number of shingles, the component's smallest doc_id, and the component."""
    sets = [shingles(t) for _, t in rows]
    classes = {}
    for s in sets:
        if s:
            classes.setdefault(frozenset(s), len(classes))
    keys = list(classes)
    holders = defaultdict(list)
    for i, s in enumerate(keys):
        for x in s:
            holders[x].append(i)
    parent = list(range(len(keys)))

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for i, s in enumerate(keys):
        common = Counter(j for x in s for j in holders[x] if j > i)
        for j, n in common.items():
            if 100 * n >= 75 * (len(s) + len(keys[j]) - n):
                parent[find(i)] = find(j)
    of = [find(classes[frozenset(s)]) if s else None for s in sets]
    least = {}
    for (d, _), k in zip(rows, of, strict=True):
        if k is not None and d is not None:
            least[k] = min(d, least.get(k, d))
    return [(len(s), least.get(k) if s else d, k) for (d, _), s, k in zip(rows, sets, of, strict=True)]


def expected(rows):
    return Counter((d, n, c, c is None or d == c) for (d, _), (n, c, _) in zip(rows, grouped(rows), strict=True))


def found(frame):
    return Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_duplicates.near_duplicates(frame).collect())


def frame_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def read(spark, sf_dir, name, key="doc_id"):
    return [(r[key], r.text) for r in spark.read.parquet(f"{sf_dir}/{name}.parquet").collect()]


def test_near_duplicates_query_equals_brute_force(spark, sf_dir):
    rows = read(spark, sf_dir, "documents")
    got = Counter((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in queries.QUERIES["op10_near_duplicates"](spark, sf_dir).collect())
    assert got == expected(rows)


def test_nul_belongs_to_words(spark):
    rows = [(1, "a\x00b c d e f g"), (2, "a b c d e f g"), (3, "a\x00b c d e f g\x00")]
    assert found(frame_of(spark, rows)) == expected(rows)
    assert expected(rows)[(1, 2, 1, True)] == 1


def test_links_run_through_rows_without_id(spark):
    w = [f"w{k}" for k in range(60)]
    chain = [" ".join(w[k : k + 44]) for k in (0, 5, 10)]
    assert [100 * len(shingles(chain[0]) & shingles(chain[j])) >= 75 * len(shingles(chain[0]) | shingles(chain[j])) for j in (1, 2)] == [True, False]
    rows = [(1, chain[0]), (None, chain[1]), (2, chain[2]), (None, "some other text of six words"), (None, None), (42, "the answer to all of it")]
    assert found(frame_of(spark, rows)) == expected(rows)
    assert {c for _, _, c, _ in expected(rows)} == {1, 42, None}


def crowd(rng, size, common, own):
    """Texts that share a passage but have words of their own, so that they meet in buckets and are not linked."""
    passage = " ".join(f"p{k}" for k in range(common))
    return [passage + " " + " ".join(f"q{rng.integers(1 << 40)}" for _ in range(own)) for _ in range(size)]


def test_groups_of_many_classes(spark):
    """A passage in more classes than are paired at once, close copies among them, and a large main component."""
    rng = np.random.default_rng(7)
    texts = crowd(rng, 150, 120, 30)
    near = [t.replace(" p60 ", f" r{k} ") for k, t in enumerate(texts[:40])]
    base = " ".join(f"m{k}" for k in range(200))
    main = [base.replace(f" m{2 * k + 20} ", " x ") for k in range(70)]
    rows = [(int(d), t) for d, t in zip(rng.permutation(1000), [*texts, *near, *main, *texts[:30]])]
    assert found(frame_of(spark, rows)) == expected(rows)


def test_only_rows_of_a_group_go(spark):
    """A null row beside document 42, unlike texts under one id, repeats, and rows without an id."""
    text, other = "one two three four five six seven", "eight nine ten eleven twelve thirteen"
    rows = [
        (42, text, 1), (None, None, 2), (None, None, 3), (43, text + " ", 4), (7, other, 5), (7, "a b c d e f g h", 6), (7, other, 7), (8, "", 8), (8, "", 9),
        (None, other, 10), (None, "lone text of some six words", 11), (None, "lone text of some six words", 12), (9, None, 13),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, own_id int")
    kept = near_duplicates.deduplicated(df)
    assert kept.columns == df.columns
    got = sorted(r.own_id for r in kept.collect())
    assert [k for k in got if k not in (5, 7, 11, 12)] == [1, 2, 3, 6, 8, 9, 13]
    assert len(got) == 9 and len({5, 7} & set(got)) == 1 and len({11, 12} & set(got)) == 1


def test_clean_rows_under_a_contaminated_id_stay(spark):
    item = " ".join(f"b{k}" for k in range(20))
    rows = [(1, item, 1), (1, "clean words only", 2), (None, item, 3), (None, None, 4), (42, "x", 5), (2, "", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, own_hash int")
    kept = positional_index.decontaminated(df, spark.createDataFrame([(5, item)], "item_id long, text string"))
    assert kept.columns == df.columns
    assert sorted(r.own_hash for r in kept.collect()) == [2, 4, 5, 6]


def words13(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def contamination(rows, items):
    windows = defaultdict(set)
    for i, text in items:
        w = words13(text)
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(i)
    sizes = {len(x) for x in windows}
    for d, text in rows:
        w = words13(text)
        hit, names = set(), set()
        for size in sizes:
            for k in range(len(w) - size + 1):
                if found := windows.get(tuple(w[k : k + size])):
                    hit |= set(range(k, k + size))
                    names |= found
        listed = ",".join(sorted(map(str, names)))
        yield d, len(w), len(hit), len(names), hashlib.sha256(listed.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w)


def test_decontamination_query_equals_brute_force(spark, sf_dir):
    got = Counter(tuple(r) for r in queries.QUERIES["op1_decontamination"](spark, sf_dir).collect())
    assert got == Counter(contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark", "item_id")))


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage of the pipeline returns, on the smallest tables."""
    sf_dir, out = "/root/testdata/sf0.001", {}
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        made = stage(spark, rows, sf_dir).collect()
        out[name] = (rows, made)
        if name != "sentencepiece":
            rows = spark.createDataFrame(made, rows.schema)
    return out


def test_stage_toxicity(spark, stages):
    given, made = stages["toxicity"]
    scores = queries.QUERIES["op3_toxicity"](spark, "/root/testdata/sf0.001").collect()
    clean = {r.doc_id for r in scores if r.predicted == 0}
    assert Counter(made) == Counter(r for r in given.collect() if r.doc_id in clean)


def test_stage_near_duplicates(stages):
    given, made = stages["near_duplicates"]
    rows = given.collect()
    groups = grouped([(r.doc_id, r.text) for r in rows])
    assert Counter(made) == Counter(r for r, (n, c, _) in zip(rows, groups, strict=True) if not n or r.doc_id == c)


def test_stage_decontamination(spark, sf_dir, stages):
    given, made = stages["decontamination"]
    rows = given.collect()
    judged = contamination([(r.doc_id, r.text) for r in rows], read(spark, sf_dir, "benchmark", "item_id"))
    assert Counter(made) == Counter(r for r, j in zip(rows, judged, strict=True) if not j[-1])


def test_stages_pii_and_sentencepiece(spark, stages):
    given, made = stages["pii"]
    texts = {r.doc_id: r for r in given.collect()}
    assert len(made) == len(texts)
    email = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    assert sum(len(email.findall(r.text or "")) for r in texts.values()) > 0
    for r in made:
        assert not email.search(r.text or "") and r.n_chars == (None if r.text is None else len(r.text))
        assert (r.lang, r.source) == (texts[r.doc_id].lang, texts[r.doc_id].source)
    import sentencepiece

    lib = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    rows, tokens = stages["sentencepiece"]
    want = Counter()
    for r in rows.collect():
        ids = lib.encode(r.text or "")
        want[r.doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(lib.decode(ids).encode()).hexdigest()] += 1
    assert Counter(tuple(r) for r in tokens) == want


def test_run_equals_its_stages(spark, sf_dir, stages):
    assert Counter(map(tuple, corpus_pipeline.run(spark, sf_dir).collect())) == Counter(map(tuple, stages["sentencepiece"][1]))


def test_vectors_of_one_id_and_products_that_overflow(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.0, 2.0]), (1, [9.0, 0.0]), (1, [2.0, 0.0]), (1, [9.0, 0.0]), (2, [0.0, 5.0]), (3, [1e308, 1e308]), (20, [1e308, 1e308]), (4, [-1.0, -1.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter((r.query_id, r["rank"], r.vec_id, r.score) for r in learned_partitions.neighbours(df, asked=32).collect())
    want = Counter()
    with np.errstate(over="ignore"):
        for query in (0, 20):
            best = {v: max(float(np.dot(a, b)) for i, a in rows if i == query for j, b in rows if j == v) for v in {i for i, _ in rows} - {query}}
            for k, (v, score) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))):
                want[query, k + 1, v, score] += 1
    assert got == want and max(r[3] for r in got) == float("inf")


def test_a_filter_passes_all_members_and_few_others(spark):
    rows = spark.range(20000).withColumn("hash", F.xxhash64("id"))
    members = rows.filter("id % 40 = 7").select("hash")
    marked = common.possible(rows, F.col("hash"), members, "some")
    assert marked.columns == ["id", "hash", "some"] and marked.count() == 20000
    assert marked.filter("id % 40 = 7 and not some").isEmpty() and marked.filter("some").count() < 500 + 20000 // 12
    assert common.possible(rows, F.col("hash"), members.limit(0), "some").filter("some").isEmpty()


def test_texts_without_a_near_copy_are_not_dealt(spark):
    held = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        words = "concat_ws(' ', transform(sequence(1, 30), k -> concat('w', if(id < 4, 0, id), '_', k)))"
        kept = near_duplicates.deduplicated(spark.range(400).selectExpr("id as doc_id", f"{words} as text"))
        assert sorted(r[0] for r in kept.select("doc_id").collect()) == [0, *range(4, 400)]
        plan = kept._jdf.queryExecution().optimizedPlan().toString()
        assert "map_bits" in plan and "Union" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", held)
