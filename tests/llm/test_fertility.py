"""Tokeniser fertility against a plain version."""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pytest
import sentencepiece

from grantlake.llm import queries, tokeniser_fertility as fertility

MODEL = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)


def plain(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = Counter(tuple(words[k : k + 8]) for k in range(len(words) - 7))
    hit = {k + i for k in range(len(words) - 7) if windows[tuple(words[k : k + 8])] > 1 for i in range(8)}
    lines = [line for line in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(hit)


def fails(n_words, n_repeat):
    return n_words < 20 or 100 * n_repeat > 30 * n_words


def piece_measures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    ids = [i for w in words for k in range(0, len(w), 256) for i in MODEL.encode(w[k : k + 256])]
    if not ids:
        return 0, None, None, None
    counts = Counter(ids).values()
    back = sum(MODEL.is_byte(i) or MODEL.is_unknown(i) for i in ids)
    return len(ids), sum(map(len, words)) / len(ids), back / len(ids), -sum(n / len(ids) * math.log2(n / len(ids)) for n in counts)


def verdicts(rows, names):
    """``rows``: language, words, base_failed, measures by name. Whether each is kept."""
    grid = lambda name, x: float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-fertility.DIGITS[name.split("_")[0]]), ROUND_HALF_UP))
    strata = defaultdict(list)
    for language, n, failed, m in rows:
        if not failed:
            strata[language, int(math.log2(n))].append(m)
    out = []
    for language, n, failed, m in rows:
        kept = not failed
        stratum = strata[language, int(math.log2(max(n, 1)))]
        for name in names if len(stratum) >= fertility.ENOUGH else ():
            low, high = np.percentile([grid(name, x[name]) for x in stratum], [25, 75])
            reach = max(fertility.REACH * (high - low), fertility.FLOORS[name.split("_")[0]])
            kept &= low - reach <= m[name] <= high + reach
        out.append(kept)
    return out


@pytest.mark.parametrize("enough", [50, 3])
def test_query_equals_plain_version(spark, sf_dir, monkeypatch, enough):
    monkeypatch.setattr(fertility, "ENOUGH", enough)
    texts = {r.doc_id: r for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in queries.QUERIES["op11_fertility"](spark, sf_dir).collect()}
    assert set(got) == set(texts)
    vocabularies = queries.public_vocabularies()
    names = [f"{m}_{v.name}" for v in vocabularies for m in fertility.MEASURES]
    measured = fertility.measured(spark.read.parquet(f"{sf_dir}/documents.parquet"), vocabularies, "lang").collect()
    rows = []
    for r in measured:
        counts = plain(texts[r.doc_id].text)
        assert tuple(got[r.doc_id][x] for x in fertility.PLAIN) == counts
        failed = fails(counts[0], counts[4])
        assert got[r.doc_id].base_failed == failed
        n, *pieces = piece_measures(texts[r.doc_id].text)
        assert r.tokens_pieces == n
        assert [r.chars_pieces, r.fallback_pieces, r.entropy_pieces] == pytest.approx(pieces)
        rows.append((r.language, counts[0], failed, {x: r[x] for x in names}))
    kept = verdicts(rows, names)
    assert [got[r.doc_id].kept for r in measured] == kept
    assert enough == 50 or 0 < sum(kept) < sum(not r[2] for r in rows)


def test_odd_texts(spark):
    line = "the quick brown fox jumps over the lazy dog again\n"
    texts = [
        None, "", " \t\r\n", "one", line * 5, line + " \n\n" + line, "x" * 700 + " y", "é日本 \x00 a\x00b <|#|> ñ ñ", "Привет мир друзья", "日本語のテキスト",
        " ".join(str(k) for k in range(40)), line * 100_000, "α β γ " * 9 + "1 2 3 4 5 6 7", "𓀀𓀁 𓀂",
    ]
    scripts = ["none", "none", "none", "latin", "latin", "latin", "latin", "latin", "cyrillic", "kana", "none", "latin", "greek", "none"]
    df = spark.createDataFrame([(k, t, "x", None) for k, t in enumerate(texts)], "doc_id long, text string, n_words string, language string")
    vocabularies = queries.public_vocabularies()
    got = sorted(fertility.measured(df, vocabularies).collect(), key=lambda r: r.doc_id)
    for r, text, script in zip(got, texts, scripts, strict=True):
        assert tuple(r[x] for x in fertility.PLAIN) == plain(text), text[:60]
        assert r.language == script
        n, *pieces = piece_measures(text)
        assert r.tokens_pieces == n
        assert [r.chars_pieces, r.fallback_pieces, r.entropy_pieces] == (pieces if pieces[0] is None else pytest.approx(pieces))
    assert got[13].fallback_bytes > 0 and got[13].fallback_pieces > 0
    judged = {r.doc_id: r for r in fertility.judged(fertility.measured(df, vocabularies), vocabularies).collect()}
    assert [judged[k].kept for k in (0, 3, 4, 10)] == [False, False, False, True]


def test_garbled_text_is_rejected(spark):
    rng = np.random.default_rng(2)
    words = ["house", "water", "letter", "morning", "garden", "river", "street", "window", "people", "and", "the", "of"]
    clean = [" ".join(rng.choice(words, 200)) for _ in range(80)]
    bad = [" ".join("".join(chr(c) for c in rng.integers(0x4E00, 0x9FFF, 4)) for _ in range(200)), "zq" * 300 + " qz" * 199]
    df = spark.createDataFrame([(k, t, "en") for k, t in enumerate(clean + bad)], "doc_id long, text string, lang string")
    vocabularies = queries.public_vocabularies()
    found = {r.doc_id: r for r in fertility.judged(fertility.measured(df, vocabularies, "lang"), vocabularies).collect()}
    assert not any(found[k].rejected_by for k in range(80))
    assert found[80].rejected_by and not found[80].kept
    assert not found[81].kept


def test_empty(spark):
    vocabularies = queries.public_vocabularies()
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert fertility.judged(fertility.measured(none, vocabularies, "lang"), vocabularies).count() == 0
