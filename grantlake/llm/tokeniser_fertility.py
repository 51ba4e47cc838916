"""Quality rules by tokeniser fertility.

``measured`` counts what plain rules need and encodes the words of each text with public vocabularies: characters per token,
share of tokens that are fall-back bytes, and entropy of the tokens in bits. ``judged`` draws rejection bands: for each
language (or script, where no language is given) and each length class (power of two of words) the quartiles of a measure,
widened by REACH times their distance and by a floor at least. Quartiles are exact over all documents that pass the
plain rules, on a grid of measures, so that what is held for them has a bound. A language with fewer than ENOUGH documents
in a class has no band there.

Words are encoded one by one, as their number per word is what fertility is about; a word of more than PIECE code points is
encoded in pieces. Null and empty texts have no words and zeros. Repeated rows are judged, and count, each for itself. An
empty table gives no rows. Other columns than ``doc_id``, ``text`` and the language column are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

LEAST_WORDS = 20
#: A text fails when more than this share of its words, in percent, stands in repeated windows of WINDOW words.
MOST_REPEATED = 30
WINDOW = 8
REACH = 5.0
#: The least distance from the quartiles to the ends of a band.
FLOORS = {"chars": 0.25, "fallback": 0.05, "entropy": 0.5}
#: The grid on which measures are ranked, in decimal digits.
DIGITS = {"chars": 2, "fallback": 3, "entropy": 2}
ENOUGH = 50
PIECE = 256
#: Bytes of text whose words are encoded together.
_SLICE = 1 << 22
_CLASSES = c.byte_table(b"\x20\x09\x0a\x0b\x0c\x0d", lower=False)
_SYMBOLS = np.zeros(256, np.int64)
_SYMBOLS[np.frombuffer(b"#*$%&|<>", np.uint8)] = 1
#: First and last code point of the letters that tell scripts apart (fixed values).
SCRIPTS = {
    "latin": (0xC0, 0x24F), "greek": (0x370, 0x3FF), "cyrillic": (0x400, 0x52F), "hebrew": (0x590, 0x5FF), "arabic": (0x600, 0x6FF),
    "devanagari": (0x900, 0x97F), "thai": (0xE00, 0xE7F), "kana": (0x3040, 0x30FF), "han": (0x4E00, 0x9FFF), "hangul": (0xAC00, 0xD7A3),
}


@dataclass(frozen=True)
class Vocabulary:
    """A public vocabulary by its file's bytes: a sentencepiece model, or ranks (base64 and number per line) with the pattern that splits text."""

    name: str
    data: bytes
    pattern: str | None = None


class _Encoder:
    """Encodes words; ``fallback`` tells which ids stand for a piece of a character."""

    def __init__(self, vocabulary: Vocabulary):
        if vocabulary.pattern is None:
            model = sentencepiece.SentencePieceProcessor(model_proto=vocabulary.data)
            self.fallback = np.array([model.is_byte(i) or model.is_unknown(i) for i in range(model.get_piece_size())])
            self.encode = lambda words: model.encode(words, num_threads=1)
            return
        ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.data.splitlines() if line)}
        encoding = tiktoken.Encoding(vocabulary.name, pat_str=vocabulary.pattern, mergeable_ranks=ranks, special_tokens={})
        self.fallback = np.zeros(max(ranks.values()) + 1, bool)
        for token, i in ranks.items():
            try:
                token.decode()
            except UnicodeDecodeError:
                self.fallback[i] = True
        # A word in a text follows a blank, which these vocabularies write into its first token.
        self.encode = lambda words: [encoding.encode_ordinary(f" {w}") for w in words]

    def ids(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after another, and where each word's begin."""
        long = {i: [w[k : k + PIECE] for k in range(0, len(w), PIECE)] for i, w in enumerate(words) if len(w) > PIECE}
        for i in long:
            words[i] = ""
        found = self.encode(words)
        for i, pieces in long.items():
            found[i] = [t for ids in self.encode(pieces) for t in ids]
        cuts = np.zeros(len(found) + 1, np.int64)
        np.cumsum([len(x) for x in found], out=cuts[1:])
        return np.fromiter((t for ids in found for t in ids), np.int64, cuts[-1]), cuts


@cache
def _encoder(vocabulary: Vocabulary) -> _Encoder:
    return _Encoder(vocabulary)


def script(text: str) -> str:
    """The script of most letters of a text; ``none`` without letters. ASCII letters are Latin."""
    points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    ascii = int((((points | 32) >= 97) & ((points | 32) <= 122) & (points < 128)).sum())
    counts = {name: int(((points >= a) & (points <= b)).sum()) + (ascii if name == "latin" else 0) for name, (a, b) in SCRIPTS.items()}
    most = max(counts, key=lambda name: counts[name])
    return most if counts[most] else "none"


def _repeats(values: np.ndarray) -> np.ndarray:
    """How often each value of an array stands in it."""
    numbers = pa.array(values).dictionary_encode().indices.to_numpy()
    return np.bincount(numbers)[numbers] if len(values) else np.zeros(0, np.int64)


def _plain(raw: np.ndarray, offsets: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The counts of the plain rules per row; begin, end and hash of each word, and how many words come before each row."""
    marks, begins, ends, rows = c.word_spans(raw, offsets, _CLASSES)
    many = len(offsets) - 1
    leads = np.zeros(len(raw) + 1, np.int32 if len(raw) < 1 << 31 else np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=leads[1:])

    first, last = c.stretches(raw != 10, offsets)
    # A line tells something if a word begins in it.
    told = np.searchsorted(begins, last) > np.searchsorted(begins, first)
    first, last = first[told], last[told]
    of = np.searchsorted(offsets, first, side="right") - 1
    salt = c.mixed(np.arange(1, many + 1, dtype=np.uint64))
    lines = pa.array(c.span_hashes(raw, first, last) ^ salt[of]).dictionary_encode().indices.to_numpy()
    distinct = np.zeros(many, np.int64)
    ahead = np.zeros(lines.max(initial=-1) + 1, np.int64)
    ahead[lines[::-1]] = of[::-1]
    np.add.at(distinct, ahead, 1)

    words = c.span_hashes(marks, begins, ends)
    runs = c.run_hashes(words, WINDOW)
    row = np.repeat(np.arange(many), np.diff(rows))[: len(runs)]
    start = np.flatnonzero(np.arange(len(runs)) + WINDOW <= rows[row + 1])
    twice = start[_repeats(runs[start] ^ salt[row[start]]) > 1]
    edges = np.zeros(len(begins) + 1, np.int64)
    np.add.at(edges, twice, 1)
    np.add.at(edges, twice + WINDOW, -1)

    counts = {
        "n_words": np.diff(rows),
        "word_chars": c.reduced((leads[ends] - leads[begins]).astype(np.int64), rows),
        "n_symbols": c.reduced(_SYMBOLS[raw], offsets),
        "n_dup_lines": np.bincount(of, minlength=many) - distinct,
        "n_repeat_words": c.reduced((np.cumsum(edges)[:-1] > 0).astype(np.int64), rows),
    }
    return counts, begins, ends, words, rows


def _fertility(encoder: _Encoder, words: list[str], which: np.ndarray, rows: np.ndarray, chars: np.ndarray) -> list[np.ndarray]:
    """Tokens, characters per token, share of fall-back tokens and entropy per row; null (nan) without tokens."""
    ids, cuts = encoder.ids(words)
    sizes = np.diff(cuts)[which]
    n = c.reduced(sizes, rows)
    ends = np.cumsum(sizes)
    flat = ids[np.repeat(cuts[:-1][which] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
    row = np.repeat(np.arange(len(n)), n)
    width = len(encoder.fallback)
    keys = np.sort(row * width + flat)
    head = np.flatnonzero(np.diff(keys, prepend=-1))
    counts = np.diff(np.append(head, len(keys)))
    own = keys[head] // width
    spread = np.bincount(own, counts * np.log2(counts), minlength=len(n))
    back = np.bincount(row, encoder.fallback[flat], minlength=len(n))
    with np.errstate(divide="ignore", invalid="ignore"):
        return [n, np.where(n > 0, chars / n, np.nan), np.where(n > 0, back / n, np.nan), np.where(n > 0, np.log2(n) - spread / n, np.nan)]


PLAIN = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MEASURES = ("chars", "fallback", "entropy")


def measured(documents: DataFrame, vocabularies: Sequence[Vocabulary], language: str | None = None) -> DataFrame:
    """doc_id, language (or script), the counts of PLAIN, and for each vocabulary tokens_, chars_, fallback_ and entropy_ with its name."""
    tokens = [f"{m}_{v.name}" for v in vocabularies for m in ("tokens", *MEASURES)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoders = [_encoder(v) for v in vocabularies]
        for batch in c.slices(batches, most=_SLICE):
            raw, offsets = c.utf8(batch.column("text"))
            counts, begins, ends, words, rows = _plain(raw, offsets)
            which = pa.array(words).dictionary_encode().indices.to_numpy()
            one = np.zeros(which.max(initial=-1) + 1, np.int64)
            one[which] = np.arange(len(which))
            spelled = c.gathered(raw, begins[one], ends[one]).to_pylist()
            found = [x for e in encoders for x in _fertility(e, list(spelled), which, rows, counts["word_chars"])]
            named = batch.column("language")
            if named.null_count:
                texts = zip(named.to_pylist(), batch.column("text"), strict=True)
                named = pa.array([script(t.as_py() or "") if v is None else v for v, t in texts], pa.string())
            columns = [batch.column("doc_id"), named, *(pa.array(counts[x]) for x in PLAIN)]
            columns += [pa.array(x, from_pandas=x.dtype.kind == "f") for x in found]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "language", *PLAIN, *tokens])

    kinds = [f"{x} {'long' if x.startswith('tokens_') else 'double'}" for x in tokens]
    named = (F.lit(None) if language is None else F.col(language)).cast("string").alias("language")
    ddl = ", ".join(["doc_id long", "language string", *(f"{x} long" for x in PLAIN), *kinds])
    return documents.select(F.col("doc_id").cast("long"), "text", named).mapInArrow(run, ddl)


def _failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def judged(found: DataFrame, vocabularies: Sequence[Vocabulary]) -> DataFrame:
    """``found`` (see ``measured``) with base_failed, rejected_by (names of measures out of their bands) and kept."""
    rows = c.staged(found.withColumn("base_failed", _failed()).withColumn("length_class", F.floor(F.log2(F.greatest("n_words", F.lit(1))))), "measures")
    names = [f"{m}_{v.name}" for v in vocabularies for m in MEASURES]
    # On the grid a measure has few thousand values, which is what each task holds of a language and class.
    quartiles = [F.percentile(F.round(x, DIGITS[x.split("_")[0]]), F.array(F.lit(0.25), F.lit(0.75))).alias(f"q_{x}") for x in names]
    bands = rows.filter(~F.col("base_failed")).groupBy("language", "length_class").agg(F.count("*").alias("many"), *quartiles)
    bands = bands.filter(F.col("many") >= ENOUGH)
    joined = rows.join(bands, ["language", "length_class"], "left")

    def out(name: str) -> Column:
        q = F.col(f"q_{name}")
        reach = F.greatest(REACH * (q[1] - q[0]), F.lit(FLOORS[name.split("_")[0]]))
        return F.when((F.col(name) < q[0] - reach) | (F.col(name) > q[1] + reach), F.lit(name))

    joined = joined.withColumn("rejected_by", F.filter(F.array(*[out(x) for x in names]), lambda x: x.isNotNull()))
    kept = ~F.col("base_failed") & (F.size("rejected_by") == 0)
    return joined.select(*rows.columns, "rejected_by", kept.alias("kept"))
