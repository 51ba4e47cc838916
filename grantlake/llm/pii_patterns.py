"""Personal data by bootstrapped contextual extraction.

Exact rules find e-mail addresses, IP addresses, card and phone numbers. These are the seeds: the two words before a
seed are a lexical pattern of its kind. All occurrences of patterns with several different seeds are then counted in
the whole corpus, with what follows: the seed of the pattern's kind that begins there, else a token, with the digit groups
that continue it for cards and phones. Spark scores the graph of patterns and instances in rounds: a
pattern is as reliable as the average of what follows it, an instance as the best of its patterns; seeds stay at one,
and ordinary words at zero. Identifiers after reliable patterns are found although no rule knows their form.

Null texts are empty and have no spans. Rows that repeat get equal spans; a row is known by its doc_id (which may be
null) and a hash of its text. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

KINDS = ("email", "ip", "card", "phone")
#: Different seeds that make two words a pattern, rounds of scoring, and the score from which a pattern finds instances.
SUPPORT, ROUNDS, RELIABLE = 3, 3, 0.6
#: Patterns sent to the tasks at once; more are counted in further passes over the texts.
PASS_PATTERNS = 1_000_000
CLASSES = c.byte_table(b"\x20\x09\x0a\x0b\x0c\x0d")

# Runs without an address are matched too, so that each run is read once.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]+(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"[0-9]+(\.[0-9]+\.[0-9]+\.[0-9]+)?")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_DIGITS = re.compile(r"[^0-9]+")
#: What may follow a reliable pattern: a token with a digit or an at sign, without punctuation around it.
_TOKEN = re.compile(r"[\"'(<\[]*([^\s\"'(<\[][^\s]*?)[\"')>\],.;:!?]*")
_LEAD = re.compile(r"[\"'(<\[]*")
#: Digits up to the end of a word, and the most digits that several of them have together.
_GROUP = re.compile(r"\+?(?:\([0-9]++\)|[0-9]++)(?:[./-]?+(?:\([0-9]++\)|[0-9]++))*+(?=[\"')>\],.;:!?]*+(?:[\x20\x09-\x0d]|\Z))")
_MOST = {"card": 19, "phone": 15}


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """kind, begin and end of what the rules find, by kind and begin."""
    out = []
    if "@" in text:
        out += [("email", *m.span()) for m in _EMAIL.finditer(text) if m[1]]
    if not _DIGIT.search(text):
        return out
    if "." in text:
        for m in _IP.finditer(text):
            if m[1] and all(len(x.lstrip("0")) <= 3 and int(x[-4:]) <= 255 for x in m[0].split(".")):
                out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if 16 <= m.end() - m.start() and 16 <= len(d := _DIGITS.sub("", m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.sub("", m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def _continued(text: str, begin: int, most: int, spans: list[tuple[str, int, int]]) -> tuple[int, int] | None:
    """Begin and end of the digit groups at ``begin``, one space between them, as far as they meet no span of a rule."""
    m = (text[begin - 1 : begin] == "(" and _GROUP.match(text, begin - 1)) or _GROUP.match(text, begin)
    if not m:
        return None
    start, end, digits = m.start(), m.end(), len(_DIGITS.sub("", m[0]))
    while text[end : end + 1] == " " and (m := _GROUP.match(text, end + 1)) and m[0][0] != "+":
        digits += len(_DIGITS.sub("", m[0]))
        if digits > most or any(b < m.end() and end < e for _, b, e in spans):
            break
        end = m.end()
    return start, end


def _follower(text: str, begin: int, end: int, kind: str, spans: list[tuple[str, int, int]]) -> tuple[int, int] | None:
    """Begin and end of the identifier of a kind that starts with the word from ``begin`` to ``end``; ``spans``: the rules' ones."""
    first = _LEAD.match(text, begin, end).end()
    ends = {k: e for k, b, e in spans if b == first}
    if ends:
        # What the rules of another kind find is no seed of this one.
        return first, ends.get(kind) or max(ends.values())
    m = _TOKEN.fullmatch(text, begin, end)
    if not m:
        return None
    span = (kind in _MOST and _continued(text, first, _MOST[kind], spans)) or m.span(1)
    return span if span[1] - span[0] >= 5 else None


class _Words:
    """Words of a slice of texts, the hash of the two before each, and offsets in characters."""

    def __init__(self, texts: pa.Array):
        data, offsets = c.utf8(texts)
        marks, self.begins, self.ends, self.rows = c.word_spans(data, offsets, CLASSES)
        hashes = c.span_hashes(marks, self.begins, self.ends)
        row = np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))
        self.row, self.before = row, np.zeros(len(hashes), np.uint64)
        runs = c.run_hashes(hashes, 2)
        if len(hashes) > 2:
            self.before[2:] = runs[: len(hashes) - 2]
        self.known = np.arange(len(hashes)) - self.rows[:-1][row] >= 2 if len(hashes) else np.zeros(0, bool)
        chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
        start = chars[offsets[:-1]]
        self.char_begin = chars[self.begins] - start[row] if len(row) else np.zeros(0, np.int64)
        self.char_end = chars[self.ends] - start[row] if len(row) else np.zeros(0, np.int64)


def _seeds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in c.slices(batches):
        texts = batch.column("text").to_pylist()
        found = [(i, *s) for i, t in enumerate(texts) if t for s in base_spans(t)]
        if not found:
            continue
        words = _Words(batch.column("text"))
        rows = []
        for i, kind, begin, end in found:
            a, b = words.rows[i], words.rows[i + 1]
            k = a + np.searchsorted(words.char_begin[a:b], begin, "right") - 1
            if k >= a and words.known[k] and _LEAD.fullmatch(texts[i], words.char_begin[k], begin):
                rows.append((kind, int(words.before[k].view(np.int64)), texts[i][begin:end].lower()))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*rows, strict=True)], ["kind", "pattern", "instance"])


def _followers(patterns: np.ndarray, kinds: np.ndarray):
    """For a sorted array of patterns and the kinds (bits) of each: how often each occurs, and the identifiers after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.zeros(len(patterns), np.int64)
        for batch in c.slices(batches):
            words = _Words(batch.column("text"))
            hashes = words.before.view(np.int64)
            at = np.minimum(np.searchsorted(patterns, hashes), len(patterns) - 1)
            hit = np.flatnonzero((patterns[at] == hashes) & words.known)
            np.add.at(seen, at[hit], 1)
            rows = []
            texts = {}
            for k in hit:
                i = int(words.row[k])
                if i not in texts:
                    texts[i] = (text := batch.column("text")[i].as_py()), base_spans(text)
                text, spans = texts[i]
                begin, end = int(words.char_begin[k]), int(words.char_end[k])
                token = text[begin:end]
                if "@" not in token and not _DIGIT.search(token):
                    continue
                for bit, kind in enumerate(KINDS):
                    if kinds[at[k]] >> bit & 1 and (span := _follower(text, begin, end, kind, spans)):
                        whose = batch.column("doc_id")[i].as_py(), batch.column("text_hash")[i].as_py()
                        rows.append((int(patterns[at[k]]), kind, text[slice(*span)].lower(), *whose, *span, 1))
            if rows:
                columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), _FOLLOWER_TYPES, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, _FOLLOWER_NAMES)
        some = np.flatnonzero(seen)
        if len(some):
            nulls = [pa.nulls(len(some), t) for t in _FOLLOWER_TYPES[1:7]]
            yield pa.RecordBatch.from_arrays([pa.array(patterns[some]), *nulls, pa.array(seen[some])], _FOLLOWER_NAMES)

    return run


_FOLLOWER_NAMES = ["pattern", "kind", "instance", "doc_id", "text_hash", "begin", "end", "n"]
_FOLLOWER_TYPES = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]


def discovered(documents: DataFrame) -> DataFrame:
    """Spans that reliable patterns find: doc_id, text_hash, kind, begin, end. ``documents``: doc_id, text, text_hash."""
    spark = documents.sparkSession
    seeds = c.staged(documents.select("text").mapInArrow(_seeds, "kind string, pattern long, instance string").distinct(), "seeds")
    patterns = seeds.groupBy("kind", "pattern").count().filter(F.col("count") >= SUPPORT).select("kind", "pattern")
    patterns = c.staged(patterns, "patterns")
    passes = -(-patterns.select("pattern").distinct().count() // PASS_PATTERNS)
    empty = spark.createDataFrame([], "doc_id long, text_hash long, kind string, begin long, end long")
    followers = None
    for k in range(passes):
        part = patterns.filter(F.pmod(F.xxhash64("pattern"), F.lit(passes)) == k)
        part = part.groupBy("pattern").agg(F.sum(sum(F.when(F.col("kind") == x, 1 << bit).otherwise(0) for bit, x in enumerate(KINDS))))
        given = [tuple(r) for r in part.toLocalIterator()]
        known, bits = np.array([r[0] for r in given], np.int64), np.array([r[1] for r in given], np.uint8)
        order = np.argsort(known)
        known, bits = known[order], bits[order]
        if not len(known):
            continue
        found = documents.mapInArrow(_followers(known, bits), "pattern long, kind string, instance string, doc_id long, text_hash long, begin long, end long, n long")
        followers = found if followers is None else followers.unionByName(found)
    if followers is None:
        return empty
    followers = c.staged(followers, "followers")
    total = followers.filter("instance is null").groupBy("pattern").agg(F.sum("n").alias("total"))
    edges = followers.filter("instance is not null").groupBy("kind", "pattern", "instance").agg(F.sum("n").alias("n"))
    edges = edges.join(seeds.select("kind", "instance", F.lit(1.0).alias("seed")).distinct(), ["kind", "instance"], "left")
    edges = c.staged(edges.withColumn("seed", F.coalesce("seed", F.lit(0.0))), "edges")
    total = c.staged(patterns.join(total, "pattern"), "totals")
    belief = edges.select("kind", "pattern", "instance", "n", F.col("seed").alias("belief"), "seed")
    for _ in range(ROUNDS):
        score = belief.groupBy("kind", "pattern").agg(F.sum(F.col("n") * F.col("belief")).alias("good"))
        score = c.staged(score.join(total, ["kind", "pattern"]).select("kind", "pattern", (F.col("good") / F.col("total")).alias("score")), "scores")
        best = edges.join(score, ["kind", "pattern"]).groupBy("kind", "instance").agg(F.max("score").alias("best"))
        belief = c.staged(edges.join(best, ["kind", "instance"]).withColumn("belief", F.greatest("seed", "best")), "beliefs").select("kind", "pattern", "instance", "n", "belief", "seed")
    reliable = score.filter(F.col("score") >= RELIABLE).select("kind", "pattern")
    spans = followers.filter("instance is not null").join(reliable, ["kind", "pattern"])
    return spans.select("doc_id", "text_hash", F.concat(F.lit("context_"), "kind").alias("kind"), "begin", "end").distinct()


def with_spans(documents: DataFrame) -> tuple[DataFrame, str]:
    """``documents`` with a further column, and its name: kind, begin, end of what context finds."""
    key, name = c.fresh(documents, "text_hash"), c.fresh(documents, "found")
    keyed = documents.withColumn(key, F.xxhash64("text"))
    spans = discovered(keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.col(key).alias("text_hash")))
    # A text has few such spans: each needs two words of its own before it.
    spans = spans.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("kind", "begin", "end"))).alias(name))
    left, right = c.fresh(documents, "_d"), c.fresh(documents, "_h")
    spans = c.staged(spans.select(F.col("doc_id").alias(left), F.col("text_hash").alias(right), name), "found")
    on = keyed["doc_id"].eqNullSafe(F.col(left)) & (keyed[key] == F.col(right))
    return keyed.join(spans, on, "left").drop(left, right, key), name


def all_spans(text: str, found: list[dict] | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """The rules' spans, and those of context that meet none of them, each by kind and begin."""
    base = base_spans(text) if text else []
    more = [(f["kind"], f["begin"], f["end"]) for f in found or []]
    more = [s for s in more if not any(s[1] < e and b < s[2] for _, b, e in base)]
    return base, sorted(more, key=lambda s: (KINDS.index(s[0].removeprefix("context_")), s[1]))


def spans_of(documents: DataFrame) -> DataFrame:
    """Per row: doc_id, spans (kind, begin, end) with those of the rules first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            out = []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist(), strict=True):
                base, more = all_spans(text, found)
                out.append([{"kind": k, "begin": b, "end": e} for k, b, e in [*base, *more]])
            kind = pa.list_(pa.struct([("kind", pa.string()), ("begin", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, kind)], ["doc_id", "spans"])

    rows, name = with_spans(documents.select("doc_id", "text"))
    rows = rows.select(F.col("doc_id").cast("long"), "text", F.col(name).alias("found"))
    return rows.mapInArrow(run, "doc_id long, spans array<struct<kind string, begin long, end long>>")


def masked(documents: DataFrame) -> DataFrame:
    """``documents`` with each span of its text replaced by its kind in angle brackets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in c.slices(batches):
            at = batch.schema.get_field_index("text")
            out = []
            for text, found in zip(batch.column(at).to_pylist(), batch.column(name).to_pylist(), strict=True):
                base, more = all_spans(text, found)
                parts, done = [], 0
                for kind, begin, end in sorted([*base, *more], key=lambda s: (s[1], -s[2])):
                    if begin >= done:
                        parts += [text[done:begin], f"<{kind.removeprefix('context_')}>"]
                    done = max(done, end)
                out.append("".join([*parts, text[done:]]) if parts else text)
            yield batch.set_column(at, "text", pa.array(out, pa.string())).drop_columns([name])

    rows, name = with_spans(documents)
    return rows.mapInArrow(run, documents.schema)
