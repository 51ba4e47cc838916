"""Secret scans with character Markov models, with DataFrame functions only.

Rules find assignments, access keys and hexadecimal strings. Two character models, one of random strings and one of
ordinary identifiers, are trained from labelled samples: values that the rules find (label 1) and words of the texts (label
0). A long token is reported if the first model makes it much likelier than the second, per character and in all.

The samples are bounded; rules and models run over whole texts of all rows. Null texts are empty and have no spans; rows
that repeat get equal spans. Tokens that meet a rule's span are not reported again. Other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantlake.llm import common as c

KINDS = ("assign", "access", "hex", "markov")
#: Java patterns; the first is filtered by the length of its second group afterwards, so that failing matches are not retried.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
LEAST_VALUE = 6
#: Candidates of the models.
TOKEN = r"[A-Za-z0-9+/_=-]{16,}"
#: Documents that samples are taken from at most (smallest hashes of doc_id), values and words taken from them.
FIT_DOCUMENTS, FIT_STRINGS = 4000, 40_000
#: Log-likelihood ratio that a token needs in all and per character.
LEAST_RATIO, LEAST_PER_CHARACTER = 12.0, 0.8
_CHARACTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"


def _matches(pattern: str) -> Column:
    """The matches, and the lengths of the pieces around them, which give the offsets."""
    around = F.transform(F.split("text", pattern, -1), F.length)
    return F.struct(F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found"), around.alias("between"))


def _spans(kind: str, at: str) -> Column:
    """Spans from the struct of ``_matches`` in column ``at``: running sums over pieces and matches."""
    return F.expr(
        f"aggregate({at}.found, struct(cast(array() as array<struct<kind string, begin bigint, end bigint, value string>>) as out, 0L as at),"
        f" (a, m) -> struct("
        f"array_append(a.out, named_struct('kind', '{kind}', 'begin', a.at + {at}.between[size(a.out)], 'end', a.at + {at}.between[size(a.out)] + length(m), 'value', m)) as out,"
        f" a.at + {at}.between[size(a.out)] + length(m) as at), a -> a.out)"
    )


def scanned(documents: DataFrame) -> DataFrame:
    """doc_id, rule spans and candidate tokens (kind, begin, end, value) of each text."""
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "markov": TOKEN}
    # Only texts that hold a match are cut up.
    for kind, pattern in patterns.items():
        rows = rows.withColumn(f"_{kind}", F.when(F.col("text").rlike(pattern), _matches(pattern)))
    empty = F.expr("cast(array() as array<struct<kind string, begin bigint, end bigint, value string>>)")
    rows = rows.drop("text").select("doc_id", *[F.coalesce(_spans(k, f"_{k}"), empty).alias(k) for k in patterns])
    value = F.filter("assign", lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= LEAST_VALUE)
    return rows.withColumn("assign", value)


def _pairs(strings: DataFrame) -> DataFrame:
    """How often each character follows each other one, by label."""
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substring(F.col("value"), i, F.lit(2))))
    return strings.filter(F.length("value") > 1).select("label", pair.alias("pair")).groupBy("label", "pair").count()


def ratios(documents: DataFrame, scan: DataFrame) -> Column:
    """Log-likelihood ratios by pair of characters, as an array; trained on bounded samples of both labels."""
    hits = c.hashed_sample(scan.filter("size(assign) + size(access) + size(hex) > 0"), "doc_id", FIT_DOCUMENTS)
    values = F.concat(F.transform("assign", lambda s: F.regexp_extract(s["value"], ASSIGN, 1)), "access.value", "hex.value")
    strange = hits.select(F.lit(1).alias("label"), F.explode(values).alias("value")).distinct().orderBy(F.xxhash64("value")).limit(FIT_STRINGS)
    # Ids are chosen first: so many numbers of eight bytes are a fixed bound, and no texts meet in one task.
    ids = c.hashed_sample(documents.select(F.col("doc_id").cast("long")), "doc_id", FIT_DOCUMENTS)
    texts = documents.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(ids), "doc_id", "left_semi")
    words = texts.select(F.lit(0).alias("label"), F.explode(F.regexp_extract_all("text", F.lit(r"[A-Za-z][A-Za-z_]{3,}"), F.lit(0))).alias("value"))
    words = words.distinct().orderBy(F.xxhash64("value")).limit(FIT_STRINGS)
    counted = {(r["label"], r["pair"]): r["count"] for r in _pairs(strange.unionByName(words)).collect()}
    size = len(_CHARACTERS)
    totals: dict[tuple[int, str], int] = {}
    for (label, pair), n in counted.items():
        totals[label, pair[0]] = totals.get((label, pair[0]), 0) + n

    def likelihood(label: int, a: str, b: str) -> float:
        return math.log((counted.get((label, a + b), 0) + 0.5) / (totals.get((label, a), 0) + 0.5 * size))

    return F.array(*[F.lit(likelihood(1, a, b) - likelihood(0, a, b)) for a in _CHARACTERS for b in _CHARACTERS])


def _score(codes: Column, ratio: Column) -> Column:
    pairs = F.sequence(F.lit(1), F.size(codes) - 1)
    return F.aggregate(pairs, F.lit(0.0), lambda a, i: a + F.get(ratio, F.get(codes, i - 1) * len(_CHARACTERS) + F.get(codes, i)))


def spans_of(documents: DataFrame) -> DataFrame:
    """doc_id and spans (kind, begin, end): those of the rules, and tokens that the models take for random strings."""
    scan = c.staged(scanned(documents), "scan")
    ratio = ratios(documents, scan)
    token = scan.withColumn("base", F.concat("assign", "access", "hex"))
    # Digits alone are numbers, not names of either sort.
    apart = F.filter("markov", lambda t: t["value"].rlike("[A-Za-z]") & ~F.exists("base", lambda b: (b["begin"] < t["end"]) & (t["begin"] < b["end"])))
    codes = F.transform(apart, lambda t: F.struct(t.alias("t"), F.transform(F.split(t["value"], ""), lambda x: F.instr(F.lit(_CHARACTERS), x) - 1).alias("codes")))
    chosen = F.filter("coded", lambda t: _score(t["codes"], ratio) >= F.greatest(F.lit(LEAST_RATIO), LEAST_PER_CHARACTER * F.size(t["codes"])))
    out = token.withColumn("coded", codes).withColumn("markov", F.transform(chosen, lambda t: t["t"]))
    order = " ".join(f"when '{k}' then {i}" for i, k in enumerate(KINDS))
    spans = f"array_sort(transform(concat(base, markov), s -> struct(s.begin as begin, case s.kind {order} end as place, s.kind as kind, s.end as end)))"
    return out.select("doc_id", F.expr(f"transform({spans}, s -> struct(s.kind as kind, s.begin as begin, s.end as end))").alias("spans"))
