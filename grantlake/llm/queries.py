"""The operators applied to their whole tables, in the columns that are compared."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantlake.llm import (
    chat_windows,
    learned_partitions,
    minimax_shards,
    near_duplicates,
    pii_patterns,
    piece_merges,
    positional_index,
    ranked_search,
    secret_models,
    spelling_variants,
    subword_quality,
    tokeniser_fertility,
    toxicity,
)
from grantlake.llm.common import table

#: The vocabulary files of tokenizers; paths of the driver.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(function: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[function.__name__] = function
    return function


@_query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = positional_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@_query
def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def token_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every text."""

    def digests(ids: str, n: int, text: str) -> tuple[int, str, str]:
        return n, hashlib.sha256(ids.encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()

    columns = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return piece_merges.encoded(documents, Path(PIECE_MODEL).read_bytes(), ["doc_id"], columns, digests)


@_query
def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_digests(table(spark, sf_dir, "documents"))


@_query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predicted(toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


@_query
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _predicted(subword_quality.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


def _predicted(found: DataFrame) -> DataFrame:
    return found.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii_patterns.spans_of(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii_patterns.KINDS))
    counts = [_count(kind).alias(f"n_{kind}") for kind in pii_patterns.KINDS]
    return found.select("doc_id", *counts, F.sha2(_spelled(base), 256).alias("base_sha256"), _spelled(F.col("spans")).alias("spans"))


def _count(kind: str) -> Column:
    return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")


def _spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"].cast("string"), s["end"].cast("string"))), ",")


@_query
def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return learned_partitions.neighbours(table(spark, sf_dir, "embeddings"))


@_query
def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minimax_shards.sharded(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    marks = "</s>[INST] ok [/INST]"
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(marks).alias("text"),
    )
    given = table(spark, sf_dir, "conversations").select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    read = chat_windows.read_back(chat_windows.windows(given.unionByName(own)))
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    # The digests of a conversation need its texts in one row.
    whole = read.groupBy("conv_id").agg(
        F.sum(F.size("turns")).cast("long").alias("n_turns"),
        F.array_sort(F.collect_list(F.struct("window", told.alias("told"), F.array_join("masked", "").alias("masked")))).alias("parts"),
        F.sum("chars").alias("formatted_chars"),
    )
    masked = F.array_join("parts.masked", "")
    return whole.select(
        "conv_id", "n_turns", F.sha2(F.array_join("parts.told", ""), 256).alias("turns_sha256"),
        F.length(masked).cast("long").alias("loss_chars"), F.sha2(masked, 256).alias("loss_sha256"), "formatted_chars",
    )


@_query
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_models.spans_of(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"] != "markov")
    counts = [_count(kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")]
    return found.select("doc_id", *counts, F.sha2(_spelled(base), 256).alias("base_sha256"), _spelled(F.col("spans")).alias("spans"))


@_query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling_variants.words_of(table(spark, sf_dir, "documents"), damage=31)
    return spelling_variants.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


def public_vocabularies() -> list[tokeniser_fertility.Vocabulary]:
    return [
        tokeniser_fertility.Vocabulary("pieces", Path(PIECE_MODEL).read_bytes()),
        tokeniser_fertility.Vocabulary("bytes", Path(BYTE_RANKS).read_bytes(), public_tokenizers.PATTERN),
    ]


@_query
def op11_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabularies = public_vocabularies()
    found = tokeniser_fertility.measured(table(spark, sf_dir, "documents"), vocabularies, "lang")
    return tokeniser_fertility.judged(found, vocabularies).select("doc_id", *tokeniser_fertility.PLAIN, "base_failed", "kept")


@_query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.search(ranked_search.build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"))


_TERMS = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
SQL["op12_ranked_search"] = f"""
with texts as (select row_number() over () as r, doc_id, {_TERMS} as terms from documents where text is not null),
lengths as (select r, doc_id, len(terms) as n from texts where len(terms) > 0),
totals as (select count(*) as docs, sum(n)::bigint as words from lengths),
tfs as (select r, term, count(*) as tf from (select r, unnest(terms) as term from texts) group by r, term),
dfs as (select term, count(*) as df from tfs group by term),
items as (select distinct item_id, unnest({_TERMS}) as term from benchmark),
weights as (
    select item_id, term, floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double))::bigint as w from items join dfs using (term), totals
),
scores as (
    select item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))))::bigint as score
    from weights join tfs using (term) join lengths using (r), totals group by item_id, r, doc_id
),
ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id nulls last)::int as rank, doc_id, score
    from scores where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 10
"""
