"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is cut into units: a run of spaces with the characters up to the next space. No piece reaches over a unit's
end, so units are encoded by themselves and each distinct one only once per slice of texts. All units are one flat
numpy array of symbols. In each round every unit finds the best pair it holds; its leftmost places are merged at
once, and the array is compacted; units without a pair leave. Symbols that are no pieces become byte pieces.

The vocabulary comes from a model file whose normaliser changes nothing but spaces (a dummy space is put in front).
Null texts are empty; empty texts have no ids. Every id is kept. Other columns of the input are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame

from grantlake.llm import common as c

SPACE = "▁"
#: Units whose encoding a task remembers.
REMEMBERED = 60_000
_UNITS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
_NONE = np.iinfo(np.int64).max
_WIDE = 1 << 21
_POINTS = 0x110000
#: Bytes of text whose units are encoded together.
_SLICE = 1 << 20


@dataclass
class Vocabulary:
    """Pieces by id and the pairs that make them. Characters that are only parts of pieces have numbers from ``size`` on."""

    size: int
    text: list[str]
    byte_of: np.ndarray
    byte_ids: np.ndarray
    control: np.ndarray
    unknown: int  # its id
    symbols: dict[str, int]
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    pair_results: np.ndarray
    early: np.ndarray
    bigrams: set[tuple[int, int]]

    @cached_property
    def odd(self) -> np.ndarray:
        """The ids that don't spell themselves."""
        out = (self.byte_of >= 0) | self.control
        out[self.unknown] = True
        return out


@lru_cache(maxsize=4)
def vocabulary(model: bytes) -> Vocabulary:
    lib = sentencepiece.SentencePieceProcessor(model_proto=model)
    size = lib.get_piece_size()
    text = [lib.id_to_piece(i) for i in range(size)]
    byte_of = np.array([int(text[i][1:-1], 16) if lib.is_byte(i) else -1 for i in range(size)])
    control = np.array([lib.is_control(i) for i in range(size)])
    normal = [i for i in range(size) if byte_of[i] < 0 and not control[i] and not lib.is_unknown(i)]
    # Equal scores have equal ranks, so that the leftmost of them is first.
    _, rank = np.unique([-lib.get_score(i) for i in normal], return_inverse=True)
    symbols = {text[i]: i for i in normal}
    for i in normal:
        for ch in text[i]:
            symbols.setdefault(ch, size + len(symbols))
    pairs, early, bigrams = {}, np.zeros(size + len(symbols) + size, bool), set()
    ranks = dict(zip(normal, rank, strict=True))
    for i in normal:
        p = text[i]
        bigrams.update((symbols[a], symbols[b]) for a, b in zip(p, p[1:], strict=False))
        for k in range(1, len(p)):
            left, right = symbols.get(p[:k]), symbols.get(p[k:])
            if left is not None and right is not None:
                pairs[left * _WIDE + right] = (ranks[i], i)
                for part, n in ((left, k), (right, len(p) - k)):
                    if n > 1 and ranks[part] >= ranks[i]:
                        early[part] = True  # a pair with this part comes before the part itself
    keys = np.array(sorted(pairs), np.int64)
    byte_ids = np.full(256, lib.unk_id(), np.int64)
    byte_ids[byte_of[byte_of >= 0]] = np.flatnonzero(byte_of >= 0)
    return Vocabulary(
        size, text, byte_of, byte_ids, control, lib.unk_id(), symbols, keys,
        np.array([pairs[k][0] for k in keys], np.int64), np.array([pairs[k][1] for k in keys], np.int64), early, bigrams,
    )


def units_of(text: str) -> list[str]:
    return _UNITS.findall(SPACE + text.replace(" ", SPACE)) if text else []


def _ranks(v: Vocabulary, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Where in the pair table each pair is, or _NONE."""
    key = left * _WIDE + right
    at = np.minimum(np.searchsorted(v.pair_keys, key), len(v.pair_keys) - 1)
    return np.where(v.pair_keys[at] == key, at, _NONE)


def _distinct(values: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct values, all below ``limit``, and which of them each one is."""
    if limit > _POINTS:
        return np.unique(values, return_inverse=True)
    slot = np.zeros(limit, np.int64)
    slot[values] = 1
    known = np.flatnonzero(slot)
    slot[known] = np.arange(len(known))
    return known, slot[values]


def encode_units(v: Vocabulary, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The ids of all units one after another, and where each unit's begin and the last end."""
    if not units:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    flat = "".join(units)
    lengths = np.array([len(u) for u in units], np.int64)
    code = np.frombuffer(flat.encode("utf-32-le", "surrogatepass"), np.uint32)
    present = np.zeros(_POINTS, bool)
    present[code] = True
    kinds = np.flatnonzero(present)
    number = np.zeros(_POINTS, np.int64)
    number[kinds] = np.arange(len(kinds))
    back = number[code]
    table = np.array([v.symbols.get(chr(k), v.size + len(v.symbols)) for k in kinds], np.int64)
    symbols = table[back] if len(code) else np.zeros(0, np.int64)
    unit = np.repeat(np.arange(len(units)), lengths)
    # Neighbours that no piece holds side by side are never merged, so a long unit falls into short ones here.
    near = back[:-1] * len(kinds) + back[1:]
    known, where = _distinct(near, len(kinds) ** 2)
    joins = np.array([(int(table[k // len(kinds)]), int(table[k % len(kinds)])) in v.bigrams for k in known], bool)
    cut = np.ones(len(symbols), bool)
    if len(symbols) > 1:
        cut[1:] = ~joins[where] | (unit[1:] != unit[:-1])
    place, word = np.arange(len(symbols)), np.cumsum(cut)
    done_place, done_symbol = [], []
    pair, rank = np.full(len(symbols), _NONE), np.full(len(symbols), _NONE)
    anew = np.arange(len(symbols) - 1)
    while len(symbols):
        # Only pairs beside a merge are looked up again.
        pair[anew] = rank[anew] = _NONE
        same = anew[anew < len(symbols) - 1]
        same = same[word[same + 1] == word[same]]
        pair[same] = _ranks(v, symbols[same], symbols[same + 1])
        same = same[pair[same] < _NONE]
        rank[same] = v.pair_ranks[pair[same]]
        first = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        count = np.diff(np.append(first, len(symbols)))
        least = np.minimum.reduceat(rank, first)
        live = np.repeat(least < _NONE, count)
        done_place.append(place[~live])
        done_symbol.append(symbols[~live])
        at = np.flatnonzero((rank == np.repeat(least, count)) & live)
        if not len(at):
            break
        result = v.pair_results[pair[at]]
        # Of pairs that overlap, every second one counts from the left.
        begins = np.concatenate([[True], at[1:] != at[:-1] + 1])
        run = np.arange(len(at)) - np.flatnonzero(begins)[np.cumsum(begins) - 1]
        ahead = np.concatenate([[True], word[at][1:] != word[at][:-1]])
        lone = np.logical_or.reduceat(v.early[result], np.flatnonzero(ahead))[np.cumsum(ahead) - 1]
        take = np.where(lone, ahead, run % 2 == 0)
        at, result = at[take], result[take]
        symbols[at] = result
        live[at + 1] = False
        near = np.zeros(len(symbols), bool)
        near[at] = near[np.maximum(at - 1, 0)] = True
        symbols, place, word, pair, rank, near = symbols[live], place[live], word[live], pair[live], rank[live], near[live]
        anew = np.flatnonzero(near)
    place = np.concatenate(done_place) if done_place else np.zeros(0, np.int64)
    symbols = np.concatenate(done_symbol) if done_symbol else np.zeros(0, np.int64)
    order = np.argsort(place, kind="stable")
    place, symbols = place[order], symbols[order]
    # Characters without a piece become the pieces of their bytes.
    odd = np.flatnonzero(symbols >= v.size)
    if len(odd):
        spelled = [v.byte_ids[np.frombuffer(flat[p].encode("utf-8", "surrogatepass"), np.uint8)] for p in place[odd]]
        sizes = np.ones(len(symbols), np.int64)
        sizes[odd] = [len(s) for s in spelled]
        begin = np.cumsum(sizes) - sizes
        ids = np.repeat(symbols, sizes)
        ids[np.repeat(begin[odd], sizes[odd]) + np.concatenate([np.arange(len(s)) for s in spelled])] = np.concatenate(spelled)
        place = np.repeat(place, sizes)
        symbols = ids
    return symbols, np.searchsorted(place, np.concatenate([[0], np.cumsum(lengths)]))


def encode(v: Vocabulary, text: str) -> list[int]:
    return encode_units(v, units_of(text))[0].tolist()


def _spelled(v: Vocabulary, ids: list[int]) -> str:
    """The characters of ids, spaces as in the pieces; runs of byte pieces are read as UTF-8."""
    out, held = [], bytearray()
    for i in ids:
        if v.byte_of[i] >= 0:
            held.append(v.byte_of[i])
            continue
        if held:
            out.append(_read(held))
            held = bytearray()
        out.append(" ⁇ " if i == v.unknown else "" if v.control[i] else v.text[i])
    return "".join(out) + _read(held)


def _read(held: bytes | bytearray) -> str:
    """Bytes as UTF-8; each byte that doesn't fit is a replacement character."""
    out, at = [], 0
    while at < len(held):
        try:
            out.append(held[at:].decode())
            break
        except UnicodeDecodeError as e:
            out.append(held[at : at + e.start].decode() + "�")
            at += e.start + 1
    return "".join(out)


def decode(v: Vocabulary, ids: list[int]) -> str:
    """The text of ids; the dummy space in front goes."""
    return _spelled(v, ids).removeprefix(SPACE).replace(SPACE, " ")


def encoded(documents: DataFrame, model: bytes, kept: list[str], columns: str, rows: Callable) -> DataFrame:
    """``rows(ids_text, count, decoded)`` of every text, beside the columns ``kept``; see ``tokens``."""
    sent = documents.sparkSession.sparkContext.broadcast(model)  # half a megabyte

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(sent.value)
        number: dict[str, int] = {}
        count, ids, spelled = [], [], []
        for batch in c.slices(batches, most=_SLICE):
            cut = [units_of(t or "") for t in batch.column("text").to_pylist()]
            if len(number) > REMEMBERED:
                number, count, ids, spelled = {}, [], [], []
            new = list({u for units in cut for u in units if u not in number})
            number.update(zip(new, range(len(count), len(count) + len(new)), strict=True))
            found, cuts = encode_units(v, new)
            texts = pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(found).cast(pa.string()))
            count += np.diff(cuts).tolist()
            ids += pc.binary_join(texts, ",").to_pylist()
            # Pieces that are neither bytes nor marks spell what they were made of.
            for k in np.flatnonzero(c.reduced(v.odd[found].astype(np.int64), cuts)):
                new[k] = _spelled(v, found[cuts[k] : cuts[k + 1]].tolist())
            spelled += [u.replace(SPACE, " ") for u in new]
            out = []
            for units in cut:
                at = [number[u] for u in units]
                text = "".join([spelled[k] for k in at])
                out.append(rows(",".join([ids[k] for k in at]), sum([count[k] for k in at]), text[1:] if text[:1] == " " else text))
            made = [pa.array(x) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *made], [*kept, *(x.split()[0] for x in columns.split(", "))])

    given = ", ".join(f"`{k}` {documents.schema[k].dataType.simpleString()}" for k in kept)
    return documents.select(*kept, *(["text"] if "text" not in kept else [])).mapInArrow(run, f"{given}, {columns}")


def tokens(documents: DataFrame, model: bytes) -> DataFrame:
    """doc_id, ids (decimal, joined by commas), n_tokens and the text that the ids decode to."""
    return encoded(documents, model, ["doc_id"], "ids string, n_tokens long, decoded string", lambda ids, n, text: (ids, n, text))
