"""Removal of repeated word passages by recompression: equal passages get equal symbols inside."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_stage, byte_list, texts
from .repeats import SUFFIX, Plan, keyed, marks, spans, suffix_batch, with_marks
from .rolling import Rolling, anchored, finished, least_at, word_names
from .word_hash import owners

WIDTH = 20
ROUNDS = 2
#: After two rounds a symbol has up to 4 words, and whether and as what it begins at a word depends on the
#: 2 words before and the 4 words from there on. So of SPAN successive places inside a window at least one
#: begins a symbol, and all of them are settled by the window alone.
BEFORE, AFTER, SPAN = 2, 4, 12
_PIECE = 1 << 22
_NONE = np.uint64(0xFFFFFFFFFFFFFFFF)


def _numbers(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    names = names.astype(np.uint64)
    return names, finished(names ^ np.uint64(0x5851F42D4C957F2D))


def recompress(names: np.ndarray, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where symbols begin after the rounds, and their names.

    Each round splits the names into two halves by a bit of their hash and joins every first-half name
    with a second-half name that follows it. A new name is a hash of the two old ones: the same in every
    task, so it is global without a dictionary. Pairs cannot overlap, and a run of equal names has equal
    bits: its members stay one by one, so that passages cut out of a long run agree.
    """
    begins = np.arange(len(names))
    for step in range(ROUNDS):
        bit = (finished(names + np.uint64(0x632BE59BD9B4E019 * (step + 1) & 0xFFFFFFFFFFFFFFFF)) >> np.uint64(63)).astype(bool)
        joins = np.zeros(len(names), bool)
        joins[:-1] = ~bit[:-1] & bit[1:] & (text[:-1] == text[1:])
        second = np.zeros(len(names), bool)
        second[1:] = joins[:-1]
        pair = np.flatnonzero(joins)
        named = names.copy()
        named[pair] = finished(names[pair] * np.uint64(0x9E3779B97F4A7C15) + finished(names[pair + 1]) + np.uint64(step))
        begins, names, text = begins[~second], named[~second], text[~second]
    return begins, names


def _suffixes(names: np.ndarray, text: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    begins, symbols = recompress(names, text)
    keys = np.full(len(names), _NONE, np.uint64)
    keys[begins] = finished(symbols ^ np.uint64(0xA0761D6478BD642F))
    anchor = least_at(keys[BEFORE:], SPAN) + BEFORE
    low, high = anchored(anchor, np.arange(len(names)) + WIDTH <= ends)
    a, b = _numbers(names)
    a, b = Rolling(a, 0), Rolling(b, 1)
    at = anchor[low]
    core = finished(a.of(at - BEFORE, at + WIDTH - BEFORE - SPAN + 1))
    full = finished(b.of(low, high + WIDTH) ^ ((at - low) << 8 | (high - low)).astype(np.uint64))
    return text[low], core, full, low, high


def _cut(values: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    for start, names, begins in word_names(values):
        for k in range(len(begins) - 1):
            yield start + k, names[begins[k] : begins[k + 1]]


PLAN = Plan(WIDTH, "u8", _numbers, _cut, keep_first=True)


def remove_passages(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, spans (begin, end in words of each maximal removed run), kept (words joined by a space).

    A word goes if a window of 20 successive words of its document covers it whose words also start
    earlier: in a document with a smaller id, or before in the same one. Windows are judged on the
    input. Words are what stands between blanks and line breaks, unchanged; a null text has none.
    Rows alike in doc_id and text are one document and get the same result; rows that only share an id
    are ordered by a number of their text. A null id comes first. Every input row gives one row; an
    empty table gives an empty result.
    """
    own = keyed(texts(docs))

    def suffixes(batch: pa.RecordBatch) -> pa.RecordBatch:
        parts = []
        for start, names, begins in word_names(byte_list(batch.column("text"))):
            text = owners(begins)
            ends = begins[1:][text]
            for at in range(0, len(names), _PIECE):  # what is settled by a window is settled in any piece that holds it
                piece = slice(at, at + _PIECE + WIDTH - 1)
                of, core, full, low, high = _suffixes(names[piece], text[piece], np.minimum(ends[piece], piece.stop) - at)
                first = begins[of]
                parts.append((of + start, core, full, low + at - first, high + at - first))
        return suffix_batch(batch, parts)

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, runs, kept = [], [], []
        for raw, found in zip(byte_list(batch.column("text")), batch.column("marks").to_pylist()):
            words = raw.split()  # bytes part at exactly these blanks
            gone = spans(found)
            at, parts = 0, []
            for begin, end in gone:
                parts += words[at:begin]
                at = end
            sizes.append(len(words))
            runs.append([{"begin": x, "end": y} for x, y in gone])
            kept.append(b" ".join([*parts, *words[at:]]))
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "spans", "kept"])

    found = marks(own, arrow_stage(own, suffixes, SUFFIX), PLAN)
    return arrow_stage(with_marks(own, found), remove, "doc_id long, n_words long, spans array<struct<begin: long, end: long>>, kept string")
