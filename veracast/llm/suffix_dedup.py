"""Removal of byte strings that occur more than once, by sorted suffixes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import arrow_stage, byte_list, texts
from .repeats import SUFFIX, Plan, keyed, marks, spans, suffix_batch, with_marks
from .rolling import BYTE_A, BYTE_B, Rolling, anchored, finished, least_at

WIDTH = 400
#: An anchor is the byte whose next GRAM bytes hash lowest among the first SPAN places of a window.
GRAM, SPAN = 16, 128
_BLOCK = 1 << 20


def _numbers(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return BYTE_A[data], BYTE_B[data]


def _pieces(values: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
    """Blocks of (text index, first byte, bytes). A long text comes in pieces that overlap by a window less one byte."""
    block, size = [], 0
    for k, value in enumerate(values):
        for begin in range(0, max(1, len(value) - WIDTH + 1), _BLOCK):
            part = value[begin : begin + _BLOCK + WIDTH - 1]
            if len(part) >= WIDTH:
                block.append((k, begin, part))
                size += len(part)
            if size >= _BLOCK:
                yield block
                block, size = [], 0
    if block:
        yield block


def _suffixes(block: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, ...]:
    data = np.frombuffer(b"".join(p for _, _, p in block), np.uint8)
    sizes = np.array([len(p) for _, _, p in block])
    ends = np.cumsum(sizes)
    piece = np.repeat(np.arange(len(block)), sizes)
    a, b = _numbers(data)
    a, b = Rolling(a, 0), Rolling(b, 1)
    anchor = least_at(finished(a.all(GRAM)), SPAN)
    low, high = anchored(anchor, np.arange(len(data)) + WIDTH <= ends[piece])
    own = piece[low]
    at = anchor[low]
    core = finished(a.of(at, at + WIDTH - SPAN + 1))
    full = finished(b.of(low, high + WIDTH) ^ ((at - low) << 8 | (high - low)).astype(np.uint64))
    base = np.array([begin for _, begin, _ in block]) - (ends - sizes)
    return np.array([k for k, _, _ in block])[own], core, full, low + base[own], high + base[own]


def _cut(values: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
    for k, value in enumerate(values):
        yield k, np.frombuffer(value, np.uint8)


PLAN = Plan(WIDTH, "u1", _numbers, _cut, keep_first=False)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, spans (begin, end of each maximal removed run), kept (the bytes that stay).

    A byte goes if a string of 400 bytes that covers it also starts at another place of any document.
    Strings never cross documents and are judged on the input. Texts are UTF-8; a null text is empty.
    Rows alike in doc_id and text are one document and get the same result, so a repeated row alone
    removes nothing; rows that only share an id are different documents. A null id is an id like
    another one. Every input row gives one row; an empty table gives an empty result.
    """
    own = keyed(texts(docs))

    def suffixes(batch: pa.RecordBatch) -> pa.RecordBatch:
        return suffix_batch(batch, [_suffixes(block) for block in _pieces(byte_list(batch.column("text")))])

    def remove(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, runs, kept = [], [], []
        for raw, found in zip(byte_list(batch.column("text")), batch.column("marks").to_pylist()):
            gone = spans(found)
            at, parts = 0, []
            for begin, end in gone:
                parts.append(raw[at:begin])
                at = end
            sizes.append(len(raw))
            runs.append([{"begin": x, "end": y} for x, y in gone])
            kept.append(b"".join([*parts, raw[at:]]))
        kind = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        columns = [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(runs, kind), pa.array(kept, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "spans", "kept"])

    found = marks(own, arrow_stage(own, suffixes, SUFFIX), PLAN)
    return arrow_stage(with_marks(own, found), remove, "doc_id long, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary")
