"""Document fingerprints by context-triggered piecewise hashing, compared by edit distance."""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_stage, byte_list, partition_stage, texts
from .word_hash import mixed

#: Bytes that decide whether a chunk ends after the last of them.
WINDOW = 8
#: A signature has so many chunks at most; the block size follows from that.
CHUNKS = 64
_MULTIPLIER = 0x9E3779B97F4A7C15
_BASE64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
_PAIRS = np.array([a + b for a in _BASE64 for b in _BASE64])


class Fingerprint(NamedTuple):
    """Signatures at the block sizes 2^level and 2^(level+1): one 12-bit symbol for each chunk."""

    level: int
    fine: tuple[int, ...]
    coarse: tuple[int, ...]

    def __str__(self) -> str:
        return f"{1 << self.level}:{''.join(_PAIRS[list(self.fine)])}:{''.join(_PAIRS[list(self.coarse)])}"


def fingerprints_of(values: list[bytes]) -> list[Fingerprint]:
    """Of every text, whole.

    A rolling hash of the last WINDOW bytes runs over the text; a chunk at block size 2^k ends where its
    lowest k bits are all one, so borders depend on what stands next to them only and return behind
    an edit. A text's level is the smallest k that leaves at most CHUNKS chunks. A chunk's hash is
    the sum of the mixed rolling hashes at its bytes.
    """
    if not values:
        return []
    pad = bytes(WINDOW)
    flat = np.frombuffer(b"".join(chain_padded(values, pad)), np.uint8).astype(np.uint64)
    sizes = np.fromiter(map(len, values), np.int64, len(values))
    begins = np.cumsum(sizes + WINDOW) - sizes  # of each text, after its own padding
    rolling, factor, span = flat + np.uint64(1), _MULTIPLIER, 1
    while span < WINDOW:  # windows of twice the width from two of the width before
        wider = rolling.copy()
        wider[span:] += rolling[:-span] * np.uint64(factor)
        rolling, factor, span = wider, factor * factor & 0xFFFFFFFFFFFFFFFF, 2 * span
    own = mixed(rolling)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(own)])
    # The number of one bits at the low end of the hash. Block size 1 is for texts of fewer than CHUNKS bytes only.
    able = (own & np.uint64(1)).astype(bool)
    for k in np.flatnonzero(sizes < CHUNKS):
        able[begins[k] : begins[k] + sizes[k]] = True
    places = np.flatnonzero(able)
    owner = np.searchsorted(begins, places, "right") - 1
    inside = (owner >= 0) & (places < begins[owner] + sizes[owner])
    places, owner = places[inside], owner[inside]
    turned = ~own[places]
    with np.errstate(divide="ignore"):
        height = np.where(turned == 0, 64, np.log2((turned & (~turned + np.uint64(1))).astype(np.float64))).astype(np.int64)
    counts = np.bincount(owner * 65 + height, minlength=65 * len(values)).reshape(-1, 65)
    ends_at = np.cumsum(counts[:, ::-1], axis=1)[:, ::-1]  # places of at least this height, by text
    level = np.argmax(ends_at < CHUNKS, axis=1)
    level = np.where(sizes < CHUNKS, level, np.maximum(level, 1))
    ends = begins + sizes

    def signatures(levels: np.ndarray) -> list[np.ndarray]:
        chosen = height >= levels[owner]
        borders, of = places[chosen] + 1, owner[chosen]
        # A chunk also begins at the start of each text and ends at its end.
        left = np.concatenate([begins, borders])
        text = np.concatenate([np.arange(len(values)), of])
        order = np.lexsort((left, text))
        left, text = left[order], text[order]
        right = np.append(left[1:], 0)
        last = np.append(text[1:] != text[:-1], True)
        right[last] = ends[text[last]]
        real = right > left
        left, right, text = left[real], right[real], text[real]
        symbols = (mixed(sums[right] - sums[left]) >> np.uint64(52)).astype(np.int64)
        return np.split(symbols, np.searchsorted(text, np.arange(1, len(values))))

    return [Fingerprint(k, tuple(a.tolist()), tuple(b.tolist())) for k, a, b in zip(level.tolist(), signatures(level), signatures(level + 1))]


def chain_padded(values: list[bytes], pad: bytes) -> Iterator[bytes]:
    for value in values:
        yield pad
        yield value


def common_length(a: tuple[int, ...], b: tuple[int, ...]) -> int:
    """Length of the longest common subsequence, a row of the table at a time as the bits of one number."""
    at: dict[int, int] = {}
    for k, symbol in enumerate(a):
        at[symbol] = at.get(symbol, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for symbol in b:
        if match := at.get(symbol, 0):
            low = row & match
            row = (row + low | row - low) & full
    return len(a) - row.bit_count()


def likeness(a: Fingerprint, b: Fingerprint) -> float:
    """1 less the edit distance (insertions and deletions, a replacement is one of each) in proportion to both
    lengths, at the finest block size that both have; 0 if they have none in common. Two empty texts are alike."""
    if a.level == b.level:
        x, y = a.fine, b.fine
    elif a.level + 1 == b.level:
        x, y = a.coarse, b.fine
    elif a.level == b.level + 1:
        x, y = a.fine, b.coarse
    else:
        return 0.0
    both = len(x) + len(y)
    return 2 * common_length(x, y) / both if both else 1.0


def edited(text: str, following: str) -> str:
    """The last third of the text replaced by as many first code points of the following one, or all it has."""
    third = len(text) // 3
    return text[: len(text) - third] + following[:third]


def _order(key: tuple[int | None, int]) -> tuple[int, int, int]:
    """Rises where the order of documents goes on: ids fall, null ids last, then hashes of the text fall."""
    own, tie = key
    return (1, 0, -tie) if own is None else (0, -own, -tie)


def splitters(keys: DataFrame, ranges: int, per_range: int = 64) -> list[tuple[int | None, int]]:
    """First keys of so many ranges at most, in order; the very first key of all is one of them.

    About `per_range` distinct keys for each range, chosen by their hash, come to the driver."""
    distinct = keys.distinct()
    top = keys.agg(F.count(F.lit(1)).alias("n"), F.max(F.struct(F.col("doc_id").isNotNull(), "doc_id", "tie")).alias("first")).first()
    if not top.n:
        return []
    share = min(1.0, ranges * per_range / top.n)
    sample = distinct.filter(F.pmod(F.xxhash64("doc_id", "tie"), F.lit(1 << 30)) < int(share * (1 << 30))).collect()
    chosen = sorted((_order((r.doc_id, r.tie)), r.doc_id, r.tie) for r in sample)
    cut = [chosen[k * len(chosen) // ranges] for k in range(ranges)] if chosen else []
    first = (_order((top.first.doc_id, top.first.tie)), top.first.doc_id, top.first.tie)
    return [(i, tie) for _, i, tie in sorted({first, *cut})]


def fingerprint_edits(docs: DataFrame, ranges: int | None = None) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for each row's whole text.

    The next document is the one with the next smaller doc_id, after the smallest the largest. The
    edited text has its last third replaced from the next document's beginning. near_edited and
    near_next are the likeness (0 to 1) of the text's fingerprint to the edited text's and to the next
    document's.

    A null text is empty. Null doc_ids come after all others; rows that share an id, null or not, are ordered by a
    hash of their text; rows alike in both are one document, each gives its row. A single document is its own next one.
    An empty table gives an empty result.

    The texts move once: ranges of documents between sampled splitters are sorted, and the first document
    of a range also goes along to the range before, where it follows the last one.
    """
    rows = texts(docs).withColumn("tie", F.xxhash64("text"))
    count = ranges or 4 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    firsts = splitters(rows.select("doc_id", "tie"), count)
    starts = [_order(key) for key in firsts]
    known = {key: k for k, key in enumerate(firsts)}

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = list(zip(batch.column("doc_id").to_pylist(), batch.column("tie").to_pylist()))
        guests = [k for k, key in enumerate(keys) if key in known]
        own = [bisect_right(starts, _order(key)) - 1 for key in keys] + [(known[keys[k]] - 1) % len(firsts) for k in guests]
        rows = batch.take(pa.array([*range(len(keys)), *guests], pa.int64()))
        columns = [pa.array(own, pa.int32()), pa.array([False] * len(keys) + [True] * len(guests)), *rows.columns]
        return pa.RecordBatch.from_arrays(columns, ["range", "guest", *batch.schema.names])

    placed = arrow_stage(rows, place, "range int, guest boolean, doc_id long, text string, tie long")
    order = [F.col("range"), F.col("guest"), F.col("doc_id").desc_nulls_last(), F.col("tie").desc()]
    return partition_stage(
        placed.repartition("range").sortWithinPartitions(*order),
        _compared,
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double",
    )


class _Row(NamedTuple):
    range: int
    key: tuple[int | None, int]
    text: str


def _compared(batches: Iterator[pa.RecordBatch], size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Rows of whole ranges in order; a document waits until the next one has come, and rows alike in key
    are held once with their number."""
    waiting: list[_Row] = []
    times: list[int] = []

    def done(following: _Row | None) -> Iterator[pa.RecordBatch]:
        """Of a single document's own range nothing follows but itself."""
        if waiting:
            ahead = [*waiting[1:], following or waiting[-1]]
            yield _measured(list(zip(waiting, ahead))).take(pa.array(np.repeat(np.arange(len(times)), times)))
        waiting.clear()
        times.clear()

    letters = 0
    for batch in batches:
        names = zip(*(batch.column(c).to_pylist() for c in ("range", "guest", "doc_id", "tie")))
        for (number, guest, doc, tie), value in zip(names, byte_list(batch.column("text"))):
            if waiting and waiting[-1].range == number and waiting[-1].key == (doc, tie) and not guest:
                times[-1] += 1
                continue
            row = _Row(number, (doc, tie), value.decode("utf-8", "replace"))
            if waiting and (guest or waiting[0].range != number or letters >= size):
                yield from done(row if waiting[0].range == number else None)
                letters = 0
            if not guest:  # a guest's repetitions find nothing that waits
                waiting.append(row)
                times.append(1)
                letters += len(row.text)
    yield from done(None)


def _measured(pairs: list[tuple[_Row, _Row]]) -> pa.RecordBatch:
    """The result rows of documents, each with the next one."""
    changed = [edited(a.text, b.text).encode("utf-8", "replace") for a, b in pairs]
    known: dict[tuple, Fingerprint] = {}
    wanted = {row.key: row.text for pair in pairs for row in pair}
    known.update(zip(wanted, fingerprints_of([t.encode("utf-8", "replace") for t in wanted.values()])))
    after = fingerprints_of(changed)
    rows = [(known[a.key], e, known[b.key]) for (a, b), e in zip(pairs, after)]
    columns = [
        pa.array([a.key[0] for a, _ in pairs], pa.int64()),
        pa.array([len(a.text) for a, _ in pairs], pa.int64()),
        pa.array([hashlib.sha256(c).hexdigest() for c in changed]),
        pa.array([str(f) for f, _, _ in rows]),
        pa.array([str(e) for _, e, _ in rows]),
        pa.array([likeness(f, e) for f, e, _ in rows]),
        pa.array([likeness(f, n) for f, _, n in rows]),
    ]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
