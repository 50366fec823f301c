"""SimHash near-duplicates: fingerprints, candidate keys from the Golay code, and components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD, arrow_stage, held, partition_stage, stored, text_list, texts
from .components import components

SHINGLE, SEED, BITS = 4, 42, 4
#: Segment borders: three segments of at most 23 bits, the length of the code.
SEGMENTS = ((0, 22), (22, 43), (43, 64))
#: Fingerprints of one key that one task compares; larger groups are dealt out in pairs of parts.
GROUP = 4096
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
_GENERATOR = 0b101011100011  # of the binary Golay code of length 23


def fingerprint(text: str) -> int:
    """A bit is 1 if it is set in more than half of the hashes of the text's shingles, repeats included."""
    words = WORD.findall(text.translate(_LOWER))
    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [" ".join(words)]
    else:
        shingles = map(" ".join, zip(*(words[k:] for k in range(SHINGLE))))
    raw = b"".join([xxhash.xxh64_digest(s.encode("utf-8", "replace"), SEED) for s in shingles])
    hashes = np.frombuffer(raw, np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 14):  # whole long texts, a bounded part unpacked at a time
        ones += np.unpackbits(hashes[k : k + (1 << 14)], axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fp): the fingerprint as a signed 64-bit number."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = np.array([fingerprint(t) for t in text_list(batch.column("text"))], np.uint64)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return arrow_stage(texts(docs), work, "doc_id long, fp long")


def golay_table() -> np.ndarray:
    return held(("golay",), _golay_table)


def _golay_table() -> np.ndarray:
    """For each 23-bit word the 12 message bits of the only codeword within three bits of it."""
    messages = np.arange(1 << 12, dtype=np.int64)
    checks = messages << 11
    for bit in range(22, 10, -1):
        checks = np.where(checks >> bit & 1, checks ^ (_GENERATOR << (bit - 11)), checks)
    words = (messages << 11) | checks  # systematic: the message stands in the upper bits
    table = np.zeros(1 << 23, np.uint16)
    errors = [0]
    for i in range(23):
        errors.append(1 << i)
        for j in range(i):
            errors.append(1 << i | 1 << j)
            errors += [1 << i | 1 << j | 1 << k for k in range(j)]
    for error in errors:
        table[words ^ error] = messages
    return table


def segment_keys(segment: np.ndarray) -> np.ndarray:
    """Per value up to 24 codewords (sorted, repeats as -1): those nearest to it and to each value one bit away.

    Values that differ in at most two bits share one: the value halfway between is one bit from both.
    """
    flips = np.concatenate([[0], 1 << np.arange(23)])
    near = np.sort(golay_table()[segment[:, None] ^ flips].astype(np.int32), axis=1)
    near[:, 1:][near[:, 1:] == near[:, :-1]] = -1
    return near


def candidate_keys(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, key) rows. Four errors over three segments leave two segments with at most two errors
    each, so two linked fingerprints share the codewords of some pair of segments."""
    rows, keys = [], []
    by_segment = [segment_keys(((fps >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64)) for a, b in SEGMENTS]
    for pair, (x, y) in enumerate(((0, 1), (0, 2), (1, 2))):
        left, right = by_segment[x], by_segment[y]
        i, a = np.nonzero(left >= 0)
        j, b = np.nonzero(right >= 0)
        # Every codeword of one segment with every one of the other, value by value.
        n_left, n_right = np.bincount(i, minlength=len(fps)), np.bincount(j, minlength=len(fps))
        begin = np.cumsum(n_right) - n_right
        first = np.repeat(np.arange(len(i)), n_right[i])
        step = np.arange(len(first)) - np.repeat(np.cumsum(n_right[i]) - n_right[i], n_right[i])
        second = begin[i[first]] + step
        rows.append(i[first])
        keys.append((np.int64(pair) << 24) | (left[i[first], a[first]].astype(np.int64) << 12) | right[j[second], b[second]].astype(np.int64))
    return np.concatenate(rows), np.concatenate(keys)


def _spanning(values: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Links of at most four bits that hold the values of one group together as all such links do."""
    out = []
    left = np.arange(len(values))
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            at = front.pop()
            near = np.bitwise_count(values[left] ^ values[at]) <= BITS
            if near.any():
                new = left[near]
                out.append((np.full(len(new), values[at]), values[new]))
                front += new.tolist()
                left = left[~near]
    return out


def _links(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
    x = np.concatenate(a) if a else np.empty(0, np.uint64)
    y = np.concatenate(b) if b else np.empty(0, np.uint64)
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x.view(np.int64), y.view(np.int64))), pa.array(np.maximum(x.view(np.int64), y.view(np.int64)))], ["a", "b"])


def _groups(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """(group number, fp) arrays of whole groups from rows sorted by (key, fp), in pieces; of a group that is
    larger than `group` only pieces, marked so."""
    keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
    in_large = None
    for batch in batches:
        keys = np.concatenate([keys, batch.column("key").to_numpy()])
        fps = np.concatenate([fps, batch.column("fp").to_numpy().view(np.uint64)])
        if in_large is not None:
            end = int(np.searchsorted(keys, in_large, "right"))
            yield keys[:end], fps[:end], True
            keys, fps = keys[end:], fps[end:]
            if not len(keys):
                continue
            in_large = None
        begin = int(np.searchsorted(keys, keys[-1], "left"))
        if begin:
            yield keys[:begin], fps[:begin], False
            keys, fps = keys[begin:], fps[begin:]
        if len(keys) > group:
            in_large = keys[-1]
            yield keys, fps, True
            keys, fps = keys[:0], fps[:0]
    if len(keys):
        yield keys, fps, False


def _compare(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.RecordBatch]:
    """Links inside the groups of sorted (key, fp) rows; rows of large groups come out as (key, fp) for dealing."""
    small = min(8, group)
    for keys, fps, large in _groups(batches, group):
        a, b, big = [], [], []
        if not large:
            begins = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
            sizes = np.diff(np.append(begins, len(keys)))
            size_of = np.repeat(sizes, sizes)
            for step in range(1, small):  # small groups all at once, by distance in the order
                at = np.flatnonzero((size_of[:-step] <= small) & (keys[:-step] == keys[step:])) if len(keys) > step else np.empty(0, np.int64)
                if not len(at):
                    break
                at = at[np.bitwise_count(fps[at] ^ fps[at + step]) <= BITS]
                a.append(fps[at])
                b.append(fps[at + step])
            for begin, size in zip(begins[sizes > 8].tolist(), sizes[sizes > small].tolist()):
                if size > group:
                    big.append(slice(begin, begin + size))
                else:
                    for x, y in _spanning(fps[begin : begin + size]):
                        a.append(x)
                        b.append(y)
        else:
            big.append(slice(0, len(keys)))
        links = _links(a, b)
        held = [np.concatenate([v[s] for s in big]) if big else v[:0] for v in (keys, fps.view(np.int64))]
        yield pa.RecordBatch.from_arrays(
            [pa.concat_arrays([pa.nulls(links.num_rows, pa.int64()), pa.array(held[0])]), pa.concat_arrays([links.column("a"), pa.array(held[1])]), pa.concat_arrays([links.column("b"), pa.nulls(len(held[0]), pa.int64())])],
            ["key", "a", "b"],
        )


def _compare_parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links inside each (key, part pair): it holds two parts of a large group, so all its pairs meet somewhere."""
    held: dict = {}
    now = None

    def done() -> Iterator[pa.RecordBatch]:
        if held.get("fps"):
            found = _spanning(np.concatenate(held["fps"]))
            yield _links([x for x, _ in found], [y for _, y in found])

    for batch in batches:
        names = [batch.column(c).to_numpy() for c in ("key", "low", "high")]
        fps = batch.column("fp").to_numpy().view(np.uint64)
        cuts = np.flatnonzero(np.any([n[1:] != n[:-1] for n in names], axis=0)) + 1
        for begin, end in zip([0, *cuts.tolist()], [*cuts.tolist(), len(fps)]):
            name = tuple(int(n[begin]) for n in names)
            if name != now:
                yield from done()
                now, held["fps"] = name, []
            held["fps"].append(fps[begin:end])
    yield from done()


def links(fps: DataFrame, group: int = GROUP) -> DataFrame:
    """(a, b) with a < b: links between distinct fingerprints that leave the same components as all links."""

    def keyed(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = batch.column("fp").to_numpy().view(np.uint64)
        at, keys = candidate_keys(own)
        return pa.RecordBatch.from_arrays([pa.array(keys), pa.array(own[at].view(np.int64))], ["key", "fp"])

    small = fps.select("fp").distinct()
    rows = arrow_stage(small, keyed, "key long, fp long")
    sorted_rows = rows.repartition("key").sortWithinPartitions("key", "fp")
    first = stored(partition_stage(sorted_rows, partial(_compare, group=group), "key long, a long, b long"), "simhash-links")
    found = first.filter("key IS NULL").select("a", "b")
    # A large group is cut into parts by a hash; every two parts meet in a task of their own.
    large = first.filter("key IS NOT NULL").select("key", F.col("a").alias("fp"))
    parts = large.groupBy("key").agg(F.ceil(F.count(F.lit(1)) / F.lit(max(group, 2) / 2)).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int")
    dealt = large.join(parts, "key").withColumn("part", part).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    dealt = dealt.select("key", F.least("part", "other").alias("low"), F.greatest("part", "other").alias("high"), "fp")
    met = dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "fp")
    return found.unionByName(partition_stage(met, _compare_parts, "a long, b long")).distinct()


def near_duplicates(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id, for each row's whole text.

    Texts whose fingerprints differ in at most four bits are linked; component_id is the smallest
    doc_id that links reach, its own included. Texts without words, null ones too, have fingerprint
    zero and are linked like any other. Equal fingerprints are one node, so copies make no pairs.
    Every input row gives one row, repeated ids too; null ids are never the smallest, and a component
    of null ids alone has a null component_id. An empty table gives an empty result.
    """
    own = stored(fingerprints(docs), "fingerprints")
    roots = components(links(own, group))
    nodes = own.groupBy("fp").agg(F.min("doc_id").alias("least")).join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    nodes = nodes.select("fp", F.coalesce("root", "fp").alias("root"), "least")
    least = nodes.groupBy("root").agg(F.min("least").alias("component_id"))
    of_fp = nodes.join(least, "root").select("fp", "component_id")
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return own.join(of_fp, "fp").select("doc_id", hexed, "component_id")
