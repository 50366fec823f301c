"""Importance resampling towards a target: hashed n-grams whose checksums come from running prefix CRCs."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veracast.operators.keyed import global_rank

from .common import arrow_stage, byte_list, partition_stage, stored, texts
from .word_hash import owners

_FULL = np.uint32(0xFFFFFFFF)
_POLYNOMIAL = 0xEDB88320
#: Digits, letters and every byte of a character beyond ASCII stay (A-Z as a-z); all else separates words.
_NORMAL = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Shift:
    """What zero bytes do to a CRC register, a linear map over GF(2): one map for each power of two of
    their number, applied by its bytes. crc(b) = crc(ab) ^ shift(crc(a), bytes of b)."""

    def __init__(self) -> None:
        step = [c >> 1 ^ (_POLYNOMIAL if c & 1 else 0) for c in (1 << k for k in range(32))]  # one zero bit
        for _ in range(3):
            step = self._twice(step)
        self.columns, self.tables = [step], [self._table(step)]

    @staticmethod
    def _apply(columns: list[int], value: int) -> int:
        out = 0
        for k in range(32):
            if value >> k & 1:
                out ^= columns[k]
        return out

    def _twice(self, columns: list[int]) -> list[int]:
        return [self._apply(columns, c) for c in columns]

    def _table(self, columns: list[int]) -> np.ndarray:
        return np.array([[self._apply(columns, b << 8 * k) for b in range(256)] for k in range(4)], np.uint32)

    def __call__(self, crcs: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        out = crcs.copy()
        for k in range(int(sizes.max(initial=0)).bit_length()):
            if k == len(self.tables):
                self.columns.append(self._twice(self.columns[-1]))
                self.tables.append(self._table(self.columns[-1]))
            at = np.flatnonzero(sizes >> k & 1)
            out[at] = self.step(k, out[at])
        return out

    def step(self, k: int, v: np.ndarray) -> np.ndarray:
        """The registers after 2 to the k zero bytes."""
        a, b, c, d = self.tables[k]
        return a[v & 255] ^ b[v >> np.uint32(8) & 255] ^ c[v >> np.uint32(16) & 255] ^ d[v >> np.uint32(24)]


_SHIFT: list[Shift] = []


def shift() -> Shift:
    if not _SHIFT:
        _SHIFT.append(Shift())
    return _SHIFT[0]


class Prefixes:
    """Texts normalised to words with one space between, each scanned once: the running CRC at every
    word's begin and end, from which the CRC of any run of words follows."""

    def __init__(self, values: list[bytes]):
        words = [v.translate(_NORMAL).split() for v in values]
        crc = zlib.crc32
        # A space stands before each word, the first as well: what comes before a run cancels out.
        ends = [list(accumulate(own, lambda c, w: crc(w, crc(b" ", c)), initial=0)) for own in words]
        counts = np.fromiter(map(len, words), np.int64, len(words))
        self.begins = np.concatenate([[0], np.cumsum(counts)])
        size = int(self.begins[-1])
        self.end_crc = np.fromiter(chain.from_iterable(e[1:] for e in ends), np.uint32, size)
        before = np.fromiter(chain.from_iterable(e[:-1] for e in ends), np.uint32, size) ^ _FULL
        self.begin_crc = shift().step(0, before ^ np.uint32(32)) ^ _FULL
        self.widths = np.fromiter((len(w) for own in words for w in own), np.int64, size)
        self.place = np.cumsum(self.widths + 1)  # end of each word, all texts in a row
        self.owner = owners(self.begins)

    def runs(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Text index and CRC of every run of n consecutive words of one text, joined by one space."""
        first = np.arange(max(len(self.owner) - n + 1, 0))
        first = first[self.owner[first] == self.owner[first + n - 1]]
        last = first + n - 1
        size = self.place[last] - self.place[first] + self.widths[first]
        return self.owner[first], self.end_crc[last] ^ shift()(self.begin_crc[first], size)


def feature_buckets(values: list[bytes], shortest: int, longest: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text index and bucket of every feature, and the number of words of each text."""
    found = Prefixes(values)
    kinds = [found.runs(n) for n in range(shortest, longest + 1)]
    return np.concatenate([k[0] for k in kinds]), np.concatenate([k[1] for k in kinds]) % np.uint32(buckets), np.diff(found.begins)


def bucket_counts(docs: DataFrame, shortest: int, longest: int, buckets: int) -> np.ndarray:
    """Features of all texts by bucket. Every partition sends its own counts, so many rows at most; so many come back."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for values in _blocks(byte_list(batch.column("text"))):
                total += np.bincount(feature_buckets(values, shortest, longest, buckets)[1], minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["bucket", "n"])

    own = docs.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    sums = partition_stage(own, count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(buckets, np.int64)
    out[sums.bucket.to_numpy(np.int64)] = sums.n.to_numpy(np.int64)
    return out


def _blocks(values: list[bytes], size: int = 1 << 21) -> Iterator[list[bytes]]:
    """Texts that together have about so many bytes."""
    own, total = [], 0
    for value in values:
        own.append(value)
        total += len(value)
        if total >= size:
            yield own
            own, total = [], 0
    if own:
        yield own


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of a bucket's smoothed shares in target and source, rounded down."""
    buckets, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    ratios = [(float(t) + 1) * (all_source + buckets) / ((float(s) + 1) * (all_target + buckets)) for s, t in zip(source, target)]
    return np.array([math.floor(1000 * math.log(r)) for r in ratios], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, shortest: int, longest: int) -> DataFrame:
    """doc_id, n_words, n_features, weight of each row. `gain` has one number for each bucket."""
    sent = docs.sparkSession.sparkContext.broadcast(gain)  # as long as the number of buckets

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for values in _blocks(byte_list(batch.column("text"))):
            owner, bucket, n_words = feature_buckets(values, shortest, longest, len(sent.value))
            n_features, weight = np.bincount(owner, minlength=len(values)), np.zeros(len(values), np.int64)
            np.add.at(weight, owner, sent.value[bucket])
            found.append((n_words, n_features, weight))
        columns = [pa.array(np.concatenate([f[k] for f in found]) if found else np.empty(0, np.int64)) for k in range(3)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "n_words", "n_features", "weight"])

    return arrow_stage(texts(docs), work, "doc_id long, n_words long, n_features long, weight long")


def noise(seed: str) -> Column:
    """Thousandths of a Gumbel draw fixed by seed and doc_id, rounded down; a null id is an empty text."""
    own = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(own, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, shortest: int = 1, longest: int = 1, buckets: int = 10_000, percent: int = 10, least_words: int = 20, seed: str = "2024"
) -> DataFrame:
    """doc_id, n_features, weight, score, rank: `percent` of the documents with at least `least_words`
    words are drawn, without repetition and in proportion to how much likelier the target makes them.

    Words are runs of digits, letters a-z (A-Z are lower-cased) and characters beyond ASCII. Features are all runs of `shortest` to `longest`
    words, repeats counted, hashed to `buckets` by CRC-32. A document's weight is the sum of its
    features' gains, its score the weight with Gumbel noise; the highest scores are drawn and ranked
    from 1, ties to the smaller doc_id (null last, then more features). Other documents have a null rank.
    A null or empty text has no features and weight 0. Every input row gives one row, repeated ids too; they share the noise.
    An empty target gives each bucket the share 1 / buckets; an empty table gives an empty result.
    """
    gain = gains(bucket_counts(docs, shortest, longest, buckets), bucket_counts(target, shortest, longest, buckets))
    weighed = weigh(docs, gain, shortest, longest)
    scored = stored(weighed.withColumn("score", F.col("weight") + noise(seed)).withColumn("row", F.monotonically_increasing_id()), "resampling")
    enough = F.col("n_words") >= least_words
    drawn = percent * scored.filter(enough).count() // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("n_features").desc(), F.col("row")]
    ranked = global_rank(scored.filter(enough).select(*columns, "row"), order, "place")
    rank = F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    return ranked.select(*columns, rank).unionByName(scored.filter(~enough).select(*columns, F.lit(None).cast("long").alias("rank")))
