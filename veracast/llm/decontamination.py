"""Benchmark decontamination: which documents contain a test item, by its five-word shingles."""

from __future__ import annotations

import math
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_stage, held, text_list, texts
from .word_hash import WordHashes, sequences

WIDTH = 5
LEAST = 0.8
#: Words of test items that are sent to the executors at a time; more items make more rounds.
ROUND_WORDS = 2_000_000
_BITS = 22


def _shingles(words: list[str]) -> set[tuple[str, ...]]:
    """The five-word sequences of a text; of a shorter text its whole word sequence."""
    if len(words) < WIDTH:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(WIDTH))))


def _hashes_of(flat: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text index and hash of every shingle."""
    sizes = np.diff(begins)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    found = sequences(flat, tuple(range(WIDTH)))
    whole = owner[: len(found)] == owner[WIDTH - 1 :][: len(found)]
    parts, of = [found[whole]], [owner[: len(found)][whole]]
    for n in range(1, WIDTH):  # texts of n words
        short = np.flatnonzero(sizes == n)
        if len(short):
            own = flat[begins[short][:, None] + np.arange(n)]
            parts.append(np.array([sequences(row, tuple(range(n)), n)[0] for row in own], np.uint64))
            of.append(short)
    return np.concatenate(of), np.concatenate(parts)


def needed(size: int) -> int:
    """Shingles that a document must share with an item of `size` shingles."""
    return math.ceil(LEAST * size - 1e-9)


class Items(NamedTuple):
    """Test items, and their keys in order, each with its item."""

    ids: list[int | None]
    shingles: list[set[tuple[str, ...]]]
    keys: np.ndarray
    item_of: np.ndarray


def build(rows: list[tuple[int | None, str]]) -> Items:
    """The MinHash keys of each item: its lowest shingle hashes.

    How many depends on the item's size, so items are treated by size and not by one common signature:
    a document that holds `needed(m)` of m shingles lacks at most m - needed(m), so one more than that
    always includes one that it holds. No containment of 0.8 is missed, however long the document is.
    """
    hashes = WordHashes()
    keep, keys, item_of = [], [], []
    for start, words, flat, begins in hashes.of([text for _, text in rows]):
        of, found = _hashes_of(flat[:, 0], begins)
        for k, own in enumerate(words):
            shingles = _shingles(own)
            if shingles:
                lowest = np.unique(found[of == k])[: len(shingles) - needed(len(shingles)) + 1]
                keys.append(lowest)
                item_of.append(np.full(len(lowest), len(keep)))
                keep.append((rows[start + k][0], shingles))
    all_keys = np.concatenate(keys) if keys else np.empty(0, np.uint64)
    order = np.argsort(all_keys, kind="stable")
    return Items([i for i, _ in keep], [s for _, s in keep], all_keys[order], (np.concatenate(item_of) if item_of else np.empty(0, np.int64))[order])


class Search:
    def __init__(self, items: Items):
        self.items = items
        self.maybe = np.zeros(1 << _BITS, bool)
        self.maybe[items.keys >> np.uint64(64 - _BITS)] = True

    def matches(self, values: list[str]) -> list[tuple[int, int | None, int, int]]:
        """(text index, item id, shared shingles, shingles of the item) of every pair that reaches the threshold."""
        items, out = self.items, []
        if not len(items.keys):
            return out
        for start, words, flat, begins in held(("decontamination",), WordHashes).of(values):
            of, found = _hashes_of(flat[:, 0], begins)
            near = np.flatnonzero(self.maybe[found >> np.uint64(64 - _BITS)])
            of, found = of[near], found[near]
            low, high = np.searchsorted(items.keys, found, "left"), np.searchsorted(items.keys, found, "right")
            pairs = {(int(of[k]), int(items.item_of[i])) for k in np.flatnonzero(high > low) for i in range(low[k], high[k])}
            last, own = -1, set()
            for text, item in sorted(pairs):
                if text != last:
                    last, own = text, _shingles(words[text])
                size = len(items.shingles[item])
                shared = len(items.shingles[item] & own)
                if shared >= needed(size):
                    out.append((start + text, items.ids[item], shared, size))
        return out


def find_items(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, n_shared, n_shingles, containment for every document that holds at least 0.8 of
    a test item's distinct five-word shingles, counted exactly.

    Words are runs of letters and digits in lower case. A text of fewer than five words has one
    shingle, its word sequence; one without words has none and matches nothing, a null text too.
    Repeated rows of either table give one pair. Each round sends a bounded number of words of test
    items to the executors; all documents are read in each. Empty tables give an empty result.
    """
    spark = docs.sparkSession
    items = texts(benchmark, key="item_id").withColumnRenamed("doc_id", "item_id").distinct()
    words = items.agg(F.sum(F.length("text") / 2)).first()[0] or 0
    rounds = max(1, math.ceil(words / ROUND_WORDS))
    numbered = items.withColumn("round", F.pmod(F.xxhash64("item_id"), F.lit(rounds)))
    found = []
    for k in range(rounds):
        part = [(r.item_id, r.text) for r in numbered.filter(F.col("round") == k).toLocalIterator()]
        sent = spark.sparkContext.broadcast(build(part))
        cell: list[Search] = []

        def work(batch: pa.RecordBatch, sent=sent, cell=cell) -> pa.RecordBatch:
            if not cell:
                cell.append(Search(sent.value))
            ids = batch.column("doc_id").to_pylist()
            rows = [(ids[t], item, shared, size, shared / size) for t, item, shared, size in cell[0].matches(text_list(batch.column("text")))]
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64())
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows) if rows else ((),) * 5, kinds)]
            return pa.RecordBatch.from_arrays(columns, ["doc_id", "item_id", "n_shared", "n_shingles", "containment"])

        found.append(arrow_stage(texts(docs), work, "doc_id long, item_id long, n_shared long, n_shingles long, containment double"))
    return reduce(DataFrame.unionByName, found).distinct()
