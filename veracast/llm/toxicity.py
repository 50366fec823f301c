"""Toxicity scores by an FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_column, arrow_stage, held, partition_stage, stored, text_list, texts
from .word_hash import WordHashes, mixed, owners, sequences

#: Labelled rows learnt from at most, by class; the bound of the one task that learns.
POSITIVES, NEGATIVES = 6_000, 10_000
#: A feature must be in so many of these documents; rare ones would only be remembered, not learnt.
LEAST_DOCUMENTS = 3
EPOCHS = 5
ALPHA, BETA, L1, L2 = 0.5, 1.0, 6.0, 1.0
#: First letters that stand for a word whatever its ending.
STEMS = (4, 5, 6)
THRESHOLD = 0.3
_FILTER_BITS = 24


def _hashes() -> WordHashes:
    return held(("toxicity",), lambda: WordHashes(stems=STEMS))


def _grams(hashes: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Text index and 32-bit feature of each word, word pair, pair with one word skipped, and word stem."""
    owner, flat = owners(begins), hashes[:, 0]
    kinds, texts_of = [], []
    for salt, steps in ((1, (0,)), (2, (0, 1)), (3, (0, 2))):
        found = sequences(flat, steps, salt)
        whole = owner[: len(found)] == owner[max(steps) :][: len(found)]
        kinds.append(found[whole])
        texts_of.append(owner[: len(found)][whole])
    for k in range(1, hashes.shape[1]):
        long_enough = hashes[:, k] != 0
        kinds.append(sequences(hashes[:, k][long_enough], (0,), 3 + k))
        texts_of.append(owner[long_enough])
    return np.concatenate(texts_of), (mixed(np.concatenate(kinds)) >> np.uint64(32)).astype(np.uint32)


class Model(NamedTuple):
    """The features with a weight, in order, and the bias."""

    features: np.ndarray
    weights: np.ndarray
    bias: float


def learn(rows: list[tuple[int, np.ndarray]]) -> Model:
    """FTRL-proximal over (label, distinct features) rows in the order given.

    Each coordinate has its own rate, which falls with the squares of its gradients; the L1 part keeps
    a weight at exactly zero until its evidence is larger than that.
    """
    vocabulary = []
    for part in range(16):  # by the top bits, so that one part of the features is sorted at a time
        own = [f[(f >> 28) == part] for _, f in rows]
        values, counts = np.unique(np.concatenate(own) if own else np.empty(0, np.uint32), return_counts=True)
        vocabulary.append(values[counts >= LEAST_DOCUMENTS])
    features = np.concatenate(vocabulary)
    z, n = np.zeros(len(features) + 1), np.zeros(len(features) + 1)

    def weights(at: np.ndarray) -> np.ndarray:
        own = z[at]
        strength = (BETA + np.sqrt(n[at])) / ALPHA + L2
        return np.where(np.abs(own) > L1, -(own - np.sign(own) * L1) / strength, 0.0)

    indexed = []
    for label, own in rows:
        at = np.searchsorted(features, own)
        known = at[np.flatnonzero(features[np.minimum(at, len(features) - 1)] == own)] if len(features) else at[:0]
        indexed.append((label, np.append(known, len(features))))  # the last place is the bias
    for _ in range(EPOCHS):
        for label, at in indexed:
            w = weights(at)
            p = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35)))
            g = p - label
            rate = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / ALPHA
            z[at] += g - rate * w
            n[at] += g * g
    final = weights(np.arange(len(z)))
    kept = np.flatnonzero(final[:-1])
    return Model(features[kept], final[kept], float(final[-1]))


def labelled_sample(labels: DataFrame) -> DataFrame:
    """(doc_id, label, place): rows to learn from, the first of each class in the order of a hash of
    the id, so many at most, with the number of all such rows. Held-out ids (crc32 of the id as text, remainder 2 by 4) are left out;
    of several labels of an id the highest counts, null labels and ids do not."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("label"))
    known = known.filter("doc_id IS NOT NULL AND label IN (0, 1)").groupBy("doc_id").agg(F.max("label").alias("label"))
    known = known.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2).withColumn("place", F.xxhash64("doc_id"))
    first = [known.filter(F.col("label") == y).orderBy("place", "doc_id").limit(n) for y, n in ((1, POSITIVES), (0, NEGATIVES))]
    totals = known.groupBy("label").agg(F.count(F.lit(1)).alias("of_all"))
    # The classes are mixed anew: the order of choice would put what one class has more of at the end.
    chosen = first[0].unionByName(first[1]).withColumn("place", F.xxhash64(F.lit("order"), F.col("doc_id")))
    return chosen.join(F.broadcast(totals), "label")


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """The model learnt from the labelled sample: features are hashed where the texts are, one task learns."""
    # At most POSITIVES + NEGATIVES ids, so this side may be sent to every executor.
    rows = texts(docs).join(F.broadcast(labelled_sample(labels)), "doc_id").select("doc_id", "label", "place", "of_all", "text")

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        found: list[np.ndarray] = []
        for _, words, flat, begins in _hashes().of(text_list(batch.column("text"))):
            owner, own = _grams(flat, begins)
            order = np.argsort(owner, kind="stable")
            parts = np.split(own[order], np.searchsorted(owner[order], np.arange(1, len(words))))
            found += [np.unique(p) for p in parts]
        lists = pa.array([f.view(np.int32) for f in found], pa.list_(pa.int32()))
        return pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("label", "place", "doc_id", "of_all")), lists], ["label", "place", "doc_id", "of_all", "features"])

    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, of_all = [], {0: 0, 1: 0}
        for batch in batches:
            lists = batch.column("features")
            values, offsets = lists.values.to_numpy().view(np.uint32), lists.offsets.to_numpy()
            for k, (label, place, doc, total) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("label", "place", "doc_id", "of_all")))):
                of_all[label] = total
                rows.append((place, doc, label, values[offsets[k] : offsets[k + 1]].copy()))
        rows.sort(key=lambda r: r[:2])
        # A repeated document is learnt once.
        unique = [r for k, r in enumerate(rows) if k == 0 or r[:2] != rows[k - 1][:2]]
        model = learn([(label, f) for _, _, label, f in unique])
        seen = [len(unique), sum(r[2] for r in unique)]
        bias = model.bias
        if 0 < seen[1] < seen[0]:  # the sample's odds give way to those of all labels
            bias += np.log((of_all[1] / of_all[0]) / (seen[1] / (seen[0] - seen[1])))
        columns = [np.concatenate([model.features.astype(np.int64), [-1, -2, -3]]), np.concatenate([model.weights, [bias, *map(float, seen)]])]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["feature", "weight"])

    hashed = stored(arrow_stage(rows, features, "label int, place long, doc_id long, of_all long, features array<int>"), "toxicity-sample")
    weights = partition_stage(hashed.coalesce(1), one, "feature long, weight double").toPandas()
    known = weights[weights.feature >= 0].sort_values("feature")
    extra = dict(zip(weights.feature, weights.weight))
    if extra.get(-3, 0) in (0, extra.get(-2, 0)):  # no labels, or one class only: its share is the score
        share = extra.get(-3, 0.0) / max(extra.get(-2, 0.0), 1.0)
        return Model(np.empty(0, np.uint32), np.empty(0), float("inf") if share else float("-inf"))
    return Model(known.feature.to_numpy().astype(np.uint32), known.weight.to_numpy(), extra[-1])


class Scorer:
    """A bit table tells most features without a weight from those that may have one."""

    def __init__(self, model: Model):
        self.model = model
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[model.features >> np.uint32(32 - _FILTER_BITS)] = True

    def scores(self, values: list[str]) -> np.ndarray:
        out = np.empty(len(values))
        for start, words, flat, begins in _hashes().of(values):
            owner, own = _grams(flat, begins)
            hit = np.flatnonzero(self.maybe[own >> np.uint32(32 - _FILTER_BITS)])
            pairs = np.unique((owner[hit].astype(np.uint64) << np.uint64(32)) | own[hit].astype(np.uint64))
            feature = (pairs & np.uint64(0xFFFFFFFF)).astype(np.uint32)
            at = np.minimum(np.searchsorted(self.model.features, feature), max(len(self.model.features) - 1, 0))
            weight = np.where(self.model.features[at] == feature, self.model.weights[at], 0.0) if len(feature) else np.empty(0)
            total = self.model.bias + np.bincount((pairs >> np.uint64(32)).astype(np.int64), weight, len(words))
            with np.errstate(over="ignore"):  # a score beyond the range of exp is 0
                out[start : start + len(words)] = 1 / (1 + np.exp(-total))
        return out


def _score_of(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """Scores of a text column. The model's size is bounded by the labelled sample."""
    sent = spark.sparkContext.broadcast(model)
    cell: list[Scorer] = []

    def work(values: pa.Array) -> pa.Array:
        if not cell:
            cell.append(Scorer(sent.value))
        return pa.array(cell[0].scores(text_list(values)))

    return arrow_column(spark, work, "double")


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted for each row's whole text.

    A null or empty text has no features and gets the bias alone. Every input row gives one row,
    repeated ids too; a null doc_id is not held out. Without labels of both classes the score is
    1.0 if the known ones are toxic and else 0.0. An empty table gives an empty result.
    """
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))
    scored = texts(docs).select("doc_id", held_out.alias("held_out"), _score_of(docs.sparkSession, model)(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, as they are, whose text is not predicted to be toxic. No row moves to another
    task, and only its text goes to the Python worker."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"))
    text = F.coalesce(F.col("document.text").cast("string"), F.lit(""))
    scored = whole.withColumn("score", _score_of(docs.sparkSession, model)(text))
    return scored.filter(F.col("score") < threshold).select("document.*")
