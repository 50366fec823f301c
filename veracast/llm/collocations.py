"""Phrases whose words occur together: counts of all phrases in weighted acyclic automata, cut by prefix ranges."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from itertools import chain, groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import phrase_automata as automata
from .common import byte_list, partition_stage, returning_memory, stored
from .phrase_automata import Automaton, Walk
from .word_hash import mixed, sequences

#: Words of the longest phrase.
LONGEST = 4
#: Distinct phrases that a shard gathers before it builds its automata from them.
RUN_ROWS = 400_000
#: Bits of the table that tells frequent phrases from most others; the bound of what is broadcast.
FILTER_BITS = 26
#: Documents from which the borders of the ranges come, and paths from each.
SAMPLED, PATHS = 2_000, 64
#: Letters A-Z become a-z, a tab becomes a space, and all that parts pieces a line break.
_CLEAN = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))
Path = tuple[bytes, ...]


def pieces_of(texts: Iterable[bytes]) -> list[list[bytes]]:
    """Words of every piece of the texts."""
    # All white space of ASCII is a space or a line break by now, so a plain split parts words at spaces only.
    return [words for p in b"\n".join(texts).translate(_CLEAN).split(b"\n") if (words := p.split())]


def cut(texts: list[bytes]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct words, the place there of every word of all pieces, and the number of words of each piece."""
    whole = pa.array([b"\n".join(texts).translate(_CLEAN)], pa.binary())
    pieces = pc.split_pattern(pc.split_pattern(whole, b"\n").flatten(), b" ")
    words = pieces.flatten()
    real = pc.not_equal(words, b"")  # two spaces in a row have an empty word between them
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False))])
    sizes = np.diff(before[pieces.offsets.to_numpy()]).astype(np.int32)
    known = words.filter(real).dictionary_encode()
    return known.dictionary, known.indices.to_numpy().astype(np.int32), sizes[sizes > 0]


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def phrase_hashes(hashes: np.ndarray, n: int, lang: bytes) -> np.ndarray:
    """A hash of the n words from each place on."""
    return mixed(sequences(hashes, tuple(range(n))) ^ np.uint64(xxhash.xxh64_intdigest(lang)))


class Filter:
    """A table of bits that holds all frequent phrases of one length and few others: it saves work and decides nothing."""

    def __init__(self, bits: np.ndarray):
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        place = hashes >> np.uint64(64 - FILTER_BITS)
        return (self.bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63)) & np.uint64(1)).astype(bool)


class Run:
    """The phrases of n words that a shard has met, by language, until it builds its automata."""

    def __init__(self, n: int, borders: list[Path], passing: Filter | None):
        self.n, self.borders, self.passing = n, borders, passing
        self.labels: dict[bytes, int] = {}
        self.paths: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.rows = 0

    def add(self, lang: bytes, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        """Pieces of `sizes` words each, the words by their places in `words`."""
        if self.n == 1:
            counts = np.bincount(ids, minlength=len(words))
            paths = np.arange(len(words))[:, None]
        else:
            at = np.arange(max(len(ids) - self.n + 1, 0))
            if len(at):
                shorter = self.passing.has(phrase_hashes(word_hashes(words)[ids], self.n - 1, lang))
                owner = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
                at = at[shorter[at] & shorter[at + 1] & (owner[at] == owner[at + self.n - 1])]
            code = automata.order_codes([ids[at + k] for k in range(self.n)], len(words))
            _, place, counts = np.unique(code, return_index=True, return_counts=True)
            paths = ids[at[place][:, None] + np.arange(self.n)]
        if not len(paths):
            return
        used = np.unique(paths)
        label = np.zeros(len(words), np.int32)
        label[used] = [self.labels.setdefault(words[k], len(self.labels)) for k in used.tolist()]
        first = np.full((len(paths), 1), self.labels.setdefault(lang, len(self.labels)), np.int32)
        self.paths.append(np.concatenate([first, label[paths]], axis=1))
        self.counts.append(counts)
        self.rows += len(paths)

    def built(self) -> Iterator[pa.RecordBatch]:
        """The sorted phrases as one automaton for each range, and the run begins anew."""
        if self.rows:
            words = sorted(self.labels)
            rank = np.zeros(len(words), np.int32)
            rank[[self.labels[w] for w in words]] = np.arange(len(words))
            paths, counts = automata.summed(rank[np.concatenate(self.paths)], np.concatenate(self.counts), len(words))
            cut = [0, *(first_from(paths, words, b) for b in self.borders), len(paths)]
            made = []
            for number, (begin, end) in enumerate(zip(cut[:-1], cut[1:])):
                if begin < end:
                    own, part = automata.only_used(words, paths[begin:end])
                    made.append((number, automata.minimal(automata.trie_of(own, part, counts[begin:end], totals=self.n == 1))))
            yield batch_of([(number, -1, a) for number, a in made])
        self.labels, self.paths, self.counts, self.rows = {}, [], [], 0


def first_from(paths: np.ndarray, words: list[bytes], border: Path) -> int:
    """The first of the sorted paths that does not come before the border."""
    low, high = 0, len(paths)
    while low < high:
        middle = (low + high) // 2
        if tuple(words[k] for k in paths[middle, :3].tolist()) < border:
            low = middle + 1
        else:
            high = middle
    return low


def batch_of(rows: list[tuple[int, int, Automaton]]) -> pa.RecordBatch:
    numbers = [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int32())]
    return pa.RecordBatch.from_arrays([*numbers, *automata.to_arrays([r[2] for r in rows])], ["range", "asker", *automata.NAMES])


SCHEMA = f"range int, asker int, {automata.COLUMNS}"


def borders_of(docs: DataFrame, ranges: int) -> list[Path]:
    """Borders between so many prefix ranges, from the phrases of a bounded sample of documents. They set sizes, not results."""
    share = min(1.0, SAMPLED / max(docs.count(), 1))
    sample = docs.withColumn("place", F.monotonically_increasing_id()).filter(F.pmod(F.xxhash64("place", F.length("text")), F.lit(1 << 30)) < int(share * (1 << 30)))

    def paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for lang, text in zip(byte_list(batch.column("lang")), byte_list(batch.column("text"))):
                pairs = [(lang, a, b) for p in pieces_of([text]) for a, b in zip(p, p[1:])]
                out += pairs[:: max(1, -(-len(pairs) // PATHS))]
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.binary()) for k in range(3)], ["a", "b", "c"])

    found = partition_stage(sample.select("lang", "text"), paths, "a binary, b binary, c binary").limit(2 * SAMPLED * PATHS).collect()
    known = sorted({tuple(map(bytes, r)) for r in found})
    return sorted({known[k * len(known) // ranges] for k in range(1, ranges)}) if known else []


def encoded(docs: DataFrame) -> DataFrame:
    """lang, words, ids, sizes: texts of one language cut into words once, some megabytes a row. `words` are the distinct
    ones by line breaks, `ids` their places there for all pieces in a row, `sizes` the words of each piece (32-bit numbers)."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, texts in by_language(batch):
                words, ids, sizes = cut(texts)
                columns = [pa.array([x], pa.binary()) for x in (lang, b"\n".join(words.to_pylist()), ids.tobytes(), sizes.tobytes())]
                yield pa.RecordBatch.from_arrays(columns, ["lang", "words", "ids", "sizes"])

    return stored(partition_stage(docs, encode, "lang binary, words binary, ids binary, sizes binary"), "phrase-words")


def shards(words: DataFrame, n: int, borders: list[Path], passing: Filter | None) -> DataFrame:
    """Automata of the phrases of n words of every partition of `encoded` texts, by range."""
    sent = words.sparkSession.sparkContext.broadcast((borders, passing.bits if passing else None))  # both of bounded size

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut, bits = sent.value
        run = Run(n, cut, Filter(bits) if bits is not None else None)
        for batch in batches:
            for k in range(batch.num_rows):
                lang, known, ids, sizes = (batch.column(c)[k].as_py() for c in ("lang", "words", "ids", "sizes"))
                run.add(lang, known.split(b"\n"), np.frombuffer(ids, np.int32), np.frombuffer(sizes, np.int32))
                if run.rows >= RUN_ROWS:
                    yield from run.built()
        yield from run.built()

    return partition_stage(words, build, SCHEMA)


def by_language(batch: pa.RecordBatch, size: int = 2 << 20) -> Iterator[tuple[bytes, list[bytes]]]:
    """Texts of one language, some megabytes at a time."""
    held: dict[bytes, list[bytes]] = {}
    sizes: dict[bytes, int] = {}
    for lang, text in zip(byte_list(batch.column("lang")), byte_list(batch.column("text"))):
        held.setdefault(lang, []).append(text)
        sizes[lang] = sizes.get(lang, 0) + len(text)
        if sizes[lang] >= size:
            yield lang, held.pop(lang)
            del sizes[lang]
    yield from held.items()


def by_range(df: DataFrame) -> DataFrame:
    """All rows of a range one after the other, its own automaton (asker -1) first."""
    return df.repartition("range").sortWithinPartitions("range", "asker")


def range_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Iterator[tuple[int, Automaton]]]]:
    def rows() -> Iterator[tuple[int, int, Automaton]]:
        for batch in batches:
            yield from zip(batch.column("range").to_pylist(), batch.column("asker").to_pylist(), automata.from_batch(batch))

    for number, own in groupby(rows(), key=lambda r: r[0]):
        yield number, ((asker, a) for _, asker, a in own)


def union_of(own: Iterable[Automaton], most: int = 1 << 19) -> automata.Trie:
    """The union of any number of automata, some at a time."""
    waiting: list[Automaton] = []
    size = 0
    for a in own:
        waiting.append(a)
        size += len(a.label)
        if size > most and len(waiting) > 1:
            waiting = [automata.minimal(automata.united(waiting))]
            size = len(waiting[0].label) // 2  # what is united already does not fill the next round at once
    return automata.united(waiting)


def frequent(parts: DataFrame, n: int, least: int) -> DataFrame:
    """Per range the union of its automata, weights summed, without phrases that occur less often than `least`."""

    def unite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in range_rows(batches):
            kept = automata.pruned(union_of(a for _, a in rows), n + 1, least)
            yield batch_of([(number, -1, automata.minimal(kept))])

    return stored(partition_stage(by_range(parts), unite, SCHEMA), f"phrases-{n}")


def filter_of(found: DataFrame, n: int) -> Filter:
    """The bits of all phrases of n words in `found`."""

    def slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = [np.zeros(0, np.uint64)]
            for a in automata.from_batch(batch):
                trie = automata.united([a])
                paths, words = automata.paths_of(trie, n + 1), word_hashes(trie.words)
                for lang in np.unique(paths[:, 0]).tolist():
                    own = words[paths[paths[:, 0] == lang, 1:]]
                    hashes.append(phrase_hashes(own.reshape(-1), n, trie.words[lang])[::n])
            place = np.concatenate(hashes) >> np.uint64(64 - FILTER_BITS)
            bits = np.uint64(1) << (place & np.uint64(63))
            yield pa.RecordBatch.from_arrays([pa.array((place >> np.uint64(6)).astype(np.int64)), pa.array(bits.view(np.int64))], ["slot", "bits"])

    rows = partition_stage(found, slots, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits")).toPandas()
    table = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    table[rows.slot.to_numpy(np.int64)] = rows.bits.to_numpy(np.int64).view(np.uint64)
    return Filter(table)


def part_requests(found: DataFrame, borders: list[Path]) -> DataFrame:
    """Per range its automaton of all lengths (asker -1), and for each range that holds a part of its phrases the
    automaton of those parts, weights 0. A range asks for a part once, however many of its phrases have it."""
    sent = found.sparkSession.sparkContext.broadcast(borders)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in range_rows(batches):
            trie = union_of(a for _, a in rows)
            asked: dict[int, list[Automaton]] = {}
            for length in range(1, LONGEST):
                pieces = [np.zeros((0, length + 1), np.int64)]
                for n in range(length + 1, LONGEST + 1):
                    paths = automata.paths_of(trie, n + 1)
                    pieces += [paths[:, : length + 1], np.concatenate([paths[:, :1], paths[:, n - length + 1 :]], axis=1)]
                wanted = np.concatenate(pieces)
                wanted, _ = automata.summed(wanted, np.zeros(len(wanted), np.int64), len(trie.words))
                home = [bisect_right(sent.value, tuple(trie.words[k] for k in p)) for p in wanted[:, :3].tolist()]
                edges = np.flatnonzero(np.diff(home, prepend=-1, append=-1))
                for begin, end in zip(edges[:-1].tolist(), edges[1:].tolist()):
                    words, own = automata.only_used(trie.words, wanted[begin:end])
                    asked.setdefault(home[begin], []).append(automata.minimal(automata.trie_of(words, own, np.zeros(end - begin, np.int64))))
            yield batch_of([(number, -1, automata.minimal(trie))] + [(h, number, automata.minimal(automata.united(a))) for h, a in asked.items()])

    return stored(partition_stage(by_range(found), ask, SCHEMA), "phrase-parts")


def part_counts(asked: DataFrame) -> DataFrame:
    """The answers: the parts' automata composed with the counts of the range that holds them, back to who asked."""

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number, rows in range_rows(batches):
            counts: Walk | None = None
            for asker, a in rows:
                if asker < 0:
                    counts = Walk(a)
                else:
                    held = counts or Walk(automata.minimal(automata.Trie([], [])))
                    yield batch_of([(asker, number, automata.composed(a, held))])

    return partition_stage(by_range(asked), answer, SCHEMA)


def scored(own: DataFrame, answers: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, score of every candidate by its lowest cut, and (phrase null) each range's share of a language's words as a."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in range_rows(batches):
            trie, replies = None, []
            for asker, a in rows:
                if asker < 0:
                    trie = automata.united([a])
                else:
                    replies.append(a)
            if trie is None or not trie.layers:
                continue
            parts = Walk(automata.minimal(union_of(replies)))
            known = parts.labels_of(trie.words)
            top = trie.layers[0]
            out = [(trie.words[k], None, 0, a, None, None, None) for k, a in zip(top.label.tolist(), top.weight.tolist())]
            for n in range(2, LONGEST + 1):
                paths = automata.paths_of(trie, n + 1)
                if not len(paths):
                    continue
                cuts = []
                for k in range(1, n):
                    rest = np.concatenate([paths[:, :1], paths[:, k + 1 :]], axis=1)
                    cuts.append((parts.weights(known[paths[:, : k + 1]]).tolist(), parts.weights(known[rest]).tolist()))
                for row, (path, a) in enumerate(zip(paths.tolist(), trie.layers[n].weight.tolist())):
                    # Whole numbers without bound; of equal scores min takes the first cut.
                    best, _, l, r = min((2_000_000 * a // (left[row] + right[row]), k, left[row], right[row]) for k, (left, right) in enumerate(cuts))
                    out.append((trie.words[path[0]], b" ".join(trie.words[k] for k in path[1:]), n, a, l, r, best))
            kinds = [pa.binary(), pa.binary(), pa.int32(), *[pa.int64()] * 4]
            yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], kind) for k, kind in enumerate(kinds)], ["lang", "phrase", "size", "a", "l", "r", "score"])

    rows = partition_stage(by_range(own.unionByName(answers)), score, "lang binary, phrase binary, size int, a long, l long, r long, score long")
    return rows.withColumn("lang", F.unhex(F.col("lang").cast("string")).cast("string")).withColumn("phrase", F.col("phrase").cast("string"))


def undominated(candidates: DataFrame, percent: int) -> DataFrame:
    """Candidates of which no longer one that holds them has `percent` of their count."""
    words = F.split("phrase", " ")
    inner = F.flatten(
        F.transform(
            F.sequence(F.lit(2), F.col("size") - 1),
            lambda n: F.transform(F.sequence(F.lit(1), F.col("size") - n + 1), lambda at: F.array_join(F.slice(words, at, n), " ")),
        )
    )
    longer = candidates.filter("size > 2").select("lang", F.explode(inner).alias("phrase"), F.col("a").alias("of_longer"))
    most = longer.groupBy("lang", "phrase").agg(F.max("of_longer").alias("of_longer"))
    whole = "decimal(38,0)"
    held = F.coalesce(F.col("of_longer").cast(whole) * F.lit(100).cast("decimal(9,0)") >= F.col("a").cast(whole) * F.lit(percent).cast("decimal(9,0)"), F.lit(False))
    return candidates.join(most, ["lang", "phrase"], "left").filter(~held)


def first_of_each(rows: DataFrame, limit: int, parts: int) -> DataFrame:
    """rank 1, 2 ... up to `limit` within each language; a large one is cut down in parts first."""
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
    first = rows.withColumn("rank", F.row_number().over(some)).filter(F.col("rank") <= limit).drop("rank")
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(F.col("rank") <= limit)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def collocations(docs: DataFrame, least: int = 30, percent: int = 80, limit: int = 2000, ranges: int | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's phrases of 2 to 4 words that score highest.

    A-Z are lower-cased; `.,;:!?` and line breaks part pieces, spaces and tabs words. a, l and r are the
    counts of the phrase and of its two parts by the cut that scores lowest (of equal ones the first), n is the number of words of
    the language. Phrases that occur at least `least` times are candidates; those are dropped which a longer candidate holds with
    `percent` of their count. A null language is `und`, a null text is empty; repeated rows count as
    often as they stand there; ids play no part. An empty table, or one without candidates, gives an empty result.

    Phrases of n words are counted after those of n - 1: a phrase can only be frequent if both shorter
    ones inside it are, which a table of bits of fixed size tells (what slips through is counted and then dropped).
    Texts are cut into words once. Every partition builds automata of its sorted phrases, cut by prefix ranges; a range unites them.
    """
    returning_memory(docs.sparkSession)
    # As hexadecimal digits a language has no line break, whatever it is.
    lang = F.hex(F.coalesce(F.col("lang").cast("string"), F.lit("und")).cast("binary"))
    clean = docs.select(lang.alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    borders = borders_of(clean, ranges or 2 * partitions(docs.sparkSession))
    words = encoded(clean)
    found: DataFrame | None = None
    passing: Filter | None = None
    for n in range(1, LONGEST + 1):
        now = frequent(shards(words, n, borders, passing), n, least)
        found = now if found is None else found.unionByName(now)
        passing = filter_of(now, n) if n < LONGEST else None
    asked = part_requests(found, borders)
    rows = stored(scored(asked.filter("asker < 0"), part_counts(asked)), "phrase-scores")
    totals = rows.filter("phrase IS NULL").groupBy("lang").agg(F.sum("a").alias("n"))
    kept = undominated(rows.filter("phrase IS NOT NULL"), percent)
    first = first_of_each(kept, limit, partitions(docs.sparkSession))
    return first.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
