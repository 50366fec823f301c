"""Windows of fixed length that occur more than once: sampled suffixes in sorted order, and their windows.

Both removers of repeated passages share what is here. A text is a sequence of units (bytes or words).
Every window of `width` units has an anchor, chosen by the window's content alone, so equal windows have
it at the same place. A suffix begins at each anchor; it stands for a run of neighbouring windows:

- `core` names the leading units that all windows of the anchor share, whatever surrounds them;
- `full` names the whole stretch that the run of windows covers.

Equal windows therefore lie in suffixes of one core. Suffixes of the same full stretch agree in all their
windows at once; only cores with different stretches need their windows looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import arrow_stage, byte_list, partition_stage, stored
from .rolling import Rolling

SUFFIX = "core long, full long, key_id long, tie int, at long"
#: Suffixes that one bucket sorts, about.
BUCKET_ROWS = 400_000
#: Suffixes of one core whose windows one task compares; windows of larger cores are aggregated one by one.
CORE_ROWS = 4096
_LEAF = 1 << 13
_FIRST_CORE, _LAST_CORE, _FIRST_FULL, _LAST_FULL, _FIRST_ROW = 1, 2, 4, 8, 16


def keyed(df: DataFrame) -> DataFrame:
    """(doc_id, text) with a key that is never null: the id and a number of the text, for rows that
    share an id. Rows alike in both are one document."""
    lowest = F.lit(-(1 << 63)).cast("long")
    return df.select("doc_id", "text", F.coalesce("doc_id", lowest).alias("key_id"), F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int").alias("tie"))


def suffix_batch(batch: pa.RecordBatch, parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """The suffixes found in a batch: parts are (text index, core, full, first window, last window)."""
    of, core, full, low, high = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64),) * 5
    key_id, tie = (batch.column(c).to_numpy()[of] for c in ("key_id", "tie"))
    columns = [core.astype(np.uint64).view(np.int64), full.astype(np.uint64).view(np.int64), key_id, tie, (low << 8) | (high - low)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["core", "full", "key_id", "tie", "at"])


def multikey_quicksort(columns: list[np.ndarray]) -> np.ndarray:
    """The order of rows by their columns: split in three by a pivot of the first column; the rows equal
    to it go on with the next one. Small parts are sorted directly."""
    out = np.empty(len(columns[0]), np.int64)
    work = [(np.arange(len(columns[0])), 0, 0)]
    while work:
        rows, depth, begin = work.pop()
        if depth == len(columns) or len(rows) <= 1:
            out[begin : begin + len(rows)] = rows
        elif len(rows) <= _LEAF:
            out[begin : begin + len(rows)] = rows[np.lexsort([c[rows] for c in reversed(columns[depth:])])]
        else:
            own = columns[depth][rows]
            pivot = np.sort(own[:: max(1, len(own) // 63)])[len(own[:: max(1, len(own) // 63)]) // 2]
            less, more = own < pivot, own > pivot
            low, same, high = rows[less], rows[~(less | more)], rows[more]
            work += [(low, depth, begin), (same, depth + 1, begin + len(low)), (high, depth, begin + len(low) + len(same))]
    return out


def _bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One bucket of the range partitioning: sorted, neighbours compared; lone suffixes inside it are left out."""
    names = ["core", "full", "key_id", "tie", "at"]
    held = [[b.column(c).to_numpy() for c in names] for b in batches]
    if not held:
        return
    columns = [np.concatenate(c) for c in zip(*held)]
    order = multikey_quicksort(columns)
    columns = [c[order] for c in columns]
    differs = [np.concatenate([[True], c[1:] != c[:-1]]) for c in columns]
    once = np.logical_or.reduce(differs)  # a repeated row is one document
    columns = [c[once] for c in columns]
    new_core = np.concatenate([[True], columns[0][1:] != columns[0][:-1]])
    new_full = new_core | np.concatenate([[True], columns[1][1:] != columns[1][:-1]])
    core_no, full_no = np.cumsum(new_core) - 1, np.cumsum(new_full) - 1
    mixed = np.bincount(core_no[new_full])[core_no] > 1
    shared = np.bincount(full_no)[full_no] > 1
    edge = (
        _FIRST_CORE * (core_no == 0) | _LAST_CORE * (core_no == core_no[-1]) | _FIRST_FULL * (full_no == 0) | _LAST_FULL * (full_no == full_no[-1])
    ).astype(np.int32)
    edge[0] |= _FIRST_ROW
    kept = mixed | shared | (edge > 0)
    ends = {
        "first_core": columns[0][0], "first_full": columns[1][0], "last_core": columns[0][-1], "last_full": columns[1][-1],
        "first_mixed": bool(mixed[0]), "last_mixed": bool(mixed[-1]), "one_core": bool(core_no[-1] == 0), "one_full": bool(full_no[-1] == 0),
    }
    ends = {k: v.item() if hasattr(v, "item") else v for k, v in ends.items()}
    kind = pa.struct([(k, pa.bool_() if isinstance(v, bool) else pa.int64()) for k, v in ends.items()])
    n, pid = int(kept.sum()), TaskContext.get().partitionId()
    flags = [pa.array(x[kept]) for x in (*columns, ~new_full, shared, mixed, edge)]
    summary = pa.concat_arrays([pa.array([ends], kind), pa.nulls(n - 1, kind)])
    yield pa.RecordBatch.from_arrays([*flags, pa.array(np.full(n, pid, np.int32)), summary], [*names, "again", "shared", "mixed", "edge", "pid", "ends"])


_FLAGS = (
    SUFFIX + ", again boolean, shared boolean, mixed boolean, edge int, pid int, ends struct<first_core: long, first_full: long, last_core: long,"
    " last_full: long, first_mixed: boolean, last_mixed: boolean, one_core: boolean, one_full: boolean>"
)


def _across(spark: SparkSession, ends: list) -> DataFrame:
    """What each bucket learns from its neighbours, by the first and last suffix of each (one row a bucket)."""
    ends = sorted(ends, key=lambda e: e.pid)
    n = len(ends)
    left, right, from_left, from_right = [False] * n, [False] * n, [False] * n, [False] * n
    for i in range(1, n):
        before, now = ends[i - 1], ends[i]
        if before.last_core == now.first_core:
            from_left[i] = before.last_full == now.first_full
            left[i] = not from_left[i] or before.last_mixed or (before.one_core and left[i - 1])
    for i in range(n - 2, -1, -1):
        now, after = ends[i], ends[i + 1]
        if now.last_core == after.first_core:
            from_right[i] = now.last_full == after.first_full
            right[i] = not from_right[i] or after.first_mixed or (after.one_core and right[i + 1])
    rows = [
        (e.pid, left[i] or (e.one_core and right[i]), right[i] or (e.one_core and left[i]), from_left[i], from_right[i]) for i, e in enumerate(ends)
    ]
    return spark.createDataFrame(rows, "pid int, first_mixed boolean, last_mixed boolean, from_left boolean, from_right boolean")


def compared(suffixes: DataFrame) -> DataFrame:
    """Suffixes that are not alone: key_id, tie, at, core, again (an equal stretch comes before), shared
    (an equal stretch is elsewhere) and mixed (the core has different stretches).

    Sampled splitters over all columns deal the suffixes out in ranges, so one core with a third of
    the rows spreads over many buckets; what crosses a border is settled from the borders' rows.
    """
    spark = suffixes.sparkSession
    table = stored(suffixes, "suffixes")
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), table.count() // BUCKET_ROWS + 1)
    dealt = table.repartitionByRange(buckets, "core", "full", "key_id", "tie", "at")
    flags = stored(partition_stage(dealt, _bucket, _FLAGS), "compared")
    # One row a bucket comes to the driver and goes back.
    ends = flags.filter("ends IS NOT NULL").select("pid", "ends.*").collect()
    known = flags.join(F.broadcast(_across(spark, ends)), "pid")

    def at_edge(bit: int, flag: str):
        return (F.col("edge").bitwiseAND(F.lit(bit)) != 0) & F.col(flag)

    return known.select(
        "key_id", "tie", "at", "core",
        (F.col("again") | at_edge(_FIRST_ROW, "from_left")).alias("again"),
        (F.col("shared") | at_edge(_FIRST_FULL, "from_left") | at_edge(_LAST_FULL, "from_right")).alias("shared"),
        (F.col("mixed") | at_edge(_FIRST_CORE, "first_mixed") | at_edge(_LAST_CORE, "last_mixed")).alias("mixed"),
    )


class Windows:
    """The windows of stretches of units: two hashes each, and where they are."""

    def __init__(self, stretches: list[bytes], kind: str, units: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]], width: int):
        raw = np.frombuffer(b"".join(stretches), kind)
        sizes = np.fromiter(map(len, stretches), np.int64, len(stretches)) // np.dtype(kind).itemsize
        begins = np.cumsum(sizes) - sizes
        counts = np.maximum(sizes - width + 1, 0)
        self.row = np.repeat(np.arange(len(stretches)), counts)
        self.step = np.arange(len(self.row)) - np.repeat(np.cumsum(counts) - counts, counts)
        at = begins[self.row] + self.step
        a, b = units(raw)
        self.a, self.b = Rolling(a, 0).of(at, at + width), Rolling(b, 1).of(at, at + width)


class Plan:
    """How a remover sees its texts: width of a window in units, dtype of a unit in a stretch, the two
    unit numbers, the units of texts, and whether the first occurrence stays."""

    def __init__(self, width: int, kind: str, numbers, cut: Callable[[list[bytes]], Iterator[tuple[int, np.ndarray]]], keep_first: bool):
        self.width, self.kind, self.numbers, self.cut, self.keep_first = width, kind, numbers, cut, keep_first


def _removed(plan: Plan, key: list[np.ndarray], place: list[np.ndarray], shared: np.ndarray) -> np.ndarray:
    """Which windows go: of those with equal keys all but the first place, or all if there are two places."""
    order = np.lexsort([*reversed(place), *reversed(key)])
    new = np.logical_or.reduce([np.concatenate([[True], k[order][1:] != k[order][:-1]]) for k in key]) if len(order) else np.empty(0, bool)
    if plan.keep_first:
        gone = ~new
    else:
        group = np.cumsum(new) - 1
        gone = (np.bincount(group, 1 + shared[order])[group] > 1) if len(order) else new
    out = np.empty(len(order), bool)
    out[order] = gone
    return out


def _runs(key_id: np.ndarray, tie: np.ndarray, start: np.ndarray, width: int) -> pa.RecordBatch:
    """Neighbouring windows of one text as stretches of units."""
    order = np.lexsort([start, tie, key_id])
    key_id, tie, start = key_id[order], tie[order], start[order]
    new = np.ones(len(start), bool)
    new[1:] = (key_id[1:] != key_id[:-1]) | (tie[1:] != tie[:-1]) | (start[1:] > start[:-1] + width)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    columns = [key_id[first], tie[first], start[first], start[last] + width] if len(first) else [key_id, tie, start, start]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["key_id", "tie", "begin", "end"])


_STRETCH = "core long, key_id long, tie int, start long, shared boolean, stretch binary"
_MARK = "key_id long, tie int, begin long, end long"


def marks(docs: DataFrame, suffixes: DataFrame, plan: Plan) -> DataFrame:
    """(key_id, tie, begin, end): stretches of units that removed windows cover; they may overlap."""
    width = plan.width
    found = compared(suffixes)
    low, last = F.shiftright("at", 8), F.shiftright("at", 8) + F.col("at").bitwiseAND(F.lit(255))
    whole = found.filter("again" if plan.keep_first else "shared").select("key_id", "tie", low.alias("begin"), (last + width).alias("end"))
    # One suffix of each stretch speaks for all of them; its windows are needed where its core has others.
    asked = found.filter("mixed AND NOT again").groupBy("key_id", "tie").agg(F.collect_list(F.struct("core", "at", "shared")).alias("asked"))

    def stretches(batch: pa.RecordBatch) -> pa.RecordBatch:
        size = np.dtype(plan.kind).itemsize
        rows: list[tuple] = []
        asked_of, ids, ties = (batch.column(c).to_pylist() for c in ("asked", "key_id", "tie"))
        for k, units in plan.cut(byte_list(batch.column("text"))):
            raw = units.tobytes()
            for ask in asked_of[k]:
                begin, end = ask["at"] >> 8, (ask["at"] >> 8) + (ask["at"] & 255) + width
                rows.append((ask["core"], ids[k], ties[k], begin, ask["shared"], raw[begin * size : end * size]))
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else ((),) * 6, kinds)], ["core", "key_id", "tie", "start", "shared", "stretch"])

    # Rows alike in both are one document: a second one would cut the same stretches again, as if they were other places.
    once = docs.join(asked, ["key_id", "tie"]).select("key_id", "tie", "text", "asked").dropDuplicates(["key_id", "tie"])
    rows = stored(arrow_stage(once, stretches, _STRETCH), "stretches")
    large = rows.groupBy("core").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CORE_ROWS).select("core")
    near = rows.join(large, "core", "left_anti").repartition("core").sortWithinPartitions("core")
    far = rows.join(large, "core", "left_semi")

    def of(batch: pa.RecordBatch) -> tuple:
        windows = Windows(batch.column("stretch").to_pylist(), plan.kind, plan.numbers, width)
        columns = [batch.column(c).to_numpy(zero_copy_only=False)[windows.row] for c in ("core", "key_id", "tie", "start", "shared")]
        columns[3] = columns[3] + windows.step
        return windows, columns

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _whole_cores(batches):
            windows, (core, key_id, tie, start, shared) = of(batch)
            gone = _removed(plan, [core, windows.a, windows.b], [key_id, tie, start], shared)
            gone &= ~shared if not plan.keep_first else True
            yield _runs(key_id[gone], tie[gone], start[gone], width)

    def each(batch: pa.RecordBatch) -> pa.RecordBatch:
        windows, (_, key_id, tie, start, shared) = of(batch)
        columns = [windows.a.view(np.int64), windows.b.view(np.int64), key_id, tie, start, shared]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["a", "b", "key_id", "tie", "start", "shared"])

    settled = partition_stage(near, compare, _MARK)
    single = arrow_stage(far.select(*[c.split()[0] for c in _STRETCH.split(", ")]), each, "a long, b long, key_id long, tie int, start long, shared boolean")
    place = F.struct("key_id", "tie", "start")
    groups = single.groupBy("a", "b").agg(F.min(place).alias("first"), F.sum(F.when(F.col("shared"), 2).otherwise(1)).alias("places"))
    gone = (place != F.col("first")) if plan.keep_first else (F.col("places") > 1) & ~F.col("shared")
    settled_far = single.join(groups, ["a", "b"]).filter(gone).select("key_id", "tie", F.col("start").alias("begin"), (F.col("start") + width).alias("end"))
    return whole.unionByName(settled).unionByName(settled_far)


def _whole_cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by core, in batches that do not cut a core's rows apart, some thousand rows each."""
    held: pa.Table | None = None
    for batch in batches:
        for at in range(0, batch.num_rows, CORE_ROWS):
            part = pa.Table.from_batches([batch.slice(at, CORE_ROWS)])
            held = part if held is None else pa.concat_tables([held, part])
            core = held.column("core").to_numpy()
            cut = int(np.searchsorted(core, core[-1], "left"))
            if cut:
                yield held.slice(0, cut).combine_chunks().to_batches()[0]
                held = held.slice(cut)
    if held is not None and held.num_rows:
        yield held.combine_chunks().to_batches()[0]


def with_marks(docs: DataFrame, found: DataFrame) -> DataFrame:
    """Every document with its marks: doc_id, text, marks (null if it has none)."""
    lists = found.groupBy("key_id", "tie").agg(F.collect_list(F.struct("begin", "end")).alias("marks"))
    return docs.join(lists, ["key_id", "tie"], "left").select("doc_id", "text", "marks")


def spans(found: list[dict] | None) -> list[tuple[int, int]]:
    """Overlapping and touching stretches as one, in order."""
    out: list[tuple[int, int]] = []
    for begin, end in sorted((m["begin"], m["end"]) for m in found or ()):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out
