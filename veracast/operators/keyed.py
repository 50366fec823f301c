"""Per-key operators that stay whole and spread out when one key holds much of the data.

`max_by`/`min_by` aggregates combine inside each input partition before the shuffle, so a hot
key sends one row per partition. Joins that attach per-key values to many rows take the hottest
keys from a broadcast list of fixed length. Last-N windows run in two rounds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

HOT_KEYS = 1000
ROUND_ONE_GROUPS = 256


def present(key: str | Column) -> Column:
    """The id is neither missing nor empty."""
    column = F.col(key) if isinstance(key, str) else key
    return F.coalesce(column.cast("string"), F.lit("")) != ""


def dedupe_latest(
    df: DataFrame, key: str, seq: str = "seq", kept: Column | None = None, watch: Callable[[DataFrame], DataFrame] | None = None, own_id: Column | None = None
) -> DataFrame:
    """The last of the `kept` rows per id in input order; rows without an id go. `first_seq` keeps the
    place where the id first appeared, which decides ties later on.

    `watch` is shown one row per id before ids without a kept row go: `_rows` (all rows), `_own` (those
    with an id of their own, `own_id`) and `_kept`. What it measures there costs no further pass."""
    others = [name for name in df.columns if name != key]
    if watch is None:
        rows = df.where(present(key)) if kept is None else df.where(present(key) & kept)
        grouped = rows.groupBy(key).agg(F.max_by(F.struct(*others), F.col(seq)).alias("_row"), F.min(seq).alias("first_seq"))
        return grouped.select(key, "_row.*", "first_seq")
    place = F.col(seq) if kept is None else F.when(kept, F.col(seq))
    grouped = df.withColumn(key, F.when(present(key), F.col(key))).groupBy(key).agg(
        F.max_by(F.struct(*others), place).alias("_row"),
        F.min(place).alias("first_seq"),
        F.count(F.lit(1)).alias("_rows"),
        F.count_if(present(key) if own_id is None else own_id).alias("_own"),
        F.count(place).alias("_kept"),
    )
    return watch(grouped).where(present(key) & (F.col("_kept") > 0)).select(key, "_row.*", "first_seq")


def latest_per_key(df: DataFrame, keys: Sequence[str], newest: Sequence[Column]) -> DataFrame:
    """The row per key with the largest `newest` tuple."""
    others = [name for name in df.columns if name not in keys]
    return (
        df.groupBy(*keys)
        .agg(F.max_by(F.struct(*others), F.struct(*newest)).alias("_row"))
        .select(*keys, "_row.*")
    )


def last_n(df: DataFrame, keys: Sequence[str], newest_first: Sequence[Column], n: int, rank_col: str = "recency") -> DataFrame:
    """The newest `n` rows per key, numbered from 1.

    Round one ranks inside groups of input partitions: every partition first keeps its own newest
    `n` per key, then a group of partitions does. Round two ranks the few rows left. A key with a
    third of all rows thus reaches no single task whole.
    """
    grouped = df.withColumn("_group", F.spark_partition_id() % F.lit(ROUND_ONE_GROUPS))
    first = Window.partitionBy(*keys, "_group").orderBy(*newest_first)
    second = Window.partitionBy(*keys).orderBy(*newest_first)
    return (
        grouped.withColumn(rank_col, F.row_number().over(first))
        .where(F.col(rank_col) <= n)
        .drop("_group")
        .withColumn(rank_col, F.row_number().over(second))
        .where(F.col(rank_col) <= n)
    )


def attach_per_key(
    rows: DataFrame,
    lookup: DataFrame,
    keys: Sequence[str],
    row_id: Sequence[str],
    weights: DataFrame | None = None,
) -> DataFrame:
    """Left join of one lookup row per key onto many rows per key, without piling a hot key up.
    A lookup with several rows of a key would multiply rows: callers reduce it first.

    The HOT_KEYS keys with the most rows are read off a key count and their lookup rows are
    broadcast: a list of fixed length whatever the data size. Rows of those keys, and rows without
    a key, are answered by it and get a hash of their row id beside the join key, so that they
    spread evenly in the shuffled join that serves all other keys. `weights` may hand in key
    counts (`_weight`) already made.
    """
    values = [name for name in lookup.columns if name not in keys]
    counts = weights if weights is not None else rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_weight"))
    hottest = counts.orderBy(F.desc("_weight"), *keys).limit(HOT_KEYS).select(*keys)
    found = lookup.join(F.broadcast(hottest), list(keys), "left_semi")
    hot = hottest.join(F.broadcast(found), list(keys), "left").select(
        *keys, F.lit(True).alias("_hot"), *[F.col(name).alias(f"_hot_{name}") for name in values]
    )
    # An odd hash never equals the 0 of the lookup side, so these rows match nothing there.
    unmatched = F.col("_hot")
    for key in keys:
        unmatched = unmatched | F.col(key).isNull()
    spread = F.when(unmatched, F.xxhash64(*row_id).bitwiseOR(F.lit(1))).otherwise(F.lit(0).cast("bigint"))
    marked = rows.join(F.broadcast(hot), list(keys), "left").withColumn("_spread", spread)
    cold = lookup.withColumn("_spread", F.lit(0).cast("bigint"))
    joined = marked.join(cold, [*keys, "_spread"], "left")
    kept = [name for name in rows.columns]
    return joined.select(
        *kept, *[F.when(F.col("_hot"), F.col(f"_hot_{name}")).otherwise(F.col(name)).alias(name) for name in values]
    )


def global_rank(df: DataFrame, order: Sequence[Column], rank_col: str = "rank") -> DataFrame:
    """Rank 1..n over the whole table without a one-partition window.

    The sorted rows are written to the shared folder with their position inside their range
    partition; the row counts of the earlier partitions, one number per partition, are broadcast
    and added. `order` must be a total order.
    """
    placed = cut_lineage(df.orderBy(*order).withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", 33))
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    inside = F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    ranked = placed.join(F.broadcast(offsets), "_part")
    return ranked.withColumn(rank_col, F.col("_before") + inside + 1).select(rank_col, *df.columns)


def id_counts(df: DataFrame, key: str, kept: Column | None = None) -> DataFrame:
    """One row: rows read, surplus rows of repeated ids, distinct ids, and ids of which no row was
    kept. One pass with counts per id takes the place of a set difference of two id lists."""
    kept_row = F.lit(True) if kept is None else kept
    per_id = df.groupBy(F.col(key).alias("_id")).agg(
        F.count(F.lit(1)).alias("_rows"), F.max(kept_row.cast("int")).alias("_kept")
    )
    has_id = present("_id")
    return per_id.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("raw_rows"),
        F.coalesce(F.sum(F.when(has_id, F.col("_rows") - 1)), F.lit(0)).alias("duplicate_rows"),
        F.count_if(has_id).alias("distinct_ids"),
        F.count_if(has_id & (F.col("_kept") == 0)).alias("removed_ids"),
    )


def count_duplicates(df: DataFrame, key: str) -> DataFrame:
    return id_counts(df, key).select("duplicate_rows")


def removed_ids(raw: DataFrame, clean: DataFrame, key: str) -> DataFrame:
    """Ids of the raw table that the clean table no longer has."""
    return raw.where(present(key)).select(key).distinct().join(clean.select(key).distinct(), key, "left_anti")


def first_non_empty(*sources: DataFrame | Callable[[], DataFrame]) -> DataFrame:
    """The first source with a row, else the last one. A source given as a function is planned when its turn comes."""
    for source in sources:
        rows = source() if callable(source) else source
        if source is sources[-1] or not rows.isEmpty():
            return rows
